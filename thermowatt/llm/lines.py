"""Deduplication of fuzzy lines by MinHash.

A line takes part if it has at least ``MIN_CHARS`` characters after trimming.
Lines are lower-cased, with runs of blanks as one; equal ones share a 64-bit
identifier. Each distinct line has a signature of ``BANDS * ROWS`` minima over
hashes of its character shingles, cut into bands. With 10 bands of 4, a pair of
similarity 0.8 meets with probability 0.995, one of 0.9 surely. Every pair that
meets in a band is settled, in two steps. First each member is compared with
the smallest identifier of its bucket and with its neighbour in the order of
identifiers; verified links become components. Then, in each bucket that
components still divide, all members of different components are compared, but
for pairs that a prefix filter proves unlike: of two lines that are similar,
the rarest shingles of both overlap. So lines with one template and unlike rest
don't cost a comparison each. Candidates are verified by their exact Jaccard
similarity; components come from distributed union-find, and of every
component the first line stays, by doc_id and line number.

Links between buckets join roots of the first components; only these few go
through union-find once more.

Entries of a line that comes again in a task are sent on once. They travel as
arrays, one row per task and target group. A bucket that is still divided is
settled in one task, as much as its lines share with each other. Bitmaps of
shingles spare most unlike pairs the count of common ones: each bit in which two
differ stands for a shingle that only one line has.

Only places of lines that come again or are in a pair are shuffled, and only
texts of the latter.

Defined results: a null text has no lines. A null doc_id counts as larger than
any other. Rows that repeat both doc_id and text count as one document. Extra
columns are kept. Order and line breaks of what stays are unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import stored
from .components import components

SHINGLE = 6
MIN_CHARS = 20
SIMILARITY = 0.8
BANDS, ROWS = 10, 4
SEED = 20240101
#: Groups that band entries are dealt to, for each shuffle partition.
GROUPS_PER_PARTITION = 8

#: Members up to which a divided bucket's common shingles are counted, without a filter; asking lines at once.
SMALL_BUCKET = 16_384
_ASKING = 512
#: Bits of the filter for lines whose texts are wanted: 4 MB, whatever the input.
FILTER_BITS = 1 << 25
#: Members up to which a divided bucket's pairs are all compared by bitmaps; pairs a member that may be left by these.
FEW_MEMBERS = 64
LEFT_PAIRS = 4
#: Pairs compared at once.
_PAIRS = 1 << 12
#: Time to sort a shingle of a pair's lines by that of one product of the table of a block's shingles.
_SORT_COST = 250
#: Bits of a line's bitmap of shingles.
SKETCH_BITS = 4096
#: Lines whose text a task remembers to have sent on.
_SENT_LINES = 1 << 18

_FLUSH_ENTRIES = 4_000_000
_FLUSH_CHARS = 1 << 17
_BLOCK_CHARS = 1 << 15
_MET_SHINGLES = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_SQUARED = np.uint64(int(_BASE) ** 2 % 2**64)
_random = np.random.default_rng(SEED)
_FACTORS = (_random.integers(1, 1 << 31, BANDS * ROWS, np.uint32) << np.uint32(1)) | np.uint32(1)
_TERMS = _random.integers(0, 1 << 32, BANDS * ROWS, np.uint32)
_BAND_FACTORS = _random.integers(1, 1 << 62, BANDS, np.uint64) << np.uint64(1) | np.uint64(1)


def normal_line(line: str) -> str:
    """What is compared; empty if the line takes no part."""
    out = line.lower().strip()
    # Every white space but a blank counts as not printable.
    if "  " in out or not out.isprintable():
        out = " ".join(out.split())
    return out if len(out) >= MIN_CHARS else ""


def normal_lines(text: str | None) -> list[str]:
    """``normal_line`` of every line of a text; looked at line by line only where the text needs it."""
    lower = (text or "").lower()
    if "  " in lower or not lower.replace("\n", "").isprintable():
        return [normal_line(x) for x in lower.split("\n")]
    return [x if len(x) >= MIN_CHARS else "" for x in map(str.strip, lower.split("\n"))]


def line_id(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle, start of each line's); lines of at least ``SHINGLE`` characters."""
    code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(x) for x in lines], np.int64)
    two = code[:-1] * _BASE
    two += code[1:]
    four = two[:-2] * _BASE_SQUARED
    four += two[2:]
    six = four[:-2] * _BASE_SQUARED
    six += two[4:]
    six ^= np.right_shift(six, np.uint64(31), out=four[:-2])
    six *= np.uint64(0xD6E8FEB86659FD93)
    # Shingles that run over the end of a line belong to none.
    ends = np.cumsum(lengths)
    good = np.ones(len(six), bool)
    for back in range(1, SHINGLE):
        good[ends[:-1] - back] = False
    return six[good], np.concatenate(([0], np.cumsum(lengths - SHINGLE + 1)[:-1]))


def _blocks(lines: list[str]) -> Iterator[list[str]]:
    """``lines`` in parts of some ``_BLOCK_CHARS``, whose hashes fit a processor's cache."""
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)))
    at = 0
    while at < len(lines):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _BLOCK_CHARS)) + 1
        yield lines[at:stop]
        at = stop


def band_keys(lines: list[str]) -> np.ndarray:
    """Keys [lines, BANDS] of the buckets that lines fall into."""
    with np.errstate(over="ignore"):
        hashes, starts = shingle_hashes(lines)
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        keys, mixed = np.empty((len(lines), BANDS), np.uint64), np.empty_like(low)
        for band in range(BANDS):
            key = np.full(len(lines), band + 1, np.uint64)
            for row in range(band * ROWS, band * ROWS + ROWS):
                np.multiply(low, _FACTORS[row], out=mixed)
                np.add(mixed, _TERMS[row], out=mixed)
                key = (key ^ np.minimum.reduceat(mixed, starts)) * _BAND_FACTORS[band]
                key ^= key >> np.uint64(29)
            keys[:, band] = key
    return keys


def candidates(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b) from each bucket's members to its smallest and to the one before, and which entries are a bucket's first or last.

    Entries must be sorted by key and id, without repeats.
    """
    first = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
    leader = ids[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(keys) else ids
    rest = np.flatnonzero(~first)
    later = rest[leader[rest] != ids[rest - 1]]
    a = np.concatenate((ids[rest], ids[later]))
    b = np.concatenate((leader[rest], ids[later - 1]))
    last = np.concatenate((first[1:], [True])) if len(keys) else first
    return a, b, first | last


def _sorted_distinct(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, ids) without repeats, and the ids that had some."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    return keys[new], ids[new], np.unique(ids[~new])


def _entries(groups: int):
    """Task that turns (text) rows into band entries (key, line) by group, and lines that come again without keys."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_keys, held_ids, seen, again = [], [], set(), set()
        waiting: list[str] = []
        chars = 0

        def sign() -> None:
            nonlocal waiting, chars
            if waiting:
                keys = band_keys(waiting)
                ids = np.array([line_id(x) for x in waiting], np.int64)
                held_keys.append(keys.view(np.int64).ravel())
                held_ids.append(np.repeat(ids, BANDS))
            waiting, chars = [], 0

        def flush() -> Iterator[pd.DataFrame]:
            nonlocal held_keys, held_ids
            sign()
            if not held_keys:
                return
            keys, ids = np.concatenate(held_keys), np.concatenate(held_ids)
            held_keys, held_ids = [], []
            if again:
                ids_again = np.fromiter(map(line_id, again), np.int64, len(again))
                yield pd.DataFrame({"part": [int(ids_again[0]) % groups], "keys": [None], "ids": [ids_again]})
            seen.clear()
            again.clear()
            part = (keys.view(np.uint64) >> np.uint64(8)) % np.uint64(groups)
            part = part.astype(np.min_scalar_type(groups))  # small numbers are sorted digit by digit
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(groups + 1, dtype=part.dtype))
            rows = []
            for g in np.flatnonzero(np.diff(cuts)).tolist():
                own = order[cuts[g] : cuts[g + 1]]
                rows.append((g, keys[own], ids[own]))
            for at in range(0, len(rows), 64):
                yield pd.DataFrame(rows[at : at + 64], columns=["part", "keys", "ids"])

        for pdf in batches:
            for text in pdf["text"]:
                for line in normal_lines(text):
                    if line in seen:
                        again.add(line)
                    elif line:
                        seen.add(line)
                        waiting.append(line)
                        chars += len(line)
                        if chars > _FLUSH_CHARS:
                            sign()
                            if len(held_keys) and sum(map(len, held_ids)) > _FLUSH_ENTRIES or len(seen) > 200_000:
                                yield from flush()
        yield from flush()

    return run


def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """First candidates as arrays (a, b) without a key, buckets of three or more as (key, members), lines that come again as (a)."""
    signed = pdf["keys"].notna()
    empty = [np.zeros(0, np.int64)]
    keys, ids, again = _sorted_distinct(
        np.concatenate(empty + pdf.loc[signed, "keys"].to_list()), np.concatenate(empty + pdf.loc[signed, "ids"].to_list())
    )
    again = np.unique(np.concatenate([again, *pdf.loc[~signed, "ids"]]))
    a, b, _ = candidates(keys, ids)
    pairs = pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)}).drop_duplicates().to_numpy()
    rows = [(None, pairs[at : at + 65536, 0], pairs[at : at + 65536, 1]) for at in range(0, len(pairs), 65536)]
    rows += [(None, again[at : at + 65536], None) for at in range(0, len(again), 65536)]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(first)
    stops = np.append(starts[1:], len(keys))
    large = stops - starts > 2
    for i, j in zip(starts[large].tolist(), stops[large].tolist()):
        rows.append((int(keys[i]), ids[i:j], None))
    return pd.DataFrame(rows, columns=["key", "a", "b"]).astype({"key": "Int64"})


def buckets(docs: DataFrame) -> DataFrame:
    """See ``_meet``."""
    spark = docs.sparkSession
    groups = GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = docs.select("text").mapInPandas(_entries(groups), "part int, keys array<long>, ids array<long>")
    return entries.groupBy("part").applyInPandas(_meet, "key long, a array<long>, b array<long>")


def _occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Places of lines with their contents, and what identifies the document if it is given."""
    for pdf in batches:
        for at in range(0, len(pdf), 512):
            docs, contents, numbers, counts = pdf.iloc[at : at + 512], [], [], []
            for text in docs["text"]:
                own = [(line, no) for no, line in enumerate(normal_lines(text)) if line]
                contents += [line for line, _ in own]
                numbers += [no for _, no in own]
                counts.append(len(own))
            out = pd.DataFrame({
                "line": np.fromiter(map(line_id, contents), np.int64, len(contents)),
                "line_no": np.array(numbers, np.int32), "content": np.array(contents, object),
            })
            for c in ("doc_id", "doc_key"):
                if c in docs:
                    out[c] = docs[c].repeat(counts).reset_index(drop=True).astype("Int64")
            yield out


def _filter(wanted: DataFrame) -> np.ndarray:
    """Bits of ``FILTER_BITS`` that tell which remainders wanted lines have; bounded, so it tells less of very many lines."""
    place = F.col("line").bitwiseAND(FILTER_BITS - 1)
    words = wanted.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(line & 63 AS int))")).alias("bits")
    ).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def passed(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which lines may be wanted; all that are."""
    return (bits[(ids & (FILTER_BITS - 1)) >> 6] >> (ids & 63) & 1).astype(bool)


def _lines_of(bits):
    """Task that turns (text) rows into the lines that pass the filter that ``bits`` broadcasts, each once as far as it remembers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent: set[int] = set()
        for pdf in _occurrences(batches):
            if len(sent) > _SENT_LINES:
                sent.clear()
            ids = pdf["line"].to_numpy()
            new = passed(bits.value, ids) & ~pdf["line"].duplicated().to_numpy()
            new[new] = [x not in sent for x in ids[new].tolist()]
            sent.update(ids[new].tolist())
            yield pdf.loc[new, ["line", "content"]]

    return run


def _places_of(*filters):
    """Task that turns (doc_id, doc_key, text) rows into the places of lines that pass one of the broadcast filters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _occurrences(batches):
            ids = pdf["line"].to_numpy()
            yield pdf.loc[np.any([passed(bits.value, ids) for bits in filters], axis=0), ["line", "doc_id", "doc_key", "line_no"]]

    return run


def shingles(line: str, start: int = 0, stop: int | None = None) -> set[str]:
    """Shingles that begin in [start, stop)."""
    last = len(line) - SHINGLE + 1
    return {line[i : i + SHINGLE] for i in range(start, last if stop is None else min(stop, last))}


def jaccard(a: str, b: str) -> float:
    x, y = shingles(a), shingles(b)
    both = len(x & y)
    return both / (len(x) + len(y) - both)


def similar(a: str, y: set[str]) -> bool:
    """Whether the shingles of ``a`` and ``y`` have a Jaccard similarity of at least ``SIMILARITY``.

    At that similarity less than a fifth of the places of ``a`` can begin a
    shingle that is not in ``y``, and ``a`` has places for most of ``y``; parts
    of ``a`` that show otherwise end the comparison early.
    """
    places = len(a) - SHINGLE + 1
    if places < SIMILARITY * len(y) - 1e-6:
        return False
    x: set[str] = set()
    for start, stop in ((0, places // 4), (places // 4, places // 2), (places // 2, places)):
        x |= shingles(a, start, stop)
        if len(x - y) > places - SIMILARITY * places + 1e-6:
            return False
    both = len(x & y)
    return both / (len(x) + len(y) - both) >= SIMILARITY


def _distinct_shingles(contents: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, line) of the distinct shingles of each line, sorted by hash; hashes leave the bits that number the lines."""
    hashes, starts = shingle_hashes(contents)
    bits = np.uint64(max(1, (len(contents) - 1).bit_length()))
    line = np.repeat(np.arange(len(contents), dtype=np.uint64), np.diff(np.append(starts, len(hashes))))
    both = np.sort(hashes >> bits << bits | line)
    both = both[np.concatenate(([True], both[1:] != both[:-1]))]
    return both >> bits, (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def similar_pairs(contents: list[str], asking: np.ndarray, root: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of an asking line and another one whose hashed shingles are similar, each pair of two asking lines once.

    With ``root``, pairs of one root are left out. Bitmaps tell most pairs apart. What they leave is counted pair by
    pair or, if it is much, as common shingles of a block of asking lines and all lines at once.
    """
    hashes, line = _distinct_shingles(contents)
    n = len(contents)
    sizes = np.bincount(line, minlength=n)
    token = np.cumsum(np.concatenate(([False], hashes[1:] != hashes[:-1])))
    place = np.full(n, n)
    counts = np.bincount(token)
    words = np.ascontiguousarray(sketches(contents)[0].T)
    for at in range(0, len(asking), _ASKING):
        block = asking[at : at + _ASKING]
        place[block] = np.arange(at, at + len(block))
        # Lines that asked before have met these already.
        open_ = place[None, :] >= np.arange(at, at + len(block))[:, None]
        open_[np.arange(len(block)), block] = False
        if root is not None:
            open_ &= root[block][:, None] != root[None, :]
        step = max(1, _MET_SHINGLES // n)
        for low in range(0, len(block), step):
            some = block[low : low + step]
            differing = np.zeros((len(some), n), np.int32)
            for word in words:
                differing += np.bitwise_count(word[some][:, None] ^ word[None, :])
            open_[low : low + step] &= differing <= _most_different(sizes[some][:, None] + sizes[None, :] + 2)
        i, j = np.nonzero(open_)
        if not len(i):
            continue
        row = np.full(n, -1)
        row[block] = np.arange(len(block))
        # Shingles of one line alone, or of none that asks, are common to no pair.
        wanted = np.zeros(len(counts), bool)
        wanted[token[row[line] >= 0]] = True
        wanted &= counts > 1
        own = wanted[token]
        names, lines_of = (np.cumsum(wanted) - 1)[token[own]], line[own]
        total = int(wanted.sum())
        if _SORT_COST * int(sizes[block[i]].sum() + sizes[j].sum()) <= len(block) * n * total:
            pairs = np.array((block[i], j)).T
            for low in range(0, len(pairs), 1024):
                some = pairs[low : low + 1024]
                some = some[_alike_of(contents, *some.T)]
                yield some[:, 0], some[:, 1]
            continue
        common = np.zeros((len(block), n), np.float32)
        step = max(1, min(total, _FLUSH_ENTRIES // n))
        for low in range(0, total, step):
            part = slice(*np.searchsorted(names, [low, low + step]))
            has = np.zeros((n, step), np.float32)
            has[lines_of[part], names[part] - low] = 1
            common += has[block] @ has.T
        good = open_ & (common >= SIMILARITY * (sizes[block][:, None] + sizes[None, :] - common) - 1e-3)
        i, j = np.nonzero(good)
        yield block[i], j


def common_shingles(contents: list[str], pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(how many hashed shingles the lines of each pair (i, j) have in common, how many distinct ones each line has).

    Hashes have 44 bits here, so that a number of a line or pair fits in front of them; at most 2**20 lines.
    """
    bits, low = np.uint64(44), np.uint64((1 << 44) - 1)
    parts, done = [np.zeros(0, np.uint64)], 0
    for part in _blocks(contents):
        with np.errstate(over="ignore"):
            hashes, starts = shingle_hashes(part)
        line = np.repeat(np.arange(done, done + len(part), dtype=np.uint64), np.diff(np.append(starts, len(hashes))))
        own = np.sort(line << bits | hashes >> np.uint64(20))
        parts.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        done += len(part)
    own = np.concatenate(parts)
    sizes = np.bincount((own >> bits).astype(np.int64), minlength=len(contents))
    own &= low
    begins, common = np.cumsum(sizes) - sizes, np.zeros(len(pairs), np.int64)
    ends = np.cumsum(sizes[pairs].sum(axis=1))
    at = stop = 0
    while stop < len(pairs):
        at, stop = stop, int(np.searchsorted(ends, (ends[stop - 1] if stop else 0) + _MET_SHINGLES)) + 1
        part = pairs[at:stop]
        counts = sizes[part].ravel()
        places = np.arange(counts.sum()) + np.repeat(begins[part].ravel() - (np.cumsum(counts) - counts), counts)
        pair = np.repeat(np.arange(len(part), dtype=np.uint64).repeat(2), counts)
        # What both lines of a pair have comes twice among the shingles of the two.
        met = np.sort(pair << bits | own[places])
        both = met[1:][met[1:] == met[:-1]] >> bits
        common[at:stop] = np.bincount(both.astype(np.int64), minlength=len(part))
    return common, sizes


def sketches(contents: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bitmap of the hashed shingles of each line, how many places for shingles it has)."""
    out = np.empty((len(contents), SKETCH_BITS // 64), np.uint64)
    shift = np.uint64(64 - SKETCH_BITS.bit_length() + 1)
    done = 0
    for part in _blocks(contents):
        with np.errstate(over="ignore"):
            hashes, starts = shingle_hashes(part)
        first = np.repeat(np.arange(len(part)) * SKETCH_BITS, np.diff(np.append(starts, len(hashes))))
        has = np.zeros(len(part) * SKETCH_BITS, bool)
        has[first + (hashes >> shift).astype(np.int64)] = True
        out[done : done + len(part)] = np.packbits(has).view(np.uint64).reshape(len(part), -1)
        done += len(part)
    return out, np.array([len(x) - SHINGLE + 1 for x in contents], np.int64)


def _most_different(both: np.ndarray) -> np.ndarray:
    """How many shingles two similar lines that have ``both`` distinct ones, counted for each, can have alone: (1 - S) / (1 + S) of them."""
    return (1 - SIMILARITY) / (1 + SIMILARITY) * both + 1e-6


def may_be_similar(bitmaps: np.ndarray, places: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs (a, b) can be similar; all that are.

    Bitmaps don't differ in more bits than the lines in shingles, and there are no more shingles than places.
    """
    differing = np.bitwise_count(bitmaps[a] ^ bitmaps[b]).sum(axis=1, dtype=np.int64)
    return differing <= _most_different(places[a] + places[b])


def alike(contents: list[str], pairs: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) of lines are similar; at most 2**20 lines."""
    if not len(pairs):
        return np.zeros(0, bool)
    common, sizes = common_shingles(contents, pairs)
    over = common - SIMILARITY * (sizes[pairs].sum(1) - common)
    good = over >= -1e-6
    # Equal hashes of different shingles could change the count by one or two; the shingles themselves tell.
    for k in np.flatnonzero(np.abs(over) < 4).tolist():
        good[k] = similar(contents[pairs[k, 0]], shingles(contents[pairs[k, 1]]))
    return good


def _alike_of(contents: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``alike`` of the pairs (a, b), over the lines that are in one of them."""
    own, pairs = np.unique(np.concatenate((a, b)), return_inverse=True)
    return alike([contents[i] for i in own.tolist()], pairs.reshape(2, -1).T)


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), 1024):
            part = pdf.iloc[at : at + 1024]
            both = np.concatenate((part["content_a"].to_numpy(), part["content_b"].to_numpy()))
            _, at_first, place = np.unique(part[["a", "b"]].to_numpy().T.ravel(), return_index=True, return_inverse=True)
            contents, (a, b) = both[at_first].tolist(), place.reshape(2, -1)
            left = np.flatnonzero(may_be_similar(*sketches(contents), a, b))
            yield part.iloc[left[_alike_of(contents, a[left], b[left])]][["a", "b"]]


def _by_rarity(contents: list[str]) -> Iterator[np.ndarray]:
    """The distinct shingles of each line, hashed, those first that are rare among all the lines."""
    shift = np.uint64(48 if len(contents) < 4096 else 44)
    counts = np.zeros(1 << (64 - int(shift)), np.int64)
    parts = [contents[at : at + 1024] for at in range(0, len(contents), 1024)]
    with np.errstate(over="ignore"):
        for part in parts:
            counts += np.bincount((shingle_hashes(part)[0] >> shift).astype(np.int64), minlength=len(counts))
        for part in parts:
            hashes, starts = shingle_hashes(part)
            for own in np.split(hashes, starts[1:]):
                own = np.unique(own)
                yield own[np.lexsort((own, counts[(own >> shift).astype(np.int64)]))]


def settle(contents: list[str], roots: list[int]) -> list[tuple[int, int]]:
    """Links (i, j) that connect all similar lines, directly or over others; lines of one root are connected already.

    Of similar x and y, x with no more shingles than y, at least 2 S / (1 + S) of x's shingles and S of y's are
    common to both (S the similarity). In any one order of shingles, the first of x up to the share that may be
    missing, and the first of y, therefore have one in common.
    """
    names = {r: i for i, r in enumerate(dict.fromkeys(roots))}
    up = list(range(len(names)))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    of = [names[r] for r in roots]
    links: list[tuple[int, int]] = []

    if len(contents) <= SMALL_BUCKET:
        # Of two roots one is not the largest, so only lines outside the largest look others up.
        root = np.array(of)
        for a, b in similar_pairs(contents, np.flatnonzero(root != np.bincount(root).argmax()), root):
            for i, j in zip(a.tolist(), b.tolist()):
                if find(of[i]) != find(of[j]) and similar(contents[i], shingles(contents[j])):
                    up[find(of[i])] = find(of[j])
                    links.append((i, j))
        return links
    kept, probes, sizes = [], [], np.zeros(len(contents), np.int64)
    for i, own in enumerate(_by_rarity(contents)):
        n = sizes[i] = len(own)
        kept.append(own[: n - math.ceil(2 * SIMILARITY / (1 + SIMILARITY) * n - 1e-6) + 1])
        probes.append(own[: n - math.ceil(SIMILARITY * n - 1e-6) + 1])
    # Shingle -> root -> lines: what has the root of the line that looks is passed over as a whole.
    index: dict[int, dict[int, list[int]]] = {}
    for j in np.argsort(sizes, kind="stable").tolist():
        met: set[int] = set()
        mine = find(of[j])
        for token in probes[j].tolist():
            for root, members in index.get(token, {}).items():
                if find(root) != mine:
                    met.update(members)
        least, own = SIMILARITY * sizes[j] - 1e-6, None
        for i in sorted(i for i in met if sizes[i] >= least):
            if find(of[i]) != find(of[j]):
                own = shingles(contents[j]) if own is None else own
                if similar(contents[i], own):
                    up[find(of[i])] = find(of[j])
                    links.append((i, j))
        for token in kept[j].tolist():
            index.setdefault(token, {}).setdefault(of[j], []).append(j)
    return links


def _bucket_pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first rows of some buckets of one size, all pairs (i, j) of rows of each), ``_PAIRS`` at once where buckets are smaller."""
    for n in np.unique(sizes).tolist():
        a, b = np.triu_indices(n, 1)
        own = starts[sizes == n]
        step = max(1, _PAIRS // max(1, len(a)))
        for at in range(0, len(own), step):
            first = own[at : at + step]
            yield first, first[:, None] + a, first[:, None] + b


def _settled(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links of all buckets of a part, as roots of the lines linked."""
    pdf = pdf.sort_values("key", kind="stable")
    key, roots, contents = pdf["key"].to_numpy(), pdf["root"].to_numpy(), pdf["content"].tolist()
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(starts, len(key)))
    few = sizes <= FEW_MEMBERS
    rows, found, whole = [], [np.zeros(0, np.int64)], [*zip(starts[~few].tolist(), sizes[~few].tolist())]

    # A line that is in several buckets is one here.
    line, at_few = np.full(len(key), -1), np.flatnonzero(np.repeat(few, sizes))
    _, at_first, line[at_few] = np.unique(pdf["line"].to_numpy()[at_few], return_index=True, return_inverse=True)
    own_roots, texts = roots[at_few[at_first]], [contents[i] for i in at_few[at_first].tolist()]
    bitmaps, places = sketches(texts)
    for first, i, j in _bucket_pairs(starts[few], sizes[few]):
        left = roots[i] != roots[j]
        left[left] = may_be_similar(bitmaps, places, line[i[left]], line[j[left]])
        # Where bitmaps tell too few pairs apart, common shingles are counted for the whole bucket.
        n = int(sizes[np.searchsorted(starts, first[0])])
        many = left.sum(axis=1) > LEFT_PAIRS * n
        whole += [(at, n) for at in first[many].tolist()]
        left[many] = False
        low, high = np.sort(np.array((line[i[left]], line[j[left]])), axis=0)
        found.append(np.unique(low * len(texts) + high))
    a, b = np.divmod(np.unique(np.concatenate(found)), max(1, len(texts)))
    for at in range(0, len(a), 1024):
        some = slice(at, at + 1024)
        good = _alike_of(texts, a[some], b[some])
        rows += zip(own_roots[a[some][good]].tolist(), own_roots[b[some][good]].tolist())
    for i, n in whole:
        own = roots[i : i + n].tolist()
        rows += [(own[a], own[b]) for a, b in settle(contents[i : i + n], own)]
    return pd.DataFrame(rows, columns=["a", "b"]).astype("int64").drop_duplicates()


def _found(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node, root) of lines that the first links connect, links (a, b) that connect roots or lines without a link, and places.

    Places are those of all lines that come again or are in a pair of candidates; others may be among them.
    """
    met = stored(buckets(docs), "line-buckets")
    pairs = stored(met.where("key IS NULL AND b IS NOT NULL").selectExpr("inline(arrays_zip(a, b))").distinct(), "line-pairs")
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct(), "line-wanted")
    # Most lines are in no pair and come once: filters spare them the shuffle, joins settle the rest.
    share = docs.sparkSession.sparkContext.broadcast
    in_pair = share(_filter(wanted))
    repeated = share(_filter(met.where("key IS NULL AND b IS NULL").select(F.explode("a").alias("line"))))
    places = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("doc_key"), "text").mapInPandas(
        _places_of(in_pair, repeated), "line long, doc_id long, doc_key long, line_no int"
    )
    texts = docs.select("text").mapInPandas(_lines_of(in_pair), "line long, content string")
    texts = texts.join(wanted, "line", "left_semi").dropDuplicates(["line"])
    texts = stored(texts, "line-texts")
    both = pairs.join(texts.select(F.col("line").alias("a"), F.col("content").alias("content_a")), "a").join(
        texts.select(F.col("line").alias("b"), F.col("content").alias("content_b")), "b"
    )
    first = stored(components(both.mapInPandas(_verified, "a long, b long"), "a", "b"), "line-first-roots")

    # Buckets that components still divide; those with the same members are one.
    members = met.where("key IS NOT NULL").groupBy(F.col("a").alias("members")).agg(F.min("key").alias("key"))
    members = members.select("key", F.explode("members").alias("line")).join(first.withColumnRenamed("node", "line"), "line", "left")
    members = stored(members.select("key", "line", F.coalesce("root", "line").alias("root")), "line-members")
    divided = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    divided = members.join(stored(divided, "line-divided"), "key").join(texts, "line")
    parts = GROUPS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = divided.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
    more = parted.groupBy("part").applyInPandas(_settled, "a long, b long")
    return first, stored(more.distinct(), "line-root-links"), places


def line_links(docs: DataFrame) -> DataFrame:
    """Links (a, b) between identifiers of different lines that connect all similar ones that meet in a band."""
    first, more, _ = _found(docs)
    return first.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(more)


def line_roots(first: DataFrame, more: DataFrame) -> DataFrame:
    """(line, root) of every line that is like another, from ``_found``; the root is the smallest identifier of its component."""
    tops = stored(components(more, "a", "b"), "line-top-roots")
    above = tops.select(F.col("node").alias("root"), F.col("root").alias("top"))
    lifted = first.select(F.col("node").alias("line"), "root").join(above, "root", "left")
    lone = tops.join(first.select("node"), "node", "left_anti").select(F.col("node").alias("line"), "root")
    return lifted.select("line", F.coalesce("top", "root").alias("root")).unionAll(lone)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Lines to remove: doc_id, doc_key, line_no, with first_doc_id and first_line_no of the line that stays."""
    first, more, places = _found(docs)
    roots = line_roots(first, more)
    rooted = places.join(roots, "line", "left").select(
        F.coalesce("root", "line").alias("root"), "doc_id", "doc_key", "line_no"
    )
    rooted = stored(rooted, "line-rooted")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_key", "line_no")
    firsts = rooted.groupBy("root").agg(F.min(order).alias("first"), F.max(order).alias("last")).where("first <> last")
    firsts = stored(firsts, "line-firsts")
    return rooted.join(firsts, "root").where(order != F.col("first")).select(
        "doc_id", "doc_key", "line_no",
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.line_no").alias("first_line_no"),
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the text of repeated lines taken out; other columns as they were, n_chars counted anew if there is one."""
    gone = repeated_lines(docs).groupBy(F.col("doc_id").alias("_doc_id"), F.col("doc_key").alias("_gone_key"))
    gone = gone.agg(F.collect_set("line_no").alias("_gone"))

    @F.pandas_udf("string")
    def without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lists in batches:
            out = []
            for text, gone in zip(texts, lists):
                if gone is not None:
                    gone = set(gone.tolist())
                    text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
                out.append(text)
            yield pd.Series(out, dtype=object)

    # The document as one struct: its columns may have any names.
    left = docs.select(F.struct("*").alias("_doc"), F.xxhash64("doc_id", "text").alias("_doc_key"))
    same = (F.col("_doc_key") == F.col("_gone_key")) & F.col("_doc.doc_id").eqNullSafe(F.col("_doc_id"))
    kept = F.col("_gone").isNull()
    text = F.when(kept, F.col("_doc.text")).otherwise(without("_doc.text", "_gone"))
    left = left.join(gone, same, "left").withColumn("_text", text)
    n_chars = F.when(kept, F.col("_doc").getField("n_chars")).otherwise(F.length("_text").cast("long"))
    changed = {"text": F.col("_text"), "n_chars": n_chars}
    return left.select(*(changed[c].alias(c) if c in changed else F.col("_doc").getField(c).alias(c) for c in docs.columns))
