"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at ``4`` or fewer differing bits. Of two linked
ones, the left or the right 32 bits differ in at most 2 bits. Each half is
covered by anchors: the code words of the Hamming code of length 31 (covering
radius 1; the 32nd bit is left out). The midpoint of two halves that differ in
at most 2 bits is at most 1 bit from either, and within 1 bit of the midpoint
lies an anchor. So a half goes to every anchor within 2 bits, the covering
radius plus the threshold as seen from the midpoint: 16 on average, and every
link meets at some anchor. No link is lost; whatever meets by chance is sorted
out by comparing all 64 bits.

Equal fingerprints are reduced to one before that. Each anchor's group links
its components by a spanning forest, never by all pairs; large groups are
split further by what the other half has in common.

Defined results: ``component_id`` is the smallest doc_id reachable, null only
if all of the component are. A text without words has fingerprint zero, which
links like any other. Repeated rows share their component. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .common import stored

BITS = 64
MAX_DIFFERENT = 4
SHINGLE_WORDS = 4
#: Groups up to this size are compared as they are, larger ones after a further split.
GROUP_ROWS = 512


def fingerprint(text: str, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's word shingles, repeats included."""
    words = text.encode().lower().split()  # bytes: A-Z only, and exactly the white space of the definition
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[i:j], 42) for i, j in zip(starts, stops)], np.uint64)
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):  # bounded memory for long texts
        block = hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes)).view(">u8")[0])


def fingerprint_column(text: Column) -> Column:
    """Fingerprint as a signed 64-bit number."""

    @F.pandas_udf("long")
    def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(t) for t in s], np.uint64).view(np.int64))

    return fingerprints(F.coalesce(text, F.lit("")))


def _syndromes(half: np.ndarray) -> np.ndarray:
    """Hamming syndrome of the low 31 bits: the exclusive or of the places 1 to 31 of set bits."""
    out = np.zeros(len(half), np.int64)
    for place in range(1, 32):
        out ^= np.where(half >> (place - 1) & 1, place, 0)
    return out


#: Words of one or two set bits by their syndrome: what has to be flipped to reach a code word.
_FLIPS: dict[int, list[int]] = {s: [] for s in range(32)}
for _i in range(1, 32):
    _FLIPS[_i].append(1 << (_i - 1))
    for _j in range(_i + 1, 32):
        _FLIPS[_i ^ _j].append(1 << (_i - 1) | 1 << (_j - 1))
_FLIPS[0].append(0)


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, anchor) of every code word within 2 bits of the low 31 bits of ``half``."""
    low = half & 0x7FFFFFFF
    syndrome = _syndromes(low)
    index, found = [], []
    for s, flips in _FLIPS.items():
        own = np.flatnonzero(syndrome == s)
        index.append(np.repeat(own, len(flips)))
        found.append((low[own][:, None] ^ np.array(flips, np.int64)[None, :]).ravel())
    return np.concatenate(index), np.concatenate(found)


def _replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        fp = pdf["fp"].to_numpy(np.int64)
        for side, half in ((0, fp & 0xFFFFFFFF), (1, fp >> 32 & 0xFFFFFFFF)):
            index, anchor = anchors(half)
            yield pd.DataFrame({"anchor": anchor << 1 | side, "fp": fp[index]})


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= MAX_DIFFERENT


def _link(fp: np.ndarray, members: np.ndarray) -> list[tuple[int, int]]:
    """Links (member, member) that connect what ``members`` have linked, by search from one after the other."""
    links, rest = [], members
    while len(rest) > 1:
        seed, rest = rest[0], rest[1:]
        frontier = np.array([seed])
        while len(frontier) and len(rest):
            take = max(1, (1 << 20) // len(rest))  # bounds the memory of a comparison
            now, frontier = frontier[:take], frontier[take:]
            reached = _near(fp[rest][:, None], fp[now][None, :]).any(axis=1)
            links += [(seed, i) for i in rest[reached].tolist()]
            frontier = np.concatenate((frontier, rest[reached]))
            rest = rest[~reached]
    return links


def group_links(fp: np.ndarray, side: int) -> list[tuple[int, int]]:
    """Links that connect one anchor's group of distinct fingerprints (unsigned), at most five for each of them."""
    if len(fp) <= GROUP_ROWS:
        return _link(fp, np.arange(len(fp)))
    # At most 4 bits of the other half differ, so one of its five parts is equal.
    links = []
    other = (fp >> np.uint64(0 if side else 32)) & np.uint64(0xFFFFFFFF)
    for low, width in ((0, 6), (6, 6), (12, 6), (18, 7), (25, 7)):
        part = (other >> np.uint64(low)) & np.uint64((1 << width) - 1)
        order = np.argsort(part, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            links += _link(fp, members)
    return links


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links from rows sorted by anchor; a group may run over several batches."""
    held_anchor, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for pdf in _with_end(batches):
        last = pdf is None
        if not last:
            held_anchor = np.concatenate((held_anchor, pdf["anchor"].to_numpy(np.int64)))
            held = np.concatenate((held, pdf["fp"].to_numpy(np.int64)))
        cuts = np.flatnonzero(np.diff(held_anchor)) + 1
        bounds = [0, *cuts.tolist()] + ([len(held)] if last else [])
        sizes, starts = np.diff(bounds), np.array(bounds[:-1], np.int64)
        fp = held.view(np.uint64)
        pairs = starts[sizes == 2]
        pairs = pairs[_near(fp[pairs], fp[pairs + 1])]
        a, b = fp[pairs].tolist(), fp[pairs + 1].tolist()
        for k in np.flatnonzero(sizes > 2).tolist():
            group = fp[bounds[k] : bounds[k + 1]]
            for i, j in group_links(group, int(held_anchor[bounds[k]] & 1)):
                a.append(int(group[i])), b.append(int(group[j]))
        if a:
            yield pd.DataFrame({"a": np.array(a, np.uint64).view(np.int64), "b": np.array(b, np.uint64).view(np.int64)})
        held_anchor, held = held_anchor[bounds[-1] :], held[bounds[-1] :]


def _with_end(batches):
    yield from batches
    yield None


def fingerprint_links(fingerprints: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct ``fp`` that differ in at most 4 bits, directly or over others."""
    spread = fingerprints.mapInPandas(_replicate, "anchor long, fp long")
    n = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = spread.repartition(n, "anchor").sortWithinPartitions("anchor")
    return met.mapInPandas(_compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of every row."""
    marked = stored(docs.select("doc_id", fingerprint_column(F.col("text")).alias("fp")), "simhash")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(fingerprint_links(distinct.select("fp")), "a", "b")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labelled = rooted.join(stored(smallest, "simhash-roots"), "root").select("fp", "component_id")
    return marked.join(labelled, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest doc_id.

    Rows that share that doc_id all stay; a component whose doc_ids are all null keeps all its rows.
    """
    keep = near_duplicates(docs).where("doc_id = component_id OR component_id IS NULL").select("doc_id").distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["doc_id"]), "left_semi")
