"""Interpolated modified Kneser-Ney n-gram models over words, and the probability of texts under them.

Counting: tasks turn words into 64-bit hashes, count the n-grams of about
``FLUSH_TOKENS`` tokens at a time, and hand them on in compressed pieces, one
per shard. A shard is a range of hashes of contexts, so an n-gram meets all
others of its context, in numbers only: one row per n-gram and piece, however
often it occurs. The shard writes the model's part and hands the shorter
n-grams down, counted by the kinds of what stands before them. There are as
many shards as the training text needs at ``SHARD_CHARS`` each. Nothing is
pruned, capped or sampled; the driver learns sums alone.

Storage: per order and shard one file of sorted hash arrays in the shared
folder: n-grams with counts, contexts with their totals and the numbers of
n-grams seen once, twice and more often. Scoring tasks map these files into
memory and look up the sorted n-grams of about ``BATCH_TOKENS`` tokens shard
by shard. Where the shared folder is no mounted file system, a shard is read
instead, one at a time.

Probabilities: three discounts per order from the counts of counts, raw counts
at the highest order and continuation counts below, down to the uniform share
of one among all words and the unknown one. An n-gram that begins with the
start mark keeps its raw count, as nothing can stand before it.

Defined results: a null text is the empty text, whose only token is the end.
Without training texts every token has probability 1. Texts are taken whole.
Repeated rows count as often as they occur. Words whose 64-bit hashes are equal are
taken for one. Extra columns are kept unless they clash with the results.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources import drop_folder, shared_folder
from .common import stored
from .warc import _opened

#: Words of the longest n-gram.
ORDER = 2
#: What base scores add to every count.
BASE_ADD = 0.1
#: Training characters to a shard, tokens counted before they are handed on, tokens scored at once.
SHARD_CHARS, FLUSH_TOKENS, BATCH_TOKENS = 16 << 20, 1 << 21, 1 << 19
#: Words that are hashed at once.
MEMO_WORDS = 250_000
#: Characters, and the rest of their last text, that are split into words at once.
SPLIT_CHARS = 1 << 22

_PIECES = "kind int, shard int, blob binary, once long, twice long, thrice long, four long, total long, kinds long, tokens long"
_SUMS = ("once", "twice", "thrice", "four", "total", "kinds", "tokens")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
# Words hold no blanks, so no word is one of these.
_START, _END = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" start", b" end"))
#: Kind of the pieces with raw counts of words.
_RAW = 0


def _split(texts: list[str]) -> list[np.ndarray]:
    words = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    named = words.flatten().dictionary_encode()
    kinds = named.dictionary.cast(pa.large_binary())
    hashes = np.empty(len(kinds), np.uint64)
    for at in range(0, len(kinds), MEMO_WORDS):
        own = kinds.slice(at, MEMO_WORDS).to_numpy(zero_copy_only=False)
        hashes[at : at + len(own)] = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    places = named.indices.to_numpy()
    # Blanks at either end of a text leave an empty word there.
    real = places != pc.index(kinds, b"").as_py()
    ends = np.cumsum(pc.list_value_length(words).to_numpy())
    return np.split(hashes[places[real]], np.concatenate(([0], np.cumsum(real)))[ends[:-1]])


def _hashed(texts: list[str]) -> Iterator[np.ndarray]:
    """Hashes of the words of each text; A-Z count as a-z. A word is hashed once for all texts split together."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= SPLIT_CHARS:
            yield from _split(held)
            held, size = [], 0
    if held:
        yield from _split(held)


def _new(ordered: np.ndarray) -> np.ndarray:
    """Whether each differs from the one before it."""
    return np.concatenate(([True], ordered[1:] != ordered[:-1]))[: len(ordered)]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, where one of each is, which of them each one is)."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = _new(ordered)
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], order[new], which


def _laid_out(texts: list[np.ndarray], order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(sorted words, columns of the n-grams as places among these, text of each): an n-gram for each word and one for the end."""
    start = np.full(order - 1, _START)
    words, _, line = _distinct(np.concatenate([np.concatenate((start, t, [_END])) for t in texts]))
    owner = np.repeat(np.arange(len(texts)), [len(t) + order for t in texts])
    last = line[order - 1 :]
    whole = last != np.searchsorted(words, _START)
    columns = [line[i : len(line) - order + 1 + i][whole] for i in range(order)]
    return words, columns, owner[order - 1 :][whole]


def _counted(columns: list[np.ndarray], kinds: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(columns, counts) of distinct n-grams in order, from columns of places below ``kinds``."""
    *front, last = columns
    if not front:
        names, counts = np.unique(last, return_counts=True)
        return [names], counts
    prefix, shorter = front[0], []
    for column in front[1:]:
        names, _, prefix = _distinct(prefix * kinds + column)
        shorter.append(names)
    names, counts = np.unique(prefix * kinds + last, return_counts=True)
    out = [names % kinds]
    names //= kinds
    for known in shorter[::-1]:
        out.append(known[names] % kinds)
        names = known[names] // kinds
    return [names, *out[::-1]], counts


def _key(columns: list[np.ndarray]) -> np.ndarray:
    out = columns[0]
    for column in columns[1:]:
        out = (out ^ out >> np.uint64(31)) * _M1 + column
        out = (out ^ out >> np.uint64(29)) * _M2
        out ^= out >> np.uint64(32)
    return out


def _summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(sorted keys, columns, counts) of distinct n-grams."""
    key = _key(columns)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    sums = np.add.reduceat(counts[order], first) if len(first) else counts[:0]
    return key[first], [c[order[first]] for c in columns], sums


def _packed(words: np.ndarray, columns: list[np.ndarray], counts: np.ndarray) -> bytes:
    """N-grams of a piece: the words they are made of, once each, then places among these."""
    flat = np.concatenate(columns)
    ordered = np.sort(flat)
    used = ordered[_new(ordered)]
    place = np.empty(len(words), np.uint32)
    place[used] = np.arange(len(used))
    parts = [np.array([len(counts), len(columns), len(used)], np.int64), words[used], place[flat], counts.astype(np.int64)]
    return zstandard.ZstdCompressor(1).compress(b"".join(p.tobytes() for p in parts))


def _unpacked(blob: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    size, order, kinds = np.frombuffer(data, np.int64, 3)
    names = np.frombuffer(data, np.uint64, kinds, 24)
    places = np.frombuffer(data, np.uint32, order * size, 24 + 8 * kinds)
    counts = np.frombuffer(data, np.int64, size, 24 + 8 * kinds + 4 * order * size)
    return [names[places[i * size : (i + 1) * size]] for i in range(order)], counts


def _shard_of(columns: list[np.ndarray], shards: int) -> np.ndarray:
    """An n-gram lies with its context, a single word by itself."""
    return (_key(columns[:-1] if len(columns) > 1 else columns) % np.uint64(shards)).astype(np.int64)


def _by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of its rows in their order)."""
    by = np.argsort(shard.astype(np.min_scalar_type(shards)), kind="stable")
    borders = np.concatenate(([0], np.cumsum(np.bincount(shard, minlength=shards))))
    for s in np.flatnonzero(np.diff(borders)):
        yield int(s), by[borders[s] : borders[s + 1]]


def _dealt(kind: int, words: np.ndarray, columns: list[np.ndarray], counts: np.ndarray, shards: int) -> Iterator[dict]:
    """Pieces of n-grams that are in order, given as places among ``words``."""
    for s, own in _by_shard(_shard_of([words[c] for c in columns], shards), shards):
        yield {"kind": kind, "shard": s, "blob": _packed(words, [c[own] for c in columns], counts[own])}


def _frame(rows: list[dict]) -> pd.DataFrame:
    names = [x.split()[0] for x in _PIECES.split(", ")]
    out = pd.DataFrame(rows, columns=names)
    return out.fillna({n: 0 for n in names if n != "blob"}).astype({n: "int64" for n in names if n != "blob"})


def _merged(blobs: list[bytes], order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    parts = [_unpacked(b) for b in blobs]
    if not parts:
        return _summed([np.empty(0, np.uint64)] * order, np.empty(0, np.int64))
    return _summed([np.concatenate(c) for c in zip(*(p[0] for p in parts))], np.concatenate([p[1] for p in parts]))


def _narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def _write(path: str, arrays: list[np.ndarray]) -> None:
    """Arrays one after the other, each at a multiple of 8 bytes; whole or not at all."""
    files, target = _opened(path)
    files.create_dir(target.rsplit("/", 1)[0], recursive=True)
    own = f"{target}-{uuid.uuid4().hex}"
    head = np.array([len(arrays), *(x for a in arrays for x in (a.itemsize, len(a)))], np.int64)
    with files.open_output_stream(own, compression=None) as out:
        for part in (head, *arrays):
            data = part.tobytes()
            out.write(data + bytes(-len(data) % 8))
    try:
        files.move(own, target)
    except OSError:  # another try of the task was first, with the same content
        files.delete_file(own)


def _mapped(path: str) -> list[np.ndarray]:
    """The arrays of a file, mapped into memory; read where the folder is not mounted. No file: no arrays."""
    files, target = _opened(path)
    if not files.get_file_info(target).is_file:
        return []
    if files.type_name == "local":
        data = np.memmap(target, np.uint8, "r")
    else:
        with files.open_input_file(target) as source:
            data = np.frombuffer(source.read(), np.uint8)
    shapes = data[8 : 8 + 16 * int(data[:8].view(np.int64)[0])].view(np.int64).reshape(-1, 2)
    at, out = 8 + 16 * len(shapes), []
    for width, size in shapes.tolist():
        out.append(data[at : at + width * size].view(f"u{width}"))
        at += width * size + -(width * size) % 8
    return out


def _file(folder: str, order: int, shard: int) -> str:
    return f"{folder}/order-{order}/shard-{shard:08d}.arrays"


def _gatherer(order: int, shards: int):
    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def handed() -> Iterator[pd.DataFrame]:
            words, columns, _ = _laid_out(held, order)
            for kind, own in ((_RAW, columns[-1:]), (order, columns)):
                for piece in _dealt(kind, words, *_counted(own, len(words)), shards):
                    yield _frame([piece])

        for pdf in batches:
            for text in _hashed(pdf["text"].tolist()):
                held.append(text)
                size += len(held[-1]) + order
                if size >= FLUSH_TOKENS:
                    yield from handed()
                    held, size = [], 0
        if held:
            yield from handed()

    return gather


def _builder(order: int, shards: int, folder: str):
    """Writes a shard of one order; its rows are sums, then the pieces of the next lower order."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["shard"].iloc[0])
        keys, columns, counts = _merged(pdf["blob"][pdf["kind"] == order].tolist(), order)
        words, _, seen = _merged(pdf["blob"][pdf["kind"] == _RAW].tolist(), 1)
        sums = {"kind": -1, "shard": shard, "total": counts.sum()}
        sums |= {name: np.sum(counts == i + 1) for i, name in enumerate(("once", "twice", "thrice", "four"))}
        if order == 1:
            # Every word of the training texts ends an n-gram, so both have the same keys.
            _write(_file(folder, 1, shard), [words, _narrow(seen), _narrow(counts)])
            return _frame([sums | {"kinds": len(words), "tokens": seen.sum()}])
        context = _key(columns[:-1])
        by = np.argsort(context, kind="stable")
        names, first = np.unique(context[by], return_index=True)
        ordered = counts[by]
        parts = [np.add.reduceat(x, first) for x in (ordered, ordered == 1, ordered == 2, ordered > 2)] if len(by) else [counts] * 4
        _write(_file(folder, order, shard), [keys, _narrow(counts), names, *(_narrow(p.astype(np.int64)) for p in parts)])
        shorter = np.where(columns[1] == _START, counts, 1) if order > 2 else np.ones(len(counts), np.int64)
        _, lower, continued = _summed(columns[1:], shorter)
        names, places = np.unique(np.concatenate(lower), return_inverse=True)
        lower = np.split(places, order - 1)
        by = np.lexsort(lower[::-1])
        rows = [sums, *_dealt(order - 1, names, [c[by] for c in lower], continued[by], shards)]
        raw_piece = {"kind": _RAW, "shard": shard, "blob": _packed(words, [np.arange(len(words))], seen)}
        return _frame(rows + ([raw_piece] if len(words) else []))

    return build


@dataclass(frozen=True)
class NgramModel:
    """Where a model lies, and the few numbers that hold for all of it."""

    folder: str
    order: int
    shards: int
    #: order -> discounts of n-grams seen once, twice, more often.
    discounts: dict[int, tuple[float, float, float]]
    #: Kinds of n-grams of order 2, over which the lowest order shares probability.
    continuations: int
    #: What the lowest order leaves to the uniform share.
    left: float
    kinds: int
    tokens: int


def _discounts(once: int, twice: int, thrice: int, four: int) -> tuple[float, float, float]:
    """The estimates from counts of counts; half a count, one and one and a half where these are too few."""
    if not (once and twice and thrice and four):
        return 0.5, 1.0, 1.5
    y = once / (once + 2 * twice)
    found = 1 - 2 * y * twice / once, 2 - 3 * y * thrice / twice, 3 - 4 * y * four / thrice
    return tuple(min(max(d, 0.0), float(i + 1)) for i, d in enumerate(found))


def train(texts: DataFrame, order: int = ORDER, shard_chars: int | None = None) -> NgramModel:
    """A model of all rows of ``texts`` (text), in the shared folder."""
    if order < 2:
        raise ValueError("the order is at least 2")
    spark = texts.sparkSession
    texts = texts.select(F.coalesce("text", F.lit("")).alias("text"))
    chars = texts.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    shards = max(16, -(-chars // (shard_chars or SHARD_CHARS)))
    folder = shared_folder(spark, "ngram-model")
    rows = texts.mapInPandas(_gatherer(order, shards), _PIECES)
    discounts = {}
    for level in range(order, 0, -1):
        rows = stored(rows.groupBy("shard").applyInPandas(_builder(level, shards, folder), _PIECES), f"ngrams-{level}")
        sums = rows.where("kind = -1").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SUMS)).first()
        discounts[level] = _discounts(sums["once"], sums["twice"], sums["thrice"], sums["four"])
        rows = rows.where("kind >= 0")
    more = sums["kinds"] - sums["once"] - sums["twice"]
    left = sum(d * n for d, n in zip(discounts[1], (sums["once"], sums["twice"], more))) / max(1, sums["total"])
    return NgramModel(folder, order, shards, discounts, sums["total"], left if sums["kinds"] else 1.0, sums["kinds"], sums["tokens"])


class _Scorer:
    """Looks n-grams up in the mapped files of a model."""

    def __init__(self, model: NgramModel):
        self.model, self.files = model, {}

    def arrays(self, order: int, shard: int) -> list[np.ndarray]:
        path = _file(self.model.folder, order, shard)
        if path in self.files:
            return self.files[path]
        found = _mapped(path)
        if not found or isinstance(found[0].base, np.memmap) or isinstance(found[0], np.memmap):
            self.files[path] = found  # mapped pages are the system's to give back
        return found

    def found(self, order: int, shard: np.ndarray, keys: np.ndarray, at: int, values: list[int]) -> np.ndarray:
        """Columns ``values`` of the rows of sorted ``keys`` in the array at place ``at``; 0 where there are none."""
        out = np.zeros((len(values), len(keys)), np.int64)
        for s, own in _by_shard(shard, self.model.shards):
            arrays = self.arrays(order, s)
            if not arrays or not len(arrays[at]):
                continue
            place = np.minimum(np.searchsorted(arrays[at], keys[own]), len(arrays[at]) - 1)
            there = np.asarray(arrays[at][place]) == keys[own]
            for out_row, value in zip(out, values):
                out_row[own] = np.where(there, arrays[value][place], 0)
        return out

    def _discounted(self, order: int, counts: np.ndarray) -> np.ndarray:
        return np.maximum(counts - np.array([0.0, *self.model.discounts[order]])[np.minimum(counts, 3)], 0)

    def probabilities(self, words: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
        """Of the last word of each n-gram after those before it; n-grams are columns of places among the sorted ``words``."""
        order, model = len(columns), self.model
        if order == 1:
            (counts,) = self.found(1, _shard_of([words], model.shards), words, 0, [2])
            return (self._discounted(1, counts) / max(1, model.continuations) + model.left / (model.kinds + 1))[columns[0]]
        keys, first, which = _distinct(_key([words[c] for c in columns]))
        columns = [c[first] for c in columns]
        (counts,) = self.found(order, _shard_of([words[c] for c in columns], model.shards), keys, 0, [1])
        if order == 2:
            contexts, of = words, columns[0]
            shard = _shard_of([words], model.shards)
        else:
            contexts, first, of = _distinct(_key([words[c] for c in columns[:-1]]))
            shard = _shard_of([words[c[first]] for c in columns], model.shards)
        total, *seen = self.found(order, shard, contexts, 2, [3, 4, 5, 6])
        known = np.maximum(total, 1)
        left = np.where(total > 0, sum(d * n for d, n in zip(model.discounts[order], seen)) / known, 1.0)
        return (self._discounted(order, counts) / known[of] + left[of] * self.probabilities(words, columns[1:]))[which]

    def scored(self, texts: list[np.ndarray]) -> pd.DataFrame:
        model = self.model
        words, columns, owner = _laid_out(texts, model.order)
        which = columns[-1]
        (raw,) = self.found(1, _shard_of([words], model.shards), words, 0, [1])
        base = np.log10((raw + BASE_ADD) / (model.tokens + BASE_ADD * (model.kinds + 1)))
        logs = np.log10(self.probabilities(words, columns))
        size = len(texts)
        return pd.DataFrame({
            "n_tokens": np.bincount(owner, minlength=size), "n_known": np.bincount(owner, raw[which] > 0, size).astype(np.int64),
            "base_score": np.bincount(owner, base[which], size), "score": np.bincount(owner, logs, size),
        })


_SCORES = ("n_tokens", "n_known", "base_score", "score", "perplexity")


def score(docs: DataFrame, model: NgramModel) -> DataFrame:
    """``docs`` with n_tokens, n_known, base_score, score (log10 of the text's probability) and perplexity per token.

    ``base_score`` is the text's log10 probability by single words, with ``BASE_ADD`` added to every count.
    """

    @F.pandas_udf("n_tokens long, n_known long, base_score double, score double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = _Scorer(model)
        for texts in batches:
            done, held, size = [], [], 0
            for text in _hashed(texts.tolist()):
                held.append(text)
                size += len(held[-1]) + 1
                if size >= BATCH_TOKENS:
                    done.append(scorer.scored(held))
                    held, size = [], 0
            if held:
                done.append(scorer.scored(held))
            yield pd.concat(done) if done else pd.DataFrame({c: [] for c in _SCORES[:4]})

    names = [F.col(f"`{c}`") for c in docs.columns if c not in _SCORES]
    found = docs.select(*names, scores(F.coalesce("text", F.lit(""))).alias("_scores"))
    return found.select(*names, "_scores.*", F.expr("power(10D, -_scores.score / _scores.n_tokens)").alias("perplexity"))


def free(spark: SparkSession, model: NgramModel) -> None:
    """Delete a model's files."""
    drop_folder(spark, model.folder)
