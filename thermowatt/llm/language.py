"""Language identification by interpolated Kneser-Ney models over characters.

Training counts the 4-grams of every labelled training text in Spark, and takes
from all of them, at every order, the absolute discount, the continuation
counts below the highest order, and each n-gram's discounted share of its
context. Only then are the n-grams pruned to a fixed model size: those of the
largest count times share stay, and what a pruned one had goes to the lower
order, so that probabilities still sum to one. Languages are laid out in blocks
of ``BLOCK``: n-grams of a block lie in sorted arrays of 64-bit hashes, beside
a row of log probabilities, one per language; an n-gram that no language of
the block has is found by its context and the next lower order. A text's
language is the one of lowest cross-entropy per character. Any number of
languages can be learned.

Each block is put together in one task, and calibration texts are measured in
tasks; the driver gets the finished arrays and a row of numbers for each text.

Rejection is calibrated on a bounded sample of training texts: a text goes if
its best cross-entropy lies further above its language's median, in spreads that
texts of its length have, than a margin over a high quantile of that sample. The score is the posterior of
the chosen language at a temperature fitted to the same sample.

Defined results: ``und`` with score 0 for texts that are null or have no letter,
and for all if there is nothing to learn from; such texts are rejected. Texts
are taken whole, in chunks of bounded memory. A null doc_id counts as empty
text where folds are told. Extra columns are kept unless they clash with the results.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

#: Bound of the model's highest order in log probabilities, about 8 bytes each, as long as LEAST_GRAMS does not exceed it.
MODEL_CELLS = 4_000_000
#: N-grams of an order that every language may keep, however many languages there are.
LEAST_GRAMS = 500
#: Languages that share their arrays.
BLOCK = 16
#: Training texts, at most about, that calibration looks at. The model itself counts all training texts.
CALIBRATION_ROWS = 4_000
#: A text is rejected beyond REJECT_MARGIN times what a share REJECT_SHARE of the calibration sample stays below;
#: a small sample tells little of its tail, so the limit is never under REJECT_LEAST spreads.
REJECT_SHARE, REJECT_MARGIN, REJECT_LEAST = 0.999, 1.75, 16.0
CHUNK_CHARS = 1 << 19
UNDETERMINED = "und"

_FLUSH = 2_000_000  # distinct n-grams a task gathers before it hands them on
_PIECE = 1 << 20  # bytes of a laid-out block that travel in one row
_SALTS = 32  # parts of a language's n-grams that are pruned on their own first
_START = np.full(3, 32, np.int64)
_M1, _M2 = np.int64(-7046029254386353131), np.int64(-4417276706812531889)


class _Classes:
    """What every code point is: 1 white space, 2 digit."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            chars = map(chr, range(0x110000))
            cls.table = np.fromiter((c.isspace() + 2 * c.isdecimal() for c in chars), np.uint8, 0x110000)
        return cls.table


def codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text; digits are 0, a run of white space is one blank."""
    out = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    kind = _Classes.get()[out]
    out = np.where(kind == 2, 48, np.where(kind == 1, 32, out))
    blank = kind == 1
    return out[~(blank & np.concatenate(([True], blank[:-1])))] if len(out) else out


def chunks(texts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(codes, starts, owner): pieces of texts laid end to end, each after three codes of context."""
    held, owner, size = [], [], 0
    for i, text in enumerate(texts):
        own = np.concatenate((_START, codes(text)))
        for at in range(0, max(1, len(own) - 3), CHUNK_CHARS):
            piece = own[at : at + CHUNK_CHARS + 3]
            if len(piece) > 3:
                held.append(piece), owner.append(i)
                size += len(piece)
            if size >= CHUNK_CHARS:
                yield np.concatenate(held), np.cumsum([0] + [len(p) for p in held[:-1]]), np.array(owner)
                held, owner, size = [], [], 0
    if held:
        yield np.concatenate(held), np.cumsum([0] + [len(p) for p in held[:-1]]), np.array(owner)


def grams(code: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context of three, character, piece) of every position of the chunk."""
    three = code[:-3] << 42 | code[1:-2] << 21 | code[2:-1]
    piece = np.searchsorted(starts, np.arange(len(three)), "right") - 1
    lengths = np.diff(np.append(starts, len(code)))
    inside = np.arange(len(three)) - starts[piece] < lengths[piece] - 3
    return three[inside], code[3:][inside], piece[inside]


def key4(three: np.ndarray, char: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (three ^ three >> 31) * _M1 + char
        return (h ^ h >> 29) * _M2


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []

    def summed() -> pd.DataFrame:
        return pd.concat(held).groupby(["lang", "three", "ch"], as_index=False)["n"].sum()

    for pdf in batches:
        for lang, own in pdf.groupby("lang"):
            for code, starts, _ in chunks(own["text"]):
                three, char, _ = grams(code, starts)
                which, distinct = pd.factorize(key4(three, char))
                at = np.zeros(len(distinct), np.int64)
                at[which[::-1]] = np.arange(len(which) - 1, -1, -1)
                n = np.bincount(which, minlength=len(distinct))
                held.append(pd.DataFrame({"lang": lang, "three": three[at], "ch": char[at], "n": n}))
                if sum(map(len, held)) > _FLUSH:
                    held = [summed()]
                    if len(held[0]) > _FLUSH:
                        yield held.pop()
    if held:
        yield summed()


def count_grams(rows: DataFrame) -> DataFrame:
    """(lang, three, ch, n) over all ``rows`` (lang, text)."""
    parts = rows.mapInPandas(_count, "lang string, three long, ch long, n long")
    return parts.groupBy("lang", "three", "ch").agg(F.sum("n").alias("n"))


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of each key in a sorted array."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


_MASKS = {3: (1 << 63) - 1, 2: (1 << 42) - 1, 1: (1 << 21) - 1}


class KneserNey:
    """One language: per order sorted hashes with discounted shares, and contexts with what they leave to lower orders."""

    def __init__(self, shares: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], vocabulary: int):
        """``shares``: order -> (context, character, share), of all n-grams or the kept ones."""
        self.levels, self.vocabulary = {}, vocabulary
        self.grams = {order: (context, char) for order, (context, char, _) in shares.items()}
        for order, (context, char, share) in shares.items():
            keys = key4(context, char) if order == 4 else context << 21 | char
            names, which = np.unique(context, return_inverse=True)
            left = 1 - np.bincount(which, share, len(names))
            order_of = np.argsort(keys)
            self.levels[order] = keys[order_of], share[order_of], names, left

    def prob(self, order: int, context: np.ndarray, char: np.ndarray) -> np.ndarray:
        if order == 0:
            return np.full(len(char), 1 / self.vocabulary)
        keys, share, names, left = self.levels[order]
        at, there = _find(keys, key4(context, char) if order == 4 else context << 21 | char)
        c, known = _find(names, context)
        lower = self.prob(order - 1, context & _MASKS[order - 2] if order > 2 else context * 0, char)
        return np.where(there, share[at], 0) + np.where(known, left[c], 1) * lower

    def left_over(self, order: int, context: np.ndarray) -> np.ndarray:
        _, _, names, left = self.levels[order]
        at, known = _find(names, context)
        return np.where(known, left[at], 1)


@dataclass
class Block:
    """Some languages over the same arrays."""

    #: order -> (sorted hashes, log probabilities [n, languages], sorted contexts, log of what is left [n, languages])
    tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    floor: np.ndarray

    def logs(self, three: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Log probabilities [n, languages] of characters after their contexts."""
        out = np.zeros((len(char), len(self.floor)), np.float32)
        todo, context = np.arange(len(char)), three
        for order in (4, 3, 2, 1):
            keys, probs, names, left = self.tables[order]
            own = char[todo]
            at, there = _find(keys, key4(context, own) if order == 4 else context << 21 | own)
            out[todo[there]] += probs[at[there]]
            todo, context = todo[~there], context[~there]
            at, known = _find(names, context)
            out[todo[known]] += left[at[known]]
            context = context & _MASKS[order - 2] if order > 2 else context * 0
        out[todo] += self.floor
        return out


@dataclass
class Model:
    languages: list[str]
    blocks: list[Block]
    #: language -> median, spread of a single character, spread that does not shrink with length
    normal: dict[str, tuple[float, float, float]]
    temperature: float = 0.1
    #: Spreads above its language's median from which a text is rejected.
    limit: float = REJECT_LEAST

    def logs(self, three: np.ndarray, char: np.ndarray) -> np.ndarray:
        return np.concatenate([b.logs(three, char) for b in self.blocks], 1)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character [n, languages], characters) of texts."""
        sums, sizes = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for code, starts, owner in chunks(texts):
            three, char, piece = grams(code, starts)
            which, _ = pd.factorize(key4(three, char))
            at = np.zeros(which.max() + 1, np.int64)
            at[which[::-1]] = np.arange(len(which) - 1, -1, -1)
            logs = self.logs(three[at], char[at])
            for k in range(len(self.languages)):
                sums[:, k] -= np.bincount(owner[piece], logs[which, k], len(texts))
            sizes += np.bincount(owner[piece], minlength=len(texts))
        return sums / np.maximum(sizes, 1)[:, None], sizes

    def posterior(self, entropy: np.ndarray, sizes: np.ndarray, temperature: float) -> np.ndarray:
        z = -(entropy - entropy.min(1, keepdims=True)) * np.sqrt(sizes)[:, None] / temperature
        p = np.exp(np.maximum(z, -700))
        return p / p.sum(1, keepdims=True)

    def excess(self, entropy: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Spreads that each text's best cross-entropy lies above its language's median."""
        best = entropy.argmin(1)
        normal = np.array([self.normal[x] for x in self.languages])[best]
        spread = np.sqrt(normal[:, 1] ** 2 / np.maximum(sizes, 1) + normal[:, 2] ** 2)
        return (entropy[np.arange(len(best)), best] - normal[:, 0]) / spread

    def predict(self, texts: list[str]) -> pd.DataFrame:
        entropy, sizes = self.entropies(texts)
        best = entropy.argmin(1)
        score = self.posterior(entropy, sizes, self.temperature)[np.arange(len(best)), best]
        names = np.array(self.languages, dtype=object)[best]
        return pd.DataFrame({"lang_pred": names, "score": score, "excess": self.excess(entropy, sizes)})


def _combined(models: list[KneserNey]) -> Block:
    tables = {}
    lower = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for order in (4, 3, 2, 1):
        names = np.unique(np.concatenate([m.levels[order][2] for m in models]))
        left = np.log(np.stack([m.left_over(order, names) for m in models], 1).clip(1e-30)).astype(np.float32)
        # Of a gram that one language has, the others' probabilities are needed as well.
        context = np.concatenate([m.grams[order][0] for m in models] + [lower[0]])
        char = np.concatenate([m.grams[order][1] for m in models] + [lower[1]])
        keys, first = np.unique(key4(context, char) if order == 4 else context << 21 | char, return_index=True)
        context, char = context[first], char[first]
        probs = np.stack([m.prob(order, context, char) for m in models], 1)
        tables[order] = keys, np.log(probs).astype(np.float32), names, left
        lower = context & _MASKS[order - 2] if order > 2 else context * 0, char
    return Block(tables, np.full(len(models), -np.log(models[0].vocabulary), np.float32))


def shares(counted: DataFrame) -> dict[int, DataFrame]:
    """Order -> (lang, context, ch, n, share) from counts (lang, three, ch, n), over all n-grams of every language."""
    out, level = {}, counted.withColumnRenamed("three", "context")
    for order in (4, 3, 2, 1):
        if order < 4:  # kinds of what stands before the shorter n-gram
            context = F.col("context").bitwiseAND(F.lit(_MASKS[order - 1])) if order > 1 else F.lit(0).cast("long")
            level = level.groupBy("lang", context.alias("context"), "ch").agg(F.count(F.lit(1)).alias("n"))
        level = stored(level, f"language-grams-{order}")
        kinds = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos"))
        discount = "IF(ones > 0 AND twos > 0, ones / (ones + 2 * twos), 0.75D) AS discount"
        totals = level.groupBy("lang", "context").agg(F.sum("n").alias("total"))
        share = "(n - discount) / total AS share"
        out[order] = level.join(totals, ["lang", "context"]).join(kinds.selectExpr("lang", discount), "lang").selectExpr(
            "lang", "context", "ch", "n", share
        )
    return out


def _pruned(level: DataFrame, most: int) -> DataFrame:
    """The ``most`` n-grams of every language with the largest count times share."""
    by = "ORDER BY n * share DESC, context, ch"
    first = level.selectExpr("*", f"row_number() OVER (PARTITION BY lang, pmod(xxhash64(context, ch), {_SALTS}) {by}) AS r")
    last = first.where(F.col("r") <= most).selectExpr("*", f"row_number() OVER (PARTITION BY lang {by}) AS rank")
    return last.where(F.col("rank") <= most).select("lang", "context", "ch", "share")


def _laid_out(vocabulary: int):
    """Task that puts the kept n-grams (block, place, level, context, ch, share) of a block's languages together, pickled in pieces."""

    def run(table: pa.Table) -> pa.Table:
        cols = {c: table[c].to_numpy() for c in table.column_names}
        block, models = int(cols["block"][0]), []
        for place in range(int(cols["place"].max()) + 1):
            at = {o: np.flatnonzero((cols["place"] == place) & (cols["level"] == o)) for o in (4, 3, 2, 1)}
            models.append(KneserNey({o: tuple(cols[c][i] for c in ("context", "ch", "share")) for o, i in at.items()}, vocabulary))
        laid = _combined(models)
        data = pickle.dumps((laid.tables, laid.floor), 5)
        parts = [data[i : i + _PIECE] for i in range(0, len(data), _PIECE)]
        return pa.table({"block": pa.array([block] * len(parts), pa.int32()), "piece": pa.array(range(len(parts)), pa.int32()), "part": pa.array(parts, pa.binary())})

    return run


def train(rows: DataFrame) -> Model | None:
    """A model from ``rows`` (lang, text), all of them labelled; None if there are none with text."""
    levels = shares(count_grams(rows))
    languages = sorted(r["lang"] for r in levels[1].select("lang").distinct().collect())  # one row a language
    if not languages:
        return None
    most = max(LEAST_GRAMS, MODEL_CELLS // (len(languages) * min(len(languages), BLOCK)))
    vocabulary = levels[1].select("ch").distinct().count() + 1
    places = rows.sparkSession.createDataFrame(
        [(x, i // BLOCK, i % BLOCK) for i, x in enumerate(languages)], "lang string, block int, place int"
    )
    kept = reduce(DataFrame.unionAll, [_pruned(level, most).withColumn("level", F.lit(order)) for order, level in levels.items()])
    kept = kept.join(F.broadcast(places), "lang").select("block", "place", "level", "context", "ch", "share")  # one row a language
    # Bounded: `most` rows an order and language, for the task that lays out a block as for its result.
    found = kept.groupBy("block").applyInArrow(_laid_out(vocabulary), "block int, piece int, part binary").toArrow()
    found = found.sort_by([("block", "ascending"), ("piece", "ascending")])
    blocks = []
    for block in range(-(-len(languages) // BLOCK)):
        own = found.filter(pa.compute.equal(found["block"], block))["part"]
        blocks.append(Block(*pickle.loads(b"".join(x.as_buffer() for x in own))))
    return Model(languages, blocks, {})


def _measured(shared):
    """Task that measures (lang, text): lang, characters, cross-entropies by the model that ``shared`` broadcasts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at : at + 256]
                entropy, sizes = shared.value.entropies(part["text"].tolist())
                yield pd.DataFrame({"lang": part["lang"].tolist(), "size": sizes, "entropy": list(entropy)})

    return run


def calibrate(model: Model, entropy: np.ndarray, sizes: np.ndarray, langs: list[str]) -> None:
    """Fit spreads and temperature to what ``Model.entropies`` gave for labelled texts."""
    number = {x: i for i, x in enumerate(model.languages)}
    right = np.array([number[x] for x in langs], np.int64)
    own = entropy[np.arange(len(right)), right]
    for k, lang in enumerate(model.languages):
        mine = (right == k) & (sizes > 0)
        if not mine.any():
            model.normal[lang] = 2.0, 4.0, 0.5
            continue
        centre = float(np.median(own[mine]))
        off = np.abs(own[mine] - centre)
        # Short texts tell the spread of a character, long ones what stays.
        middle = np.median(sizes[mine])
        short, long = sizes[mine] <= middle, sizes[mine] >= middle
        per_char = float(np.quantile(off[short] * np.sqrt(sizes[mine][short]), 0.8))
        stays = float(np.quantile(off[long], 0.8))
        model.normal[lang] = centre, max(per_char, 1.0), max(stays, 0.02)
    if len(right):
        tries = [0.01 * 2**i for i in range(12)]
        loss = [
            -np.mean(np.log(model.posterior(entropy, sizes, t)[np.arange(len(right)), right].clip(1e-9))) for t in tries
        ]
        model.temperature = tries[int(np.argmin(loss))]
        model.limit = max(REJECT_LEAST, REJECT_MARGIN * float(np.quantile(model.excess(entropy, sizes), REJECT_SHARE)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` with held_out, lang_pred, score and rejected; learned from its labelled rows that are not held out."""
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in ("held_out", "lang_pred", "score", "rejected")]
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.select("doc_id", "lang", "text")
    model = train(labelled.select("lang", "text"))
    shared = spark.sparkContext.broadcast(model)  # bounded by MODEL_CELLS, beyond it by LEAST_GRAMS a language
    fitted = {}
    if model is not None:
        share = CALIBRATION_ROWS / max(1, labelled.count())
        drawn = (F.xxhash64("doc_id", F.lit("calibration")).cast("double") / 2.0**63 + 1) / 2 < share
        sample = labelled.where(drawn & F.col("lang").isin(model.languages) & (F.length("text") <= 100_000)).select("lang", "text")
        # A row of numbers for each of about CALIBRATION_ROWS texts.
        got = sample.mapInPandas(_measured(shared), "lang string, size long, entropy array<double>").toArrow()
        entropy = got["entropy"].combine_chunks().flatten().to_numpy().reshape(-1, len(model.languages))
        calibrate(model, entropy, got["size"].to_numpy(), got["lang"].to_pylist())
        fitted = {"normal": model.normal, "temperature": model.temperature, "limit": model.limit}

    @F.pandas_udf("lang_pred string, score double, excess double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = replace(shared.value, **fitted)
        for s in texts:
            yield pd.concat([own.predict(s[at : at + 256].tolist()) for at in range(0, len(s), 256)] or [own.predict([])])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)) if model is not None else F.lit(False)
    marked = docs.select(*names, held_out(F.col("doc_id")).alias("held_out"), lettered.alias("_lettered"))
    if model is None:
        return marked.select(
            *names, "held_out", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")
        )
    found = marked.withColumn("_p", predict(F.coalesce("text", F.lit(""))))
    return found.select(
        *names, "held_out",
        F.when(F.col("_lettered"), F.col("_p.lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(F.col("_lettered"), F.col("_p.score")).otherwise(0.0).alias("score"),
        (~F.col("_lettered") | (F.col("_p.excess") > model.limit)).alias("rejected"),
    )
