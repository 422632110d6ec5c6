"""Approximate nearest neighbours by inner product, over shifted space-filling curves.

Vectors are told apart by length: a class holds lengths within a factor of
the square root of two, so in a class the largest inner product is all but the
nearest direction, and no long vector blurs the directions of short ones. Each
curve looks at its own few random orthogonal directions, shifts them by its
own offset, and orders the directions of the vectors by their place on a
Hilbert curve through these axes. Spark range-partitions all vectors by class,
curve and place, and numbers them; a query has a place in every class and is
compared with the vectors in a window around it, on every curve. Windows are
cut into blocks of at most ``block_rows`` vectors, each compared with some
``ask_rows`` queries as one matrix product in a task, which hands on the ``k``
best of a block only. The best of all curves are ranked by the exact inner
product in double precision.

A window reaches over a share ``window`` of a class on either side. On data
without any structure (isotropic random vectors) nothing less than a large
share finds most neighbours, whatever the index; data of few inherent
dimensions needs far less, and the share is the knob.

Equal vectors are reduced to one before that; it stands for its k + 1 smallest
ids, as no ranking can need more. Defined results: vectors that are null, zero,
hold null or non-finite components or have another length than most take no
part. Ties go to the smaller id. Rows with a null id take no part. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

CURVES = 16
DIRECTIONS = 8
BITS = 7
WINDOW = 1 / 24
BLOCK_ROWS = 4096
ASK_ROWS = 4096
SEED = 7


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points [n, d] with coordinates of ``bits`` bits; d * bits at most 62."""
    x = cells.T.astype(np.int64).copy()
    d, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns of the sub-cubes, from the largest down
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & p
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = np.where(high, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, d):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    q = top
    while q > 1:
        turn = np.where((x[d - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    out = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            out = out << 1 | x[i] >> bit & 1
    return out


def usable(vector: Column) -> Column:
    """Whether a vector takes part, its length aside."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _length_class() -> Column:
    """Number of the class a vector's length is in; some 4,200 at most, as doubles have so many powers of two."""
    peak = "array_max(transform(vector, x -> abs(x)))"
    squares = "aggregate(vector, 0D, (a, x) -> a + (x / peak) * (x / peak))"
    return F.expr(f"get(transform(array({peak}), peak -> CAST(floor(2 * log2(peak) + log2({squares}) + 0.5) AS INT)), 0)")


def _places(dim: int, curves: int):
    """Task that gives (curve, place) of vectors."""
    rng = np.random.default_rng(SEED)
    turns = []
    while sum(t.shape[1] for t in turns) < curves * DIRECTIONS:
        turns.append(np.linalg.qr(rng.normal(size=(dim, dim)))[0])
    # Directions of one rotation are used up before the next begins.
    axes = np.concatenate(turns, 1)[:, : curves * DIRECTIONS]
    shifts = rng.uniform(0, 0.5, size=(curves, DIRECTIONS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            v = np.stack(pdf["vector"].to_list())
            v = v / np.abs(v).max(1)[:, None]
            flat = v / np.sqrt((v * v).sum(1))[:, None] @ axes
            for curve in range(curves):
                own = flat[:, curve * DIRECTIONS : (curve + 1) * DIRECTIONS] * np.sqrt(dim) / 6 + 0.25 + shifts[curve]
                cells = np.clip(own * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
                yield pdf.assign(curve=curve, place=hilbert(cells, BITS))[["length_class", "curve", "place", "rep", "vector", "asks"]]

    return run


def _numbered(places: DataFrame) -> DataFrame:
    """``places`` with the number of vectors before each in its class and curve, without a window over a whole curve."""
    spark = places.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["length_class", "curve", "place", "rep", "asks"]
    dealt = places.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # The written files keep which range a row is in, whatever is recomputed later.
    dealt = stored(dealt.withColumn("range_no", F.spark_partition_id()), "curve-places")
    counts = dealt.groupBy("length_class", "curve", "range_no").agg(F.sum(F.expr("1 - asks")).alias("n"))
    before = counts.selectExpr(
        "length_class", "curve", "range_no", "sum(n) OVER (PARTITION BY length_class, curve ORDER BY range_no) - n AS before"
    )
    rank = """
        sum(1 - asks) OVER (PARTITION BY length_class, curve, range_no ORDER BY place, rep, asks ROWS UNBOUNDED PRECEDING)
        - (1 - asks) + before AS rank
    """
    return dealt.join(before, ["length_class", "curve", "range_no"]).selectExpr("length_class", "curve", "rep", "vector", "asks", rank)


def _best(scores: np.ndarray, queries: np.ndarray, reps: np.ndarray, k: int) -> pd.DataFrame:
    """The k best of a block for every query; all that tie with the k-th, as ids decide between them later."""
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k]
        row, col = np.nonzero(scores >= least[:, None])
    else:
        row, col = np.nonzero(np.ones(scores.shape, bool))
    return pd.DataFrame({"query": queries[row], "rep": reps[col], "score": scores[row, col]})


def _compared(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query": [], "rep": [], "score": []}).astype({"query": "int64", "rep": "int64"})
        vectors, reps = np.stack(right["vector"].to_list()), right["rep"].to_numpy()
        out = []
        for at in range(0, len(left), 256):
            own = left.iloc[at : at + 256]
            out.append(_best(np.stack(own["asking"].to_list()) @ vectors.T, own["query"].to_numpy(), reps, k))
        return pd.concat(out)

    return run


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    curves: int = CURVES,
    window: float = WINDOW,
    block_rows: int = BLOCK_ROWS,
    ask_rows: int = ASK_ROWS,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) for the rows of ``vectors`` (vec_id, embedding) where ``queries`` holds."""
    spark = vectors.sparkSession
    good = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector"), queries.alias("asks")
    )
    lengths = good.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = lengths[0]["d"]
    # -0.0 and 0.0 are equal components.
    good = good.where(F.size("vector") == dim).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    good = good.withColumn("same", F.sha2(F.to_json("vector").cast("binary"), 256))
    good = stored(good, "vectors")
    reps = good.groupBy("same").agg(F.min("vec_id").alias("rep"), F.min_by("vector", "vec_id").alias("vector"))
    reps = stored(reps.withColumn("length_class", _length_class()), "distinct-vectors")
    sizes = reps.groupBy("length_class").agg(F.count(F.lit(1)).alias("n")).collect()
    classes = spark.createDataFrame([tuple(r) for r in sizes], "length_class int, n long")

    asking = good.where("asks").groupBy("same").agg(F.lit(1).alias("asks")).join(reps, "same")
    placing = _places(dim, curves)
    place_type = "length_class int, curve int, place long, rep long, vector array<double>, asks int"
    columns = ["length_class", "rep", "vector", F.lit(0).alias("asks")]
    vectors_placed = reps.select(*columns).mapInPandas(placing, place_type)
    every_class = F.explode(F.array(*[F.lit(r["length_class"]) for r in sizes]))
    queries_placed = asking.select(*columns).mapInPandas(placing, place_type).select(
        every_class.alias("length_class"), "curve", "place", "rep", F.lit(None).cast("array<double>").alias("vector"), F.lit(1).alias("asks")
    )
    ranked = stored(_numbered(vectors_placed.unionAll(queries_placed)), "curve-ranks")

    at = ["length_class", "curve", "block"]
    reach = F.greatest(F.lit(k + 1), F.ceil(F.col("n") * window))
    lo = F.floor(F.greatest(F.col("rank") - reach, F.lit(0)) / block_rows)
    hi = F.floor(F.least(F.col("rank") + reach, F.col("n") - 1) / block_rows)
    asked = ranked.where("asks = 1").join(F.broadcast(classes), "length_class").select(
        "length_class", "curve", F.col("rep").alias("query"), F.sequence(lo, hi).alias("blocks")
    )
    # A block is met by all queries around it; beyond `ask_rows` they are dealt over copies of the block.
    loads = asked.select("length_class", "curve", F.explode("blocks").alias("block")).groupBy(*at).agg(
        F.ceil(F.count(F.lit(1)) / ask_rows).alias("parts")
    )
    loads = stored(loads, "block-loads")
    vector_of = reps.select(F.col("rep").alias("query"), F.col("vector").alias("asking"))
    asked = asked.join(vector_of, "query").select("length_class", "curve", F.explode("blocks").alias("block"), "query", "asking")
    asked = asked.join(loads, at).selectExpr(
        "length_class AS in_class", "curve AS on_curve", "block AS at_block", "pmod(xxhash64(query), parts) AS in_part", "query", "asking"
    )
    blocks = ranked.where("asks = 0").withColumn("block", F.floor(F.col("rank") / block_rows)).join(loads, at).select(
        *at, F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), "rep", "vector"
    )
    met = asked.groupBy("in_class", "on_curve", "at_block", "in_part").cogroup(blocks.groupBy(*at, "part")).applyInPandas(
        _compared(k + 1), "query long, rep long, score double"
    )
    # A pair can meet on several curves. Its score is then the same but for rounding.
    pairs = met.groupBy("query", "rep").agg(F.max("score").alias("score"))
    best = pairs.selectExpr("query", "rep", "row_number() OVER (PARTITION BY query ORDER BY score DESC, rep) AS r").where(F.col("r") <= k + 1)

    # Exact scores on the original vectors, in order of components.
    product = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = (
        best.join(reps.select(F.col("rep").alias("query"), F.col("vector").alias("q")), "query")
        .join(reps.select("rep", F.col("vector").alias("v")), "rep")
        .select("query", "rep", product.alias("score"))
    )
    # Every member of a class of equal vectors, as far as any ranking can need it.
    member = good.join(reps.select("same", "rep"), "same").select("rep", "vec_id", "asks")
    few = member.selectExpr("rep", "vec_id", "row_number() OVER (PARTITION BY rep ORDER BY vec_id) AS m").where(F.col("m") <= k + 1)
    # Of a query's best classes only so many members can be ranked; the others are left out before the join by query.
    listed = scored.join(few.select("rep", "vec_id"), "rep").selectExpr(
        "query", "vec_id", "score", "row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS r"
    ).where(F.col("r") <= k + 1).drop("r")
    asks = member.where("asks").select(F.col("rep").alias("query"), F.col("vec_id").alias("query_id"))
    final = asks.join(listed, "query").where("query_id <> vec_id")
    rank = "CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank"
    return final.selectExpr("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)
