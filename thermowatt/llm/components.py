"""Connected components of a table of links, by rounds of joins in Spark.

Union-find over partitions: every round hangs the larger neighbours of each
node under its smallest neighbour, then every node and its smaller neighbours
under the smallest of them (large-star and small-star). The links turn into
stars in a number of rounds that grows with the logarithm of the longest path.
Minima are reduced before each shuffle, and each round is written to the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources import drop_folder, shared_folder
from .common import stored

#: Rounds after which components are given up with an error; a path of n nodes takes about log2(n).
MAX_ROUNDS = 1_000


def _minimum(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest of a node and its neighbours."""
    return stored(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least-neighbours")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_minimum(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _minimum(down)
    hung = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root) for every node of a link; the root is the smallest node of its component.

    Links may repeat and run either way; those of a node with itself and those
    with a null are left out. Nodes are of any type that can be ordered.
    """
    spark = links.sparkSession
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u IS NOT NULL AND u <> v").distinct()
    root, path, last = shared_folder(spark, "components"), None, None
    for turn in range(MAX_ROUNDS):
        previous, path = path, f"{root}/{turn}"
        pairs.write.parquet(path)
        pairs = spark.read.schema(pairs.schema).parquet(path)
        # Sums of hashes tell whether a round changed anything.
        seen = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if previous:
            drop_folder(spark, previous)
        if tuple(seen) == last or not seen[0]:
            break
        last = tuple(seen)
        pairs = _small_star(_large_star(pairs)).where("u <> v").distinct()
    else:
        raise RuntimeError(f"links still change after {MAX_ROUNDS} rounds")
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
