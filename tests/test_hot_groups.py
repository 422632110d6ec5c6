from collections import Counter

from pyspark.sql import functions as F

from thermowatt.operators.hot_groups import SLICE, SplitPolicy, slice_groups

POLICY = SplitPolicy(rows_per_slice=150)


def rows(spark):
    """Key 'hot' holds a third of 3,000 rows, the others 20 each."""
    data = [("hot", float(i)) for i in range(1000)] + [(f"k{i % 100}", float(i)) for i in range(2000)]
    return spark.createDataFrame(data, "k string, v double").repartition(6)


def test_hot_group_is_cut_into_even_ordered_slices(spark):
    found = slice_groups(rows(spark), ["k"], "v", POLICY)
    assert [r["k"] for r in found.cut_keys.collect()] == ["hot"]
    sizes = Counter(r[SLICE] for r in found.rows.where("k = 'hot'").collect())
    # 1,000 rows in slices of 150.
    assert sorted(sizes) == list(range(7)) and max(sizes.values()) < 200
    spans = found.rows.where("k = 'hot'").groupBy(SLICE).agg(F.min("v").alias("a"), F.max("v").alias("b")).orderBy(SLICE).collect()
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))
    assert found.rows.where("k <> 'hot'").select(SLICE).distinct().collect()[0][0] == 0
    assert found.rows.count() == 3000


def test_more_slices_than_one_chunk(spark):
    found = slice_groups(rows(spark), ["k"], "v", SplitPolicy(rows_per_slice=5))
    sizes = Counter(r[SLICE] for r in found.rows.where("k = 'hot'").collect())
    assert sorted(sizes) == list(range(200)) and max(sizes.values()) < 12
    # Every other key is hot as well: 20 rows in slices of about five.
    others = Counter((r["k"], r[SLICE]) for r in found.rows.where("k <> 'hot'").collect())
    assert sum(others.values()) == 2000 and max(others.values()) <= 10


def test_small_input_is_left_alone(spark):
    assert slice_groups(rows(spark), ["k"], "v", SplitPolicy()).cut_keys is None


def test_one_value_only(spark):
    same = spark.createDataFrame([("a", 1.0)] * 500 + [("b", None)] * 3, "k string, v double")
    found = slice_groups(same, ["k"], "v", POLICY)
    assert found.rows.count() == 503
    assert found.rows.where("k = 'a'").select(SLICE).distinct().count() == 1


def test_no_rows(spark):
    found = slice_groups(rows(spark).where("v < 0"), ["k"], "v", POLICY)
    assert found.cut_keys is None and found.rows.count() == 0


def test_cut_along_offsets_as_from_a_topic(spark):
    data = [("hot", i) for i in range(400)] + [(f"k{i}", i) for i in range(50)]
    df = spark.createDataFrame(data, "k string, offset long")
    found = slice_groups(df, ["k"], "offset", SplitPolicy(rows_per_slice=20))
    assert found.rows.where("k = 'hot'").select(SLICE).distinct().count() > 10
