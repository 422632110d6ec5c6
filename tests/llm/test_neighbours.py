import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from thermowatt.llm.neighbours import hilbert, nearest


def brute(rows, k, asks):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 4 and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    out = []
    for q, v in good:
        if asks(q):
            best = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("d, bits", [(2, 4), (3, 3), (8, 1)])
def test_hilbert_steps_to_neighbouring_cells(d, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
    places = hilbert(cells, bits)
    assert sorted(places) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_ties_repeats_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).round(1).tolist()) for i in range(60)]
    rows += [(100 + i, [0.5, 0.25, -0.5, 1.0]) for i in range(40)] + [(60 + i, [1.0, 0.0, -0.0, 0.0]) for i in range(8)]
    rows += [(200, None), (201, [0.0] * 4), (202, [1.0, None, 1.0, 1.0]), (203, [float("nan")] * 4), (205, [1.0, 2.0]), (None, [1.0] * 4), (206, [float("inf")] * 4)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, rep string, rank int")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    for k in (3, 30):
        got = sorted(map(tuple, nearest(df, F.col("vec_id") % 5 == 0, k, window=1.0, block_rows=16).collect()))
        want = brute(rows, k, lambda q: q % 5 == 0)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-12)


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (20, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, nearest(df, F.lit(True)).collect())) == [(0, 1, 20, 4.0), (20, 1, 0, 4.0)]
    assert nearest(df.where("vec_id = 0"), F.lit(True)).collect() == []
    assert nearest(df.where("false"), F.lit(True)).collect() == []


def test_recall(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    table = pq.read_table(path)
    ids, x = np.array(table["vec_id"]), np.array(table["embedding"].to_pylist(), float)
    got = {}
    for r in nearest(spark.read.parquet(path), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        true = set(ids[np.argsort(-scores)[:20]].tolist())
        assert len(got[ids[i]]) == 20
        hits, total = hits + len(true & set(got[ids[i]])), total + 20
    assert hits / total >= 0.9


@pytest.mark.parametrize("lengths", ["unit", "lognormal", "one long"])
def test_recall_of_windows(spark, lengths):
    rng = np.random.default_rng(5)
    n = 20_000
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if lengths == "lognormal":
        x *= rng.lognormal(size=n)[:, None]
    if lengths == "one long":
        x[17] *= 1000
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": x.tolist()}))
    got = {}
    for r in nearest(df, F.col("vec_id") % 400 == 0, block_rows=64, ask_rows=8).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for i in range(0, n, 400):
        scores = x @ x[i]
        scores[i] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & got[i])
    assert hits / (20 * n / 400) >= 0.9
