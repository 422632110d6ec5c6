import random
import re
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow.parquet as pq
import pytest

from thermowatt.llm import llm_queries, runs
from thermowatt.llm.runs import backward, collapse_runs, find_runs, forward, occurrences, periodic_runs


def naive_runs(words):
    """All runs by trying every period at every place."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(24, 3 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((start, stop - start, p) for (start, stop), p in found.items())


def numbered(texts):
    return np.array(sum(texts, []), np.int64), np.cumsum([len(t) for t in texts])


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 12, (64, 5)).astype(np.uint64)
    y = rng.integers(0, 1 << 12, (64, 5)).astype(np.uint64)
    a, b = x.copy(), y.copy()
    forward(a)
    forward(b)
    a *= b
    a %= np.uint64(runs.PRIME)
    backward(a)
    for c in range(5):
        want = [sum(int(x[i, c]) * int(y[(k - i) % 64, c]) for i in range(64)) % runs.PRIME for k in range(64)]
        assert a[:, c].tolist() == want


def test_occurrences_against_comparison():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 3, 600)
    codes[200:400] = np.tile(codes[200:217], 12)[:200]
    blocks = np.arange(0, 560, 16)
    got = set(zip(*(x.tolist() for x in occurrences(codes, blocks, 16, 16, 16))))
    padded = np.concatenate((codes, np.zeros(64, np.int64)))
    want = {(int(b), d) for b in blocks for d in range(16, 32) if (padded[b : b + 16] == padded[b + d : b + d + 16]).all()}
    assert got == want and any(d == 17 for _, d in want)


def test_runs_against_brute_force():
    rng = random.Random(5)
    kinds = set()
    for _ in range(60):
        texts = []
        for _ in range(6):
            words = []
            while rng.random() < 0.85:
                piece = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, rng.choice([3, 60])))]
                words += piece * rng.randint(1, 8)
                if rng.random() < 0.4:
                    words += piece[: rng.randint(0, len(piece))]
            texts.append(words)
        want = [naive_runs(t) for t in texts]
        assert find_runs(*numbered(texts)) == want
        kinds |= {p for own in want for _, _, p in own}
    assert {1, 3, 4} < kinds and max(kinds) > 40


def test_long_periods_and_long_texts():
    rng = np.random.default_rng(3)
    piece = rng.integers(0, 1000, 20_000)
    text = np.concatenate((rng.integers(1000, 2000, 77), np.tile(piece, 3), piece[:5], [2000]))
    assert find_runs(text, np.array([len(text)])) == [[(77, 60_005, 20_000)]]
    assert find_runs(np.zeros(150_000, np.int64), np.array([150_000])) == [[(0, 150_000, 1)]]


def test_at_the_limits():
    one = [1] * 24
    assert find_runs(*numbered([one, one[1:], [1, 2, 3] * 8, [1, 2, 3] * 7 + [1, 2], list(range(9)) * 3, (list(range(9)) * 3)[:-1]])) == [
        [(0, 24, 1)], [], [(0, 24, 3)], [], [(0, 27, 9)], [],
    ]
    # Runs end with their text, whatever follows.
    assert find_runs(*numbered([[1] * 20, [1] * 20, []])) == [[], [], []]


def test_batches_do_not_change_the_result(spark, monkeypatch):
    monkeypatch.setattr(runs, "BATCH_WORDS", 30)
    texts = ["a b c " * n for n in range(20)]
    got = [r for _, r, _ in runs._described(texts)]
    assert got == [naive_runs(t.split()) for t in texts]


def test_frame(spark):
    rows = [
        (1, "Start " + "x y\n" * 15 + "end", "c", 5), (1, "Start " + "x y\n" * 15 + "end", "c", 5), (2, None, None, None),
        (3, "", "c", 1), (None, " \t\r\n", "c", 1), (4, "A b " * 24, "c", 1), (5, "no  runs\there", "c", 0),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int")
    got = periodic_runs(df).collect()
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [
        (1, 32, [(1, 30, 2)], "Start x y end"), (1, 32, [(1, 30, 2)], "Start x y end"), (2, 0, [], ""), (3, 0, [], ""),
        (None, 0, [], ""), (4, 24, [(0, 24, 1)], "A b"), (5, 3, [], "no runs here"),
    ]
    kept = collapse_runs(df).collect()
    assert [r.text for r in kept] == ["Start x y end"] * 2 + [None, "", " \t\r\n", "A b", "no  runs\there"]
    assert kept[0].runs == "c" and kept[0].n_words == 5
    assert periodic_runs(df.limit(0)).collect() == []


@pytest.mark.parametrize("rows", [120])
def test_query_against_brute_force(spark, tmp_path, rows):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet")
    chosen = [i for i in range(len(table)) if zlib.crc32(str(table["doc_id"][i].as_py()).encode()) % 10 == 0]
    table = table.take(sorted({*chosen, *range(rows)}))
    folder = tmp_path / "sf"
    folder.mkdir()
    pq.write_table(table, folder / "documents.parquet")
    got = {r.doc_id: r.asDict() for r in llm_queries()["op12_periodic_runs"](spark, str(folder)).collect()}
    seen = 0
    for doc_id, text in zip(table["doc_id"].to_pylist(), table["text"].to_pylist()):
        words = re.findall("[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = naive_runs(words)
        seen += len(found)
        gone = {i for start, length, q in found for i in range(start + q, start + length)}
        top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        assert got[doc_id] == {
            "doc_id": doc_id, "n_runs": len(found), "start": top[0], "length": top[1], "period": top[2],
            "exponent_milli": top[1] and 1000 * top[1] // top[2],
            "runs_sha256": sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
            "collapsed_sha256": sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
        }
    assert seen > 50
