import hashlib
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from check_oracle import compare, connect
from thermowatt.llm.exact_dedup import exact_dedup

SF = "/root/testdata/sf0.001"


def write(folder, *files):
    folder.mkdir()
    for i, rows in enumerate(files):
        kinds = {"doc_id": pa.int64(), "text": pa.string(), "path": pa.string(), "digest": pa.int64()}
        columns = {k: pa.array([r[j] for r in rows], t) for j, (k, t) in enumerate(kinds.items())}
        pq.write_table(pa.table(columns), folder / f"part-{i}.parquet")
    return str(folder)


def expected(*files):
    groups = {}
    for f, rows in enumerate(files):
        for r, (doc_id, text, *_) in enumerate(rows):
            t = re.sub("[\x20\x09-\x0d]+", " ", text or "")
            groups.setdefault(t, []).append((doc_id is None, doc_id or 0, f, r))
    out = []
    for t, members in groups.items():
        first = min(members)
        for m in members:
            ids = [None if x[0] else x[1] for x in (m, first)]
            out.append((*ids, len(members), m == first, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


FILES = (
    [(5, "a  b", "x", 1), (3, "a\tb", None, 1), (None, "a b", "x", 2), (9, None, "x", 1), (8, "", "x", 1), (7, " ", "x", 1)],
    [(1, "a\n\r b", "x", 1), (1, "a b", "x", 1), (None, "only", "x", 1), (4, "long " * 30_000, "x", 1)],
    [(2, "long " * 30_000, "x", 1), (6, "a b", "x", 1), (3, "a b", "x", 1)],
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("batches", [1, 3])
def test_against_brute_force(spark, tmp_path, batches):
    assert rows(exact_dedup(spark, write(tmp_path / "t", *FILES), batches)) == expected(*FILES)


def test_bytes_decide_when_digests_are_equal(spark, tmp_path):
    path = write(tmp_path / "t", *FILES)
    weak = exact_dedup(spark, path, 3, lambda text: F.substring(F.sha2(text, 256), 1, 0))
    assert rows(weak) == expected(*FILES)


def test_empty_table(spark, tmp_path):
    assert exact_dedup(spark, write(tmp_path / "t", [])).collect() == []


def test_same_rows_as_sql(spark):
    assert compare(spark, connect(SF), "op1_exact_dedup", SF) is None
