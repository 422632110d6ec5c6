import itertools
import zlib
from collections import Counter

import corpus_pipeline
import pytest
from thermowatt.llm.common import stored
from thermowatt.llm.mixing import mix, mixed_order, positioned

from .test_lines import brute as brute_lines
from .test_simhash import naive_fingerprint, roots

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns
    assert set(steps[-1].columns) == {*steps[0].columns, "token_ids", "n_tokens", "round_trip"}


def test_language_id_keeps_clean_documents_as_they_are(steps):
    before, after = texts(steps[0]), texts(steps[1])
    assert after.items() <= before.items() and len(after) >= 0.99 * len(before)


def test_line_dedup_against_brute_force(steps):
    before, after = texts(steps[1]), texts(steps[2])
    gone = brute_lines(list(before.items()))
    want = {d: "\n".join(x for i, x in enumerate((t or "").split("\n")) if (d, i) not in {g[:2] for g in gone}) for d, t in before.items()}
    assert before.keys() == after.keys()
    assert sum(want[d] == after[d] for d in want) >= 0.97 * len(want)


def test_one_document_of_each_group_stays(steps):
    before, after = texts(steps[2]), texts(steps[3])
    ids = sorted(before)
    fps = [naive_fingerprint(before[i]) for i in ids]
    near = [(i, j) for i, j in itertools.combinations(range(len(ids)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4]
    assert after.keys() == {ids[r] for r in roots(len(ids), near)}


def test_mixing_changes_the_order_only(steps):
    assert texts(steps[4]) == texts(steps[3])


def test_tokens_decode_to_the_text(steps):
    rows = steps[5].collect()
    assert {r.doc_id: r.text for r in rows} == texts(steps[4])
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in rows)


def test_run_gives_the_same(spark, steps):
    key = lambda df: sorted((r.doc_id, r.n_tokens, zlib.crc32(str(r.token_ids).encode())) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(steps[5])


def test_run_carries_the_mixed_order(spark, steps):
    rows = sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda r: r.mix_position)
    assert [r.mix_position for r in rows] == list(range(len(rows)))
    assert [r.doc_id for r in rows] == [r.doc_id for r in mix(steps[3]).orderBy("mix_position").collect()]


def test_order_is_read_from_files_however_they_are_packed(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('s', CAST(log2(1 + id % 512) AS INT)) AS source", "'x' AS text")
    docs = stored(mixed_order(docs, block_rows=8), "test-order")
    rows = sorted(positioned(docs).repartition(7, "doc_id").collect(), key=lambda r: r.mix_position)
    assert [r.mix_position for r in rows] == list(range(20_000))
    deviates_less_than(rows, block=8)


def deviates_less_than(rows, block):
    """Before a source ends each has had its weight, to within a block (and the slot's own)."""
    sizes, got = Counter(r.source for r in rows), Counter()
    weights = {s: n**0.5 / sum(x**0.5 for x in sizes.values()) for s, n in sizes.items()}
    for at, r in enumerate(rows, 1):
        got[r.source] += 1
        if got[r.source] > sizes[r.source] - block:
            break
        assert all(abs(got[s] - at * w) < 2 * block for s, w in weights.items())
    assert len(rows) > block and at > block
