import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermowatt.llm import language
from thermowatt.llm.language import codes, grams, identify

KIND = "doc_id long, text string, lang string"


def naive(text, vocabulary):
    """Interpolated Kneser-Ney over strings; the discount of an order from its counts of counts."""
    padded = "   " + text
    counts = {4: Counter(padded[i : i + 4] for i in range(len(text)))}
    for order in (3, 2, 1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])

    def prob(context, char):
        order = len(context) + 1
        table = counts[order]
        kinds = Counter(table.values())
        d = kinds[1] / (kinds[1] + 2 * kinds[2]) if kinds[1] and kinds[2] else 0.75
        own = {g[-1]: n for g, n in table.items() if g[:-1] == context}
        lower = prob(context[1:], char) if order > 1 else 1 / vocabulary
        if not own:
            return lower
        total = sum(own.values())
        share = max(own.get(char, 0) - d, 0) / total
        left = sum(min(n, d) for n in own.values()) / total
        return share + left * lower

    return prob


WORDS = {"a": "the cat sat on the mat and the rat ran at the cat", "b": "einige worte anderer art und weise, eine art worte", "c": "ñandú y nada"}


def contexts_of(probe):
    return grams(np.concatenate((np.full(3, 32), codes(probe))), np.array([0]))[:2]


@pytest.mark.parametrize("block", [16, 2])
def test_same_probabilities_as_a_naive_model(spark, monkeypatch, block):
    monkeypatch.setattr(language, "BLOCK", block)
    model = language.train(spark.createDataFrame([(x, t) for x, t in WORDS.items()], "lang string, text string"))
    assert model.languages == list("abc") and len(model.blocks) == (1 if block == 16 else 2)
    vocabulary = len(set("".join(WORDS.values()))) + 1
    for probe in ("the cat", "zebra at the", "xq z", "worte und ñandú"):
        got = model.logs(*contexts_of(probe))
        padded = "   " + probe
        for k, text in enumerate(WORDS.values()):
            prob = naive(text, vocabulary)
            assert np.allclose(got[:, k], [np.log(prob(padded[i : i + 3], padded[i + 3])) for i in range(len(probe))], atol=1e-4)


def test_pruning_keeps_statistics_of_all_and_sums_to_one(spark, monkeypatch):
    rows = spark.createDataFrame([(x, t) for x, t in WORDS.items()], "lang string, text string")
    whole = {o: {(r.lang, r.context, r.ch): r.share for r in d.collect()} for o, d in language.shares(language.count_grams(rows)).items()}
    monkeypatch.setattr(language, "MODEL_CELLS", 1)
    monkeypatch.setattr(language, "LEAST_GRAMS", 9)
    for order, level in language.shares(language.count_grams(rows)).items():
        kept = language._pruned(level, 9).collect()
        assert Counter(r.lang for r in kept) == {x: min(9, sum(k[0] == x for k in whole[order])) for x in "abc"}
        assert all(whole[order][r.lang, r.context, r.ch] == r.share for r in kept)
    model = language.train(rows)
    chars = np.array(sorted(set(codes("".join(WORDS.values())).tolist())))
    for context in contexts_of("the cat und")[0]:
        total = np.exp(model.logs(np.full(len(chars), context), chars).astype(float)).sum(0)
        # One more character stands for all that were never seen.
        unseen = np.exp(model.logs(np.array([context]), np.array([0x4E00])).astype(float))[0]
        assert np.allclose(total + unseen, 1, atol=1e-4)


def test_seventy_languages(spark):
    rng = random.Random(4)
    rows = []
    for k in range(70):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 7))) for _ in range(40)]
        rows += [(k * 1000 + i, " ".join(rng.choices(words, k=30)), f"l{k:02}") for i in range(20 if k < 69 else 8)]
    got = identify(spark.createDataFrame(rows, KIND)).where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert {r.lang_pred for r in got if r.lang == "l69"} <= {"l69"} and any(r.lang == "l69" for r in got)


def test_long_texts_in_chunks(monkeypatch):
    texts = ["ab  c1", "", "x" * 50, "some more text " * 9]
    whole = [np.concatenate([np.stack(grams(c, s)[:2]) for c, s, _ in language.chunks([t])], 1) for t in texts if t]
    monkeypatch.setattr(language, "CHUNK_CHARS", 7)
    for t, w in zip([t for t in texts if t], whole):
        assert np.array_equal(np.concatenate([np.stack(grams(c, s)[:2]) for c, s, _ in language.chunks([t])], 1), w)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_accuracy_on_held_out_documents(given):
    rows = identify(given).select("doc_id", "lang", "lang_pred", "held_out", "score", "rejected").collect()
    assert len(rows) == given.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    out = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert sum(out) / len(out) > 0.99
    assert sum(r.rejected for r in rows) <= 0.005 * len(rows)


def test_labels_of_held_out_documents_do_not_matter(spark, given):
    some = given.where("doc_id < 300").select("doc_id", "text", "lang")
    twisted = some.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    a = {r.doc_id: (r.lang_pred, round(r.score, 6)) for r in identify(some).collect()}
    b = {r.doc_id: (r.lang_pred, round(r.score, 6)) for r in identify(twisted).collect()}
    assert a == b and "xx" not in {x for x, _ in b.values()}


def test_gibberish_is_rejected_and_odd_rows_have_results(spark, given):
    rng = random.Random(1)
    noise = "".join(rng.choice("qxzjkwvy漢字ЖЯ") for _ in range(600))
    odd = [(9_000_001, None, None), (9_000_002, "", "en"), (9_000_003, "123 !!", None), (9_000_004, noise, None),
           (None, "the thing and the other of them", None), (9_000_005, "the of and " * 60_000, None)]
    df = given.select("doc_id", "text", "lang").unionAll(spark.createDataFrame(odd + odd, KIND)).withColumn("score", F.lit("clash"))
    got = defaultdict(list)
    for r in identify(df).where("doc_id IS NULL OR doc_id > 9000000").collect():
        got[r.doc_id].append((r.lang_pred, r.rejected))
    for i in (9_000_001, 9_000_002, 9_000_003):
        assert got[i] == [("und", True)] * 2
    assert [x[1] for x in got[9_000_004]] == [True] * 2
    assert got[None] == [("en", False)] * 2
    assert got[9_000_005][0][0] == "en"


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "text", None), (2, None, "en")], KIND)
    assert {(r.lang_pred, r.score, r.rejected) for r in identify(df).collect()} == {("und", 0.0, True)}
    assert identify(df.where("false")).collect() == []


def test_noise_is_rejected_and_clean_text_is_not(spark, given):
    rng = random.Random(8)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300)) for _ in range(200)]
    extra = spark.createDataFrame([(9_000_000 + i, t, None) for i, t in enumerate(noise)], KIND)
    rows = identify(given.select("doc_id", "text", "lang").unionAll(extra)).select("doc_id", "rejected", "lang_pred").collect()
    wrong = [r.rejected for r in rows if r.doc_id < 9_000_000 and r.lang_pred != "und"]
    assert sum(wrong) <= 0.005 * len(wrong)
    assert sum(r.rejected for r in rows if r.doc_id >= 9_000_000) >= 0.98 * len(noise)


def test_the_driver_lays_out_no_model_and_measures_no_text(spark, given, monkeypatch):
    """Both once took the driver over its memory."""
    driver = os.getpid()

    def in_tasks(work):
        def run(*args):
            assert os.getpid() != driver
            return work(*args)

        return run

    monkeypatch.setattr(language, "_combined", in_tasks(language._combined))
    monkeypatch.setattr(language.Model, "entropies", in_tasks(language.Model.entropies))
    some = given.where("doc_id < 200")
    rows = identify(some).collect()
    assert len(rows) == some.count() and {r.lang_pred for r in rows} <= {"en", "de", "fr", "es", "und"}
