import hashlib
import random
import re

import pyarrow.parquet as pq
import pytest

from thermowatt.llm.spans import drop_repeated_passages, n_words, repeated_passages, sentences, spans

KIND = "doc_id long, text string, hash string"


def naive_gone(rows):
    """(doc_id, text) -> indices of sentences that any repeated run, but the first of its kind, covers; by all runs."""
    first, gone = {}, {}
    keyed = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    for doc_id, text in keyed:
        parts = [text[i:j] for i, j in sentences(text or "")] if text else []
        words = [" ".join(p.lower().split()) for p in parts]
        sizes = [n_words(p) for p in parts]
        for i in range(len(parts)):
            for j in range(i + 2, len(parts) + 1):
                if sum(sizes[i:j]) >= 25:
                    span = hashlib.sha256("\n".join(words[i:j]).encode()).digest()
                    if first.setdefault(span, (doc_id, text, i)) != (doc_id, text, i):
                        gone.setdefault((doc_id, text), set()).update(range(i, j))
    return gone


def passages(spark, *texts):
    """Removed passages of the documents 1, 2, ..."""
    found = repeated_passages(spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")).collect()
    return {(r.doc_id, r.passage) for r in found}


def some_words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def test_sentences():
    assert [s[slice(*x)] for s in ["One. Two!\nthree  four? 1.5 e.g. x\n\n y"] for x in sentences(s)] == ["One.", "Two!", "three  four?", "1.5 e.g.", "x", "y"]
    assert sentences("") == sentences(" \n ") == []


def test_spans_reach_enough_words():
    for first, last, words, _ in spans("One two three. " * 30):
        assert last > first and words >= 25


def test_against_brute_force(spark):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet").slice(0, 400)
    rows = [r for r in zip(table["doc_id"].to_pylist(), table["text"].to_pylist()) if len(sentences(r[1] or "")) < 200]
    assert len(rows) > 200
    passage = re.sub(r"\s+", " ", "This passage has more than fifty words. " * 8 + "It ends with some others of its own, so that its length varies. And so on.")
    rows += [(5000, f"Own start here. {passage} Own end."), (5001, f"Else. {passage.upper()}\nMore."), (5002, None), (5003, ""), (5000, f"Own start here. {passage} Own end."), (None, passage)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], KIND)
    want = naive_gone(rows)
    got = {}
    for r in repeated_passages(df).collect():
        text = next(t for d, t in rows if d == r.doc_id and t and t[r.start : r.stop] == r.passage)
        places = sentences(text)
        assert places[r.sentence][0] == r.start
        got.setdefault((r.doc_id, text), set()).update(i for i, p in enumerate(places) if r.start <= p[0] and p[1] <= r.stop)
    assert got == want
    assert any(d == 5001 for d, _ in want) and any(d is None for d, _ in want)

    left = {(r.doc_id, r.text) for r in drop_repeated_passages(df).collect()}
    assert (5003, "") in left and (5002, None) in left
    kept = next(t for d, t in left if d == 5001)
    assert "FIFTY" not in kept and kept.startswith("Else.") and kept.endswith("More.")


def test_against_brute_force_on_runs_of_all_sizes(spark):
    rng = random.Random(21)
    pool = [some_words(rng.choice([1, 3, 8, 14, 24, 40, 70]), k) + rng.choice(". |! |? |\n").rstrip("|") for k in range(60)]
    rows = []
    for doc_id in range(150):
        at = rng.randrange(60)
        run = [pool[(at + i) % 60] for i in range(rng.randrange(1, 9))]
        rows.append((doc_id, " ".join([some_words(9, 1000 + doc_id) + ".", *run, some_words(5, 2000 + doc_id) + "."])))
    want = naive_gone(rows)
    got, texts = {}, dict(rows)
    for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        places = sentences(texts[r.doc_id])
        covered = {i for i, p in enumerate(places) if r.start <= p[0] and p[1] <= r.stop}
        got.setdefault((r.doc_id, texts[r.doc_id]), set()).update(covered)
    assert got == want and len(want) > 50


def test_one_long_sentence(spark):
    long = some_words(60, 1) + "."
    found = passages(spark, f"{some_words(9, 2)}. {long} {some_words(9, 3)}.", f"{some_words(12, 4)}! {long} {some_words(7, 5)}?")
    assert len(found) == 1 and all(d == 2 and n_words(p) >= 30 and p in long for d, p in found)


def test_tail_of_a_run(spark):
    run = f"{some_words(24, 1)}. {some_words(5, 2)}. {some_words(5, 3)}."
    assert passages(spark, f"{some_words(9, 4)}. {run}", f"{run} {some_words(9, 5)}.") == {(2, run)}


def test_run_of_short_sentences(spark):
    run = " ".join(some_words(2, i) + "." for i in range(20))
    assert passages(spark, f"Start one. {run} End one.", f"Other start? {run} Other end!") == {(2, run)}
    # Below the least number of words nothing goes.
    assert passages(spark, f"Start one. {run[:60]}. End one.", f"Other start? {run[:60]}. Other end!") == set()


@pytest.mark.parametrize("stop, letters", [("。", "一二三四五六七八九十百千万天地人日月山水火木金土"), ("। ", "कखगघचछजझटठडढ ")])
def test_other_scripts(spark, stop, letters):
    rng = random.Random(3)
    sentence = lambda: "".join(rng.choice(letters) for _ in range(16)).strip() + stop
    run = "".join(sentence() for _ in range(30)).strip()
    found = passages(spark, sentence() + run, sentence() + run + sentence())
    assert found == {(2, run)}


def test_stops_before_quotes():
    s = 'He said "no." Then (he left.) “Yes.” she.'
    assert [s[i:j] for i, j in sentences(s)] == ['He said "no."', "Then (he left.)", "“Yes.”", "she."]


def test_long_sentences_are_cut_by_their_words_alone():
    run = some_words(300, 8)
    a, b = f"{some_words(30, 9)} {run}", f"{run} {some_words(11, 10)}"
    cut = lambda s: {s[i:j] for i, j in sentences(s)}
    assert len(cut(a) & cut(b)) >= len(cut(run)) - 2 > 10
    assert sentences("x " * 50) == [(0, 99)]


def test_very_long_texts_are_taken_whole(spark):
    rng = random.Random(6)
    run = " ".join(f"{some_words(10, i)}." for i in range(30))
    filler = " ".join(f"w{rng.randrange(10**9)} of it." for _ in range(60_000))
    assert passages(spark, run, f"{filler} {run}") == {(2, run)}


def test_columns_of_any_names(spark):
    run = " ".join(f"{some_words(10, i)}." for i in range(6))
    df = spark.createDataFrame([(1, run, 1, 2, 3), (2, run, 4, 5, 6)], "doc_id long, text string, _gone int, _doc_key int, hash int")
    left = drop_repeated_passages(df)
    assert left.columns == df.columns
    assert {tuple(r) for r in left.collect()} == {(1, run, 1, 2, 3), (2, "", 4, 5, 6)}


def test_empty_table(spark):
    assert repeated_passages(spark.createDataFrame([], "doc_id long, text string")).collect() == []
