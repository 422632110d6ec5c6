import math
import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

from thermowatt.llm import llm_queries, ngrams
from thermowatt.llm.ngrams import free, score, train

START, END = "<start>", "<end>"


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x20\x09-\x0D]+", lowered) + [END]


class Naive:
    """The model by its formulas, over dictionaries of whole n-grams."""

    def __init__(self, texts, order):
        self.order, self.raw = order, Counter()
        counts = Counter()
        for text in texts:
            self.raw.update(tokens(text))
            line = [START] * (order - 1) + tokens(text)
            counts.update(tuple(line[i : i + order]) for i in range(len(line) - order + 1))
        self.counts = {order: counts}
        for k in range(order - 1, 0, -1):
            lower = Counter()
            for gram, n in self.counts[k + 1].items():
                lower[gram[1:]] += n if gram[1] == START else 1
            self.counts[k] = lower
        self.discounts = {}
        for k, own in self.counts.items():
            n = [0, *(sum(c == i for c in own.values()) for i in (1, 2, 3, 4))]
            if all(n[1:]):
                y = n[1] / (n[1] + 2 * n[2])
                self.discounts[k] = [0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0), i) for i in (1, 2, 3)]
            else:
                self.discounts[k] = [0, 0.5, 1, 1.5]

    def prob(self, gram):
        k = len(gram)
        if not k:
            return 1 / (len(self.raw) + 1)
        own = {g: n for g, n in self.counts[k].items() if g[:-1] == gram[:-1]}
        if not own:
            return self.prob(gram[1:])
        total = sum(own.values())
        d = self.discounts[k]
        left = sum(d[min(n, 3)] for n in own.values()) / total
        n = own.get(gram, 0)
        return max(n - d[min(n, 3)], 0) / total + left * self.prob(gram[1:])

    def score(self, text):
        line = [START] * (self.order - 1) + tokens(text)
        grams = [tuple(line[i : i + self.order]) for i in range(len(line) - self.order + 1)]
        return sum(math.log10(self.prob(g)) for g in grams)

    def base(self, text):
        total, kinds = sum(self.raw.values()), len(self.raw)
        return sum(math.log10((self.raw[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in tokens(text))


TRAIN = [
    "the cat sat on the mat", "The cat ate the rat.", "a rat sat on a mat and the cat sat on it", "the dog sat on the log", None, "",
    "the the the the", "dog eat dog", "a dog and a cat and a rat", "ÄÖ äö The cat\x0bsat", "the cat sat on the mat",
]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_against_formulas(spark, order, monkeypatch):
    monkeypatch.setattr(ngrams, "FLUSH_TOKENS", 12)
    monkeypatch.setattr(ngrams, "BATCH_TOKENS", 9)
    naive = Naive(TRAIN, order)
    model = train(spark.createDataFrame([(t,) for t in TRAIN], "text string").repartition(3), order)
    asked = TRAIN + ["unknown words here", "the cat", "cat the unknown sat on", "A" * 50 + " \t\n b"]
    rows = [(i, t, "x", 1.0) for i, t in enumerate(asked)]
    got = score(spark.createDataFrame(rows, "doc_id int, text string, source string, score double"), model).collect()
    for r in got:
        text = asked[r.doc_id]
        own = tokens(text)
        assert r.n_tokens == len(own) and r.n_known == sum(t in naive.raw for t in own)
        assert r.base_score == pytest.approx(naive.base(text), rel=1e-12)
        assert r.score == pytest.approx(naive.score(text), rel=1e-12)
        assert r.perplexity == pytest.approx(10 ** (-naive.score(text) / len(own)))
    assert len(got) == len(asked) and got[0].source == "x"
    assert (model.kinds, model.tokens) == (len(naive.raw), sum(naive.raw.values()))
    # Probabilities after any context add up to one, with one share for what is unknown.
    for context in {g[:-1] for g in naive.counts[order]}:
        assert sum(naive.prob((*context, w)) for w in [*naive.raw, "unknown"]) == pytest.approx(1)
    free(spark, model)


def test_shards_and_pieces_do_not_change_the_model(spark, monkeypatch):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet").slice(0, 60)
    df = spark.createDataFrame([(t,) for t in table["text"].to_pylist()], "text string")
    rows = [(r.score, r.base_score) for r in score(df, train(df)).collect()]
    monkeypatch.setattr(ngrams, "FLUSH_TOKENS", 500)
    monkeypatch.setattr(ngrams, "SPLIT_CHARS", 100)
    monkeypatch.setattr(ngrams, "MEMO_WORDS", 50)
    other = train(df.repartition(5), shard_chars=1000)
    assert other.shards > 100
    assert [(r.score, r.base_score) for r in score(df, other).collect()] == [pytest.approx(r, rel=1e-12) for r in rows]


def test_a_folder_that_is_not_mounted_is_read(spark, monkeypatch):
    df = spark.createDataFrame([(t,) for t in TRAIN], "text string")
    model = train(df)
    path = ngrams._file(model.folder, 1, next(s for s in range(model.shards) if ngrams._mapped(ngrams._file(model.folder, 1, s))))
    mapped = [a.tolist() for a in ngrams._mapped(path)]

    class Remote:
        type_name = "hdfs"

        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return getattr(self.files, name)

    opened = ngrams._opened
    monkeypatch.setattr(ngrams, "_opened", lambda url: (Remote(opened(url)[0]), opened(url)[1]))
    assert [a.tolist() for a in ngrams._mapped(path)] == mapped and mapped[0] == sorted(mapped[0])


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([], "text string")
    model = train(df)
    assert (model.kinds, model.tokens) == (0, 0)
    (row,) = score(spark.createDataFrame([("a b",)], "text string"), model).collect()
    assert (row.n_tokens, row.n_known, row.base_score, row.score) == (3, 0, 0.0, 0.0)
    assert score(df, model).collect() == []


def test_query(spark, tmp_path):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet").slice(0, 50)
    pq.write_table(table, tmp_path / "documents.parquet")
    rows = dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in rows}
    naive = Naive([t for i, t in rows.items() if not out[i]], 2)
    got = {r.doc_id: r for r in llm_queries()["op11_lm_scoring"](spark, str(tmp_path)).collect()}
    assert set(got) == set(rows) and len(set(out.values())) == 2
    for i, text in rows.items():
        own = tokens(text)
        assert (got[i].held_out, got[i].n_tokens, got[i].train_tokens) == (out[i], len(own), sum(naive.raw.values()))
        assert got[i].n_known == sum(t in naive.raw for t in own)
        assert got[i].base_score == pytest.approx(naive.base(text), rel=1e-12)
    for i in sorted(rows, key=lambda i: len(rows[i] or ""))[:12]:
        assert got[i].score == pytest.approx(naive.score(rows[i]), rel=1e-12)


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    got = llm_queries()["op11_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > got["sum(base_score)"]


def test_a_word_is_hashed_once_for_texts_split_together(monkeypatch):
    hashed = []

    class Counting:
        @staticmethod
        def xxh3_64_intdigest(word):
            hashed.append(bytes(word))
            return digest(word)

    digest = ngrams.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(ngrams, "xxhash", Counting)
    texts = [" \tA b\x0bc ", "", "  ", "c\x1cd É a a", "B\r\n" * 3000]
    words = [[bytes(w) for w in t.encode().lower().split()] for t in texts]
    found = [w.tolist() for w in ngrams._hashed(texts)]
    assert found == [[digest(w) for w in ws] for ws in words]
    assert sorted(set(hashed) - {b""}) == sorted(w for w in hashed if w) == sorted({w for ws in words for w in ws})
