import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from thermowatt.llm import llm_queries
from thermowatt.llm.spelling import BidirectionalIndex, near_pairs, near_words, spelling_variants, suffix_ranks


def naive_pairs(words):
    """Pairs one edit apart, by taking out a code point of either or both."""
    found, without = set(), {}
    known = set(words)
    for w in words:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            if rest in known:
                found |= {(w, rest), (rest, w)}
            without.setdefault((i, rest), []).append(w)
    for own in without.values():
        found |= {(a, b) for a in own for b in own if a != b}
    return found


def naive_variants(counts):
    near = {w: set() for w in counts}
    for a, b in naive_pairs(list(counts)):
        near[a].add(b)
    forms = {}
    for w, own in near.items():
        top = min(own, key=lambda x: (-counts[x], x), default=None)
        forms[w] = top if own and counts[top] >= 10 * counts[w] else None
    rows = set()
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, n, len(near[w]), forms[w], counts[forms[w]] if forms[w] else None, root))
    return rows


def random_words(rng, alphabet, lengths, count):
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(*lengths))) for _ in range(count)})


def test_suffix_ranks():
    rng = np.random.default_rng(1)
    for top in (2, 3, 40):
        text = np.concatenate((rng.integers(1, top, 300), [0]))
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffix_ranks(text, top).tolist() == want


@pytest.mark.parametrize("alphabet, lengths", [("ab", (2, 9)), ("abcdé", (7, 8)), ("aÿ中", (3, 5)), ("ab", (60, 62))])
def test_index_against_brute_force(alphabet, lengths):
    rng = random.Random(2)
    words = random_words(rng, alphabet, lengths, 150)
    words += [w[:40] + w[41:] for w in words if len(w) > 50]
    found = set()
    for right in (True, False):
        q, w = near_words(BidirectionalIndex(words), words, right)
        found |= {(words[a], words[b]) for a, b in zip(q, w)}
    want = naive_pairs(words)
    assert found | {(b, a) for a, b in found} == want and want


def test_words_that_are_not_indexed():
    index = BidirectionalIndex(["abcdefg", "abcdefgh"])
    assert [x.tolist() for x in near_words(index, ["abczefg", "ab€defg", "zzzzzzz", "abcdefg"], True)] == [[0, 3], [0, 1]]
    assert [x.tolist() for x in near_words(index, ["ab€defg"], False)] == [[0], [0]]


WORDS = "word string, n long, m string, near string"


def test_variants_against_brute_force(spark):
    rng = random.Random(3)
    counts = {w: rng.choice([2, 3, 25, 260, 2_700]) for w in random_words(rng, "abé", (7, 9), 700)}
    df = spark.createDataFrame([(w, n, "x", "y") for w, n in counts.items()], WORDS)
    got = {tuple(r) for r in spelling_variants(df).collect()}
    want = naive_variants(counts)
    assert got == want
    # Chains of forms are there, and words without any.
    assert any(form not in (None, root) for *_, form, _, root in want) and any(r[3] is None for r in want)


def test_a_half_that_many_words_share(spark):
    rng = random.Random(4)
    words = ["samehalf" + w for w in random_words(rng, "abc", (7, 8), 300)] + random_words(rng, "abcd", (7, 7), 100)
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = {(r.word, r.near) for r in near_pairs(df, shard_words=20).collect()}
    assert got == naive_pairs(words)


def test_defined_results(spark):
    rows = [("variant", 3, "c", "d"), ("variant", 2, "c", "d"), (None, 9, "c", "d"), ("short", 900, "c", "d"), ("", 1, "", ""),
            ("variants", 50, "c", "d"), ("varyants", None, "c", "d"), ("x" * 5_000, 1, "c", "d"), ("x" * 5_001, 10, "c", "d")]
    got = {r.word: tuple(r)[1:] for r in spelling_variants(spark.createDataFrame(rows, WORDS)).collect()}
    assert got == {
        "variant": (5, 1, "variants", 50, "variants"), "variants": (50, 2, None, None, "variants"),
        "varyants": (0, 1, "variants", 50, "variants"),
        "x" * 5_000: (1, 1, "x" * 5_001, 10, "x" * 5_001), "x" * 5_001: (10, 1, None, None, "x" * 5_001),
    }
    assert spelling_variants(spark.createDataFrame([], WORDS)).collect() == []


def test_query_against_brute_force(spark, tmp_path):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet").slice(0, 150)
    pq.write_table(table, tmp_path / "documents.parquet")
    counts = Counter()
    for doc_id, text in zip(table["doc_id"].to_pylist(), table["text"].to_pylist()):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    got = {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in llm_queries()["op13_spelling_variants"](spark, str(tmp_path)).collect()}
    assert got == naive_variants(counts) and any(r[2] for r in got)
