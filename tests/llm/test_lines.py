import itertools
import random
import time

import numpy as np
import pandas as pd
import pyarrow.parquet as pq

from thermowatt.llm import lines
from thermowatt.llm.lines import drop_repeated_lines, jaccard, line_links, normal_line, repeated_lines

KIND = "doc_id long, text string, line_no string"


def roots(nodes, links):
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def brute(rows):
    places = {}
    for doc_id, text in set(rows):
        for no, line in enumerate((text or "").split("\n")):
            if line := normal_line(line):
                places.setdefault(line, []).append((doc_id is None, doc_id or 0, no))
    links = [(a, b) for a, b in itertools.combinations(sorted(places), 2) if min(len(a), len(b)) * 2 > max(len(a), len(b)) and jaccard(a, b) >= 0.8]
    label, groups = roots(places, links), {}
    for line, own in places.items():
        groups.setdefault(label[line], []).extend(own)
    gone = set()
    for own in groups.values():
        first = min(own)
        gone |= {(None if p[0] else p[1], p[2], None if first[0] else first[1], first[2]) for p in own if p != first}
    return gone


def sample():
    """Texts of the given table in which lines come again, some with small changes."""
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet").slice(0, 40)
    rng = random.Random(9)
    pool = [line for t in table["text"].to_pylist() for line in t.split("\n")]
    rows = []
    for i in range(60):
        own = []
        for line in rng.choices(pool, k=8):
            line = line[:400]
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(line) + 1)
                line = line[:at] + rng.choice("xyz ") + line[at + 1 :]
            own.append(line)
        rows.append((i, "\n".join(own)))
    return rows


def test_against_brute_force(spark):
    rows = sample()
    df = spark.createDataFrame([(*r, "clash") for r in rows], KIND)
    got = {tuple(r) for r in repeated_lines(df).select("doc_id", "line_no", "first_doc_id", "first_line_no").collect()}
    want = brute(rows)
    assert len(want) > 100
    assert {g[:2] for g in got} <= {w[:2] for w in want}
    assert len(got & want) >= 0.97 * len(want)


def test_recall_at_the_threshold(spark):
    rng, rows, pairs = random.Random(2), [], []
    for i in range(150):
        a = "".join(rng.choice("abcdefghij klmnop") for _ in range(240))
        b = list(a)
        for at in rng.sample(range(240), 4):
            b[at] = "#"
        pairs.append((normal_line(a), normal_line("".join(b))))
        rows += [(2 * i, a), (2 * i + 1, "".join(b))]
    wanted = {(lines.line_id(a), lines.line_id(b)) for a, b in pairs if jaccard(a, b) >= 0.8}
    got = {frozenset(r) for r in line_links(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(wanted) > 50
    assert sum(frozenset(w) in got for w in wanted) >= 0.98 * len(wanted)


def test_texts_that_stay(spark):
    long = "A line that is long enough to take part in this."
    rows = [(2, f"{long}\nshort\n\nown words that come only here, once"), (1, f"short\n  {long.upper()}  \n"), (None, long),
            (3, None), (4, ""), (1, f"short\n  {long.upper()}  \n"), (5, long + "\n" + long), (6, "z" * 300_000)]
    out = drop_repeated_lines(spark.createDataFrame([(*r, "clash") for r in rows], KIND))
    assert out.columns == ["doc_id", "text", "line_no"]
    got = sorted((tuple(r)[:2] for r in out.collect()), key=str)
    want = [(2, "short\n\nown words that come only here, once"), (1, f"short\n  {long.upper()}  \n"), (1, f"short\n  {long.upper()}  \n"),
            (None, ""), (3, None), (4, ""), (5, ""), (6, "z" * 300_000)]
    assert got == sorted(want, key=str)


def test_lengths_are_counted_anew(spark):
    long = "A line that is long enough to take part in this."
    df = spark.createDataFrame([(1, long, 48), (2, f"{long}\nrest", 53), (3, "rest", 99)], "doc_id long, text string, n_chars long")
    assert {(r.doc_id, r.n_chars) for r in drop_repeated_lines(df).collect()} == {(1, 48), (2, 4), (3, 99)}


def test_early_ends_do_not_change_the_answer():
    rng = random.Random(4)
    for _ in range(2000):
        a = "".join(rng.choice("ab c") for _ in range(rng.randrange(20, 120)))
        b = a if rng.random() < 0.3 else "".join(rng.choice("ab c") for _ in range(rng.randrange(20, 120)))
        b = "".join(c if rng.random() > 0.02 else "#" for c in b) + "ab" * rng.randrange(10)
        assert lines.similar(a, lines.shingles(b)) == (jaccard(a, b) >= lines.SIMILARITY)


def test_large_buckets_give_two_candidates_a_member():
    keys, ids = np.repeat(np.array([5, 9], np.int64), [1000, 3]), np.arange(1003, dtype=np.int64)
    a, b, sent = lines.candidates(keys, ids)
    assert len(a) <= 2 * len(ids) and sent.sum() == 4
    assert len(set(roots(range(1003), list(zip(a.tolist(), b.tolist()))).values())) == 2


def test_empty_table(spark):
    assert repeated_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def templates(n=60, kinds=25):
    """Unlike families of lines with one template; the lines of a family are alike."""
    rng, out = random.Random(12), []
    word = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    for _ in range(kinds):
        head = word(180)
        for _ in range(n // 4):
            slot = word(24)
            out += [f"{head}{slot}{word(3)}" for _ in range(4)]
    rng.shuffle(out)
    return out


def test_large_divided_buckets_are_settled_as_by_all_pairs():
    own = templates(kinds=1, n=200)
    links = [(i, j) for i, j in itertools.combinations(range(len(own)), 2) if jaccard(own[i], own[j]) >= 0.8]
    got = lines.settle(own, list(range(len(own))))
    assert roots(range(len(own)), got) == roots(range(len(own)), links)
    assert len(set(roots(range(len(own)), links).values())) > 20
    assert len(got) < len(own)


def test_pairs_counted_at_once_are_those_of_the_shingles(monkeypatch):
    rng = random.Random(14)
    own = templates(kinds=4, n=40) + ["".join(rng.choice("ab c") for _ in range(rng.randrange(20, 90))) for _ in range(60)]
    want = {(i, j) for i, j in itertools.combinations(range(len(own)), 2) if jaccard(own[i], own[j]) >= 0.8}
    for asking in (range(len(own)), range(0, len(own), 3), [min(want)[0]]):
        monkeypatch.setattr(lines, "_ASKING", 7)
        got = [(i, j) for a, b in lines.similar_pairs(own, np.array(asking)) for i, j in zip(a.tolist(), b.tolist())]
        assert len(got) == len({frozenset(p) for p in got})
        assert {frozenset(p) for p in got} == {frozenset(p) for p in want if {*p} & {*asking}} and got
    pairs = np.array(list(itertools.combinations(range(len(own)), 2)))
    common, sizes = lines.common_shingles(own, pairs)
    assert sizes.tolist() == [len(lines.shingles(x)) for x in own]
    assert common.tolist() == [len(lines.shingles(own[i]) & lines.shingles(own[j])) for i, j in pairs.tolist()]


def test_like_lines_of_one_root_cost_no_comparisons():
    rng = random.Random(15)
    base = "".join(rng.choice("abcdefghij klmnop") for _ in range(200))
    own = [f"{base[:190]}{i:010d}" for i in range(4_000)]
    began = time.perf_counter()
    assert lines.settle(own + ["q" * 30 + base[::-1]], [0] * 4_000 + [1]) == []
    assert time.perf_counter() - began < 2.5
    # A stranger that is like them is linked, by one link.
    assert len(lines.settle(own + [base[:190] + "x" * 10], [0] * 4_000 + [1])) == 1


def test_buckets_beyond_the_small_ones_are_settled_alike(monkeypatch):
    own = templates(kinds=2, n=160)
    rng = random.Random(16)
    for groups in (1, 7, len(own)):
        given = [rng.randrange(groups) for _ in own]
        found = []
        for small in (0, 16_384):
            monkeypatch.setattr(lines, "SMALL_BUCKET", small)
            links = lines.settle(own, given) + [(i, given.index(r)) for i, r in enumerate(given)]
            found.append(roots(range(len(own)), links))
        assert found[0] == found[1]


def test_every_pair_that_meets_is_settled(spark):
    own = templates()
    rows = [(i, "\n".join(own[i::40])) for i in range(40)]
    found = line_links(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    ids = {line_id: i for i, line_id in enumerate(map(lines.line_id, own))}
    keys = lines.band_keys(own)
    links = [
        (i, j) for i, j in itertools.combinations(range(len(own)), 2)
        if (keys[i] == keys[j]).any() and jaccard(own[i], own[j]) >= 0.8
    ]
    assert len(links) > 1_000
    assert roots(range(len(own)), [(ids[r.a], ids[r.b]) for r in found]) == roots(range(len(own)), links)


def test_lines_of_a_plain_text_are_not_looked_at_one_by_one(monkeypatch):
    odd = "ΑΣ ΑΣ ΑΣ ΑΣ ΑΣ ΑΣ ΑΣ"
    texts = [None, "", "\n", f" {odd} \n{odd}\nΣ", "İ" * 30 + "\nB", "a  b" * 9 + "\nc", "d\te" * 9, " x" * 20, "e f" * 9, "q " * 30 + "\n " * 3]
    assert [lines.normal_lines(t) for t in texts] == [[normal_line(x) for x in (t or "").split("\n")] for t in texts]
    seen = []
    monkeypatch.setattr(lines, "normal_line", seen.append)
    docs = pd.DataFrame({"doc_id": [1, None], "doc_key": [5, 6], "text": [f"{odd}\nshort\n{odd} two", None]})
    out = next(lines._occurrences(iter([docs])))
    assert out["line_no"].tolist() == [0, 2] and out["doc_id"].tolist() == [1, 1] and out["doc_key"].tolist() == [5, 5]
    assert not seen


def test_texts_of_lines_in_no_pair_are_not_shuffled(spark):
    lines_ = [f"{i:04} a line that shares its words with no other {i * 7919 % 10007:05}" for i in range(300)]
    ids = [lines.line_id(x) for x in lines_]
    wanted = spark.createDataFrame([(x,) for x in ids[:20]], "line long")
    bits = lines._filter(wanted)
    good = lines.passed(bits, np.array(ids, np.int64))
    assert good[:20].all() and good[20:].sum() <= 3
    assert not lines.passed(lines._filter(wanted.where("false")), np.array(ids, np.int64)).any()
    sent = spark.createDataFrame([("\n".join(lines_),)], "text string").mapInPandas(
        lines._lines_of(spark.sparkContext.broadcast(bits)), "line long, content string"
    ).collect()
    assert set(ids[:20]) <= {r.line for r in sent} and len(sent) <= 23
    assert all(r.line == lines.line_id(r.content) for r in sent)


def test_unlike_pairs_are_told_by_bitmaps(monkeypatch):
    rng = random.Random(18)
    own = templates(kinds=2, n=80) + ["".join(rng.choice("abcdefgh jklm") for _ in range(rng.randrange(20, 400))) for _ in range(80)]
    for _ in range(160):
        line = rng.choice(own)
        cut = rng.randrange(len(line))
        own.append((line[:cut] + "".join(rng.choice("abcd") for _ in range(rng.randrange(60))) + line[cut + rng.randrange(20) :]).ljust(20, "x"))
    pairs = np.array(list(itertools.combinations(range(len(own)), 2)))
    like = np.array([jaccard(own[i], own[j]) >= 0.8 for i, j in pairs.tolist()])
    may = lines.may_be_similar(*lines.sketches(own), *pairs.T)
    assert like.sum() > 100 and not (like & ~may).any() and may.sum() < 0.1 * len(pairs)
    assert lines.alike(own, pairs).tolist() == like.tolist()

    # Only what bitmaps leave has its shingles counted.
    counted = []
    monkeypatch.setattr(lines, "common_shingles", lambda x, y, f=lines.common_shingles: counted.append(len(y)) or f(x, y))
    told = pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})
    told = told.assign(content_a=told["a"].map(own.__getitem__), content_b=told["b"].map(own.__getitem__))
    got = pd.concat(lines._verified(iter([told])))
    assert got.to_numpy().tolist() == pairs[like].tolist()
    assert sum(counted) == may.sum()


def test_small_buckets_are_settled_as_one_by_one(monkeypatch):
    rng, own = random.Random(19), templates(kinds=3, n=60)
    rows = []
    for key in range(120):
        for i in rng.sample(range(len(own)), rng.randrange(3, 40)):
            rows.append((key, lines.line_id(own[i]), i, own[i]))
    pdf = pd.DataFrame(rows, columns=["key", "line", "root", "content"])
    want = []
    for _, bucket in pdf.groupby("key"):
        names = bucket["root"].tolist()
        want += [(names[i], names[j]) for i, j in lines.settle(bucket["content"].tolist(), names)]
    want = roots(range(len(own)), want)
    assert 20 < len(set(want.values())) < 100
    settle = lines.settle
    for few, left in ((256, 10**6), (256, 0), (10, 10**6), (0, 0)):
        calls = []
        monkeypatch.setattr(lines, "settle", lambda x, y: calls.append(len(x)) or settle(x, y))
        monkeypatch.setattr(lines, "FEW_MEMBERS", few)
        monkeypatch.setattr(lines, "LEFT_PAIRS", left)
        got = lines._settled(pdf.sample(frac=1, random_state=1))
        assert roots(range(len(own)), got.to_numpy().tolist()) == want
        assert (not calls) == (few == 256 and left > 0) and all(n > few or not left for n in calls)


def test_only_lines_that_come_again_or_are_in_a_pair_have_places(spark):
    rng = random.Random(20)
    lone = ["".join(rng.choice("abcdefghij klmnop") for _ in range(60)) for _ in range(300)]
    twice, like = "this line stands in two texts, word for word", "this one has a near copy with another end of it: {}"
    rows = [(i, "\n".join(lone[i::6])) for i in range(6)]
    rows += [(10, twice), (11, f"short\n{twice}"), (12, like.format("a")), (13, like.format("b")), (14, f"own {twice[5:]}!\nx\n" * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 8):
        first, _, places = lines._found(df.repartition(parts, "doc_id"))
        got = {(r.doc_id, r.line_no) for r in places.collect()}
        assert {(10, 0), (11, 1), (12, 0), (13, 0), (14, 0), (14, 2)} <= got and len(got) < 60
        assert first.count() >= 2
        gone = {(r.doc_id, r.line_no, r.first_doc_id) for r in repeated_lines(df.repartition(parts, "doc_id")).collect()}
        assert {(11, 1, 10), (13, 0, 12)} <= gone and (14, 2) in {g[:2] for g in gone}
        assert gone == {g[:3] for g in brute(rows)}
