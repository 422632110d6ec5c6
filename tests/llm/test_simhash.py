import itertools
import random
import re

import numpy as np
import pyarrow.parquet as pq
import xxhash

from thermowatt.llm.components import components
from thermowatt.llm.simhash import anchors, drop_near_duplicates, fingerprint, group_links, near_duplicates

SF = "/root/testdata/sf0.001"


def naive_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(n, links):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in links:
        i, j = find(i), find(j)
        up[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


def test_fingerprint():
    texts = ["", " \n", "One", "one two three", "A b c d", "É É x x " * 9, "w " * 200_000, "a b c\x1cd e f"]
    for t in texts + pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()[:60]:
        assert fingerprint(t) == naive_fingerprint(t)


def test_halves_that_differ_in_two_bits_share_an_anchor():
    rng = random.Random(3)
    for _ in range(60):
        a = rng.getrandbits(32)
        for flips in [(), (rng.randrange(32),), tuple(rng.sample(range(32), 2)), (31, 5)]:
            b = a
            for f in flips:
                b ^= 1 << f
            index, found = anchors(np.array([a, b], np.int64))
            assert set(found[index == 0]) & set(found[index == 1])


def test_groups_of_any_size_keep_every_link():
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(12)]
    for size in (3, 40, 900):
        fps = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for c in rng.choices(centres, k=size)})
        own = np.array(fps, np.uint64)
        near = [(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4]
        for side in (0, 1):
            links = group_links(own, side)
            assert all((fps[i] ^ fps[j]).bit_count() <= 4 or roots(len(fps), near)[i] == roots(len(fps), near)[j] for i, j in links)
            # Links of a group may also pass over members of other parts, so only all that is linked must be joined.
            assert roots(len(fps), links) == roots(len(fps), near)


def brute(rows):
    fps = [naive_fingerprint(t) for _, t in rows]
    links = [(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4]
    label = roots(len(fps), links)
    smallest = {}
    for (doc_id, _), r in zip(rows, label):
        if doc_id is not None:
            smallest[r] = min(smallest.get(r, doc_id), doc_id)
    return sorted(((d, f, smallest.get(r)) for (d, _), f, r in zip(rows, fps, label)), key=str)


def found(df):
    return sorted(((r[0], r[1] & (2**64 - 1), r[2]) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    table = pq.read_table(f"{SF}/documents.parquet")
    rows = list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))
    rng, base = random.Random(1), " ".join(f"w{i}" for i in range(3000)).split()
    for k in range(80):  # a chain of copies that drift apart
        base = base[:]
        base[rng.randrange(3000)] = f"x{k}"
        rows.append((10_000 + k, " ".join(base)))
    rows += [(None, "lonely text"), (None, None), (20_001, ""), (20_000, " "), (20_000, " "), (0, rows[0][1])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, component_id int")
    assert found(near_duplicates(df)) == brute(rows)


def test_one_document_of_each_group_stays(spark):
    text = "some words that are long enough to count " * 3
    rows = [(3, text), (2, text), (2, text), (7, "something else altogether in this one"), (None, "no id but words of its own here")]
    kept = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(str(r[0]) for r in kept.collect()) == ["2", "2", "7", "None"]


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(60)]
    links += [(300, i) for i in range(301, 360)]
    df = spark.createDataFrame([*links, (None, 1), (5, None)], "a long, b long")
    label = roots(400, links)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {tuple(r) for r in components(df, "a", "b").collect()} == {(n, label[n]) for n in nodes}
