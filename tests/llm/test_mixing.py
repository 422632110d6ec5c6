import random
from collections import Counter

import pytest

from thermowatt.llm.mixing import OTHER, lay_out, mix, mixed_order, plan, schedule, shares, slot_of


@pytest.mark.parametrize("seed", range(6))
def test_deviation_stays_below_one_block(seed):
    rng = random.Random(seed)
    parts = shares({f"s{i}": rng.random() ** 3 + 0.001 for i in range(rng.randrange(1, 25))}, 1000)
    cycle = sum(parts.values())
    assert cycle == 1000 and min(parts.values()) >= 1
    got = Counter()
    for slot, s in enumerate(lay_out(parts) * 2, 1):
        got[s] += 1
        assert all(abs(got[x] - slot * n / cycle) < 1 for x, n in parts.items())


@pytest.mark.parametrize("seed", range(6))
def test_schedule_with_sources_that_run_out(seed):
    rng = random.Random(seed)
    weights = {f"s{i}": rng.random() + 0.05 for i in range(6)}
    blocks = {s: rng.randrange(0, 400) for s in weights}
    phases = plan(weights, blocks, 50)
    order = {}
    for s, n in blocks.items():
        for k in range(n):
            slot, release, due = slot_of(phases, s, k)
            assert release <= slot < due and slot not in order
            order[slot] = s
    assert sorted(order) == list(range(sum(blocks.values())))
    for p, after in zip(phases, [*phases[1:], None]):
        stop = after.start if after else len(order)
        got, n = Counter(), {s: len(x) for s, x in p.slots.items()}
        for slot in range(p.start, stop):
            got[order[slot]] += 1
            assert all(abs(got[s] - (slot - p.start + 1) * n[s] / p.cycle) < 1 for s in n)


def documents(spark, n=3000):
    rng = random.Random(3)
    rows = [(i, rng.choice(["big"] * 8 + ["a", "b", "c", None]), f"t{i}", i % 7) for i in range(n)]
    rows += [(None, "a", None, 1), (None, "a", None, 1), (5, "a", "t", 1), (5, "a", "t", 1), (6, "unlisted", "t", 1)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, mix_slot int")


def test_rows_are_kept_and_mixed(spark, monkeypatch):
    monkeypatch.setattr("thermowatt.llm.mixing.BUCKET_ROWS", 200)
    docs = documents(spark)
    weights = {"big": 0.4, "a": 0.3, "b": 0.2, "c": 0.1}
    rows = mix(docs, weights, block_rows=8, cycle=100).collect()
    assert Counter((r.doc_id, r.source, r.text) for r in rows) == Counter((r.doc_id, r.source, r.text) for r in docs.collect())
    assert len({r.mix_position for r in rows}) == len(rows)
    assert {r.mix_source for r in rows if r.source in (None, "unlisted")} == {OTHER}
    sizes = Counter(r.mix_source for r in rows)
    blocks = Counter((r.mix_source, r.mix_block) for r in rows)
    for (s, k), n in blocks.items():
        assert n == min(8, sizes[s] - 8 * k)
    share = Counter(r.mix_source for r in rows if r.mix_slot < 60)
    total = {OTHER: 0.1} | weights
    for s, w in total.items():
        assert abs(share[s] / 8 - 60 * w / sum(total.values())) <= 1 + 60 * 0.01


def test_mixed_order_keeps_columns_and_is_sorted(spark):
    docs = documents(spark, 500)
    out = mixed_order(docs, block_rows=4)
    assert out.columns == docs.columns and out.count() == docs.count()
    first = [r.source for r in out.limit(100).collect()]
    assert len(set(first)) >= 5


def test_empty_table(spark):
    assert mix(documents(spark).where("false")).collect() == []


def skewed(n):
    return {f"s{i}": (1_000 if i == 0 else 1 + i % 7) ** 1.5 for i in range(n)}


@pytest.mark.parametrize("n", [1, 20, 1_000, 1_500])
def test_deviation_from_the_given_weights(n):
    weights = skewed(n)
    total, got = sum(weights.values()), Counter()
    blocks = {s: 40 + int(30_000 * w / total) for s, w in weights.items()}
    owed = sorted(weights, key=lambda s: blocks[s] / weights[s])
    ends = int(blocks[owed[0]] / weights[owed[0]] * total)  # until then no source runs out
    for s, k, slot, release, due in schedule(weights, blocks):
        if slot >= ends:
            break
        assert k == got[s] and release <= slot < due
        w = weights[s] / total
        assert abs(release - k / w) <= 1 and (abs(due - (k + 1) / w) <= 1 or due > ends)
        got[s] += 1
        assert got[s] - (slot + 1) * w < 1 + 1e-9
        if slot % 97 == 0:
            assert all(abs(got[x] - (slot + 1) * v / total) < 1 + 1e-9 for x, v in weights.items())


@pytest.mark.parametrize("seed", range(6))
def test_deviation_from_the_flow_as_sources_run_out(seed):
    rng = random.Random(seed)
    weights = {f"s{i}": rng.random() ** 3 + 0.01 for i in range(12)} | {"none": 0.0}
    blocks = {s: rng.randrange(0, 60) for s in weights}
    rows = list(schedule(weights, blocks))
    assert [r[2] for r in rows] == list(range(sum(blocks.values())))
    assert Counter(r[0] for r in rows) == Counter(blocks)
    given, got = {s: 0.0 for s in weights}, Counter()
    for s, _, slot, _, _ in rows[: len(rows) - blocks["none"]]:
        rest = 1.0
        while rest > 1e-12:  # one slot of the flow, cut where a source runs out
            active = {x: w for x, w in weights.items() if w and blocks[x] - given[x] > 1e-9}
            if not active:
                break
            step = min([rest] + [(blocks[x] - given[x]) * sum(active.values()) / w for x, w in active.items()])
            for x, w in active.items():
                given[x] += step * w / sum(active.values())
            rest -= step
        got[s] += 1
        assert all(abs(got[x] - given[x]) < 1 + 1e-6 for x in weights)


def test_every_source_has_a_weight_of_its_own(spark):
    rows = [(i, f"s{i % 1_200}") for i in range(4_800)] + [(10_000 + i, "hot") for i in range(9_000)]
    got = mix(spark.createDataFrame(rows, "doc_id long, source string"), block_rows=2).collect()
    assert {r.mix_source for r in got} == {r[1] for r in rows}
    total = 1_200 * 2 + 9_000**0.5
    hot = sorted(r.mix_slot for r in got if r.source == "hot")
    first = [x for x in hot if x < 2_000]
    assert abs(len(first) / 2 - 2_000 * 9_000**0.5 / total) < 1
