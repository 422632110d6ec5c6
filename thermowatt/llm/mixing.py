"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of rows. With weight w (all weights sum to 1),
its k-th block, counted from 0, is released at slot floor(k / w) and due by
slot ceil((k + 1) / w); each slot takes the released block that is due first.
At every slot each source has then had less than one block more or less than
its share. Weights are taken exactly as given, as fractions of whole numbers.

The share is that of an even flow: a source gives its weight a slot until it
has no blocks left, and from then on the others share by their weights among
themselves. Releases and deadlines are the slots in which a block's flow
begins and ends, so the bound of one block holds from the first slot to the
last. No row is dropped or repeated.

One task lays out all blocks, in memory that grows with the number of sources
only; the schedule has a row per block and joins the rows by source and block.
The driver holds one number per source.

Rows of a source are taken in the order of a hash of doc_id. They are counted
by source and hash bucket first, so a row's number within its source is the
sum of the buckets before plus its place in its own bucket: a source that
holds a third of all rows is numbered by many tasks.

Defined results: a null source, and any without a weight, count as the source
``OTHER``. Sources of weight 0 come after all others, in equal shares. Rows
with equal or null doc_ids are told apart by a hash of the text, and rows
equal in both are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import stored

OTHER = "(other)"
#: Rows of a hash bucket that numbers rows of one source.
BUCKET_ROWS = 2_000
#: Blocks of the schedule that its task hands on at a time.
SCHEDULE_ROWS = 50_000


def shares(weights: Mapping[str, float], cycle: int) -> dict[str, int]:
    """Whole slots of a cycle for each weight, at least 1, by largest remainder."""
    total = math.fsum(weights.values())
    exact = {s: w / total * cycle for s, w in weights.items()}
    whole = {s: max(1, math.floor(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], s))
    while (left := cycle - sum(whole.values())) != 0:
        if left < 0:
            whole[max(whole, key=lambda s: (whole[s], s))] -= 1
        else:
            for s in order[:left]:
                whole[s] += 1
    return whole


def lay_out(parts: Mapping[str, int]) -> list[str]:
    """One cycle: the source of every slot, earliest deadline first among released blocks."""
    cycle = sum(parts.values())
    waiting = [(0, s, 0) for s in sorted(parts)]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, str, int]] = []
    out = []
    for slot in range(cycle):
        while waiting and waiting[0][0] <= slot:
            release, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * cycle // parts[s]), release, s, k))
        due, _, s, k = heapq.heappop(ready)
        if due < slot + 1:
            raise AssertionError("a block misses its deadline")
        out.append(s)
        if k + 1 < parts[s]:
            heapq.heappush(waiting, ((k + 1) * cycle // parts[s], s, k + 1))
    return out


@dataclass
class Phase:
    """From slot ``start`` on, sources take turns by ``slots`` (per source: its slots in a cycle)."""

    start: int
    cycle: int
    first: dict[str, int]
    slots: dict[str, list[int]]


def plan(weights: Mapping[str, float], blocks: Mapping[str, int], cycle: int) -> list[Phase]:
    """The phases of a schedule by whole shares of a repeated ``cycle``; each ends when some source has no blocks left."""
    left = {s: n for s, n in blocks.items() if n}
    start, done, phases = 0, {s: 0 for s in left}, []
    while left:
        parts = shares({s: weights[s] for s in left}, max(cycle, len(left)))
        order = lay_out(parts)
        slots: dict[str, list[int]] = {s: [] for s in left}
        for slot, s in enumerate(order):
            slots[s].append(slot)
        phases.append(Phase(start, len(order), {s: done[s] for s in left}, slots))
        turns = min(left[s] // parts[s] for s in left)
        took = {s: turns * parts[s] for s in left}
        used = turns * len(order)
        if all(took[s] < left[s] for s in left):
            for s in order:  # less than one more cycle
                if took[s] == left[s]:
                    break
                took[s] += 1
                used += 1
        start += used
        for s in list(left):
            done[s] += took[s]
            left[s] -= took[s]
            if not left[s]:
                del left[s]
    return phases


def slot_of(phases: list[Phase], source: str, block: int) -> tuple[int, int, int]:
    """(slot, release, deadline) of a source's block."""
    own = [p for p in phases if source in p.first]
    p = own[bisect_right([q.first[source] for q in own], block) - 1]
    k, slots = block - p.first[source], p.slots[source]
    turn, at = divmod(k, len(slots))
    release = p.start + k * p.cycle // len(slots)
    due = p.start - (-(k + 1) * p.cycle // len(slots))
    return p.start + turn * p.cycle + slots[at], release, due


def whole_weights(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportions of ``weights``."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * scale) for s, w in exact.items()}


class _Flow:
    """When an even flow of blocks by weights begins and ends with each block, as sources run out."""

    def __init__(self, parts: Mapping[str, int], blocks: Mapping[str, int]):
        self.parts = parts
        # A source is through when the flow's level, blocks for each unit of weight, is blocks / weight.
        ends: dict[Fraction, tuple[int, int]] = {}
        for s, n in blocks.items():
            level = Fraction(n, parts[s])
            gone, weight = ends.get(level, (0, 0))
            ends[level] = gone + n, weight + parts[s]
        self.levels = sorted(ends)
        self.rounded = [x.numerator / x.denominator for x in self.levels]
        self.through, self.running = [0], [sum(parts[s] for s in blocks)]
        for x in self.levels:
            self.through.append(self.through[-1] + ends[x][0])
            self.running.append(self.running[-1] - ends[x][1])

    def time(self, source: str, k: int) -> tuple[int, int]:
        """(floor, ceiling) of the slot at which the flow has given ``k`` blocks of ``source``."""
        part = self.parts[source]
        at = bisect_left(self.rounded, k / part)  # whole numbers divide to the nearest double, so order is kept
        while at < len(self.levels) and self.levels[at] * part < k:
            at += 1
        given = k * self.running[at]
        return self.through[at] + given // part, self.through[at] - (-given // part)


def schedule(weights: Mapping[str, float], blocks: Mapping[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, slot, release, deadline) of all blocks, slot by slot."""
    if any(not w >= 0 for w in weights.values()):
        raise ValueError("weights must be at least 0")
    left = {s: n for s, n in blocks.items() if n}
    first = {s: n for s, n in left.items() if weights[s] > 0}
    start = 0
    for own, heavy in ((first, weights), ({s: n for s, n in left.items() if s not in first}, dict.fromkeys(left, 1))):
        if not own:
            continue
        flow = _Flow(whole_weights({s: heavy[s] for s in own}), own)
        ready = [(flow.time(s, 1)[1], 0, s, 0) for s in own]
        heapq.heapify(ready)
        waiting: list[tuple[int, str, int]] = []
        total = sum(own.values())
        for slot in range(total):
            while waiting and waiting[0][0] <= slot:
                release, s, k = heapq.heappop(waiting)
                heapq.heappush(ready, (flow.time(s, k + 1)[1], release, s, k))
            due, release, s, k = heapq.heappop(ready)
            if due < slot + 1:
                raise AssertionError("a block misses its deadline")
            yield s, k, start + slot, start + release, start + due
            if k + 1 < own[s]:
                heapq.heappush(waiting, (flow.time(s, k + 1)[0], s, k + 1))
        start += total


def tempered_weights(counts: Mapping[str, int], power: float) -> dict[str, float]:
    return {s: n**power for s, n in counts.items() if n}


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    block_rows: int = 64,
    cycle: int | None = None,
    power: float = 0.5,
) -> DataFrame:
    """``docs`` with mix_source, mix_block, mix_release, mix_deadline, mix_slot and mix_position (unique, in mixed order).

    Without ``weights``, a source weighs its number of rows to the ``power``.
    Weights are exact; only if the caller gives a ``cycle`` are they first
    rounded to whole slots of it.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if not c.startswith("mix_")]
    text = [F.xxhash64("text")] if "text" in docs.columns else []
    marked = docs.select(*names).withColumn("mix_hash", F.xxhash64("doc_id", *text))

    if weights is None:
        marked = marked.withColumn("mix_source", F.coalesce("source", F.lit(OTHER)))
    else:
        weights = {OTHER: min(weights.values(), default=1.0)} | dict(weights)
        known = spark.createDataFrame([(s,) for s in weights], "source string").select("source", F.col("source").alias("mix_source"))
        # Bounded by what the caller lists.
        marked = marked.join(F.broadcast(known), "source", "left").withColumn("mix_source", F.coalesce("mix_source", F.lit(OTHER)))

    total = docs.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    bucket = F.floor((F.shiftrightunsigned("mix_hash", 1) / F.lit(float(2**63))) * buckets).cast("int")
    marked = marked.withColumn("mix_bucket", F.least(bucket, F.lit(buckets - 1)))
    counted = marked.groupBy("mix_source", "mix_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counted.selectExpr(
        "mix_source", "mix_bucket",
        "sum(n) OVER (PARTITION BY mix_source ORDER BY mix_bucket) - n AS mix_before",
    )
    sizes = {r["mix_source"]: r["n"] for r in counted.groupBy("mix_source").agg(F.sum("n").alias("n")).collect()}
    weights = tempered_weights(sizes, power) if weights is None else {s: weights[s] for s in sizes}
    if cycle is not None and sizes:
        weights = shares(weights, max(cycle, len(sizes)))
    blocks = {s: -(-n // block_rows) for s, n in sizes.items()}

    def lay_out_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["mix_source", "mix_block", "mix_slot", "mix_release", "mix_deadline"]
        for _ in batches:
            rows = schedule(weights, blocks)
            while part := list(islice(rows, SCHEDULE_ROWS)):
                yield pd.DataFrame(part, columns=columns)

    laid_out = spark.range(0, 1, 1, 1).mapInPandas(
        lay_out_all, "mix_source string, mix_block long, mix_slot long, mix_release long, mix_deadline long"
    )
    laid_out = stored(laid_out, "mix-schedule")

    place = "row_number() OVER (PARTITION BY mix_source, mix_bucket ORDER BY mix_hash, doc_id) - 1 + mix_before"
    numbered = marked.join(before, ["mix_source", "mix_bucket"]).selectExpr(*names, "mix_source", f"{place} AS place")
    timed = numbered.withColumn("mix_block", F.floor(F.col("place") / block_rows)).join(laid_out, ["mix_source", "mix_block"])
    return timed.select(
        *names, "mix_source", "mix_block", "mix_release", "mix_deadline", "mix_slot",
        (F.col("mix_slot") * block_rows + F.col("place") % block_rows).alias("mix_position"),
    )


def mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The rows and columns of ``docs``, sorted into mixed order over all partitions."""
    return mix(docs, **options).orderBy("mix_position").select(*docs.columns)


def positioned(mixed: DataFrame) -> DataFrame:
    """A stored and reread ``mixed_order`` with mix_position: each row's place, by the number of its file and its place there.

    How Spark packs files into tasks when it reads them doesn't matter.
    """
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long")
    piece = F.coalesce(F.regexp_extract("_metadata.file_name", r"-c(\d+)\.", 1).try_cast("long"), F.lit(0))
    placed = mixed.select(
        "*", part.alias("_part"), piece.alias("_piece"), F.col("_metadata.row_index").alias("_row")
    )
    # One row per file.
    counts = placed.groupBy("_part", "_piece").agg(F.count(F.lit(1)).alias("n"))
    before = counts.selectExpr("_part", "_piece", "sum(n) OVER (ORDER BY _part, _piece) - n AS _before")
    joined = placed.join(F.broadcast(before), ["_part", "_piece"])
    return joined.select(*[c for c in mixed.columns if c != "mix_position"], (F.col("_before") + F.col("_row")).alias("mix_position"))
