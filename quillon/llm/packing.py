"""Filling fixed-capacity containers: bulk-synchronous best-fit.

Each superstep range-sorts the unplaced items and the gaps of the open containers
together.  A gap sorts at its room, or, if that is above what is waiting, at an item
size drawn in proportion to the waiting volume, so that the room is dealt to the
ranges as they need it.  A sweep from large to small within every task hands each item
the smallest gap at hand that holds it; the gap stays in the task with what room is
left, so one gap takes a run of items in a single sweep.  Items left without a gap
take, by rank, the free gaps of the next higher tasks, which the driver pairs from one
count per task.  If the waiting items exceed all gaps, or all room together, the largest
of them open as many new containers as that takes; and the step repeats.  From the
``PATIENCE``-th step on at least half of the containers that the waiting volume would
fill are opened, so the steps stay few whatever the number of items.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.storage import Scratch

#: Rows of a range in a superstep.
RANGE_ROWS = 200_000
#: Sizes that describe the waiting volume, and the step from which containers are opened faster.
QUANTILES, PATIENCE = 64, 8
#: Steps of the histogram of waiting sizes.
STEPS = 4096


def pieces(items: DataFrame, capacity: int) -> DataFrame:
    """``(item, piece, size)``: items cut at the capacity, and only those that exceed it."""
    return items.select("item", "size", F.explode(F.sequence(F.lit(0), ((F.col("size") - 1) / capacity).cast("int"))).alias("piece")).select(
        "item", "piece", F.least(F.lit(capacity).cast("bigint"), F.col("size") - F.col("piece") * F.lit(capacity).cast("bigint")).alias("size")
    )


class _Gaps:
    """Gaps by room; the smallest that holds a size is found by bisection over the distinct rooms."""

    def __init__(self):
        self.rooms: list[int] = []
        self.bins: dict[int, list[str]] = {}

    def add(self, room: int, key: str) -> None:
        held = self.bins.get(room)
        if held is None:
            insort(self.rooms, room)
            self.bins[room] = [key]
        else:
            held.append(key)

    def take(self, size: int) -> tuple[str, int] | None:
        at = bisect_left(self.rooms, size)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        held = self.bins[room]
        key = held.pop()
        if not held:
            del self.bins[room], self.rooms[at]
        return key, room


_SWEPT = ["part", "kind", "rank", "item", "size", "bin", "room"]


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted from large to small, gaps before items of their size.

    Kind 0: an item and its container; 1: an item left, with its rank; 2: a gap any lower
    task's items fit, with its rank from the smallest; 3: a gap too small for that.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    free = _Gaps()
    waiting, least = 0, 0
    for pdf in batches:
        out = []
        for key, v, room in zip(pdf["key"].tolist(), pdf["v"].tolist(), pdf["room"].tolist()):
            least = v
            if room >= 0:
                free.add(room, key)
            elif (found := free.take(v)) is not None:
                other, room = found
                out.append((part, 0, 0, key, v, other, 0))
                if room > v:
                    free.add(room - v, other)
            else:
                out.append((part, 1, waiting, key, v, None, 0))
                waiting += 1
        yield pd.DataFrame(out, columns=_SWEPT)
    out, rank = [], 0
    for room in free.rooms:
        for key in free.bins[room]:
            out.append((part, 2, rank, None, 0, key, room) if room >= least else (part, 3, 0, None, 0, key, room))
            rank += room >= least
    for a in range(0, len(out), 10_000):
        yield pd.DataFrame(out[a : a + 10_000], columns=_SWEPT)


def _pair(counts: dict[tuple[int, int], int]) -> tuple[list[tuple], dict[int, int], int]:
    """Which waiting items take which free gaps of higher tasks; how many wait before each task; all that still wait.

    Tasks hold descending values, so task 0 has the largest.  Returns segments
    (task, first rank, last rank, other task, shift of rank).
    """
    parts = sorted({p for p, _ in counts})
    stack: list[list[int]] = []
    segments, taken = [], {}
    for p in parts:
        need, at = counts.get((p, 1), 0), 0
        while need and stack:
            q, first, left = stack[-1]
            n = min(need, left)
            segments.append((p, at, at + n - 1, q, first - at))
            at, need = at + n, need - n
            stack[-1][1:] = [first + n, left - n]
            if not stack[-1][2]:
                stack.pop()
        taken[p] = at
        if counts.get((p, 2), 0):
            stack.append([p, 0, counts[p, 2]])
    before, total = {}, 0
    for p in parts:
        before[p] = total - taken[p]
        total += counts.get((p, 1), 0) - taken[p]
    return segments, before, total


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """``(bin, item, piece, size)``: every item in containers of ``capacity``, none over it.

    ``items`` has ``item`` (unique) and ``size``; an item larger than the capacity is
    cut into full containers and a rest, no other is cut.  Null or non-positive sizes
    take no room and give no row; an empty table gives an empty result; ties are
    ordered by item; other columns are ignored.  The result does not depend on how the
    input is split into partitions.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark = items.sparkSession
    tmp = Scratch(spark, "pack")
    cut = pieces(items.select("item", F.col("size").cast("bigint").alias("size")).where("size > 0 and item is not null"), capacity)
    cut = tmp.put(cut.withColumn("key", F.concat_ws("/", F.col("item").cast("string"), F.col("piece").cast("string"))), "cut")
    left = cut.select(F.col("key").alias("item"), "size")
    gaps = left.where("false").select(F.col("item").alias("bin"), F.col("size").alias("room"))
    width = -(-capacity // STEPS)
    step = (F.col("size") / width).cast("int").alias("step")
    # Waiting sizes in at most STEPS steps: (step, number, volume, least, most).
    steps = [tuple(r) for r in left.groupBy(step).agg(F.count("*"), F.sum("size"), F.min("size"), F.max("size")).collect()]
    waiting, n_gaps, turn = sum(s[1] for s in steps), 0, 0
    if not waiting:
        return cut.select(F.col("key").alias("bin"), "item", "piece", "size")
    while True:
        least = min(s[3] for s in steps)
        # A gap's place: its room, or a size of what is waiting, drawn anew each time.
        sizes = F.array(*[F.lit(int(q)).cast("bigint") for q in _quantiles(steps)])
        drawn = sizes[F.pmod(F.xxhash64("bin", F.lit(turn)), F.lit(QUANTILES)).cast("int")]
        rows = left.select(F.col("item").alias("key"), F.col("size").alias("v"), F.lit(-1).cast("bigint").alias("room")).unionByName(
            # Gaps below the smallest waiting item are out of the game.
            gaps.where(F.col("room") >= least).select(F.col("bin").alias("key"), F.least("room", drawn).alias("v"), "room")
        )
        order = [F.col("v").desc(), (F.col("room") < 0).asc(), F.xxhash64("key"), F.col("key")]
        swept = tmp.put(
            rows.repartitionByRange(-(-(waiting + n_gaps) // RANGE_ROWS), *order).sortWithinPartitions(*order)
            .mapInPandas(_sweep, "part int, kind int, rank bigint, item string, size bigint, bin string, room bigint"), f"swept-{turn}",
        )
        # Sums per task, kind and step: tasks hold ranges of sizes, so these are not many more rows than steps and tasks.
        stats = swept.where("kind > 0").groupBy("part", "kind", step).agg(
            F.count("*").alias("n"), F.sum("size").alias("size"), F.sum("room").alias("room"), F.max("room").alias("most"), F.min("size").alias("low"), F.max("size").alias("high")
        ).collect()
        counts: dict[tuple[int, int], int] = {}
        for r in stats:
            counts[r.part, r.kind] = counts.get((r.part, r.kind), 0) + r.n
        segments, before, waiting = _pair({k: n for k, n in counts.items() if k[1] < 3})
        placed = swept.where("kind = 0").select("item", "bin")
        free = swept.where("kind >= 2").select("bin", "room", F.when(F.col("kind") == 2, F.col("part")).alias("q"), F.col("rank").alias("at"))
        rest = swept.where("kind = 1").select("item", "size", "part", "rank")
        gaps = free.select("bin", "room")
        if segments:
            table = F.broadcast(spark.createDataFrame(segments, "p int, lo bigint, hi bigint, q int, shift bigint"))
            hit = rest.join(table, (F.col("part") == F.col("p")) & F.col("rank").between(F.col("lo"), F.col("hi")), "left")
            taken = tmp.put(hit.withColumn("at", F.col("rank") + F.col("shift")).select("item", "size", "part", "rank", "q", "at"), f"taken-{turn}")
            met = tmp.put(free.join(taken.where("q is not null").select("q", "at", "item", "size"), ["q", "at"], "left").select("bin", "room", "item", "size"), f"met-{turn}")
            placed = placed.unionByName(met.where("item is not null").select("item", "bin"))
            gaps = met.select("bin", (F.col("room") - F.coalesce("size", F.lit(0))).alias("room"))
            rest = taken.where("q is null").select("item", "size", "part", "rank")
        if not waiting:
            tmp.append(placed, "placed")
            break
        room = sum(r.room for r in stats if r.kind >= 2)
        most = max((r.most for r in stats if r.kind >= 2), default=0)
        # Items that took a gap of a higher task still count among the steps, which only blurs the next places of gaps.
        steps = [(r.step, r.n, r["size"], r.low, r.high) for r in stats if r.kind == 1]
        volume = rest.agg(F.sum("size")).first()[0] if segments else sum(s[2] for s in steps)
        big = min(volume, sum(s[2] for s in steps if s[4] > most))
        # New containers only for what cannot fit: items above every gap, and sizes beyond all room.
        need = max(-(-big // capacity), -(-(volume - room) // capacity), -(-volume // (2 * capacity)) if turn + 1 >= PATIENCE else 0)
        need = min(waiting, max(need, 0 if turn + 1 < PATIENCE else 1))
        offsets = F.broadcast(spark.createDataFrame(list(before.items()), "part int, offset bigint"))
        rest = rest.join(offsets, "part").select("item", "size", (F.col("rank") + F.col("offset")).alias("at"))
        opened = rest.where(F.col("at") < need).select("item", "size", F.col("item").alias("bin"))
        tmp.append(placed.unionByName(opened.select("item", "bin")), "placed")
        gaps = gaps.unionByName(opened.select("bin", (F.lit(capacity).cast("bigint") - F.col("size")).alias("room")))
        left = rest.where(F.col("at") >= need).select("item", "size")
        n_gaps, waiting, turn = sum(r.n for r in stats if r.kind >= 2) + need, waiting - need, turn + 1
        for name in ("swept", "taken", "met"):
            tmp.drop(f"{name}-{turn - 2}")
        if not waiting:
            break
    return cut.join(tmp.read("placed").select(F.col("item").alias("key"), "bin"), "key").select("bin", "item", "piece", "size")


def _quantiles(steps: list[tuple[int, int, int, int, int]]) -> list[int]:
    """QUANTILES sizes between which equal volumes wait."""
    total, so_far, sizes = sum(s[2] for s in steps), 0, []
    for _, _, volume, _, most in sorted(steps):
        so_far += volume
        while len(sizes) < QUANTILES and so_far * QUANTILES * 2 >= (2 * len(sizes) + 1) * total:
            sizes.append(most)
    return sizes


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """``(bins, used, capacity, fill)``: containers, tokens in them and the share of the room that is used."""
    return packed.agg(F.count_distinct("bin").alias("bins"), F.coalesce(F.sum("size"), F.lit(0)).alias("used")).select(
        "bins", "used", F.lit(capacity).alias("capacity"), F.round(F.col("used") / (F.col("bins") * capacity), 6).alias("fill")
    )
