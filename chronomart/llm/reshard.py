"""Reshard stored documents by minimum-cost flow: equal bytes, fewest bytes moved.

Old shards hold blocks of rows in a fixed order.  From the bytes of the old
shards and the room in the new ones a flow network is solved on the driver (a
node per shard): bytes that stay cost nothing, bytes that move cost one each.
Each old shard's row order is then cut into what stays and what goes where, and
``rewrite`` writes only the shards that lose or gain rows.  ``lay_out`` writes a
first layout, whose rows get an identity that they keep in all later ones, and
``read`` reads the files of a layout.

Rows so large that a cut beside them would leave shards uneven (more than a
256th of a shard, so at most 256 per shard) are placed one by one first: they
stay if there is room and otherwise go where there is most of it.

Positions of rows in an old shard are the sum of whole blocks before (1,024 a
shard) and a window inside a block, so a shard with most of the data is spread
over many tasks.  Texts are not shuffled to make a plan.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomart.llm.common import fresh, stored
from chronomart.sources.storage import shared_folder

#: Rows above one such part of a shard are placed singly; they are at most this many per shard.
LARGE_PART = 256
BLOCK_BITS = 10


@dataclass
class _Edge:
    to: int
    room: int
    cost: int
    back: int


class Network:
    """Directed network with capacities and costs; successive cheapest paths."""

    def __init__(self, nodes: int) -> None:
        self.edges: list[list[_Edge]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, room: int, cost: int) -> tuple[int, int]:
        self.edges[a].append(_Edge(b, room, cost, len(self.edges[b])))
        self.edges[b].append(_Edge(a, 0, -cost, len(self.edges[a]) - 1))
        return a, len(self.edges[a]) - 1

    def sent(self, edge: tuple[int, int]) -> int:
        e = self.edges[edge[0]][edge[1]]
        return self.edges[e.to][e.back].room

    def solve(self, source: int, sink: int) -> int:
        """Send as much as fits at least cost; returns that cost."""
        potential, total = [0] * len(self.edges), 0
        while True:
            far: list[int | None] = [None] * len(self.edges)
            via: dict[int, tuple[int, _Edge]] = {}
            heap = [(0, source)]
            far[source] = 0
            while heap:
                d, a = heapq.heappop(heap)
                if d > far[a]:
                    continue
                for e in self.edges[a]:
                    if e.room and (far[e.to] is None or d + e.cost + potential[a] - potential[e.to] < far[e.to]):
                        far[e.to] = d + e.cost + potential[a] - potential[e.to]
                        via[e.to] = a, e
                        heapq.heappush(heap, (far[e.to], e.to))
            if far[sink] is None:
                return total
            potential = [p + (d if d is not None else far[sink]) for p, d in zip(potential, far, strict=True)]
            path, at = [], sink
            while at != source:
                at, e = via[at]
                path.append(e)
            amount = min(e.room for e in path)
            for e in path:
                e.room -= amount
                self.edges[e.to][e.back].room += amount
                total += amount * e.cost


def rooms(taken: list[int], rest: int) -> list[int]:
    """Room per shard so that ``rest`` more bytes make all shards as equal as they can be."""
    room, order = [0] * len(taken), sorted(range(len(taken)), key=lambda j: (taken[j], j))
    level, count = 0, 0
    for n, j in enumerate(order, 1):
        need = sum(taken[order[i]] for i in range(n)) + rest
        if n == len(order) or need <= taken[order[n]] * n:
            level, count = divmod(need, n)
            for i in range(n):
                room[order[i]] = level + (i < count) - taken[order[i]]
            break
    return room


def transfers(old: list[int], room: list[int]) -> list[list[tuple[int, int]]]:
    """For each old shard the (new shard, bytes) it sends, what stays first; the fewest bytes move.

    Bytes move through one hub, so the network grows with the number of shards.
    """
    n, m = len(old), len(room)
    source, sink, hub = n + m, n + m + 1, n + m + 2
    net = Network(n + m + 3)
    stay, out, into = {}, {}, {}
    for i, amount in enumerate(old):
        net.add(source, i, amount, 0)
        if i < m:
            stay[i] = net.add(i, n + i, amount, 0)
        out[i] = net.add(i, hub, amount, 1)
    for j, amount in enumerate(room):
        into[j] = net.add(hub, n + j, amount, 0)
        net.add(n + j, sink, amount, 0)
    net.solve(source, sink)
    wanted = [[j, net.sent(into[j])] for j in range(m) if net.sent(into[j])]
    plan: list[list[tuple[int, int]]] = []
    for i in range(n):
        parts = [(i, kept)] if i in stay and (kept := net.sent(stay[i])) else []
        moving = net.sent(out[i])
        while moving:
            amount = min(moving, wanted[0][1])
            parts.append((wanted[0][0], amount))
            moving -= amount
            wanted[0][1] -= amount
            if not wanted[0][1]:
                wanted.pop(0)
        plan.append(parts)
    return plan


def place_large(large: list[tuple[int, int]], shards: int) -> tuple[list[int], list[int]]:
    """New shards of single rows given as (old shard, size), largest first, and the bytes each shard then holds.

    A row stays while its shard is not above the mean of all large rows.
    """
    held, places = [0] * shards, []
    mean = sum(s for _, s in large) / shards
    for old, size in large:
        j = old if old < shards and held[old] + size <= mean else min(range(shards), key=lambda j: (held[j], j))
        held[j] += size
        places.append(j)
    return places, held


def reshard(
    df: DataFrame, old: Column, size: Column, shards: int, doc_id: str = "doc_id", row: str | None = None
) -> DataFrame:
    """``df`` with size, old_shard, shard and slot: new shards of nearly equal bytes.

    ``old`` is a shard number from 0; numbers of ``shards`` and more have no place
    to stay in, and null becomes ``shards``.  ``size`` counts at least one byte per row.  Slots number a
    shard's rows from 0 without gaps.  Repeated rows are rows of their own.  An
    empty table stays empty.  Columns of ``df`` with those names are replaced.
    The plan is made from a stored table of all columns of ``df``: pass the ones
    that identify a row.  ``row`` names a column that tells any two rows apart: it
    is carried, but only orders rows that are equal otherwise.
    """
    own = ["size", "old_shard", "shard", "slot"]
    place_of = F.coalesce(old.cast("int"), F.lit(shards))
    rows = df.withColumns({"size": size.cast("long"), "old_shard": place_of}).drop("shard", "slot")
    names = [c for c in rows.columns if c not in own]
    block, place, start, nth, seg, low, high = fresh(rows, "block", "place", "start", "nth", "seg", "low", "high")
    rows = stored(rows.withColumn(place, F.xxhash64(F.col(doc_id), *[c for c in names if c != row], "size")))
    totals = rows.groupBy("old_shard").agg(F.sum("size").alias("bytes")).collect()
    if not totals:
        return rows.drop(place).withColumns({"shard": F.lit(None).cast("int"), "slot": F.lit(None).cast("long")})
    most = sum(r["bytes"] for r in totals) // (shards * LARGE_PART)
    # Large rows: at most shards * LARGE_PART of them, by their size.
    last = [F.col(row)] if row else []
    order = [F.desc("size"), F.col(doc_id), F.col(place), *last]
    large = rows.filter(F.col("size") > most).withColumn(nth, F.row_number().over(Window.orderBy(*order)).cast("long"))
    singles = [(r["old_shard"], r["size"]) for r in large.orderBy(nth).select("old_shard", "size").collect()]
    places, held = place_large(singles, shards)
    sand = [0] * (1 + max(r["old_shard"] for r in totals))
    for r in totals:
        sand[r["old_shard"]] = r["bytes"]
    for shard, amount in singles:
        sand[shard] -= amount
    plan = transfers(sand, rooms(held, sum(sand)))
    segments = []  # a few per shard: (old shard, from byte, to byte, new shard)
    for i, parts in enumerate(plan):
        at = 0
        for k, (j, amount) in enumerate(parts):
            end = at + amount if k + 1 < len(parts) else 2**62
            segments.append((i, at, end, j))
            at = end
    spark = df.sparkSession
    cuts = spark.createDataFrame(
        [(i, a, b, j, n) for n, (i, a, b, j) in enumerate(segments)],
        f"old_shard int, `{low}` long, `{high}` long, shard int, `{seg}` int",
    )
    singly = spark.createDataFrame(
        [(n + 1, j, len(segments) + j) for n, j in enumerate(places)], f"`{nth}` long, shard int, `{seg}` int"
    )

    small = rows.filter(F.col("size") <= most).withColumn(block, F.shiftrightunsigned(place, 64 - BLOCK_BITS))
    sums = small.groupBy("old_shard", block).agg(F.sum("size").alias(start), F.count("*").alias(nth))
    earlier = Window.partitionBy("old_shard").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "old_shard",
        block,
        F.coalesce(F.sum(start).over(earlier), F.lit(0)).alias(start),
        F.coalesce(F.sum(nth).over(earlier), F.lit(0)).alias(nth),
    )
    inside = Window.partitionBy("old_shard", block).orderBy(place, F.col(doc_id), "size", *last)
    b_start, b_nth = fresh(small, "b_start", "b_nth")
    offsets = offsets.withColumnsRenamed({start: b_start, nth: b_nth})
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    small = (
        small.withColumn(start, before)
        .withColumn(nth, F.row_number().over(inside).cast("long"))
        .join(offsets, ["old_shard", block])
        .withColumn(start, F.col(start) + F.col(b_start))
        .withColumn(nth, F.col(nth) + F.col(b_nth))
        .join(F.broadcast(cuts), "old_shard")
        .filter((F.col(start) >= F.col(low)) & (F.col(start) < F.col(high)))
    )
    columns = [*names, "size", "old_shard", "shard", seg, nth]
    placed = stored(small.select(*columns).union(large.join(F.broadcast(singly), nth).select(*columns)))
    # A segment's rows are consecutive in their old shard; a shard's segments follow each other.
    found = placed.groupBy("shard", seg).agg(F.min(nth).alias(low), F.count("*").alias(high))
    upto = Window.partitionBy("shard").orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn(high, F.coalesce(F.sum(high).over(upto), F.lit(0))).drop("shard")
    # Large rows of one shard are numbered among themselves: their order over all shards has gaps.
    gapless = Window.partitionBy(seg).orderBy(nth)
    sent = placed.filter(F.col(seg) < len(segments)).join(F.broadcast(found), seg)
    sent = sent.withColumn("slot", F.col(nth) - F.col(low) + F.col(high))
    single = placed.filter(F.col(seg) >= len(segments)).join(F.broadcast(found), seg)
    single = single.withColumn("slot", F.row_number().over(gapless) - 1 + F.col(high))
    return sent.union(single).select(*names, "size", "old_shard", "shard", "slot")


def lay_out(docs: DataFrame, old: Column, row: str) -> str:
    """Write ``docs`` as a layout of shards ``old``; returns its folder, which has a folder shard=j for each shard.

    The files have a new column ``row``, a number that no two rows share.  ``old``
    must not be null.  Columns shard and slot of ``docs`` are left out.
    """
    to = f"{shared_folder(docs.sparkSession)}/shards-{uuid.uuid4().hex}"
    rows = docs.withColumns({"old_shard": old.cast("int"), row: F.monotonically_increasing_id()}).drop("shard", "slot")
    rows.withColumnRenamed("old_shard", "shard").write.option("compression", "zstd").partitionBy("shard").parquet(to)
    return to


def read(spark: SparkSession, folders: dict[int, str], schema: T.StructType) -> DataFrame:
    """Rows with their shard from the files of ``folders`` (shard -> folder shard=j); columns that files lack are null."""
    found = spark.createDataFrame([], schema)
    for base in sorted({f.rsplit("/", 1)[0] for f in folders.values()}):
        own = [f for _, f in sorted(folders.items()) if f.rsplit("/", 1)[0] == base]
        found = found.unionByName(spark.read.schema(schema).option("basePath", base).parquet(*own))
    return found


def rewrite(
    spark: SparkSession,
    docs: DataFrame,
    plan: DataFrame,
    folders: dict[int, str],
    doc_id: str = "doc_id",
    row: str | None = None,
) -> dict[int, str]:
    """Write the shards that ``plan`` changes; returns the folder of every new shard.

    ``docs`` has the old table's rows with their ``old_shard``, ``plan`` a row for
    each of them, ``folders`` the old shards' folders.  Shards that neither lose
    nor gain a row keep theirs.  Rows are matched by ``row``, a column of both
    that is never null and that no two rows share (refused otherwise).  Without
    it they are matched one by one in each ``doc_id``, nulls too, so that each is
    written once; rows that share a doc_id and an old shard may then take each
    other's places, and such rows meet in one task.
    """
    plan = stored(plan)
    moved = plan.filter("shard <> old_shard")
    ends = moved.select(F.explode(F.array("shard", "old_shard")).alias("shard")).distinct()
    changed = {r["shard"] for r in ends.collect()}  # as many as there are shards
    new = {r["shard"] for r in plan.select("shard").distinct().collect()}
    to = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    # Rows without an old shard have nowhere to stay in.
    affected = docs.filter(F.col("old_shard").isin(sorted(changed)) | F.col("old_shard").isNull()).drop("shard", "slot")
    target = plan.filter(F.col("shard").isin(sorted(changed)))
    if row:
        many = plan.groupBy(row).count().filter((F.col("count") > 1) | F.col(row).isNull())
        if many.limit(1).count():
            raise ValueError(f"{row} is null or repeated in the plan")
        rows = affected.join(target.select(row, "shard", "slot"), row)
    else:
        t_id, t_nth, nth = fresh(affected, "t_id", "t_nth", "nth")
        shard = F.col("old_shard").asc_nulls_last()
        target = target.select(
            F.col(doc_id).alias(t_id),
            F.row_number().over(Window.partitionBy(doc_id).orderBy(shard, "shard", "slot")).alias(t_nth),
            "shard",
            "slot",
        )
        rows = affected.withColumn(nth, F.row_number().over(Window.partitionBy(doc_id).orderBy(shard)))
        same = F.col(doc_id).eqNullSafe(F.col(t_id)) & (F.col(nth) == F.col(t_nth))
        rows = rows.join(target, same).drop(t_id, t_nth, nth)
    rows.sortWithinPartitions("shard", "slot").write.option("compression", "zstd").partitionBy("shard").parquet(to)
    return {j: f"{to}/shard={j}" if j in changed else folders[j] for j in sorted(new)}
