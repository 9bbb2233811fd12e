"""Resharding by minimum-cost flow.

The rows of an old shard are counted by size class; such a block is what is
moved. A flow network between blocks and new shards, where staying is free and
a moved row costs its block's mean bytes, gives the rows each block keeps. Every
row then finds its place from its rank in the block, which is counted in small
cells, and the shards that gain or lose rows are written anew.
"""

from __future__ import annotations

from collections import defaultdict, deque
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetflow.session import scratch_path

#: Cells of a block, for ranks; only the spread of the work depends on it.
CELLS = 1024


class _Network:
    """Successive shortest paths; the graphs here have a few thousand edges."""

    def __init__(self):
        self.to, self.room, self.cost, self.out = [], [], [], defaultdict(list)

    def edge(self, a, b, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def _path(self, source, sink) -> list[int]:
        far, via, queue, waiting = {source: 0}, {}, deque([source]), {source}
        while queue:
            a = queue.popleft()
            waiting.discard(a)
            for e in self.out[a]:
                b, d = self.to[e], far[a] + self.cost[e]
                if self.room[e] and d < far.get(b, d + 1):
                    far[b], via[b] = d, e
                    if b not in waiting:
                        waiting.add(b)
                        queue.append(b)
        path, b = [], sink
        while b in via and b != source:
            path.append(via[b])
            b = self.to[via[b] ^ 1]
        return path

    def solve(self, source, sink) -> None:
        while path := self._path(source, sink):
            flow = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= flow
                self.room[e ^ 1] += flow


def plan_transfers(blocks: dict[tuple[int, int], tuple[int, int]], capacities: list[int]) -> dict[tuple[int, int], int]:
    """Rows that each block (old shard, class) of (rows, bytes) keeps in its shard.

    Fewest bytes move, a row counted with its block's mean. The capacities add up
    to all rows; old shards beyond the new ones keep nothing.
    """
    net, stay = _Network(), {}
    for block, (rows, size) in sorted(blocks.items()):
        net.edge("all", block, rows, 0)
        if block[0] < len(capacities):
            stay[block] = net.edge(block, block[0], rows, 0), rows
        net.edge(block, "moving", rows, max(1, size // max(rows, 1)))
    total = sum(rows for rows, _ in blocks.values())
    for shard, room in enumerate(capacities):
        net.edge("moving", shard, total, 0)
        net.edge(shard, "kept", room, 0)
    net.solve("all", "kept")
    return {b: (stay[b][1] - net.room[stay[b][0]] if b in stay else 0) for b in blocks}


def _interval(index: Column, starts: list[int]) -> Column:
    """The last interval that starts at or before ``index``."""
    out = F.lit(0)
    for k, start in enumerate(starts):
        out = F.when(index >= start, F.lit(k)).otherwise(out)
    return out


def reshard(
    docs: DataFrame, old_shard: Column, shards: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``row`` (all columns of ``docs``), ``shard`` and ``slot``, from the files written.

    Law ``rows``: the shards' counts differ by one at most, and with that the
    fewest bytes leave the shard that ``old_shard`` (not negative) names. Slots
    count from 0 without gaps. Rows of equal size class may change places, never
    get lost; a null text has no bytes, a null id or repeated row is placed like any other, a null
    old shard counts as 0. Empty input gives no rows. Columns of ``docs`` may
    have any names. The driver holds old shards x size classes; cells are spread
    by id and text, so neither a hot shard nor a hot text meets in one task.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 8
    cell = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(CELLS)).cast("int")
    key = F.struct(
        F.coalesce(old_shard, F.lit(0)).cast("int").alias("old"), F.floor(F.log2(size)).cast("int").alias("kind"), cell.alias("cell")
    )
    rows = docs.select(F.struct("*").alias("row"), key.alias("k"), size.alias("size"))
    cells = rows.groupBy("k.old", "k.kind", "k.cell").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    totals = cells.groupBy("old", "kind").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).collect()
    blocks = {(r.old, r.kind): (r.n, r.bytes) for r in totals}
    total = sum(n for n, _ in blocks.values())
    capacities = [total // shards + (s < total % shards) for s in range(shards)]
    keep = plan_transfers(blocks, capacities)
    stays = [sum(n for (old, _), n in keep.items() if old == s) for s in range(shards)]
    gains = [0, *accumulate(c - k for c, k in zip(capacities, stays))]
    places, stay_at, leave_at = [], defaultdict(int), 0
    for old, kind in sorted(blocks):
        n = blocks[old, kind][0]
        places.append((old, kind, keep[old, kind], stay_at[old], leave_at))
        stay_at[old] += keep[old, kind]
        leave_at += n - keep[old, kind]
    placed = spark.createDataFrame(places, "old int, kind int, keep long, stay_at long, leave_at long")

    before = Window.partitionBy("old", "kind").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("old", "kind", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    starts = starts.join(F.broadcast(placed), ["old", "kind"])  # old shards x at most 64 classes
    flat = rows.select("row", F.col("k.old").alias("old"), F.col("k.kind").alias("kind"), F.col("k.cell").alias("cell"))
    inside = Window.partitionBy("old", "kind", "cell").orderBy(F.col("row").getField(id_col), F.crc32(F.col("row").getField(text_col)))
    ranked = flat.withColumn("rank", F.row_number().over(inside) - 1).join(starts, ["old", "kind", "cell"])
    rank = F.col("start") + F.col("rank")
    leaving = F.col("leave_at") + rank - F.col("keep")
    goes = ranked.withColumn("stays", rank < F.col("keep")).withColumn("to", _interval(leaving, gains[:-1]))
    goes = goes.withColumn("shard", F.when(F.col("stays"), F.col("old")).otherwise(F.col("to")))
    come = F.lit(0).cast("long")
    for s in range(shards):
        come = F.when(F.col("to") == s, leaving - gains[s] + stays[s]).otherwise(come)
    goes = goes.withColumn("slot", F.when(F.col("stays"), F.col("stay_at") + rank).otherwise(come).cast("long"))
    goes = goes.select("row", F.col("shard").cast("int").alias("shard"), "slot")

    had = [sum(n for (old, _), (n, _) in blocks.items() if old == s) for s in range(shards)]
    untouched = [s for s in range(shards) if stays[s] == had[s] == capacities[s]]
    if not total:
        return goes
    path = scratch_path(spark, "shards")
    goes.where(~F.col("shard").isin(untouched)).write.partitionBy("shard").parquet(path)
    written = spark.read.schema(goes.schema).parquet(path)
    return written.unionByName(goes.where(F.col("shard").isin(untouched))) if untouched else written
