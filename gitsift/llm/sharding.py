"""Resharding by minimum-cost flow: equal bytes per shard, fewest bytes moved.

Rows lie in old shards. Each old shard is a sequence of blocks, by a hash of the rows.
Spark sums bytes per block; that table has at most ``old_shards * BLOCKS`` rows and is
all the driver sees of the data. A flow from old sizes to new capacities, in which
bytes that stay cost nothing and bytes that move cost one each, says how much of each
old shard goes where. The old shard's sequence is cut there. A block that a cut falls
into is divided again by a second hash, so shards differ by less than one in
``BLOCKS * BLOCKS`` parts of an old shard, or by a row.

* null text: no bytes; every row counts one byte more than its text, so that empty rows
  spread too. Null doc_id or source: a value like others.
* repeated rows are rows like others; equal ones stay in one block.
* an empty table gives no rows. Very long texts are one row each and never cut.
* columns of the input that are named like results are not looked at by ``reshard``;
  ``rewrite`` and ``move`` refuse such inputs.

``reshard`` says where every row goes. ``move`` takes them there, whole rows in the order of
their slots, and ``rewrite`` does so for shards that lie in folders of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gitsift.session import materialise, shuffles_removed

#: Blocks of an old shard, and parts of a block that a cut falls into.
BLOCKS = 1024

LAW = "bytes"


def minimum_cost_flow(supply: list[int], capacity: list[int],
                      cost: list[list[int]]) -> list[list[int]]:
    """Units from each supply to each capacity, all supplied, at the least cost.

    Shortest augmenting paths on the residual graph; both sides are a few shards.
    """
    n, m = len(supply), len(capacity)
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    while any(left):
        # Cheapest way from any supply that is left to every node; sources 0..n-1, sinks n...
        best: list[float] = [0 if left[i] else float("inf") for i in range(n)] + [float("inf")] * m
        came: list[int] = [-1] * (n + m)
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    if best[i] + cost[i][j] < best[n + j]:
                        best[n + j], came[n + j], changed = best[i] + cost[i][j], i, True
                    if flow[i][j] and best[n + j] - cost[i][j] < best[i]:
                        best[i], came[i], changed = best[n + j] - cost[i][j], n + j, True
        goal = min((j for j in range(m) if room[j]), key=lambda j: best[n + j])
        path, node = [], n + goal
        while came[node] >= 0:
            path.append((came[node], node))
            node = came[node]
        amount = min([left[node], room[goal]] + [flow[b][a - n] for a, b in path if a >= n])
        for a, b in path:
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[node] -= amount
        room[goal] -= amount
    return flow


def transfers(sizes: list[int], new_shards: int) -> list[list[int]]:
    """Bytes from each old shard to each new one; capacities are equal to within a byte."""
    total = sum(sizes)
    capacity = [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    cost = [[int(i != j) for j in range(new_shards)] for i in range(len(sizes))]
    return minimum_cost_flow(sizes, capacity, cost)


def _intervals(flow: list[int], shard: int) -> list[tuple[int, int]]:
    """(end, target) along an old shard's bytes: what stays first, then what moves."""
    order = sorted((j for j in range(len(flow)) if flow[j]), key=lambda j: (j != shard, j))
    out, end = [], 0
    for j in order:
        end += flow[j]
        out.append((end, j))
    return out


def _place(intervals: list[tuple[int, int]], at: float) -> int:
    return next((j for end, j in intervals if at < end), intervals[-1][1])


def size_of(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def crc32_of(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def reshard(df: DataFrame, old_shard: Column, old_shards: int, new_shards: int) -> DataFrame:
    """doc_id, size, text_crc32, old_shard, shard, slot of every row.

    ``old_shard`` is 0 to ``old_shards`` - 1. Slots are gapless from 0 in each new shard.
    """
    rows = materialise(_keyed(df, old_shard), "rows")
    return _with_slots(rows, rows, _targets(rows, old_shards, new_shards))


def move(df: DataFrame, old_shard: Column, old_shards: int, new_shards: int, path: str) -> DataFrame:
    """The rows of ``df`` as they lie in the new shards, with ``old_shard``, ``shard`` and ``slot``.

    Shards are those of ``reshard``, written as ``shard=k`` folders below ``path``, rows in the order
    of their slots. Texts are moved once, to the shard, old shard and block that their slot is
    counted in; sizes are looked at before without them.
    """
    if taken := {"old_shard", "shard", "slot"} & set(df.columns):
        raise ValueError(f"columns {sorted(taken)} are taken by the layout")
    rows = materialise(_keyed(df, old_shard), "rows")
    whole = _keyed(df, old_shard, F.struct(*df.columns).alias("_gs_row"))
    own = [F.col("_gs_row")[c].alias(c) for c in df.columns]
    moved = _with_slots(whole, rows, _targets(rows, old_shards, new_shards), ["_gs_row"]).select(*own, "old_shard", "slot", "shard")
    with shuffles_removed(df.sparkSession):
        moved.write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.schema(moved.schema).parquet(path)


def _keyed(df: DataFrame, old_shard: Column, *carried: Column) -> DataFrame:
    """Size, digest, old shard, block and part of every row."""
    digest = F.xxhash64("doc_id", "text_crc32")
    return (df.select("doc_id", size_of(F.col("text")).alias("size"), crc32_of(F.col("text")).alias("text_crc32"),
                      old_shard.cast("int").alias("old_shard"), *carried)
            .withColumn("block", F.pmod(digest, F.lit(BLOCKS)).cast("int"))
            .withColumn("part", F.pmod(F.shiftrightunsigned(digest, 32), F.lit(BLOCKS)).cast("int")))


def _targets(rows: DataFrame, old_shards: int, new_shards: int) -> list[tuple[int, int, int, int]]:
    """(old shard, block, part or -1 for all parts, target) of all rows."""
    blocks = rows.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes")).collect()
    held: list[list[tuple[int, int]]] = [[] for _ in range(old_shards)]
    for row in blocks:
        held[row.old_shard].append((row.block, row.bytes))
    flows = transfers([sum(b for _, b in some) for some in held], new_shards)
    placed: list[tuple[int, int, int, int]] = []
    cut: dict[tuple[int, int], tuple[list[tuple[int, int]], int]] = {}
    for shard, some in enumerate(held):
        intervals, at = _intervals(flows[shard], shard), 0
        for block, size in sorted(some):
            if _place(intervals, at) == _place(intervals, at + size - 1):
                placed.append((shard, block, -1, _place(intervals, at)))
            else:
                cut[shard, block] = intervals, at
            at += size
    if cut:
        spark = rows.sparkSession
        wanted = spark.createDataFrame(list(cut), "old_shard int, block int")
        parts = (rows.join(F.broadcast(wanted), ["old_shard", "block"])
                 .groupBy("old_shard", "block", "part").agg(F.sum("size").alias("bytes")).collect())
        ahead = {key: at for key, (_, at) in cut.items()}
        for row in sorted(parts):
            key = row.old_shard, row.block
            placed.append((*key, row.part, _place(cut[key][0], ahead[key] + row.bytes / 2)))
            ahead[key] += row.bytes
    return placed


def _with_slots(whole: DataFrame, rows: DataFrame, placed: list[tuple[int, int, int, int]],
                carried: Sequence[str] = ()) -> DataFrame:
    """Targets and slots of ``whole``, which are the ``rows`` with what is carried along.

    The table of targets is bounded by shards and blocks, so it may go everywhere.
    """
    table = rows.sparkSession.createDataFrame(placed, "old_shard int, block int, one_part int, shard int")
    blocks = F.broadcast(table.filter("one_part < 0").drop("one_part"))
    parts = F.broadcast(table.filter("one_part >= 0").select(
        "old_shard", "block", F.col("one_part").alias("part"), F.col("shard").alias("part_shard")))

    def sent(some: DataFrame) -> DataFrame:
        return (some.join(blocks, ["old_shard", "block"], "left")
                .join(parts, ["old_shard", "block", "part"], "left")
                .withColumn("shard", F.coalesce("shard", "part_shard")).drop("part_shard"))

    group = ["shard", "old_shard", "block"]
    counts = sent(rows).groupBy(*group).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("old_shard", "block").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(*group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*group).orderBy("doc_id", "text_crc32")
    return (sent(whole).withColumn("inside", F.row_number().over(inside))
            .join(F.broadcast(starts), group)
            .select("doc_id", "size", "text_crc32", "old_shard", "shard", *carried,
                    (F.col("start") + F.col("inside") - 1).alias("slot")))


def rewrite(df: DataFrame, assigned: DataFrame, old_path: str, new_path: str) -> dict[int, str]:
    """Writes the shards that gained or lost rows below ``new_path``; where each shard lies now.

    ``old_path`` holds ``shard=k`` folders with the rows of ``df``. A shard whose rows all
    stay is not touched. Rows are matched by doc_id and the digest of their text, so
    repeated rows go to one shard.
    """
    if taken := {"shard", "slot", "_gs_crc"} & set(df.columns):
        raise ValueError(f"columns {sorted(taken)} are taken by the layout")
    moved = assigned.filter("old_shard <> shard").select(
        F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()
    affected = sorted(row.shard for row in moved.collect())
    targets = assigned.filter(F.col("shard").isin(affected)).select(
        F.col("doc_id").alias("_gs_id"), F.col("text_crc32").alias("_gs_crc"), "shard").distinct()
    crc = crc32_of(F.col("text"))
    out = df.join(targets, F.col("doc_id").eqNullSafe(F.col("_gs_id")) & (crc == F.col("_gs_crc")))
    out.drop("_gs_id", "_gs_crc").write.partitionBy("shard").parquet(new_path)
    shards = sorted(row.shard for row in assigned.select("shard").distinct().collect())
    return {k: f"{new_path if k in affected else old_path}/shard={k}" for k in shards}
