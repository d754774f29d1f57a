"""Resharding that moves the fewest bytes, as a minimum-cost flow.

Each old shard is seen as blocks of rows, dealt by a hash. Sizes of shards and blocks come from one
aggregate. The flow network has an edge from every old shard to every new one, free where a row may
stay and at a cost per byte where it has to move; successive shortest paths find the cheapest flow from
the old sizes to the new capacities. Whole blocks then carry the flow, the largest first, and single
blocks are exchanged until no exchange brings the shards nearer to their capacities. Only shards
that give or take blocks are written again.

The driver sees a table of shards x ``BLOCKS`` sizes, however many rows there are.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Blocks of an old shard; the sizes of the new shards differ by about a block at most.
BLOCKS = 256
# Rows numbered in one task.
RUN_ROWS = 100_000
ROW_BYTES = 16


def min_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> dict[tuple[int, int], int]:
    """The cheapest flow from supplies to demands of the same total: (i, j) -> amount.

    Successive shortest paths with node potentials, on the residual network.
    """
    if sum(supply) != sum(demand) or min([0, *supply, *demand]) < 0:
        raise ValueError("supply and demand have to be equal and not negative")
    m, n = len(supply), len(demand)
    left, need = list(supply), list(demand)
    flow: dict[tuple[int, int], int] = defaultdict(int)
    height = [0] * (m + n)  # old shards, then new shards
    while any(left):
        dist = [float("inf")] * (m + n)
        came: list[int | None] = [None] * (m + n)
        heap = []
        for i in range(m):
            if left[i]:
                dist[i] = 0
                heap.append((0, i))
        heapq.heapify(heap)
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            if u < m:
                steps = [(m + j, cost[u][j]) for j in range(n)]
            else:
                steps = [(i, -cost[i][u - m]) for i in range(m) if flow[i, u - m]]
            for v, c in steps:
                new = d + c + height[u] - height[v]
                if new < dist[v]:
                    dist[v], came[v] = new, u
                    heapq.heappush(heap, (new, v))
        end = min((m + j for j in range(n) if need[j]), key=lambda v: dist[v] + height[v])
        far = max(x for x in dist if x < float("inf"))
        height = [h + min(d, far) for h, d in zip(height, dist)]
        path = [end]
        while came[path[-1]] is not None:
            path.append(came[path[-1]])
        path.reverse()
        amount = min([left[path[0]], need[end - m], *(flow[v, u - m] for u, v in zip(path, path[1:]) if u >= m)])
        for u, v in zip(path, path[1:]):
            if u < m:
                flow[u, v - m] += amount
            else:
                flow[v, u - m] -= amount
        left[path[0]] -= amount
        need[end - m] -= amount
    return {k: v for k, v in flow.items() if v}


@dataclass
class Plan:
    """Where each block goes: (old shard, block) -> new shard; and the shards that change."""

    placed: dict[tuple[int, int], int]
    moved_bytes: int
    least_bytes: int
    affected: set[int]


def _carry(blocks: dict[tuple[int, int], int], flow: dict[tuple[int, int], int]) -> dict:
    """Blocks for each flow, the largest block to the new shard that waits for most."""
    placed = {}
    for i in sorted({i for i, _ in blocks}):
        want = {j: f for (k, j), f in flow.items() if k == i} or {0: 0}
        own = sorted(((size, b) for (k, b), size in blocks.items() if k == i), reverse=True)
        for size, b in own:
            j = max(want, key=lambda j: (want[j], -j))
            placed[i, b] = j
            want[j] -= size
    return placed


def _even_out(blocks: dict, placed: dict, capacity: list[int]) -> None:
    """Give single blocks from the fullest shard to the emptiest while that narrows the gap."""
    over = [-c for c in capacity]
    held: list[list[tuple[int, tuple[int, int]]]] = [[] for _ in capacity]
    for key, j in placed.items():
        over[j] += blocks[key]
        held[j].append((blocks[key], key))
    for _ in range(8 * len(placed) + 1):
        high, low = max(range(len(over)), key=over.__getitem__), min(range(len(over)), key=over.__getitem__)
        gap = over[high] - over[low]
        fit = [x for x in held[high] if 0 < x[0] < gap]
        if not fit:
            return
        size, key = min(fit, key=lambda x: (abs(2 * x[0] - gap), x[1]))
        held[high].remove((size, key))
        held[low].append((size, key))
        over[high] -= size
        over[low] += size
        placed[key] = low


def plan_moves(blocks: dict[tuple[int, int], int], capacity: list[int]) -> Plan:
    """From sizes of (old shard, block) and the new shards' capacities to the place of every block.

    Old shard k and new shard k are the same place; old shards beyond the new ones are emptied.
    """
    olds = sorted({i for i, _ in blocks})
    supply = [sum(s for (k, _), s in blocks.items() if k == i) for i in olds]
    cost = [[int(i != j) for j in range(len(capacity))] for i in olds]
    flow = {(olds[i], j): f for (i, j), f in min_cost_flow(supply, capacity, cost).items()}
    placed = _carry(blocks, flow)
    _even_out(blocks, placed, capacity)
    moves = {key: j for key, j in placed.items() if key[0] != j}
    return Plan(
        placed,
        sum(blocks[key] for key in moves),
        sum(f for (i, j), f in flow.items() if i != j),
        {key[0] for key in moves} | set(moves.values()),
    )


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def _dealt(docs: DataFrame, old_shard: Column, doc_id: str, text: str) -> DataFrame:
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        (F.octet_length(value).cast("bigint") + ROW_BYTES).alias("size"),
        F.crc32(value).alias("text_crc32"),
        F.coalesce(old_shard.cast("int"), F.lit(0)).alias("old_shard"),
    ).withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(BLOCKS)).cast("int"))


def reshard(
    docs: DataFrame, old_shard: Column, shards: int, doc_id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, Plan]:
    """Rows with ``doc_id, size, text_crc32, old_shard, shard, slot``, and the plan behind them.

    ``size`` is the text's bytes in UTF-8 plus 16. Shards 0 to ``shards - 1`` get sizes that differ by
    about the smallest blocks; slots number the rows of a shard from 0 without gaps, by block and
    doc_id.

    Edge cases: a null text counts as empty, a null ``old_shard`` as shard 0. Equal texts, repeated
    rows and rows without doc_id are rows like any other and get slots of their own. An empty table
    gives no rows. Other columns are not read; ``rewrite`` carries them.
    """
    spark = docs.sparkSession
    rows = _dealt(docs, old_shard, doc_id, text)
    sizes = rows.groupBy("old_shard", "block").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    found = sizes.collect()  # at most BLOCKS rows an old shard
    blocks = {(r.old_shard, r.block): r["bytes"] for r in found}
    plan = plan_moves(blocks, even_capacities(sum(blocks.values()), shards))
    counted = [(*key, j) for key, j in plan.placed.items()]
    runs = -(-max([1, *(r["rows"] for r in found)]) // RUN_ROWS)
    to = spark.createDataFrame(counted, "old_shard INT, block INT, shard INT")
    placed = rows.join(F.broadcast(to), ["old_shard", "block"]).withColumn(
        "run", F.pmod(F.xxhash64("text_crc32", "doc_id"), F.lit(runs))
    )
    key = ["shard", "old_shard", "block", "run"]
    before = Window.partitionBy("shard").orderBy("old_shard", "block", "run")
    offsets = (
        placed.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*key, (F.sum("n").over(before) - F.col("n")).alias("offset"))
    )
    within = F.row_number().over(Window.partitionBy(*key).orderBy("doc_id", "text_crc32", "size"))
    numbered = placed.withColumn("place", within).join(offsets, key)
    slot = F.col("offset") + F.col("place") - 1
    return (
        numbered.select("doc_id", "size", "text_crc32", "old_shard", "shard", slot.alias("slot")),
        plan,
    )


def rewrite(docs: DataFrame, old_shard: str, shards: int, path: str, doc_id="doc_id", text="text") -> Plan:
    """Write the shards that change to ``path``, one folder ``shard=k`` each, with all columns.

    ``docs`` holds the rows of all shards with their shard in ``old_shard``; a shard outside
    ``plan.affected`` keeps its files, which are not written here.
    """
    spark = docs.sparkSession
    rows, plan = reshard(docs, F.col(old_shard), shards, doc_id, text)
    to = spark.createDataFrame(
        [(*key, j) for key, j in plan.placed.items()], "_old INT, _block INT, shard INT"
    )
    value = F.coalesce(F.col(text), F.lit(""))
    block = F.pmod(F.xxhash64(F.col(doc_id).cast("bigint"), F.crc32(value)), F.lit(BLOCKS)).cast("int")
    kept = docs.drop("shard") if old_shard != "shard" else docs.withColumnRenamed("shard", "_from").drop("shard")
    old = F.coalesce(F.col("_from" if old_shard == "shard" else old_shard).cast("int"), F.lit(0))
    placed = (
        kept.withColumn("_old", old)
        .withColumn("_block", block)
        .join(F.broadcast(to), ["_old", "_block"])
        .filter(F.col("shard").isin(sorted(plan.affected)) if plan.affected else F.lit(False))
        .drop("_old", "_block", "_from")
    )
    placed.write.partitionBy("shard").mode("overwrite").parquet(path)
    return plan
