import itertools
import random
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from martloom.llm import resharding
from martloom.llm.queries import NEW_SHARDS, op7_resharding


def cheapest(supply, demand, cost):
    """By trying every way to hand out the units."""
    best = None
    units = [i for i, s in enumerate(supply) for _ in range(s)]
    for way in set(itertools.permutations([j for j, d in enumerate(demand) for _ in range(d)])):
        total = sum(cost[i][j] for i, j in zip(units, way))
        best = total if best is None else min(best, total)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_flow_is_cheapest(seed):
    rnd = random.Random(seed)
    supply = [rnd.randrange(4) for _ in range(3)]
    demand = [0, 0, 0]
    for _ in range(sum(supply)):
        demand[rnd.randrange(3)] += 1
    cost = [[rnd.randrange(5) for _ in range(3)] for _ in range(3)]
    flow = resharding.min_cost_flow(supply, demand, cost)
    assert [sum(f for (i, _), f in flow.items() if i == k) for k in range(3)] == supply
    assert [sum(f for (_, j), f in flow.items() if j == k) for k in range(3)] == demand
    assert sum(cost[i][j] * f for (i, j), f in flow.items()) == cheapest(supply, demand, cost)


def test_moves_little_and_evens_out():
    rnd = random.Random(1)
    blocks = {(i, b): rnd.randrange(900, 1100) for i in range(8) for b in range(64)}
    total = sum(blocks.values())
    plan = resharding.plan_moves(blocks, resharding.even_capacities(total, 10))
    sizes = Counter()
    for key, j in plan.placed.items():
        sizes[j] += blocks[key]
    assert max(sizes.values()) - min(sizes.values()) <= 1100
    assert plan.least_bytes == pytest.approx(total / 5, rel=0.02)
    assert plan.moved_bytes <= plan.least_bytes * 1.1
    same = resharding.plan_moves({(0, 0): 5, (1, 0): 5}, [5, 5])
    assert same.moved_bytes == 0 and same.affected == set()


DDL = "doc_id BIGINT, text STRING, shard INT, size INT, slot STRING"


def rows_of(df, olds, shards):
    placed, _ = resharding.reshard(df, F.col("shard"), shards)
    return placed.collect()


def check_slots(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(resharding, "RUN_ROWS", 2)
    rows = [(k, "copy" if k % 3 else "é" * (k % 50), k % 4, 1, "x") for k in range(300)]
    rows += [(7, "same", 1, 1, "x")] * 5 + [(None, None, None, 1, "x"), (None, "", 9, 1, "x")]
    df = spark.createDataFrame(rows, DDL)
    out = rows_of(df, 4, 6)
    expected = Counter(
        (i, len((t or "").encode()) + 16, crc32((t or "").encode())) for i, t, *_ in rows
    )
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == expected
    check_slots(out)
    assert rows_of(df.limit(0), 4, 6) == []


def test_rewrite_only_touched_shards(spark, tmp_path):
    rows = [(k, "t" * (k % 90), k % 4, 1, f"row {k}") for k in range(400)]
    df = spark.createDataFrame(rows, DDL)
    plan = resharding.rewrite(df, "shard", 5, str(tmp_path / "new"))
    written = spark.read.parquet(str(tmp_path / "new"))
    assert {r.shard for r in written.select("shard").distinct().collect()} <= plan.affected
    placed, _ = resharding.reshard(df, F.col("shard"), 5)
    want = {(r.doc_id, r.shard) for r in placed.collect() if r.shard in plan.affected}
    assert {(r.doc_id, r.shard) for r in written.collect()} == want
    assert {r.slot for r in written.collect()} <= {f"row {k}" for k in range(400)}


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    out = op7_resharding(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (r.doc_id, len(r.text.encode()) + 16, crc32(r.text.encode())) for r in docs
    )
    check_slots(out)
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r.size
    largest = max(r.size for r in out)
    assert set(sizes) == set(range(NEW_SHARDS))
    assert max(sizes.values()) - min(sizes.values()) <= largest
