"""Exact top-k by inner product with a pair of cover trees.

Queries and candidates are dealt into blocks, and every block of queries meets every block of
candidates in a task of its own. There both are indexed by a cover tree: a node has a centre, a
covering radius (the largest distance of its points from the centre) and children around centres
spread farthest first. For any query q and candidate c of two nodes

    q.c <= Q.R + |Q| r_R + |R| r_Q + r_Q r_R

with the centres Q, R and radii r_Q, r_R. A pair of nodes is left out when this bound is below the
worst kth score in the query node; otherwise the children meet, best bound first, and two leaves
compare all their points. The best k of each block are merged by a window over k rows a block.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.vectors import matrix, usable
from martloom.operators.lookup import bounded
from martloom.session import written

K = 5
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8_192
# Tasks for the block pairs, if the session asks for fewer.
TASKS = 64
# Points of a leaf; small ones of queries keep a group's worst score close to each query's own.
LEAF = 256
QUERY_LEAF = 32
CHILDREN = 8
SHRINK = 0.5
# The least value marks an empty place among the best k.
EMPTY = np.iinfo(np.int64).min


@dataclass
class Node:
    centre: np.ndarray
    length: float
    radius: float
    points: np.ndarray
    children: list[Node] = field(default_factory=list)


def cover_tree(x: np.ndarray, leaf: int, points: np.ndarray | None = None) -> Node:
    """A cover tree over the rows ``points`` of ``x``; leaves hold ``leaf`` rows, or equal ones."""
    points = np.arange(len(x)) if points is None else points
    own = x[points]
    middle = own.mean(axis=0)
    gap = np.linalg.norm(own - middle, axis=1)
    centre = own[int(gap.argmin())]
    gap = np.linalg.norm(own - centre, axis=1)
    # The widening covers the rounding of the distances.
    radius = float(gap.max()) * (1 + 1e-12) + 1e-9
    node = Node(centre, float(np.linalg.norm(centre)), radius, points)
    if len(points) <= leaf or gap.max() == 0:
        return node
    near, home = gap, np.zeros(len(points), dtype=np.int64)
    for k in range(1, CHILDREN):
        far = int(near.argmax())
        if near[far] <= SHRINK * gap.max():
            break
        to = np.linalg.norm(own - own[far], axis=1)
        closer = to < near
        near, home = np.where(closer, to, near), np.where(closer, k, home)
    parts = [points[home == k] for k in range(home.max() + 1)]
    node.children = [cover_tree(x, leaf, part) for part in parts if len(part)]
    return node


class Search:
    """The best k candidates of each query of one block."""

    def __init__(self, queries, query_ids, candidates, ids, k: int):
        self.q, self.c = queries, candidates
        self.query_ids, self.ids, self.k = query_ids, ids, k
        self.scores = np.full((len(queries), k), EMPTY, dtype=np.int64)
        self.best = np.full((len(queries), k), EMPTY, dtype=np.int64)
        top = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0))
        # Sums of products below 2**53 are whole in double precision, in any order.
        self.whole = top * queries.shape[1] < 2**53
        self.pairs = 0

    def run(self) -> None:
        if len(self.q) and len(self.c):
            self.visit(cover_tree(self.q, QUERY_LEAF), cover_tree(self.c, LEAF))

    def bounds(self, a: list[Node], b: list[Node]) -> np.ndarray:
        """Of each node of ``a`` with each of ``b``."""
        x, y = np.array([n.centre for n in a]), np.array([n.centre for n in b])
        (lx, rx), (ly, ry) = (np.array([(n.length, n.radius) for n in s]).T for s in (a, b))
        reach = x @ y.T + np.outer(lx, ry) + np.outer(rx, ly) + np.outer(rx, ry)
        return reach + 1e-9 * np.outer(1 + lx + rx, 1 + ly + ry)

    def visit(self, a: Node, b: Node) -> None:
        """Compare the queries of ``a`` with the candidates of ``b`` where they may still matter."""
        stack = [(float(self.bounds([a], [b])[0, 0]), a, b)]
        while stack:
            bound, a, b = stack.pop()
            # A tie may still win by its smaller id.
            if bound < float(self.scores[a.points, -1].min()):
                continue
            if not a.children and not b.children:
                self.compare(a.points, b.points)
                continue
            # Split the wider node, so that the bound falls fastest.
            if a.children and (not b.children or a.radius > b.radius):
                pairs = list(zip(self.bounds(a.children, [b])[:, 0], a.children, [b] * len(a.children)))
            else:
                pairs = list(zip(self.bounds([a], b.children)[0], [a] * len(b.children), b.children))
            stack.extend(sorted(pairs, key=lambda p: p[0]))

    def compare(self, rows: np.ndarray, columns: np.ndarray) -> None:
        self.pairs += len(rows) * len(columns)
        q, c = self.q[rows], self.c[columns]
        if self.whole:
            score = (q @ c.T).astype(np.int64)
        else:
            score = q.astype(np.int64) @ c.T.astype(np.int64)
        ids = self.ids[columns]
        hit = (score >= self.scores[rows, -1:]) & (ids[None, :] != self.query_ids[rows, None])
        place, new = np.nonzero(hit)
        if not len(place):
            return
        # The hits and the best so far of the rows that have any, best first, an empty place last.
        changed = np.unique(place)
        held = np.repeat(rows[changed], self.k)
        row = np.concatenate([held, rows[place]])
        scores = np.concatenate([self.scores[rows[changed]].ravel(), score[place, new]])
        best = np.concatenate([self.best[rows[changed]].ravel(), ids[new]])
        empty = np.arange(len(row)) < len(held)
        empty &= scores == EMPTY
        order = np.lexsort((best, ~scores, empty, row))
        row = row[order]
        start = np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1])
        rank = np.arange(len(row)) - np.repeat(start, np.diff([*start, len(row)]))
        top = rank < self.k
        self.scores[row[top], rank[top]] = scores[order][top]
        self.best[row[top], rank[top]] = best[order][top]


_OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _block_pair(k: int):
    def run(table: pa.Table) -> pa.Table:
        asked = table.column("asked").to_numpy(zero_copy_only=False)
        sides = []
        for part in (table.filter(pa.array(asked)), table.filter(pa.array(~asked))):
            rows = matrix(part.column("vector"), np.float64) if len(part) else np.empty((0, 1))
            sides += [rows, part.column("vec_id").to_numpy()]
        search = Search(*sides, k)
        search.run()
        row, place = np.nonzero(search.best != EMPTY)
        return pa.table(
            [search.query_ids[row], search.best[row, place], search.scores[row, place]], schema=_OUT
        )

    return run


def whole_components(df: DataFrame, vec_id: str, vector: str, factor: int) -> DataFrame:
    """``vec_id`` and ``vector`` of the usable rows, each component as floor(factor * x)."""
    x = F.col(vector).cast("array<double>")
    return (
        df.select(F.col(vec_id).cast("bigint").alias("vec_id"), x.alias("vector"))
        .filter(usable(F.col("vector")))
        .withColumn("dims", F.size("vector"))
        .withColumn("vector", F.transform("vector", lambda v: _floor(v * factor)))
    )


def _floor(x: F.Column) -> F.Column:
    """floor of a double as a double, also beyond the range of bigint."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def spark_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def top_k(
    df: DataFrame,
    is_query: F.Column,
    k: int = K,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    factor: int = 256,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest inner product with each query.

    Components count as floor(factor * x), so scores are whole numbers; they are exact while they
    stay below 2**63. Queries are the rows where ``is_query`` (over ``vec_id``) holds, candidates all
    rows of another vec_id and the same length. Ties go to the smaller vec_id; ranks start at 1.

    Edge cases: vectors that are null or hold a null or non-finite component take no part; rows with
    a null vec_id neither. A query with fewer candidates than k returns them all. Repeated rows are
    one candidate each; as queries those of one vec_id are one, by its smallest vector. Empty tables
    give empty results. Other columns are not read.
    """
    rows = whole_components(df, vec_id, vector, factor).filter("vec_id is not null")
    queries = rows.filter(is_query).groupBy("vec_id", "dims").agg(F.min("vector").alias("vector"))
    blocks = rows.groupBy("dims").agg(
        F.greatest(F.lit(1), F.ceil(F.count_if(is_query) / QUERY_BLOCK)).alias("q_blocks"),
        F.ceil(F.count(F.lit(1)) / CANDIDATE_BLOCK).alias("c_blocks"),
    )
    blocks = written(blocks, "blocks")
    zero = F.lit(0).cast("bigint")

    def dealt(side: DataFrame, asked: bool) -> DataFrame:
        q = F.pmod(F.xxhash64("vec_id"), "q_blocks")
        # Repeated rows of a candidate spread over the blocks.
        c = F.pmod(F.xxhash64("vec_id", "vector", F.spark_partition_id()), "c_blocks")
        every_c = F.explode(F.sequence(zero, F.col("c_blocks") - 1))
        every_q = F.explode(F.sequence(zero, F.col("q_blocks") - 1))
        return (
            side.join(bounded(blocks), "dims")
            .withColumn("q", q if asked else every_q)
            .withColumn("c", every_c if asked else c)
            .select("dims", "q", "c", F.lit(asked).alias("asked"), "vec_id", "vector")
        )

    met = (
        dealt(queries, True)
        .unionByName(dealt(rows, False))
        # A fixed number of partitions: by their bytes, a few tasks would get all the work.
        .repartition(max(TASKS, spark_partitions(df)), "dims", "q", "c")
        .groupBy("dims", "q", "c")
        .applyInArrow(_block_pair(k), "query_id BIGINT, vec_id BIGINT, score BIGINT")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
