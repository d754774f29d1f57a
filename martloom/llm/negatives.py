"""Hard negatives of anchors, found through summaries of vector segments.

A vector is cut into segments, at several levels from one segment to ever shorter ones, and of each
the mean m and the deviation d (root of the mean square about m) are stored beside it. For two vectors
and one segment of length n

    n (m m' - d d')  <=  inner product of the segments  <=  n (m m' + d d')

as the parts about the means obey Cauchy and Schwarz. Sums over the segments of a level bound the
score of a pair; the next level refines the bound of the pairs that are still open, and only pairs
that no level settles are scored exactly. A pair is settled when its bounds miss every range of scores
that its anchor asks for, or lie below the worst of the best scores found for that range so far.

Anchors and candidates are dealt into blocks; a task holds one pair of blocks. The number of blocks
grows with the rows, so neither a hot label nor the table is held by one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.vectors import matrix, usable
from martloom.operators.lookup import bounded
from martloom.session import written

POSITIVES = 5
NEGATIVES = 3
# A negative scores from LOW to HIGH percent of its positive.
LOW, HIGH = 50, 95
ANCHOR_BLOCK = 2_048
CANDIDATE_BLOCK = 8_192
# Tasks for the block pairs, if the session asks for fewer.
TASKS = 64
# Segments of a level, in comparison with the level before.
STEP = 4
SHORTEST = 2
# Anchors and candidates that are compared at a time.
ROWS, COLUMNS = 512, 2_048
# Share of open pairs below which they are looked at one by one instead of by matrix products.
SPARSE = 0.1
# What a task needs of a row, besides its label.
DATA = ("vec_id", "vector", "means", "deviations")
EMPTY = np.iinfo(np.int64).min
LARGEST = np.iinfo(np.int64).max


def levels(dims: int) -> list[np.ndarray]:
    """The segment edges of each level."""
    found, n = [], 1
    while n == 1 or dims // n >= SHORTEST:
        found.append(np.arange(n + 1) * dims // n)
        n *= STEP
    return found


def summarise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of all levels, a row for each vector."""
    means, deviations = [], []
    for edges in levels(x.shape[1]):
        n = np.diff(edges)
        mean = np.add.reduceat(x, edges[:-1], axis=1) / n
        about = x - np.repeat(mean, n, axis=1)
        means.append(mean)
        deviations.append(np.sqrt(np.add.reduceat(about * about, edges[:-1], axis=1) / n))
    return np.hstack(means), np.hstack(deviations)


def _floor(x: Column) -> Column:
    """floor of a double as a double, also beyond the range of bigint."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def summaries(df: DataFrame, vec_id: str, vector: str, label: Column, factor: int) -> DataFrame:
    """``vec_id, label, dims, vector, means, deviations`` of the distinct rows that take part; the
    components count as floor(factor * x)."""
    whole = F.transform(F.col(vector).cast("array<double>"), lambda x: _floor(x * factor))
    rows = (
        df.select(F.col(vec_id).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), F.col(vector))
        .filter(usable(F.col(vector).cast("array<double>")) & (F.size(vector) > 0))
        .filter("vec_id is not null and label is not null")
        .select("vec_id", "label", F.size(vector).alias("dims"), whole.alias("vector"))
        .distinct()
    )

    def run(batches):
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                made = summarise(matrix(part.column("vector"), np.float64))
                lists = [pa.array(list(m), pa.list_(pa.float64())) for m in made]
                yield pa.RecordBatch.from_arrays([*part.columns, *lists], [*part.schema.names, "means", "deviations"])

    return rows.mapInArrow(
        run,
        "vec_id BIGINT, label BIGINT, dims INT, vector ARRAY<DOUBLE>, means ARRAY<DOUBLE>, deviations ARRAY<DOUBLE>",
    )


@dataclass
class Side:
    ids: np.ndarray
    label: np.ndarray
    vector: np.ndarray
    means: np.ndarray
    deviations: np.ndarray

    def rows(self, at) -> Side:
        return Side(self.ids[at], self.label[at], self.vector[at], self.means[at], self.deviations[at])


def _side(table: pa.Table) -> Side:
    numbers = [table.column(c).to_numpy() for c in ("vec_id", "label")]
    return Side(*numbers, *(matrix(table.column(c), np.float64) for c in ("vector", "means", "deviations")))


class Search:
    """The best ``k`` candidates of each anchor in each of its ranges of scores.

    ``low`` and ``high`` have a row for each anchor and a column for each range; a range whose low is
    above its high asks for nothing. Candidates share the anchor's label, or none does.
    """

    def __init__(self, anchors: Side, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.anchors, self.low, self.high, self.k, self.same = anchors, low, high, k, same
        self.scores = np.full((*low.shape, k), EMPTY, dtype=np.int64)
        self.best = np.full((*low.shape, k), EMPTY, dtype=np.int64)
        self.pairs = self.exact = 0

    def run(self, candidates: Side) -> None:
        for row in range(0, len(self.anchors.ids), ROWS):
            for column in range(0, len(candidates.ids), COLUMNS):
                self._chunk(slice(row, row + ROWS), candidates.rows(slice(column, column + COLUMNS)))

    def _open(self, rows: slice, lower: np.ndarray, upper: np.ndarray, at=slice(None)) -> np.ndarray:
        """Pairs whose bounds still meet a range; a tie may win by its smaller id."""
        found = np.zeros(upper.shape, dtype=bool)
        column = lambda x: x[at] if upper.ndim == 1 else x[:, None]
        for p in range(self.low.shape[1]):
            floor = np.maximum(self.low[rows, p], self.scores[rows, p, -1])
            found |= (upper >= column(floor)) & (lower <= column(self.high[rows, p]))
        return found

    def _chunk(self, rows: slice, c: Side) -> None:
        a = self.anchors.rows(rows)
        keep = (a.label[:, None] == c.label[None, :]) == self.same
        keep &= a.ids[:, None] != c.ids[None, :]
        self.pairs += int(keep.sum())
        length = np.outer(*(np.sqrt((s.vector * s.vector).sum(axis=1)) for s in (a, c)))
        slack = 1e-9 * (1 + length)  # the rounding of the bounds
        start, i, j = 0, None, None
        for edges in levels(a.vector.shape[1]):
            n = np.diff(edges)
            part = slice(start, start := start + len(n))
            am, ad, cm, cd = a.means[:, part] * n, a.deviations[:, part] * n, c.means[:, part], c.deviations[:, part]
            if i is None and keep.mean() < SPARSE:
                i, j = np.nonzero(keep)
            if i is None:
                middle, spread = am @ cm.T, ad @ cd.T + slack
                keep &= self._open(rows, middle - spread, middle + spread)
            else:
                middle = np.einsum("ij,ij->i", am[i], cm[j])
                spread = np.einsum("ij,ij->i", ad[i], cd[j]) + slack[i, j]
                left = self._open(rows, middle - spread, middle + spread, i)
                i, j = i[left], j[left]
        top = float(np.abs(a.vector).max(initial=0)) * float(np.abs(c.vector).max(initial=0))
        # Sums of products below 2**53 are whole in double precision, in any order.
        kind = np.float64 if top * a.vector.shape[1] < 2**53 else np.int64
        x, y = a.vector.astype(kind), c.vector.astype(kind)
        if i is None:
            i, j = np.nonzero(keep)
        if len(i) > SPARSE * keep.size:
            score = (x @ y.T)[i, j]
        else:
            score = np.einsum("ij,ij->i", x[i], y[j])
        self.exact += len(i)
        self._take(rows, i, score.astype(np.int64), c.ids[j])

    def _take(self, rows: slice, i: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        for p in range(self.low.shape[1]):
            low, high, worst = self.low[rows, p], self.high[rows, p], self.scores[rows, p, -1]
            hit = (score >= np.maximum(low, worst)[i]) & (score <= high[i])
            if not hit.any():
                continue
            changed = np.unique(i[hit])
            held = np.repeat(changed, self.k)
            best, known = self.best[rows, p], self.scores[rows, p]
            row = np.concatenate([held, i[hit]])
            scores = np.concatenate([known[changed].ravel(), score[hit]])
            found = np.concatenate([best[changed].ravel(), ids[hit]])
            order = np.lexsort((found, ~scores, row))
            row = row[order]
            first = np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1])
            rank = np.arange(len(row)) - np.repeat(first, np.diff([*first, len(row)]))
            taken = rank < self.k
            known[row[taken], rank[taken]] = scores[order][taken]
            best[row[taken], rank[taken]] = found[order][taken]


_OUT = pa.schema([(c, pa.int64()) for c in ("anchor_id", "positive_id", "positive_score", "vec_id", "score")])
_DDL = "anchor_id BIGINT, positive_id BIGINT, positive_score BIGINT, vec_id BIGINT, score BIGINT"


def _block_pair(k: int, same: bool, low: int, high: int):
    def run(table: pa.Table) -> pa.Table:
        asked = table.column("asked").to_numpy(zero_copy_only=False)
        mine, others = table.filter(pa.array(asked)), table.filter(pa.array(~asked))
        if not len(mine) or not len(others):
            return _OUT.empty_table()
        anchors = _side(mine)
        if same:
            positive = np.zeros((len(mine), 1, 2), dtype=np.int64)
            ranges = np.full((len(mine), 1), EMPTY), np.full((len(mine), 1), LARGEST)
        else:
            lists = [[(p["vec_id"], p["score"]) for p in row] for row in mine.column("positives").to_pylist()]
            most = max(map(len, lists))
            positive = np.array([row + [(0, -1)] * (most - len(row)) for row in lists], dtype=np.int64)
            score = positive[:, :, 1]
            # 100 * s from low to high percent of the positive's score, in whole numbers; nothing
            # lies there for a score below 0.
            ranges = -(-low * score // 100), np.where(score < 0, EMPTY, high * score // 100)
        search = Search(anchors, *ranges, k, same)
        search.run(_side(others))
        row, p, rank = np.nonzero(search.best != EMPTY)
        columns = [anchors.ids[row], positive[row, p, 0], positive[row, p, 1]]
        return pa.table([*columns, search.best[row, p, rank], search.scores[row, p, rank]], schema=_OUT)

    return run


def _met(anchors: DataFrame, rows: DataFrame, by: list[str], run) -> DataFrame:
    """Every block of anchors with every block of the rows that agree in ``by``."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = lambda df, size, name: df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / size).alias(name))
    blocks = count(anchors, ANCHOR_BLOCK, "a_blocks").join(count(rows, CANDIDATE_BLOCK, "c_blocks"), by)
    blocks = bounded(written(blocks, "blocks"))
    zero = F.lit(0).cast("bigint")

    def dealt(side: DataFrame, asked: bool) -> DataFrame:
        own = F.pmod(F.xxhash64("vec_id", "vector"), "a_blocks" if asked else "c_blocks")
        other = F.explode(F.sequence(zero, F.col("c_blocks" if asked else "a_blocks") - 1))
        if "positives" not in side.columns:
            side = side.withColumn("positives", F.lit(None).cast("array<struct<vec_id:bigint,score:bigint>>"))
        return (
            side.join(blocks, by)
            .withColumn("a", own if asked else other)
            .withColumn("c", other if asked else own)
            .select(*dict.fromkeys([*by, "a", "c", "label"]), F.lit(asked).alias("asked"), "positives", *DATA)
        )

    return (
        dealt(anchors, True)
        .unionByName(dealt(rows, False))
        .repartition(max(TASKS, partitions), *by, "a", "c")
        .groupBy(*by, "a", "c")
        .applyInArrow(run, _DDL)
    )


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    factor: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows where ``is_anchor`` (over ``vec_id``) holds. A score is the inner product of
    two vectors whose components count as floor(factor * x); it is exact while it stays below 2**56.
    The positives of an anchor are its best ``positives`` rows of the same label and another vec_id;
    the negatives of each positive are the best ``negatives`` rows of other labels that score from
    ``low`` to ``high`` percent of the positive. Ties go to the smaller vec_id, fewer rows give fewer
    results, and ranks start at 1.

    Edge cases: rows with a null vec_id, label or vector, an empty vector, or a null or non-finite
    component take no part. Vectors of different lengths have no score. Equal rows count once; of
    several different rows of one vec_id each is a candidate, and the least by (label, vector) the
    anchor. A positive with a score below 0 has no negatives. Empty tables give empty results. Other
    columns are not read.
    """
    rows = written(summaries(df, vec_id, vector, F.col("label") if label is None else label, factor), "summaries")
    least = F.min(F.struct("label", "vector", "means", "deviations")).alias("r")
    asked = rows.filter(is_anchor).groupBy("vec_id", "dims").agg(least)
    anchors = written(asked.select("vec_id", "dims", "r.*"), "anchors")

    def best(met: DataFrame, k: int, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
        return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    same = _met(anchors, rows, ["dims", "label"], _block_pair(positives, True, low, high))
    first = best(same, positives, "anchor_id")
    # At most ``positives`` entries.
    found = F.collect_list(F.struct("vec_id", "score")).alias("positives")
    lists = first.groupBy(F.col("anchor_id").alias("of")).agg(found).withColumnRenamed("of", "vec_id")
    with_lists = written(anchors.join(lists.hint("merge"), "vec_id"), "positives")
    other = _met(with_lists, rows, ["dims"], _block_pair(negatives, False, low, high))
    return best(other, negatives, "anchor_id", "positive_id", "positive_score").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
