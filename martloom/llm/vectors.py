"""Near-duplicate vectors by cosine, over quantised tiles.

Vectors of one label are dealt into tiles of about ``TILE`` and every pair of tiles of a label meets
once, in a task of its own; the number of tiles grows with the label, so no label is held by one task.
A unit vector u is rounded to int8 once, û = q / s, and carries e = |u - û|. For two of them

    u.v <= û.v̂ + |û| e_v + e_u        (as u.v - û.v̂ = û.(v - v̂) + (u - û).v and |v| = 1)

so a tile product of the int8 rows, exact in float32, bounds all cosines of a tile pair. Only pairs
whose bound reaches the threshold are computed again from the full vectors in double precision.
A tile pair returns counts of links and, instead of its links, a star of each of its components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.components import components
from martloom.operators.lookup import bounded
from martloom.session import written

THRESHOLD = 0.93
TILE = 2048
# Pairs computed again at a time.
CHUNK = 1 << 16
# Covers the rounding of the bounds themselves, which are computed in double precision.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector is there and has finite components only."""
    top = F.lit(float("inf"))
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < top)), F.lit(False)
    )


def matrix(column: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    """The rows of a list column of equal lengths and without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1)


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, the step that turns them back into unit vectors, and the error bound of each."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest  # first, so that no square overflows or vanishes
    unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    step = np.abs(unit).max(axis=1) / 127
    rounded = np.rint(unit / step[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - rounded * step[:, None], axis=1)
    return rounded, step, error


def _quantised(classes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            # Vectors of one batch may differ in length.
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                q, step, error = quantise(matrix(part.column("vector"), np.float64))
                codes = pa.array([row.tobytes() for row in q], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, codes, pa.array(step), pa.array(error)],
                    [*part.schema.names, "codes", "step", "error"],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(run, f"{fields}, codes BINARY, step DOUBLE, error DOUBLE")


def _candidates(left: dict, right: dict, threshold: float):
    """Index pairs whose bound reaches the threshold."""
    reach = left["step"] * np.linalg.norm(left["codes"], axis=1)  # |û|
    dims = left["codes"].shape[1]
    exact = np.float32 if dims * 127 * 127 < 1 << 24 else np.float64
    codes = right["codes"].astype(exact).T
    for start in range(0, len(reach), 512):
        rows = slice(start, start + 512)
        bound = (left["codes"][rows].astype(exact) @ codes).astype(np.float64)
        bound *= left["step"][rows, None] * right["step"][None, :]
        bound += reach[rows, None] * right["error"][None, :] + left["error"][rows, None]
        i, j = np.nonzero(bound >= threshold - SLACK)
        yield i + start, j


def _linked(left: dict, right: dict, same: bool, threshold: float):
    """Index pairs with a cosine of at least the threshold, each once."""
    for i, j in _candidates(left, right, threshold):
        if same:
            i, j = i[i < j], j[i < j]
        for start in range(0, len(i), CHUNK):
            a, b = i[start : start + CHUNK], j[start : start + CHUNK]
            cosine = np.einsum("ij,ij->i", left["vector"][a], right["vector"][b])
            hit = cosine / (left["norm"][a] * right["norm"][b]) >= threshold
            yield a[hit], b[hit]


def _side(table: pa.Table, dims: int) -> dict:
    vector = matrix(table.column("vector"), np.float64)
    vector /= np.abs(vector).max(axis=1, keepdims=True)  # a cosine does not depend on the lengths
    codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), dtype=np.int8)
    return {
        "node": table.column("node").to_numpy(),
        "copies": table.column("copies").to_numpy(),
        "step": table.column("step").to_numpy(),
        "error": table.column("error").to_numpy(),
        "codes": codes.reshape(-1, dims),
        "vector": vector,
        "norm": np.sqrt(np.einsum("ij,ij->i", vector, vector)),
    }


_OUT = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("tied_to", pa.int64())])


def _tile_pair(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        dims = table.column("dims")[0].as_py()
        first = table.column("first").to_numpy(zero_copy_only=False)
        left = _side(table.filter(pa.array(first)), dims)
        same = table.column("i")[0] == table.column("j")[0]
        right = left if same else _side(table.filter(pa.array(~first)), dims)
        m = len(left["node"])
        node = left["node"] if same else np.concatenate([left["node"], right["node"]])
        count = np.zeros(len(node), dtype=np.int64)
        found = []
        for a, b in _linked(left, right, same, threshold):
            np.add.at(count, a, right["copies"][b])
            np.add.at(count, b + (0 if same else m), left["copies"][a])
            found.append((a, b + (0 if same else m)))
        least = node.copy()
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            while True:  # the smallest node of each component of this tile pair
                before = least.copy()
                np.minimum.at(least, a, least[b])
                np.minimum.at(least, b, least[a])
                if np.array_equal(before, least):
                    break
        hit = count > 0
        return pa.table([node[hit], count[hit], least[hit]], schema=_OUT)

    return run


def near_duplicates(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Vectors of one label (not null) and one length link when their cosine in double precision is
    at least ``threshold``. ``n_links`` counts the other vectors linked directly, equal vectors
    included; ``component_id`` is the smallest vec_id that links reach; ``kept`` marks that vector.

    Edge cases: vectors that are null, empty or zero, or that hold a null or non-finite component,
    and those of a null label, link with nothing: no links, their own component, kept. Repeated rows
    count as vectors of their own, each with a result. A row without vec_id links as any other; alone
    it has a null component and is kept. An empty table gives an empty result. Other columns are not
    read.
    """
    rows = df.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(label).alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    fit = usable(F.col("vector")) & F.exists("vector", lambda x: x != 0) & F.col("label").isNotNull()
    rows = rows.withColumn("fit", F.coalesce(fit, F.lit(False)))
    # Equal vectors are one class, whose copies are counted instead of compared.
    classes = written(
        rows.filter("fit")
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
        .withColumn("dims", F.size("vector")),
        "vectors",
    )
    tiles = classes.groupBy("label", "dims").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"))
    tiles = written(tiles, "tiles")
    # A class without any vec_id still counts for others, under a number no vec_id has taken part in.
    own = F.coalesce("node", F.lit(-(2**62)) - F.abs(F.xxhash64("label", "vector") % 2**61))
    dealt = (
        _quantised(classes.withColumn("node", own))
        .join(bounded(tiles), ["label", "dims"])
        .withColumn("tile", F.pmod(F.xxhash64("node"), "tiles"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1))
    met = (
        dealt.withColumn("other", other)
        .select(
            "label",
            "dims",
            F.least("tile", "other").alias("i"),
            F.greatest("tile", "other").alias("j"),
            (F.col("tile") <= F.col("other")).alias("first"),
            *("node", "copies", "vector", "codes", "step", "error"),
        )
        .groupBy("label", "dims", "i", "j")
        .applyInArrow(_tile_pair(threshold), "node BIGINT, n BIGINT, tied_to BIGINT")
    )
    met = written(met, "tile_links")
    found = components(met.select(F.col("node").alias("a"), F.col("tied_to").alias("b")))
    of_class = (
        classes.withColumn("own", own)
        .join(met.groupBy(F.col("node").alias("own")).agg(F.sum("n").alias("n")), "own", "left")
        .join(found.withColumnRenamed("node", "own"), "own", "left")
        .select(
            "label",
            "vector",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    component = F.coalesce("component", "vec_id")
    return (
        rows.withColumn("key", F.when(F.col("fit"), F.struct("label", "vector")))
        .join(of_class.select(F.struct("label", "vector").alias("key"), "n", "component"), "key", "left")
        .select(
            "vec_id",
            F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
            component.alias("component_id"),
            component.eqNullSafe(F.col("vec_id")).alias("kept"),
        )
    )
