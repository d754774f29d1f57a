"""Row numbers that survive a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.lookup import bounded
from martloom.session import written

# A key with more rows than this is numbered in ranges.
HOT_ROWS = 1_000_000
# Rows of a range, about.
RANGE_ROWS = 1_000_000


def _ranged(df: DataFrame, key: str, order: Sequence[str], ranges: int, name: str) -> DataFrame:
    """Number the rows of each key range by range.

    The rows are cut into ranges of (key, order), numbered inside each and shifted by the size of the
    key's earlier ranges. They are stored with their range first, so that both sides of the shift see
    the same cut.
    """
    sorted_by = [F.col(c).asc_nulls_last() for c in (key, *order)]
    cut = df.repartitionByRange(ranges, *sorted_by).withColumn("_range", F.spark_partition_id())
    # A struct key compares its NULL fields as equal, so NULL keys need no case of their own.
    cut = written(cut, "ranges").withColumn("_group", F.struct(F.col(key).alias("k"), "_range"))
    earlier = (
        Window.partitionBy("_group.k")
        .orderBy("_group._range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        cut.groupBy("_group")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_group", F.sum("_n").over(earlier).alias("_before"))
    )
    within = Window.partitionBy("_group").orderBy(*sorted_by[1:])
    return (
        cut.withColumn("_in_range", F.row_number().over(within))
        .join(offsets, "_group")
        .select(*df.columns, (F.col("_in_range") + F.coalesce("_before", F.lit(0))).alias(name))
    )


def row_numbers(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    keys_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    name: str = "row_number",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Number the rows of each key by ``order``, ascending, NULLs last.

    A window on the key alone sorts all rows of a key in one task. Keys with more than ``hot_rows``
    rows, however many there are, are cut into ranges of about ``range_rows`` of their order instead;
    all others take the plain window. Rows that tie in ``order`` stay in one range.

    ``keys_from`` names a cheaper frame with the same keys for each row, used to count; it defaults
    to ``df``.
    """
    counted = df if keys_from is None else keys_from
    sizes = counted.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)
    hot = written(sizes.select(F.struct(F.col(key).alias("k")).alias("_hot"), "_rows"), "hot_keys")
    total = hot.agg(F.sum("_rows")).first()[0]
    plain = F.row_number().over(
        Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    )
    if total is None:
        return df.withColumn(name, plain)
    # Read by both parts and by the sampling of the ranges, and made once.
    keyed = written(df, "unnumbered").withColumn("_hot", F.struct(F.col(key).alias("k")))
    keys = bounded(hot.select("_hot"))
    cool = keyed.join(keys, "_hot", "left_anti").select(*df.columns)
    warm = keyed.join(keys, "_hot", "left_semi").select(*df.columns)
    ranges = max(2, -(-total // range_rows))
    return cool.withColumn(name, plain).unionByName(_ranged(warm, key, order, ranges, name))
