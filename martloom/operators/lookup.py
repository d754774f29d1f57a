"""Lookup sides of joins, broadcast only after their size is checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS = 500_000
MAX_TEXT = 64_000_000


def bounded(df: DataFrame, max_rows: int = MAX_ROWS, max_text: int = MAX_TEXT) -> DataFrame:
    """Mark a lookup side for its join: broadcast within the bounds, sort-merge beyond them.

    The check reads at most ``max_rows + 1`` rows. Naming the strategy either way also keeps Spark
    from broadcasting the other side, whose size it estimates from files that an ``explode``
    multiplies.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    length = F.octet_length(F.concat_ws("", *text)) if text else F.lit(0)
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("t"))
    n, t = size.first()
    if n <= max_rows and (t or 0) <= max_text:
        return F.broadcast(df)
    return df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than the session has cores one partition per core.

    For a scan whose rows are costly to process, such as long texts in one row group. A scan
    that already has splits enough is left as it is. Use on plain scans only.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
