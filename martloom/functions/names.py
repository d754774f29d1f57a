"""Quoted model names and run timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted_parts(name: Column) -> Column:
    """All double-quoted identifiers in a qualified model name."""
    return F.regexp_extract_all(name, F.lit('"([^"]+)"'), F.lit(1))


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_ms_to_utc(ms: Column) -> Column:
    """Zone-less UTC timestamp of epoch milliseconds, whatever the session zone."""
    seconds = ms.cast("decimal(18,0)") / F.lit(1000).cast("decimal(5,0)")
    return _epoch() + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def utc_to_epoch_ms(at: Column) -> Column:
    """Epoch milliseconds of a zone-less UTC timestamp, whatever the session zone."""
    return F.timestamp_diff("MILLISECOND", _epoch(), at)


def materialised_label(ms: Column) -> Column:
    """Readable last run, or a fixed text when there was none."""
    text = F.concat(F.date_format(epoch_ms_to_utc(ms), "yyyy-MM-dd HH:mm:ss"), F.lit(" (UTC)"))
    return F.coalesce(text, F.lit("never materialized"))
