"""Exact money arithmetic on integer cents.

Sums stay BIGINT cents, so a result does not depend on the order in which partitions merge;
dollars appear only in the last projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(numerator: Column, denominator: Column) -> Column:
    """BIGINT ``numerator / denominator`` rounded to the nearest integer, halves away from zero.

    NULL where either side is NULL or the (positive) denominator is zero.
    """
    n = F.nullif(denominator.cast("bigint"), F.lit(0).cast("bigint"))
    s = numerator.cast("bigint")
    magnitude = F.call_function("div", 2 * F.abs(s) + n, 2 * n)
    return F.when(s < 0, -magnitude).otherwise(magnitude)


def cents_to_dollars(cents: Column | str, places: int = 2) -> Column:
    """Dollars of an integer cent amount, rounded to ``places`` decimals."""
    c = _col(cents).cast("bigint")
    if places >= 2:
        return c.cast("double") / 100
    step = 10 ** (2 - places)
    return round_half_away(c, F.lit(step)).cast("double") / 10**places


def dollars_to_cents(dollars: Column | str) -> Column:
    """Integer cents of a two-decimal dollar amount."""
    return F.rint(_col(dollars).cast("double") * 100).cast("bigint")


def mean_dollars(total_cents: Column, n: Column) -> Column:
    """``total / n`` in dollars, rounded half away from zero to the cent; NULL when n is 0."""
    return cents_to_dollars(round_half_away(total_cents, n))
