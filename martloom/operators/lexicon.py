"""Valences of tokens looked up inside the row."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lexicon up to this many tokens (and characters) is looked up inside each row.
MAX_INLINE_TOKENS = 20_000
MAX_INLINE_CHARS = 1_000_000
# Buckets per token, so that a look-up compares a token or two.
BUCKETS = 2

Lookup = Callable[[Column], Column]


def entries(lexicon: DataFrame) -> DataFrame:
    """``token`` and its ``_valence`` in whole millionths; a token that repeats has the sum."""
    millionths = F.rint(F.col("valence") * 1_000_000).cast("bigint")
    return lexicon.groupBy("token").agg(F.sum(millionths).alias("_valence"))


def inline_lookup(
    lexicon: DataFrame, most: int | None = None
) -> Lookup | None:
    """The millionths of a token, NULL where it has none, as an expression; or None when the lexicon
    is too large to be part of one.

    Reads at most ``most`` rows of the lexicon and one more. Maps search their keys one by one, so the
    tokens are dealt into buckets by their CRC.
    """
    most = MAX_INLINE_TOKENS if most is None else most
    kept = entries(lexicon).filter("token is not null and _valence is not null")
    rows = kept.limit(most + 1).collect()
    if len(rows) > most or sum(len(r.token) for r in rows) > MAX_INLINE_CHARS:
        return None
    size = max(1, BUCKETS * len(rows))
    buckets: list[dict[str, int]] = [{} for _ in range(size)]
    for r in rows:
        buckets[zlib.crc32(r.token.encode()) % size][r.token] = r._valence
    # Evaluated once, when the plan is made: a literal, of which expressions over tokens may be made.
    table = F.from_json(F.lit(json.dumps(buckets)), "ARRAY<MAP<STRING, BIGINT>>")

    def lookup(token: Column) -> Column:
        place = F.pmod(F.crc32(token), F.lit(size)).cast("int") + 1
        return F.try_element_at(F.element_at(table, place), token)

    return lookup
