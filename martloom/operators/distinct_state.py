"""Exact distinct counts from stored daily states that merge.

A state holds, for a day, a key and a bucket of 32,768 neighbouring ids, which ids occur: as a list of
their places while they are few, as a bitmap of 4 KB once that is smaller. States of any days merge by
union, so a count over all days reads states only, and a changed day replaces its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Places of a bucket, at two bytes each, above which a bitmap is smaller.
DENSE = 2_048


def daily_sets(
    rows: DataFrame, key: str = "item_id", id_column: str = "id", on: str = "event_date", dense: int = DENSE
) -> DataFrame:
    """``key, bucket, places, bits, on``: the distinct ids of each key and day.

    A NULL id is none, but its key stays, with a bucket that is NULL.
    """
    number = F.col(id_column).cast("bigint")
    placed = rows.select(
        on,
        key,
        F.bitmap_bucket_number(number).alias("bucket"),
        F.bitmap_bit_position(number).cast("smallint").alias("_place"),
    )
    # A bucket has as many places at most as a bitmap has bits. Bitmaps are made of the dense lists only: as an
    # aggregate of all groups, each would carry one of 4 KB.
    listed = placed.groupBy(on, key, "bucket").agg(F.collect_set("_place").alias("places"))
    few = listed.filter(F.size("places") <= dense).select(key, "bucket", "places", F.lit(None).cast("binary").alias("bits"), on)
    many = listed.filter(F.size("places") > dense).select(on, key, "bucket", F.explode("places").alias("_place"))
    bitmaps = many.groupBy(on, key, "bucket").agg(F.bitmap_construct_agg(F.col("_place").cast("bigint")).alias("bits"))
    return few.unionByName(bitmaps.select(key, "bucket", F.lit(None).cast("array<smallint>").alias("places"), "bits", on))


def merged_counts(states: DataFrame, key: str = "item_id", name: str = "num_orders") -> DataFrame:
    """Distinct ids of each key over all the states given.

    Lists and bitmaps meet in words of 64 ids, one bigint each, so nothing wider than that is merged.
    """
    # The bytes of a bitmap's word are read in the order that they are stored in.
    place = F.col("_place").cast("int")
    byte = F.lit(7) - F.floor(F.pmod(place, F.lit(64)) / 8).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), byte * 8 + F.pmod(place, F.lit(8)))
    # The bucket of NULL ids has no places, but its key stays.
    listed = states.filter("bits is null").select(key, "bucket", F.explode_outer("places").alias("_place"))
    listed = listed.select(key, "bucket", F.floor(place / 64).cast("int").alias("_word"), bit.alias("_ids"))
    words = F.regexp_extract_all(F.hex("bits"), F.lit("(.{16})"))
    whole = states.filter("bits is not null").select(key, "bucket", F.posexplode(words).alias("_word", "_hex"))
    whole = whole.select(key, "bucket", "_word", F.conv("_hex", 16, -10).cast("bigint").alias("_ids"))
    merged = listed.unionByName(whole.filter("_ids <> 0")).groupBy(key, "bucket", "_word").agg(F.bit_or("_ids").alias("_ids"))
    return merged.groupBy(key).agg(F.coalesce(F.sum(F.bit_count("_ids")), F.lit(0)).cast("bigint").alias(name))
