"""Homomorphic fingerprints of documents, as sums of wide vectors hashed from their paragraphs.

A paragraph, what stands between two line feeds, becomes a vector of ``WIDTH`` lanes, and a text the
sum of its paragraphs' vectors, lane by lane modulo 2**32. So the order of paragraphs does not matter,
and a paragraph is put in or taken out by adding or subtracting its vector, without the other text:
``plus`` and ``minus``. The lanes are

* ``EXACT`` lanes, the 32-bit halves of four hashes of the whole paragraph: sums agree for equal
  multisets of paragraphs, and for different ones with a chance of 2**-256;
* one lane that counts the paragraph's features, its pairs of neighbouring words (the last word stands
  alone);
* ``BITS`` lanes that count, for each bit of a hash of the feature, how many features have it set.

Of the last, 2 * count - features is a sum of random signs, so the cosine of two texts' signs
estimates that of their features, within about 1 / sqrt(BITS): ``likeness``.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import written

EXACT = 8
BITS = 128
WIDTH = EXACT + 1 + BITS
# Paragraphs above this many characters are cut into pieces for their features, so that a task holds
# the words of one piece at a time.
PIECE = 8_192

# Ranges of doc_id for each partition of an exchange, so that ranges dealt by hash fill them evenly.
RANGES = 32

_LOW = 0xFFFFFFFF
# A bit for each of the two counts that share a bigint.
_PAIR = 0x0000000100000001


def _step(df: DataFrame, name: str) -> DataFrame:
    """``written``, and the shuffle files of the jobs so far given back.

    Spark deletes a shuffle's files once the driver has collected its plan, which a driver with memory
    to spare may not do before the query ends; the texts exchanged would lie there until then.
    """
    df = written(df, name)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df


def _halves(x: Column) -> list[Column]:
    return [x.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(x, 32)]


def paragraph_sums(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``lanes``: the sum over all paragraphs of the rows of each key.

    A null text counts as the empty text, which is one blank paragraph. Sums combine before the
    exchange, and need none where ``texts`` are dealt by some of the keys.
    """
    paragraph = F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))
    paragraphs = texts.select(*keys, paragraph.alias("_p"))
    long = F.regexp_extract_all("_p", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    pieces = F.when(F.char_length("_p") <= PIECE, F.array("_p")).otherwise(long)
    cut = paragraphs.select(*keys, "_p", F.posexplode(pieces).alias("_piece", "_text"))
    cut = cut.withColumn("_words", F.array_remove(F.split("_text", r"\s+"), ""))
    after = F.slice("_words", F.lit(2), F.size("_words"))
    pairs = F.arrays_zip(F.col("_words").alias("a"), after.alias("b"))
    found = cut.select(*keys, "_p", "_piece", F.posexplode_outer(pairs).alias("_place", "_pair"))
    first = (F.col("_piece") == 0) & (F.coalesce(F.col("_place"), F.lit(0)) == 0)
    hashes = [F.when(first, F.xxhash64(F.lit(k), F.col("_p"))) for k in range(EXACT // 2)]
    found = found.select(
        *keys,
        *[h.alias(f"_h{k}") for k, h in enumerate(hashes)],
        F.when(F.col("_pair").isNotNull(), F.xxhash64("_pair.a", "_pair.b")).alias("_x"),
    ).withColumn("_y", F.when(F.col("_x").isNotNull(), F.xxhash64("_x")))
    # Bits k and k + 32 of a hash are counted by one sum; no half can carry below 2**31 features.
    counts = {
        f"_{c}{k}": F.sum(F.shiftrightunsigned(c, k).bitwiseAND(F.lit(_PAIR)))
        for c in ("_x", "_y")
        for k in range(32)
    }
    exact = {f"_e{k}{i}": F.sum(half) for k in range(EXACT // 2) for i, half in enumerate(_halves(F.col(f"_h{k}")))}
    summed = found.groupBy(*keys).agg(
        *[c.alias(name) for name, c in exact.items()],
        F.count("_x").alias("_n"),
        *[c.alias(name) for name, c in counts.items()],
    )
    zero = F.lit(0).cast("bigint")
    lanes = [F.col(c).bitwiseAND(F.lit(_LOW)) for c in exact]
    lanes.append(F.col("_n").bitwiseAND(F.lit(_LOW)))
    lanes += [half for c in counts for half in _halves(F.coalesce(F.col(c), zero))]
    return summed.select(*keys, F.array(*lanes).alias("lanes"))


def nothing() -> Column:
    """The sum of no paragraphs, which even the empty text has one of."""
    return F.array_repeat(F.lit(0).cast("bigint"), WIDTH)


def plus(a: Column, b: Column) -> Column:
    """The fingerprint with the paragraphs of both."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(_LOW)))


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the paragraphs of ``b``, which must be among them."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(_LOW)))


def as_text(lanes: Column) -> Column:
    """Eight hexadecimal digits a lane."""
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def _signs(lanes: Column) -> Column:
    n = F.element_at(lanes, EXACT + 1)
    return F.transform(F.slice(lanes, EXACT + 2, BITS), lambda c: (c * 2 - n).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the estimated cosine of their features, in [0, 1]; 0 where one
    has no words, or is null."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    x, y = _signs(a), _signs(b)
    cosine = F.try_divide(dot(x, y), F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))
    # Null, without a norm, is passed over by least and greatest.
    inside = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(cosine, F.lit(0.0))))
    return F.when(a == b, F.lit(1.0)).otherwise(inside)


def _range_of(starts: list[int]):
    """Rows with ``range``, the number of the last start up to their doc_id; rows without doc_id are dealt
    by their text into ranges below 0, of which none follows another."""
    # Large ids that are one double fall into one range.
    inner = sorted({float(s) for s in starts})[1:]

    def run(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("range", F.lit(0.0))
        if inner:
            rows = rows.drop("range").withColumn("_id", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)))
            splits = [-math.inf, *inner, math.inf]
            rows = Bucketizer(splits=splits, inputCol="_id", outputCol="range").transform(rows).drop("_id")
        without = -1 - F.pmod("h", F.lit(len(inner) + 1))
        return rows.withColumn("range", F.when(F.col("doc_id").isNull(), without).otherwise(F.col("range")).cast("int"))

    return run, len(inner) + 1


def _in_ranges(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``rows`` (doc_id, text, h) with ``range``, and ``range, edge``: the text that follows the last of each
    range, which is that of the first document of the next, and after the last range of the first;
    and the number of ranges.

    Ranges of doc_id hold about as many ids each; of a range, its first id goes to the driver.
    """
    spark = rows.sparkSession
    partitions = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "1")),
    )
    units = _step(rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("h").alias("h")), "units")
    dealt = units.select("doc_id").repartitionByRange(RANGES * partitions, "doc_id")
    starts = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.min("doc_id").alias("start"))
    starts = _step(starts, "ranges").select("start").collect()  # a row a range
    ranged, n = _range_of([r.start for r in starts])
    first = ranged(units).groupBy("range").agg(F.min(F.struct("doc_id", "h")).alias("key"))
    first = first.select(F.pmod(F.col("range") - 1, F.lit(n)).alias("range"), "key.*")
    edges = rows.join(F.broadcast(first), ["doc_id", "h"])  # a row a range
    edges = _step(edges.groupBy("range").agg(F.first("text").alias("edge")), "edges")
    return ranged(rows), edges, n


def near_edits(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, lanes, edited_lanes, near_edited, near_next`` of every row.

    The edited text is the text whose last quarter, floor(n_chars / 4) code points, is replaced by the
    first as many (or all) of the next document, that of the next larger ``doc_id``; after the last
    comes the first. Its fingerprint comes from the text's own: the paragraphs from the edit on are
    taken out, the new ones put in. ``near_edited`` and ``near_next`` are the likenesses of the text's
    fingerprint to the edited text's and to the next document's.

    Edge cases: a null text counts as empty. A row without doc_id follows no other and has no next:
    what is taken out is replaced by nothing, and near_next is 0. Where one doc_id comes with several
    texts, each is edited, and one of them, by least hash, is the next of the document before. Repeated
    rows give repeated results. Texts and paragraphs of any length count whole. An empty table gives
    an empty result; other columns are not read.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), content.alias("text"))
    # Nullable, as it is when read back: a cast of a key would cost an exchange.
    rows = rows.withColumn("h", F.when(F.col("text").isNotNull(), F.xxhash64("text")))
    rows, edges, n_ranges = _in_ranges(rows)
    # Texts are exchanged once, by range; what follows stays in their tasks.
    order = Window.partitionBy("range").orderBy(F.desc("doc_id"), F.desc("h"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    same_id, same_h = (F.lag(c).over(order).eqNullSafe(F.col(c)) for c in ("doc_id", "h"))
    number = F.row_number().over(order)
    once = (
        rows.withColumns({"_n": number, "_all": F.count(F.lit(1)).over(whole), "_again": same_id & same_h})
        .filter((F.col("_n") == 1) | ~F.col("_again"))
        .withColumns({"copies": F.coalesce(F.lead("_n").over(order), F.col("_all") + 1) - F.col("_n"), "_id": F.lead("doc_id").over(order)})
        # The least hash of a doc_id is the last of it, and that of the first doc_id the last of all.
        .withColumn("is_next", F.col("doc_id").isNotNull() & ~F.col("_id").eqNullSafe(F.col("doc_id")))
        .withColumn("is_start", F.col("doc_id").isNotNull() & F.col("_id").isNull())
        .withColumn("after", F.last(F.when(F.col("is_next"), F.col("text")), True).over(before))
    )
    edited = (
        once.join(edges.hint("merge"), "range", "left")
        .withColumn("n_chars", F.char_length("text"))
        .withColumn("cut", F.floor(F.col("n_chars") / 4).cast("int"))
        .withColumn("kept", F.expr("substring(text, 1, n_chars - cut)"))
        .withColumn("head", F.expr("substring(coalesce(after, edge), 1, cut)"))
        .withColumn("edited", F.concat("kept", F.coalesce("head", F.lit(""))))
    )
    # Paragraphs before the one that the edit begins in stay as they are.
    same = F.char_length("kept") - F.char_length(F.substring_index("kept", "\n", -1))
    sides = (
        "if(same > 0, substring(text, 1, same - 1), null)",
        "substring(text, same + 1)",
        "substring(edited, same + 1)",
    )
    row = F.struct(
        "doc_id",
        "h",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("copies").cast("bigint").alias("copies"),
        "is_next",
        "is_start",
    )
    from_edit = edited.withColumn("same", same).select(
        "range", row.alias("row"), F.posexplode(F.array(*map(F.expr, sides))).alias("side", "part")
    )
    parts = paragraph_sums(from_edit.filter("part is not null"), ["range", "row", "side"], "part")
    # Three sums at most: what stays, goes and comes.
    sums = parts.groupBy("range", "row").agg(F.map_from_entries(F.collect_list(F.struct("side", "lanes"))).alias("m"))
    side = lambda k: F.coalesce(F.try_element_at("m", F.lit(k)), nothing())
    sums = sums.select("range", "row.*", plus(side(0), side(1)).alias("lanes"), side(1).alias("out"), side(2).alias("new"))
    sums = sums.withColumn("edited_lanes", plus(minus(F.col("lanes"), F.col("out")), F.col("new"))).drop("out", "new")
    next_lanes = F.last(F.when(F.col("is_next"), F.col("lanes")), True).over(before)
    sums = sums.withColumn("next_lanes", next_lanes).withColumn(
        "near_next",
        F.when(F.col("doc_id").isNull(), F.lit(0.0))
        .when(F.col("next_lanes").isNotNull(), likeness(F.col("lanes"), F.col("next_lanes"))),
    )
    sums = _step(sums.drop("next_lanes", "h", "is_next"), "fingerprints")
    # The last of a range, whose near_next is open yet, is followed by the first of the next.
    first = sums.filter("is_start").select(
        F.pmod(F.col("range") - 1, F.lit(n_ranges)).alias("range"), F.col("lanes").alias("next_lanes")
    )
    return (
        sums.join(F.broadcast(first), "range", "left")  # a row a range
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            "lanes",
            "edited_lanes",
            likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
            F.coalesce("near_next", likeness(F.col("lanes"), F.col("next_lanes"))).alias("near_next"),
        )
    )
