"""Which dictionary names occur in which texts, ignoring case."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.text import WORD, mentions_list, tokens
from martloom.operators.lookup import bounded

# A dictionary up to this many names (and characters) is matched inside each row; a larger one
# goes through the block join.
MAX_INLINE_NAMES = 64
MAX_INLINE_CHARS = 16_384

# Names that are one word of up to this many characters are looked up in the words of the texts, if
# there are no more of them than this (and characters); all others go through the block join.
MAX_WORD_NAME = 64
MAX_WORD_NAMES = 20_000
MAX_WORD_CHARS = 1_000_000
# Words that a task remembers with their names.
REMEMBERED = 200_000
# Names of up to this many characters together are first looked for as one pattern.
MAX_PATTERN_CHARS = 2_048

# Block lengths of the block join. A text is cut into blocks of q characters; any stretch of 2q-1
# characters covers one of them whole, so a name of at least that length is found by one of its
# first q grams. Longer names take longer blocks, each ``STEP`` times the one before, so that a block
# never travels with more than about 2 * STEP blocks that follow it.
BLOCKS = (1, 2, 4, 6)
STEP = 8

# Long texts are cut into pieces of this many characters, or four of the longest names, which
# overlap by the longest name. What a task holds of a text is one piece with its blocks.
PIECE = 8_192


def inline_names(
    names: DataFrame, column: str = "product_name", most: int | None = None
) -> list[str] | None:
    """The dictionary in sorted order, or None when it is too large to match inside each row.

    Reads at most ``most`` (``MAX_INLINE_NAMES``) rows of the dictionary and one more, never the
    texts. Either way of matching gives the same rows.
    """
    most = MAX_INLINE_NAMES if most is None else most
    kept = names.select(column).filter(F.col(column).isNotNull())
    rows = kept.limit(most + 1).collect()
    found = sorted(r[0] for r in rows)
    if len(found) > most or sum(map(len, found)) > MAX_INLINE_CHARS:
        return None
    return found


def _block_lengths(longest: int) -> list[int]:
    """Block lengths for names of up to ``longest`` characters."""
    lengths = list(BLOCKS)
    while 2 * lengths[-1] * STEP - 1 <= longest:
        lengths.append(lengths[-1] * STEP)
    return lengths


def _block_length(name: Column, lengths: list[int]) -> Column:
    """Longest block length that finds a name; 0 for the empty name."""
    n = F.char_length(name)
    length = F.lit(0)
    for q in lengths:
        length = F.when(n >= 2 * q - 1, q).otherwise(length)
    return length


def _pieces(text: Column, size: int, overlap: int) -> Column:
    """The text in overlapping pieces; every stretch of ``overlap + 1`` characters lies in one."""
    last = F.greatest(F.lit(0), F.char_length(text) - overlap - 1)
    starts = F.sequence(F.lit(0), F.floor(last / size).cast("int"))
    return F.transform(starts, lambda k: F.substring(text, k * size + 1, F.lit(size + overlap)))


def _text_blocks(lowered: Column, length: int) -> Column:
    """The text cut into blocks; only the last may be shorter."""
    if length == 0:
        return F.array(F.lit(""))
    return F.regexp_extract_all(lowered, F.lit(f"(?s).{{1,{length}}}"), F.lit(0))


def _with_context(blocks: Column, after: int) -> Column:
    """Each block preceded by the one before it and followed by the next ``after`` blocks."""
    before = F.concat(F.array(F.lit("")), blocks)
    shifted = [F.slice(blocks, F.lit(i + 1), F.size(blocks)) for i in range(after + 1)]
    return F.arrays_zip(before, *shifted)


def _name_grams(names: DataFrame, column: str, lengths: list[int], reach: int) -> DataFrame:
    """(name, gram, head, tail): the first q grams of each name, one per way the blocks can fall
    on it, with what precedes and what follows the gram."""
    lowered = F.lower(column)
    q = _block_length(lowered, lengths)
    starts = F.when(q == 0, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), q))
    cut = names.select(
        F.col(column).alias("name"),
        lowered.alias("lowered"),
        q.alias("q"),
        F.explode(starts).alias("start"),
    )
    return cut.select(
        "name",
        F.expr("substring(lowered, start, q)").alias("gram"),
        F.expr("substring(lowered, 1, start - 1)").alias("head"),
        F.expr(f"substring(lowered, start + q, q * {reach})").alias("tail"),
    )


def _lowered_pieces(texts: DataFrame, key: str, text_column: str, longest_name: int) -> DataFrame:
    """``key`` and ``_piece``; every stretch as long as a name lies in one piece of its text."""
    size = max(PIECE, 4 * longest_name)
    lowered = texts.filter(F.col(text_column).isNotNull()).select(key, F.lower(text_column).alias("_text"))
    return lowered.select(key, F.explode(_pieces(F.col("_text"), size, longest_name)).alias("_piece"))


def _lookup(
    by_name: dict[str, list], value: pa.DataType
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What stands for the names in each list of words, in place of ``_words``, for ``mapInArrow``."""
    lengths = sorted({len(name) for name in by_name})
    # Words without a name are passed over together, where the names make no long pattern.
    some = None if sum(map(len, by_name)) > MAX_PATTERN_CHARS else "|".join(map(re.escape, by_name))

    def numbers(word: str) -> list:
        parts = {word[i : i + n] for n in lengths for i in range(len(word) - n + 1)}
        return [k for part in by_name.keys() & parts for k in by_name[part]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}

        def remembered(word: str) -> list:
            if len(word) > MAX_WORD_NAME:
                return numbers(word)
            if word not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[word] = numbers(word)
            return known[word]

        for batch in batches:
            place = batch.schema.get_field_index("_words")
            words = batch.column(place)
            coded = words.flatten().dictionary_encode()
            distinct, codes = coded.dictionary, coded.indices.to_numpy()
            if some is None:
                asked = np.arange(len(distinct))
            else:
                matched = pc.match_substring_regex(distinct, some)
                asked = np.flatnonzero(matched.to_numpy(zero_copy_only=False))
            of_word = dict(zip(asked.tolist(), map(remembered, distinct.take(pa.array(asked)).to_pylist())))
            named = np.zeros(len(distinct), dtype=bool)
            named[[c for c, found in of_word.items() if found]] = True
            at = np.flatnonzero(named[codes])
            ends = words.value_lengths().to_numpy().cumsum()
            rows: list[set] = [set() for _ in range(len(batch))]
            for row, c in zip(np.searchsorted(ends, at, side="right").tolist(), codes[at].tolist()):
                rows[row].update(of_word[c])
            listed = pa.array([sorted(row) for row in rows], pa.list_(value))
            yield pa.RecordBatch.from_arrays(
                [listed if i == place else c for i, c in enumerate(batch.columns)],
                ["_found" if n == "_words" else n for n in batch.schema.names],
            )

    return run


def _found_in_words(worded: DataFrame, names: list[tuple], numbered: bool = False) -> DataFrame:
    """Rows of ``worded`` that hold names (name or number, lower case), listed as ``_found`` in place of
    ``_words``."""
    value, arrow = (T.IntegerType(), pa.int32()) if numbered else (T.StringType(), pa.string())
    by_name: dict[str, list] = {}
    for k, lowered in names:
        by_name.setdefault(lowered, []).append(k)
    found = T.StructField("_found", T.ArrayType(value))
    schema = T.StructType([found if f.name == "_words" else f for f in worded.schema.fields])
    return worded.mapInArrow(_lookup(by_name, arrow), schema).filter(F.size("_found") > 0)


def with_word_mentions(texts: DataFrame, names: list[tuple[str, str]], text_column: str, out: str) -> DataFrame:
    """``with_mentions`` for names that are one word each, given with their lower case: rows keep all
    their columns, and nothing is exchanged, whatever columns repeat."""
    words = F.array_distinct(tokens(F.col(text_column)))
    worded = texts.filter(F.col(text_column).isNotNull()).withColumn("_words", words)
    return _found_in_words(worded, names).withColumnRenamed("_found", out)


def word_mentions(
    texts: DataFrame, names: list[tuple[str, str]], key: str, text_column: str, name_column: str
) -> DataFrame:
    """``block_mentions`` for names that are one word each, given with their lower case.

    Such a name lies inside a word of the text. The words of a text, each once, are looked up in
    its own task, which remembers the names of the words before; a row a piece of text, the numbers
    of its names, is exchanged.
    """
    spark = texts.sparkSession
    pieces = _lowered_pieces(texts, key, text_column, max(len(lowered) for _, lowered in names))
    words = pieces.select(key, F.array_distinct(F.regexp_extract_all("_piece", F.lit(WORD), F.lit(0))).alias("_words"))
    found = _found_in_words(words, [(k, lowered) for k, (_, lowered) in enumerate(names)], numbered=True)
    # Dealt by the key, so that telling its names apart needs no exchange of its own.
    numbers = found.repartition(key).select(key, F.explode("_found").alias("_number")).distinct()
    numbered = spark.createDataFrame([(k, name) for k, (name, _) in enumerate(names)], f"_number INT, `{name_column}` STRING")
    return numbers.join(F.broadcast(numbered), "_number").select(key, name_column)


def block_mentions(
    texts: DataFrame, names: DataFrame, key: str, text_column: str, name_column: str
) -> DataFrame:
    """Distinct (key, name) for every name that occurs in a text, for dictionaries of any size.

    Names of one word are looked up in the words of the texts (``word_mentions``), the others, and
    those of a dictionary too large for that, in blocks of the texts (``joined_mentions``). Rows that
    share ``key`` count as one.
    """
    distinct, rows, others = split_names(names, name_column)
    if rows is None:
        return joined_mentions(texts, distinct, key, text_column, name_column)
    by_words = word_mentions(texts, rows, key, text_column, name_column)
    if others is None:
        return by_words
    return by_words.unionByName(joined_mentions(texts, others, key, text_column, name_column))


def split_names(
    names: DataFrame, name_column: str
) -> tuple[DataFrame, list[tuple[str, str]] | None, DataFrame | None]:
    """The distinct names; those of one word with their lower case, or None where there are none or too
    many for the tasks to hold; the others, or None where there are none."""
    distinct = names.select(name_column).filter(F.col(name_column).isNotNull()).distinct()
    lowered = F.lower(name_column)
    # Any line end at the end of a name is no part of a word, which $ would overlook.
    is_word = F.rlike(lowered, F.lit(rf"\A{WORD}\z")) & (F.char_length(lowered) <= MAX_WORD_NAME)
    rows = distinct.filter(is_word).select(name_column, lowered.alias("_lowered")).limit(MAX_WORD_NAMES + 1).collect()
    if not rows or len(rows) > MAX_WORD_NAMES or sum(len(r[1]) for r in rows) > MAX_WORD_CHARS:
        return distinct, None, distinct
    others = distinct.filter(~is_word)
    return distinct, [tuple(r) for r in rows], None if others.isEmpty() else others


def joined_mentions(
    texts: DataFrame, distinct: DataFrame, key: str, text_column: str, name_column: str
) -> DataFrame:
    """``block_mentions`` for names of any kind and number, none of them twice or NULL.

    Texts and names meet in an equi-join of text blocks with name grams, so no text is compared
    with every name. Each block brings the characters around it, as many as the longest name of
    its length needs, so the join itself decides whether the name is there: the texts are read
    once and never exchanged.
    """
    lowered_name = F.lower(name_column)
    longest_name = distinct.agg(F.max(F.char_length(lowered_name))).first()[0]
    if longest_name is None:
        return texts.select(key, F.lit(None).cast("string").alias(name_column)).limit(0)
    lengths = _block_lengths(longest_name)
    # At most one row per block length.
    longest = {
        r.q: r.n
        for r in distinct.groupBy(_block_length(lowered_name, lengths).alias("q"))
        .agg(F.max(F.char_length(lowered_name)).alias("n"))
        .collect()
    }
    # Blocks that can follow the first gram of a class's longest name.
    after = {q: -(-(n - q) // q) if q else 0 for q, n in longest.items()}
    reach = max(after.values())
    piece = _lowered_pieces(texts, key, text_column, longest_name)
    cut = piece.select(key, *[_text_blocks(F.col("_piece"), q).alias(f"_{q}") for q in after])
    following = [f"after_{i}" for i in range(reach)]
    windows = F.concat(*[_with_context(F.col(f"_{q}"), reach) for q in after])
    # Compared after the gram has matched, so the following blocks are joined up for hits only.
    rest = F.concat_ws("", *following) if following else F.lit("")
    fits = (
        (F.col("t.gram") == F.col("n.gram"))
        & F.endswith(F.col("before"), F.col("head"))
        & F.startswith(rest, F.col("tail"))
    )
    return (
        cut.select(key, F.inline(windows))
        .toDF(key, "before", "gram", *following)
        .alias("t")
        .join(bounded(_name_grams(distinct, name_column, lengths, reach)).alias("n"), fits)
        .select(key, F.col("name").alias(name_column))
        .distinct()
    )


def row_key(*columns: str) -> Column:
    """A hash of the columns that tells different rows apart, NULLs included."""
    # Each value by its own hash, so that no long text is written as JSON.
    parts = [F.struct(F.sha2(F.col(c).cast("string"), 256).alias("x")) for c in columns]
    return F.sha2(F.to_json(F.array(*parts)), 256)


def with_mentions(texts: DataFrame, names: list[str], text_column: str, out: str) -> DataFrame:
    """Texts naming at least one entry, with the list of names found, in dictionary order."""
    lowered = texts.withColumn("_lowered", F.lower(text_column))
    any_name = reduce(
        lambda a, b: a | b, [F.contains("_lowered", F.lower(F.lit(n))) for n in names], F.lit(False)
    )
    tagged = lowered.filter(any_name).withColumn(out, mentions_list(F.col("_lowered"), names))
    return tagged.drop("_lowered")


def extract_mentions(
    texts: DataFrame,
    names: DataFrame,
    id_column: str = "id",
    text_column: str = "content",
    name_column: str = "product_name",
    most_inline: int | None = None,
) -> DataFrame:
    """One row per row of ``texts`` and distinct name occurring in it, whatever the size of the
    dictionary; ids may repeat or be NULL."""
    distinct = names.select(name_column).distinct()
    inline = inline_names(distinct, name_column, most_inline)
    if inline is None:
        _, rows, others = split_names(distinct, name_column)
        parts = []
        if rows is not None:
            named = with_word_mentions(texts.select(id_column, text_column), rows, text_column, "_names")
            parts.append(named.select(id_column, F.explode("_names").alias(name_column)))
        if others is not None:
            keyed = texts.select(id_column, text_column, row_key(id_column, text_column).alias("_key"))
            found = joined_mentions(keyed, others, "_key", text_column, name_column)
            parts.append(keyed.select("_key", id_column).join(found, "_key").select(id_column, name_column))
        return reduce(DataFrame.unionByName, parts)
    lowered = texts.select(id_column, F.lower(text_column).alias("_lowered"))
    found = mentions_list(F.col("_lowered"), inline)
    # The outer explode and the later filter keep the list from being evaluated twice.
    rows = lowered.select(id_column, F.explode_outer(found).alias(name_column))
    return rows.filter(F.col(name_column).isNotNull())
