"""Lines that repeat, up to one character, by deletion neighbourhoods.

Lines are compared after their white space is collapsed. Equal lines meet by their hash. Lines one edit
apart meet by their deletion neighbourhood: every string that a line becomes when one character is
left out, as a hashed key. Two lines with equal variants at the same place differ in that character;
a variant that equals a whole line differs from it by an insertion. The edit distance of both is then
verified on the lines themselves, and of each pair the earlier line stays.

Before that, a cheap exact test: of two lines one edit apart, the first or the last half of the
shorter one is whole in both. Only lines that share such a half with another line can have a partner,
and only these emit their neighbourhood. Lines under one key are not paired with each other: each is
held against the earliest, which is within the bound of all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.shingles import mix, power_tables
from martloom.operators.lookup import bounded
from martloom.session import written

# Texts that a task turns into Python strings at a time.
TEXTS = 256

# Lines one edit apart have as many characters at least; of shorter ones an edit makes another line.
MIN_CHARS = 20


def normal(line: str) -> str:
    return " ".join(line.split())


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed)


def halves(line: str) -> list[int]:
    """Keys of the first and last half of a line, as the shorter and as the longer of a pair."""
    keys = []
    for n in (len(line), len(line) - 1):
        keys += [_hash(line[: n // 2], 2 * n), _hash(line[-(n // 2) :], 2 * n + 1)]
    return keys


def neighbourhood(line: str) -> np.ndarray:
    """The hash of the line, then of the line without its k-th character for each k.

    Polynomials modulo 2**64: what stands before and after a character is hashed once for all.
    """
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(codes)
    power, inverse = power_tables(n + 2)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
        without = total[:-1] + (total[-1] - total[1:]) * inverse[1]
        lengths = np.full(n + 1, n - 1, dtype=np.uint64)
        lengths[0] = n
        return mix(np.concatenate([total[-1:], without]) ^ mix(lengths))


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def _sliced(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS):
            yield batch.slice(start, TEXTS)


def _lines(docs: DataFrame, shortest: int) -> DataFrame:
    """``doc_id, line, h, halves`` of every line that takes part; lines below ``MIN_CHARS`` meet equal
    ones only and have no halves."""

    def run(batches):
        for batch in _sliced(batches):
            ids, numbers, hashes, keys, ends = [], [], [], [], [0]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, line in enumerate(text.split("\n")):
                    line = normal(line)
                    if line and len(line) >= shortest:
                        ids.append(doc)
                        numbers.append(k)
                        hashes.append(_hash(line))
                        if len(line) >= MIN_CHARS:
                            keys.extend(halves(line))
                        ends.append(len(keys))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(numbers, pa.int32()),
                    _signed(hashes),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(keys)),
                ],
                ["doc_id", "line", "h", "halves"],
            )

    return docs.mapInArrow(run, "doc_id BIGINT, line INT, h BIGINT, halves ARRAY<BIGINT>")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``h, at, content``: the normal text of the lines ``wanted`` (``h`` and ``at``, their place)."""

    def run(batches):
        for batch in _sliced(batches):
            hs, docs_, lines, texts = [], [], [], []
            for doc, text, places in zip(*(batch.column(i).to_pylist() for i in range(3))):
                split = text.split("\n")
                for place in places:
                    hs.append(place["h"])
                    docs_.append(doc)
                    lines.append(place["line"])
                    texts.append(normal(split[place["line"]]) if place["line"] < len(split) else "")
            yield pa.RecordBatch.from_arrays(
                [pa.array(hs, pa.int64()), pa.array(docs_, pa.int64()), pa.array(lines, pa.int32())]
                + [pa.array(texts, pa.string())],
                ["h", "doc_id", "line", "content"],
            )

    by_doc = wanted.groupBy(F.col("at.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct("h", F.col("at.line").alias("line"))).alias("places")
    )
    found = docs.join(bounded(by_doc), "doc_id").select("doc_id", "text", "places")
    return (
        found.mapInArrow(run, "h BIGINT, doc_id BIGINT, line INT, content STRING")
        .select("h", F.struct("doc_id", "line").alias("at"), "content")
        # A place of a doc_id that comes with several texts: the line that was hashed.
        .dropDuplicates(["h"])
    )


def _neighbourhood(lines: DataFrame) -> DataFrame:
    """``v, k, h, at``: the variants of each line, and the line itself at -1."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                hs, docs, numbers, vs, ks = [], [], [], [], []
                for h, doc, line, content in zip(*(part.column(i).to_pylist() for i in range(4))):
                    found = neighbourhood(content)
                    n = len(found)
                    vs.append(found.view(np.int64))
                    ks.append(np.arange(-1, n - 1, dtype=np.int32))
                    hs.append(np.full(n, h, dtype=np.int64))
                    docs.append(np.full(n, doc, dtype=np.int64))
                    numbers.append(np.full(n, line, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (vs, ks, hs, docs, numbers)],
                    ["v", "k", "h", "doc_id", "line"],
                )

    rows = lines.select("h", "at.doc_id", "at.line", "content").mapInArrow(
        run, "v BIGINT, k INT, h BIGINT, doc_id BIGINT, line INT"
    )
    return rows.select("v", "k", "h", F.struct("doc_id", "line").alias("at"))


def _near(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """``h`` of the distinct lines that lie within one edit of an earlier line."""
    keys = distinct.select("h", F.explode(F.array_distinct("halves")).alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    survivors = keys.join(shared, "key", "left_semi").select("h").distinct()
    places = distinct.select("h", "at").join(survivors, "h", "left_semi")
    lines = written(_texts_of(docs, written(places, "line_places")), "lines")
    around = written(_neighbourhood(lines), "variants")
    shortened, whole = around.filter("k >= 0"), around.filter("k < 0")
    first = F.min(F.struct("at", "h"))
    earliest = shortened.groupBy("v", "k").agg(first.alias("by"), F.count(F.lit(1)).alias("n"))
    changed = (
        shortened.join(earliest.filter("n > 1"), ["v", "k"])
        .filter(F.col("by.at") < F.col("at"))
        .select(F.col("h").alias("later"), F.col("h").alias("a"), F.col("by.h").alias("b"), "k")
    )
    longer = shortened.join(whole.select("v", F.col("h").alias("b"), F.col("at").alias("b_at")), "v")
    inserted = longer.select(
        F.when(F.col("at") < F.col("b_at"), F.col("b")).otherwise(F.col("h")).alias("later"),
        F.col("h").alias("a"),
        "b",
        "k",
    )
    pairs = changed.withColumn("both", F.lit(True)).unionByName(inserted.withColumn("both", F.lit(False)))
    pairs = pairs.groupBy("later", "a", "b", "both").agg(F.min("k").alias("k"))
    text = lambda name: lines.select(F.col("h").alias(name), F.col("content").alias(name + "_text"))
    # One edit at a known place: the texts are equal without the character there. (A general edit
    # distance takes the square of the length.)
    without = lambda c: F.concat(F.expr(f"substring({c}, 1, k)"), F.expr(f"substring({c}, k + 2)"))
    other = F.when(F.col("both"), without("b_text")).otherwise(F.col("b_text"))
    return (
        pairs.join(text("a"), "a")
        .join(text("b"), "b")
        .filter(without("a_text") == other)
        .select(F.col("later").alias("h"))
        .distinct()
    )


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = MIN_CHARS
) -> DataFrame:
    """``doc_id`` and ``line`` (from 0) of every line that an earlier one repeats.

    Lines end at line feeds. A line repeats when, white space collapsed, an earlier line, by
    (doc_id, line), is equal, or both have 20 characters or more and are one inserted, left out or
    changed character apart, whether or not that line is itself a repetition. Lines below ``shortest``
    characters take no part; at 1 every line does that is not blank.

    Edge cases: rows without doc_id or text have no lines. Repeated rows hold the same lines at the
    same places, which do not repeat themselves; of a doc_id with several texts, equal places count
    as one. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.filter("doc_id is not null and text is not null")
    places = written(_lines(rows, shortest), "line_keys")
    at = F.struct("doc_id", "line")
    distinct = places.groupBy("h").agg(F.min(at).alias("at"), F.min_by("halves", at).alias("halves"))
    distinct = written(distinct, "distinct_lines")
    near = written(_near(rows, distinct), "near_lines").withColumn("near", F.lit(True))
    gone = distinct.select("h", "at").join(near, "h", "left")
    return (
        places.select("doc_id", "line", "h")
        .join(gone, "h")
        .filter(F.coalesce("near", F.lit(False)) | (F.struct("doc_id", "line") != F.col("at")))
        .select("doc_id", "line")
        .distinct()
    )


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = MIN_CHARS
) -> DataFrame:
    """``docs`` without repeated lines: all rows and columns, ``text`` with its other lines as they
    were. A null text stays null, and a text without repeated lines is not touched; a text of
    repeated lines only becomes empty."""
    gone = repeated_lines(docs, doc_id, text, shortest)
    by_doc = gone.groupBy(F.col("doc_id").alias("__gone_id")).agg(F.collect_list("line").alias("__gone"))
    lines = F.split(F.col(text), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__gone")
    left = F.array_join(F.transform(kept, lambda k: F.element_at(lines, k + 1)), "\n")
    joined = docs.join(by_doc, docs[doc_id].cast("bigint") == F.col("__gone_id"), "left")
    columns = [
        F.when(F.col("__gone").isNull(), docs[c]).otherwise(left).alias(c) if c == text else docs[c]
        for c in docs.columns
    ]
    return joined.select(*columns)
