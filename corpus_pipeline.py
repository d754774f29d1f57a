"""A training corpus from raw documents, in stages that are each written and read back."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, jaccard, language, line_dedup, mixing
from martloom.llm.queries import MIX_BUDGET, MIX_SEED, MIX_WEIGHTS, TOKENIZER, domain_of
from martloom.operators.lookup import bounded
from martloom.session import configure, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A character that str.split() keeps.
SOLID = r"(?U)[^\s\x1c-\x1f]"


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; ``lang`` becomes the language found.

    The ``lang`` column counts as the declared language, the source as the host. The model is fitted
    on a bounded sample of these labels. A document without letters, or in no known language, goes.
    """
    model = language.fit(docs.select("doc_id", "text", "lang"))
    # Rows are told apart by all that the decision rests on, so repeated rows need no number.
    found = language.identify(
        docs.select("doc_id", "text", "lang", "source"),
        model,
        F.struct("doc_id", "lang", "source", F.xxhash64("text").alias("h")),
        F.col("text"),
        F.col("lang"),
        F.col("source"),
    )
    # Most rows keep their language: only the others are looked up.
    changed = (
        found.filter("not accepted or lang <> key.lang or key.lang is null")
        .groupBy("key")
        .agg(F.first(F.when(F.col("accepted"), F.col("lang"))).alias("_found"))
    )
    changed = written(changed.withColumn("_changed", F.lit(True)), "languages")
    key = F.struct("doc_id", "lang", "source", F.xxhash64("text").alias("h"))
    joined = docs.withColumn("_key", key).join(bounded(changed.withColumnRenamed("key", "_key")), "_key", "left")
    kept = joined.filter("_changed is null or _found is not null")
    return kept.select(*[F.coalesce("_found", "lang").alias(c) if c == "lang" else docs[c] for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines, of any length, that an earlier document or line has; what is left
    without a character other than white space goes."""
    deduped = line_dedup.dedup_lines(docs, shortest=1)
    return _counted(deduped).filter(F.col("text").rlike(SOLID))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by doc_id, of every group of near copies.

    Rows that repeat a doc_id and its text become one; different texts under one doc_id stay or go
    together, as ``jaccard.near_copies`` groups them by their doc_id.
    """
    groups = jaccard.near_copies(docs)
    gone = written(groups.filter("doc_id <> component_id").select("doc_id").distinct(), "copies")
    left = docs.join(bounded(gone), "doc_id", "left_anti").select(*docs.columns)
    # A document that comes in several rows stays in one, but no other text of its doc_id is lost.
    rows = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 and doc_id is not null")
    rows = written(rows.select("doc_id"), "repeated")
    single = left.join(bounded(rows), "doc_id", "left_anti").select(*docs.columns)
    once = left.join(bounded(rows), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(once.select(*docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The target mix; a document comes once for each epoch that takes it."""
    mixed = mixing.mix(docs, MIX_BUDGET, MIX_WEIGHTS, domain_of(docs["source"]), seed=MIX_SEED)
    return _counted(mixed.select(*docs.columns))


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document that is left, checked by decoding them."""
    path = public_tokenizers.path(TOKENIZER)
    texts = docs.select("doc_id", "lang", "source", "text")
    # One worker for both ways, so that no second one holds memory through the other stages.
    return bpe.encode(texts, path, decoded="decoded", remember=False).select(
        "doc_id",
        "lang",
        "source",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        "token_ids",
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def _configured(stage: Stage) -> Stage:
    """The stage with the scale settings, also where it is run by itself."""
    return lambda spark, docs, sf_dir: stage(configure(spark), docs, sf_dir)


STAGES: list[tuple[str, Stage]] = [
    (stage.__name__, _configured(stage)) for stage in (languages, lines, near_copies, mixture, tokens)
]
# Trained models, joins of texts and seeded epochs are beyond SQL; tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
