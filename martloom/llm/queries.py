"""One query for each operator, over its whole table, and the SQL twins of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import (
    align,
    bpe,
    chat,
    fingerprint,
    jaccard,
    language,
    line_dedup,
    mixing,
    negatives,
    resharding,
    topk,
    toxicity,
    vectors,
)

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

# The mix of the corpus: sources fall into four domains; weights by domain and by language.
DOMAINS = 4
MIX_WEIGHTS = {
    **{(f"domain{d}",): w for d, w in enumerate((4.0, 3.0, 2.0, 1.0))},
    **{
        (f"domain{d}", lang): w
        for d in range(DOMAINS)
        for lang, w in (("en", 5.0), ("de", 2.0), ("fr", 2.0), ("es", 1.0))
    },
}
MIX_BUDGET = 0.8
MIX_SEED = 7

OLD_SHARDS = 32
NEW_SHARDS = 40


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    texts = _table(spark, folder, "documents").select("doc_id", "text")
    encoded = bpe.encode(texts, path).drop("text")
    decoded = bpe.decode(encoded, path)
    return decoded.select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def domain_of(source) -> Column:
    """The domain that a source belongs to."""
    return F.concat(F.lit("domain"), F.pmod(F.crc32(F.coalesce(source, F.lit(""))), F.lit(DOMAINS)).cast("string"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    mixed = mixing.mix(docs, MIX_BUDGET, MIX_WEIGHTS, domain_of(docs["source"]), seed=MIX_SEED)
    return mixed.select(
        "doc_id",
        domain_of(F.col("source")).alias("domain"),
        "lang",
        "source",
        "epoch",
        "n_tokens",
        F.octet_length("text").cast("bigint").alias("bytes"),
    )


def page_language(pages: DataFrame, model: language.Model) -> DataFrame:
    """Languages of web pages, from their text, their markup, their address and their host."""
    markup = F.regexp_extract("html", r"(?i)<html[^>]*\slang=[\"']?([A-Za-z-]+)", 1)
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.regexp_extract("url", r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)
    folder = F.regexp_extract("url", r"^[^:]*://[^/]+/([A-Za-z]{2})(?:/|$)", 1)
    label = F.when(F.lower(folder).isin(*language.SUFFIXES), folder)
    suffix = F.coalesce(label, F.substring_index(host, ".", -1))
    return language.identify(pages, model, F.col("page_id"), bare, markup, host, suffix)


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    model = language.fit(_table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return page_language(_table(spark, folder, "pages"), model).withColumnRenamed("key", "page_id")


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_copies(_table(spark, folder, "documents"))


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.link_turns(_table(spark, folder, "conversations"))


def op6_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_resharding(spark: SparkSession, folder: str) -> DataFrame:
    """From 32 shards, the last of which holds a third of the rows, to 40 of near equal bytes."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    old = F.least(F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS * 3 // 2)), F.lit(OLD_SHARDS - 1))
    placed, _ = resharding.reshard(docs, old, NEW_SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are kept for testing."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(docs, _table(spark, folder, "labels"), ~held_out())
    return toxicity.score(docs, lexicon).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted"
    )


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", F.col("text").alias("whole"), "text")
    lines = lambda c: F.when(c == "", 0).otherwise(F.size(F.split(c, "\n", -1)))
    return line_dedup.dedup_lines(docs, shortest=1).select(
        "doc_id",
        lines(F.col("whole")).alias("n_lines"),
        F.when(F.col("text") == F.col("whole"), lines(F.col("whole")))
        .otherwise(lines(F.col("text")))
        .alias("n_kept"),
        "text",
    )


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, folder, "embeddings"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are every fiftieth vec_id; every seventh carries the label after its own. Edge cases
    are those of ``negatives.hard_negatives``."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    embeddings = _table(spark, folder, "embeddings")
    return negatives.hard_negatives(embeddings, F.col("vec_id") % 50 == 0, label)


def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and its edited text; all edge cases are those of ``fingerprint.near_edits``."""
    near = fingerprint.near_edits(_table(spark, folder, "documents"))
    return near.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint.as_text(F.col("lanes")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_lanes")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document by both tokenizers; edge cases are those of ``align.align``."""
    paths = map(public_tokenizers.path, (TOKENIZER, PIECES))
    return align.align(_table(spark, folder, "documents"), *paths)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_mixing": op2_mixing,
    "op3_language": op3_language,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_chat": op5_chat,
    "op6_topk": op6_topk,
    "op7_resharding": op7_resharding,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_fingerprints": op12_fingerprints,
    "op13_alignment": op13_alignment,
}
ORACLES: dict[str, str] = {
    "op4_ngram_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + 4], ' '), least(len(w), 5)) AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
                  FROM words WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
            GROUP BY x.doc_id, y.doc_id),
        links AS (
            SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM documents d JOIN least ON a = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
    """,
    "op5_chat": r"""
        WITH quoted AS (
            SELECT conv_id, turn, role, conv_id || ':' || turn AS id,
                   coalesce(CAST(to_json(text) AS VARCHAR), 'null') AS q FROM conversations),
        calls AS (SELECT * FROM quoted WHERE role = 'user'),
        answers AS (SELECT conv_id || ':' || (turn - 1) AS id, q FROM quoted WHERE role = 'assistant')
        SELECT coalesce(c.id, a.id) AS call_id, c.conv_id, c.turn,
            CASE WHEN c.id IS NOT NULL THEN 0 END AS wave,
            CASE WHEN c.id IS NULL THEN 'no_call' WHEN c.q = 'null' THEN 'missing_argument'
                 WHEN a.id IS NULL THEN 'no_result' ELSE 'ok' END AS status,
            '{' || CASE WHEN c.id IS NULL THEN '' ELSE
                '"after":[' || coalesce('"' || p.id || '"', '') || '],"arguments":{"prompt":' || c.q
                || ',"turn":' || c.turn || '},' END
            || '"id":"' || coalesce(c.id, a.id) || '"'
            || CASE WHEN c.id IS NULL THEN '' ELSE ',"name":"reply"' END
            || CASE WHEN a.id IS NULL THEN '' ELSE ',"result":' || a.q END || '}' AS json
        FROM calls c FULL JOIN answers a ON c.id = a.id
        LEFT JOIN calls p ON p.conv_id = c.conv_id AND p.turn = c.turn - 2
    """,
    "op6_topk": """
        WITH whole AS (
            SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND NOT list_contains([coalesce(isfinite(x), false) FOR x IN embedding], false)),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY rank <= 5
    """,
    "op10_embedding_dedup": """
        WITH RECURSIVE fit AS (
            SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND NOT list_contains([coalesce(isfinite(x), false) FOR x IN embedding], false)
              AND list_contains([x <> 0 FOR x IN embedding], true)),
        links AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM fit x JOIN fit y
            ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
            WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
        reach AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings e JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id
    """,
    "op11_hard_negatives": """
        WITH whole AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND label IS NOT NULL
              AND NOT list_contains([coalesce(isfinite(x), false) FOR x IN embedding], false)),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
            FROM whole a JOIN whole c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
               n.vec_id AS negative_id, positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
             AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
        QUALIFY rank <= 3
    """,
}
