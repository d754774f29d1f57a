"""Lexicon scores of texts and their summary per mentioned product."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.text import TOKEN_BREAK, normalised_score, score_bin, tokens
from martloom.operators.lexicon import entries, inline_lookup
from martloom.operators.lookup import bounded
from martloom.operators.mentions import (
    inline_names,
    joined_mentions,
    row_key,
    split_names,
    with_mentions,
    with_word_mentions,
)
from martloom.operators.rules import Words, rule_scores

SCORE_PLACES = 6


def lexicon_scores(
    texts: DataFrame,
    lexicon: DataFrame,
    keep: tuple[str, ...] = ("id",),
    text_column: str = "content",
    token_break: str = TOKEN_BREAK,
    most_inline: int | None = None,
) -> DataFrame:
    """One row per row of ``texts``: its ``keep`` columns and its score in (-1, 1); no hit scores 0.

    Every token is looked up in ``lexicon`` (token, valence) and summed as integer millionths, so the
    result is the same however the work is split. The tokens are summed inside the row; a lexicon too
    large for that (``most_inline``) is joined instead.
    """
    lookup = inline_lookup(lexicon, most_inline)
    if lookup is None:
        return _joined_scores(texts, lexicon, keep, text_column, token_break)
    zero = F.lit(0).cast("bigint")
    found = tokens(F.col(text_column), token_break)
    summed = F.aggregate(found, zero, lambda total, t: total + F.coalesce(lookup(t), zero))
    total = texts.select(*keep, F.coalesce(summed, zero).alias("_total"))
    score = normalised_score(F.col("_total") / 1_000_000)
    return total.select(*keep, F.round(score, SCORE_PLACES).alias("sentiment_score"))


def _joined_scores(
    texts: DataFrame, lexicon: DataFrame, keep: tuple[str, ...], text_column: str, token_break: str
) -> DataFrame:
    """``lexicon_scores`` by a join of tokens.

    All tokens of a text sit in one task, so the partial sum leaves about one row per text to
    exchange. Equal rows are summed together and told apart again by their number; rows that only
    share an id are not.
    """
    words = texts.select(
        *keep,
        F.sha2(text_column, 256).alias("_text"),
        F.posexplode_outer(tokens(F.col(text_column), token_break)).alias("_place", "token"),
    )
    summed = (
        words.join(bounded(entries(lexicon)), "token", "left")
        .groupBy(*keep, "_text")
        .agg(
            F.sum(F.coalesce(F.col("_valence"), F.lit(0))).alias("_total"),
            F.count_if(F.coalesce(F.col("_place"), F.lit(0)) == 0).alias("_copies"),
        )
    )
    score = normalised_score(F.col("_total") / F.col("_copies") / 1_000_000)
    scored = summed.select(*keep, F.round(score, SCORE_PLACES).alias("sentiment_score"), "_copies")
    return scored.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies"))).drop(
        "_copy", "_copies"
    )


def mention_stats(scored_mentions: DataFrame) -> DataFrame:
    """Mean, count, sample deviation, first and last mention per product, with its score bin.

    ``scored_mentions`` has (product_name, sentiment_score, tweeted_at). Every measure merges
    from partial results, so a product in a third of all texts is not a hot task.
    """
    # Whole millionths, divided once: the bin sees the mean itself, only the column is rounded.
    millionths = F.rint(F.col("sentiment_score") * 10**SCORE_PLACES).cast("bigint")
    summary = (
        scored_mentions.filter(F.col("product_name").isNotNull())
        .groupBy("product_name")
        .agg(
            F.sum(millionths).alias("_sum"),
            F.count("sentiment_score").alias("mention_count"),
            F.round(F.stddev_samp("sentiment_score"), SCORE_PLACES).alias("sentiment_std"),
            F.min("tweeted_at").alias("first_mention"),
            F.max("tweeted_at").alias("last_mention"),
        )
    )
    mean = F.try_divide(F.col("_sum"), F.col("mention_count") * F.lit(10.0**SCORE_PLACES))
    return summary.select(
        "product_name",
        F.round(mean, SCORE_PLACES).alias("avg_sentiment"),
        "mention_count",
        "sentiment_std",
        "first_mention",
        "last_mention",
        score_bin(mean).alias("sentiment_category"),
    )


def scored_mentions(
    tweets: DataFrame,
    names: DataFrame,
    lexicon: DataFrame,
    most_inline: int | None = None,
    rules: Words | None = None,
) -> DataFrame:
    """(id, tweeted_at, product_name, sentiment_score) for every row of ``tweets`` and name in it.
    ``names`` holds product_name; ids may repeat or be NULL. With ``rules``, the words around a token
    change its valence; without, its valence alone counts.

    With a small dictionary, or names of one word, each text is read once: found names ride along as a
    short list while its tokens are scored, and texts that mention nothing are not scored at all.
    """

    def score(texts: DataFrame, keep: tuple[str, ...]) -> DataFrame:
        if rules is None:
            return lexicon_scores(texts, lexicon, keep)
        return rule_scores(texts, lexicon, rules, keep)

    def exploded(tagged: DataFrame) -> DataFrame:
        scores = score(tagged, ("id", "tweeted_at", "mentions"))
        # Every list has a name; the outer explode only spares a second look at the texts for it.
        return scores.select(
            "id", "tweeted_at", F.explode_outer("mentions").alias("product_name"), "sentiment_score"
        )

    distinct = names.select("product_name").distinct()
    inline = inline_names(distinct, most=most_inline)
    if inline is None:
        _, rows, others = split_names(distinct, "product_name")
        parts = []
        if rows is not None:
            parts.append(exploded(with_word_mentions(tweets.select("id", "tweeted_at", "content"), rows, "content", "mentions")))
        if others is not None:
            keyed = tweets.withColumn("_key", row_key("id", "tweeted_at", "content"))
            mentions = joined_mentions(keyed, others, "_key", "content", "product_name")
            scores = score(keyed, ("_key", "id", "tweeted_at"))
            parts.append(
                mentions.join(scores, "_key").select("id", "tweeted_at", "product_name", "sentiment_score")
            )
        return reduce(DataFrame.unionByName, parts)
    return exploded(with_mentions(tweets, inline, "content", "mentions"))


def product_sentiment(
    tweets: DataFrame, names: DataFrame, lexicon: DataFrame, rules: Words | None = None
) -> DataFrame:
    """Sentiment mart: one row per product that at least one text mentions."""
    return mention_stats(scored_mentions(tweets, names, lexicon, rules=rules))
