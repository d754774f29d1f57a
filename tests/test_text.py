import math
import random

import pytest
from pyspark.sql import functions as F

from martloom.operators import lookup, mentions, sentiment
from martloom.plans.staging import stg_tweets
from martloom.schemas import LANDING

NAMES = ["", "a", "é", "ab", "abc", "aBCa", "bcabc", "the soup ", "Überraschung", "a" * 13, "no such name"]


def texts(n=120):
    rnd = random.Random(3)
    parts = ["a", "b", "c", "é", "É", "ab", "abc ", "ABCA", "the soup ", "überraschung", "\n", "a" * 9, "𝄞"]
    rows = [(i, "".join(rnd.choices(parts, k=rnd.randint(0, 30)))) for i in range(n)]
    return rows + [(n, None), (n + 1, "")]


def brute(rows, names):
    return sorted((i, n) for i, t in rows if t is not None for n in names if n.lower() in t.lower())


@pytest.mark.parametrize("names", [NAMES, [n for n in NAMES if len(n) >= 11], [""], []])
def test_both_paths_match_brute_force(spark, names):
    rows = texts()
    df = spark.createDataFrame(rows, "id INT, content STRING")
    dictionary = spark.createDataFrame([(n,) for n in names], "product_name STRING")
    inline = mentions.extract_mentions(df, dictionary)
    blocks = mentions.block_mentions(df, dictionary, "id", "content", "product_name")
    assert sorted(map(tuple, inline.collect())) == brute(rows, names)
    assert sorted(map(tuple, blocks.collect())) == brute(rows, names)


def test_large_dictionary_takes_the_block_path(spark, monkeypatch):
    rows = texts(40)
    names = [f"{a}{b}" for a in "abcé" for b in ("", "a", "bc", "abc ", "the soup")]
    df = spark.createDataFrame(rows, "id INT, content STRING")
    dictionary = spark.createDataFrame([(n,) for n in names * 2], "product_name STRING")
    monkeypatch.setattr(mentions, "MAX_INLINE_NAMES", 3)
    found = mentions.extract_mentions(df, dictionary)
    assert sorted(map(tuple, found.collect())) == brute(rows, names)


def test_lookups_beyond_the_broadcast_bound(spark, lexicon, monkeypatch):
    rows = texts()
    df = spark.createDataFrame(rows, "id INT, content STRING")
    dictionary = spark.createDataFrame([(n,) for n in NAMES], "product_name STRING")
    few = lexicon.unionByName(spark.createDataFrame([("abca", 1.0)], lexicon.schema))
    scores = sorted(map(tuple, sentiment.lexicon_scores(df, few).collect()))
    for module in (mentions, sentiment):
        monkeypatch.setattr(module, "bounded", lambda side: lookup.bounded(side, max_rows=1))
    found = mentions.block_mentions(df, dictionary, "id", "content", "product_name")
    assert sorted(map(tuple, found.collect())) == brute(rows, NAMES)
    assert sorted(map(tuple, sentiment.lexicon_scores(df, few).collect())) == scores


def test_every_occurrence_position(spark):
    """A name is found wherever the blocks fall on it."""
    name = "pepper sauce"
    rows = [(i, "x" * i + name + "y" * (i % 3)) for i in range(20)]
    df = spark.createDataFrame(rows, "id INT, content STRING")
    dictionary = spark.createDataFrame([(name,)], "product_name STRING")
    found = mentions.block_mentions(df, dictionary, "id", "content", "product_name")
    assert found.count() == 20


def test_names_longer_than_the_context(spark):
    """The far end of a long name is checked too."""
    near, far = "long name " * 30 + "x", "long name " * 30 + "y"
    df = spark.createDataFrame([(1, f"a {near} b"), (2, f"{far}"), (3, near[:-1])], "id INT, content STRING")
    dictionary = spark.createDataFrame([(near,), (far,)], "product_name STRING")
    found = mentions.block_mentions(df, dictionary, "id", "content", "product_name")
    assert sorted(map(tuple, found.collect())) == [(1, near), (2, far)]


def test_lexicon_scores(spark, lexicon):
    rows = [(1, "good, GOOD bad"), (2, "neutral words"), (3, ""), (4, None)]
    df = spark.createDataFrame(rows, "id INT, content STRING")
    scores = {r.id: r.sentiment_score for r in sentiment.lexicon_scores(df, lexicon).collect()}
    s = 1.9 + 1.9 - 2.5
    assert scores == {1: round(s / math.sqrt(s * s + 15), 6), 2: 0.0, 3: 0.0, 4: 0.0}


def test_product_sentiment(spark, landing, lexicon, monkeypatch):
    tweets = stg_tweets(landing["raw_tweets"])
    names = landing["raw_products"].selectExpr("name AS product_name")
    mart = {r.product_name: r for r in sentiment.product_sentiment(tweets, names, lexicon).collect()}
    assert set(mart) == {"name T-1", "name B-1"}
    assert mart["name T-1"].mention_count == 2
    assert mart["name B-1"].sentiment_std is None
    assert mart["name B-1"].sentiment_category == "Very Negative"
    assert mart["name T-1"].first_mention < mart["name T-1"].last_mention
    monkeypatch.setattr(mentions, "MAX_INLINE_NAMES", 2)
    large = sentiment.product_sentiment(tweets, names, lexicon).collect()
    assert {r.product_name: r for r in large} == mart


def test_bad_tweet_times(spark):
    from martloom.plans.staging import bad_tweets

    ddl = "id STRING, user_id STRING, tweeted_at STRING, content STRING"
    raw = spark.createDataFrame(
        [("1", "u", "2024-01-01T10:00:00", "x"), ("2", "u", "soon", "y"), ("3", "u", None, "z")], ddl
    )
    assert [r.id for r in bad_tweets(raw).collect()] == ["2"]
    kept = stg_tweets(raw, on_bad_time="null")
    assert kept.filter("tweeted_at IS NULL").count() == 2
    assert kept.schema["tweeted_at"].dataType == LANDING["raw_tweets"].schema["tweeted_at"].dataType
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stg_tweets(raw).collect()


def test_rows_that_share_an_id_stay_apart(spark, lexicon):
    rows = [("7", "soup good good"), ("7", "soup bad"), (None, "the Soup"), (None, "the Soup"), ("8", "x")]
    tweets = spark.createDataFrame(rows, "id STRING, content STRING").withColumn(
        "tweeted_at", F.lit("2024-01-01").cast("timestamp_ntz")
    )
    names = spark.createDataFrame([("soup",)], "product_name STRING")
    both = [
        sorted((r.id or "", r.sentiment_score) for r in sentiment.scored_mentions(tweets, names, lexicon, most).collect())
        for most in (64, 0)
    ]
    assert both[0] == both[1] and [k for k, _ in both[0]] == ["", "", "7", "7"]
    found = [mentions.extract_mentions(tweets, names, most_inline=most).count() for most in (64, 0)]
    assert found == [4, 4]


def test_tokens_of_any_script(spark):
    rows = [(1, "It can't be große Щука, can't")]
    df = spark.createDataFrame(rows, "id INT, content STRING")
    words = spark.createDataFrame([("can't", -1.0), ("große", 4.0), ("щука", 2.0)], "token STRING, valence DOUBLE")
    score = sentiment.lexicon_scores(df, words).first().sentiment_score
    assert score == pytest.approx(4 / math.sqrt(16 + 15), abs=1e-6)


def test_the_bin_is_that_of_the_mean_itself(spark):
    rows = [("p", s, None) for s in (-0.499999, -0.5, -0.5)]
    df = spark.createDataFrame(rows, "product_name STRING, sentiment_score DOUBLE, tweeted_at TIMESTAMP_NTZ")
    row = sentiment.mention_stats(df).first()
    assert row.avg_sentiment == -0.5 and row.sentiment_category == "Negative"


def test_a_very_long_text(spark):
    rows = [(1, "ab " * 2_000_000 + "the very long pepper sauce"), (2, "sauce")]
    df = spark.createDataFrame(rows, "id INT, content STRING")
    names = spark.createDataFrame([("pepper sauce",), ("b a",), ("zz",)], "product_name STRING")
    found = mentions.block_mentions(df, names, "id", "content", "product_name").collect()
    assert sorted(map(tuple, found)) == [(1, "b a"), (1, "pepper sauce")]


def test_names_of_one_word_are_looked_up_in_words(spark, monkeypatch):
    """No block of a text becomes a row for them; all others still take the join."""
    rows = [(i, t) for i, t in texts(60)] + [(900, "x" * 8_190 + "überraschung" + "y" * 20_000 + "abc!abc"), (None, "abc")]
    rows += [(7, "Straße ΟΔΟΣ"), (901, "İstanbul it's 42")]
    plain = ["a", "é", "aBCa", "bcabc", "Überraschung", "a" * 13, "y" * 64, "ΟΔΟΣ", "it's", "4", "İst", "ABCA"]
    other = ["", "the soup ", "abc\n", "y" * 65, "c a"]
    df = spark.createDataFrame(rows, "id INT, content STRING")
    named = lambda names: spark.createDataFrame([(n,) for n in names] + [(None,)], "product_name STRING")
    joined = mentions.joined_mentions
    monkeypatch.setattr(mentions, "REMEMBERED", 3)
    for names in (plain, plain + other, other):
        asked = []
        monkeypatch.setattr(mentions, "joined_mentions", lambda t, d, *a: asked.extend(r[0] for r in d.collect()) or joined(t, d, *a))
        found = mentions.block_mentions(df, named(names), "id", "content", "product_name")
        lowered = [tuple(r) for r in df.selectExpr("id", "lower(content)").collect()]
        low = {r[0]: r[1] for r in named(names).selectExpr("product_name", "lower(product_name)").collect() if r[0] is not None}
        expected = {(i, n) for i, t in lowered if t is not None for n in names if low[n] in t}
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
        assert sorted(asked) == sorted(set(names) & set(other))
    # Too many names for the tasks to hold: all by the join.
    monkeypatch.setattr(mentions, "MAX_WORD_NAMES", 2)
    assert mentions.block_mentions(df, named(plain), "id", "content", "product_name").count() > 0
    assert set(plain) <= set(asked)


def test_names_of_one_word_are_scored_in_their_row(spark, lexicon):
    """No key of a row and no second look at the texts: nothing is exchanged for such names."""
    rows = [(str(i % 5) if i % 3 else None, t) for i, t in texts(40)] + [("1", "Soup-abc's"), ("1", None), (None, "")]
    rows += rows[::3]
    tweets = spark.createDataFrame(rows, "id STRING, content STRING").withColumn(
        "tweeted_at", F.lit("2024-01-01").cast("timestamp_ntz")
    )
    named = lambda names: spark.createDataFrame([(n,) for n in names] + [(None,)], "product_name STRING")
    plain, other = ["a", "bc", "A", "soup", "é"], ["the soup", "p-a", "c a"]
    for names in (plain, plain + other, other):
        both = [
            sorted(map(str, sentiment.scored_mentions(tweets, named(names), lexicon, most).collect())) for most in (64, 0)
        ]
        assert both[0] == both[1] and both[0]
        found = [
            sorted(map(str, mentions.extract_mentions(tweets, named(names), most_inline=most).collect())) for most in (64, 0)
        ]
        assert found[0] == found[1] and len(found[0]) == len(both[0])
    for df in (
        sentiment.scored_mentions(tweets, named(plain), lexicon, 0),
        mentions.extract_mentions(tweets, named(plain), most_inline=0),
    ):
        plan = df._jdf.queryExecution().toString()
        assert "Exchange" not in plan and "Join" not in plan
