import math
import random
import re

import pytest
from pyspark.sql import functions as F

from martloom.operators import lexicon as lexicons
from martloom.operators import rules, sentiment

LEXICON = {"good": 1.9, "bad": -2.5, "love": 3.2, "über": 0.7, "never": -0.4}
WORDS = rules.Words(("not", "never"), {"very": 0.293, "hardly": -0.293, "love": 0.5}, ("but", "though"))


def frame(spark, entries=None):
    rows = list((entries or LEXICON).items())
    return spark.createDataFrame(rows, "token STRING, valence DOUBLE")


def brute(text):
    tokens = re.findall(r"[^\W_](?:[^\W_]|')*|'+[\w']*", text or "")
    lower = [t.lower() for t in tokens]
    caps = [t.upper() == t and t != t.lower() for t in tokens]
    mixed = 0 < sum(caps) < len(caps)
    turn = next((i for i, t in enumerate(lower) if t in WORDS.contrasts), None)
    total = 0
    for i, t in enumerate(lower):
        if t not in LEXICON:
            continue
        v = LEXICON[t]
        sign = -1 if v < 0 else 1
        value = v + sign * (0.733 if caps[i] and mixed else 0)
        for k, fading in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i >= k and lower[i - k] not in LEXICON and (d := WORDS.degrees.get(lower[i - k], 0.0)):
                value += sign * (d + (0.733 if caps[i - k] and mixed else 0)) * fading
        for k in (1, 2, 3):
            value *= -0.74 if i >= k and lower[i - k] in WORDS.negations else 1
        if turn is not None:
            value *= 0.5 if i < turn else 1.5 if i > turn else 1
        total += math.floor(value * 1_000_000 + 0.5)
    total /= 1_000_000
    asked = (text or "").count("?")
    noise = min((text or "").count("!"), 4) * 0.292 + (0 if asked <= 1 else asked * 0.18 if asked <= 3 else 0.96)
    total += (total > 0) * noise - (total < 0) * noise
    return total / math.sqrt(total * total + 15)


def test_like_brute_force(spark):
    rnd = random.Random(6)
    vocabulary = ["good", "BAD", "bad", "love", "LOVE", "über", "never", "not", "VERY", "very", "hardly", "but", "though", "x", "The", "GOOD"]
    texts = [
        rnd.choice(["", "! "]).join(" ".join(rnd.choices(vocabulary, k=rnd.randrange(9))) for _ in range(2)) + rnd.choice(["", "!", "?", "??", "?????", "!!!!!!", ".\n"])
        for _ in range(400)
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000, None), (1001, ""), (1002, "GOOD"), (1003, "VERY GOOD"), (7, "good")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "id INT, content STRING, _info STRING")
    out = rules.rule_scores(df, frame(spark), WORDS, ("id", "content")).collect()
    assert sorted((r.id, r.content or "") for r in out) == sorted((i, t or "") for i, t in rows)
    for r in out:
        assert r.sentiment_score == pytest.approx(brute(r.content), abs=2e-6), r.content


def test_what_each_rule_does(spark):
    texts = ["good", "very good", "hardly good", "not good", "not very good", "GOOD x", "good!", "good??", "bad but good", "good but bad", "not bad"]
    df = spark.createDataFrame([(t,) for t in texts], "content STRING")
    s = {r.content: r.sentiment_score for r in rules.rule_scores(df, frame(spark), WORDS, ("content",)).collect()}
    assert s["hardly good"] < s["good"] < s["very good"]
    assert s["not very good"] < s["not good"] < 0 < s["not bad"]
    assert s["good"] < s["GOOD x"] and s["good"] < s["good!"] and s["good"] < s["good??"]
    assert s["good but bad"] < s["bad but good"]


def test_nothing_is_exploded_or_exchanged(spark):
    df = spark.range(3).select("id", F.lit("a good day").alias("content"))
    for out in (rules.rule_scores(df, frame(spark)), sentiment.lexicon_scores(df, frame(spark))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Exchange", "Generate", "Python", "Join", "from_json"))


def test_a_large_lexicon_is_joined_with_the_same_result(spark):
    rnd = random.Random(1)
    entries = {f"w{k}": round(rnd.uniform(-3, 3), 2) for k in range(60)}
    rows = [(k % 9, " ".join(rnd.choices([*entries, "x", "y"], k=rnd.randrange(12)))) for k in range(80)] + [(None, None), (3, "")]
    df = spark.createDataFrame(rows, "id INT, content STRING")
    both = [
        sorted((tuple(r) for r in sentiment.lexicon_scores(df, frame(spark, entries), most_inline=n).collect()), key=repr)
        for n in (60, 59)
    ]
    assert both[0] == both[1] and len(both[0]) == len(rows)
    assert lexicons.inline_lookup(frame(spark, entries), 59) is None
    with pytest.raises(ValueError, match="smaller"):
        big = spark.range(lexicons.MAX_INLINE_TOKENS + 1).select(F.col("id").cast("string").alias("token"), F.lit(1.0).alias("valence"))
        rules.rule_scores(df, big)


def test_repeated_missing_and_strange_tokens(spark):
    rows = [("a", 1.0), ("a", 0.5), (None, 3.0), ("b", None), ('q"\\', 1.0), ("日本", 2.0)]
    lexicon = spark.createDataFrame(rows, "token STRING, valence DOUBLE")
    df = spark.createDataFrame([(1, "a b 日本"), (2, "b")], "id INT, content STRING")
    got = {r.id: r.sentiment_score for r in sentiment.lexicon_scores(df, lexicon).collect()}
    assert got == {1: round(3.5 / math.sqrt(3.5**2 + 15), 6), 2: 0.0}
    none = sentiment.lexicon_scores(df, lexicon.limit(0)).collect()
    assert [r.sentiment_score for r in none] == [0.0, 0.0]
    marts = sentiment.product_sentiment(
        df.withColumn("tweeted_at", F.lit("2024-01-01").cast("timestamp")),
        spark.createDataFrame([("b",)], "product_name STRING"), lexicon, rules.Words(),
    ).collect()
    assert marts[0].mention_count == 2
