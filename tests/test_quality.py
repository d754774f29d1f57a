from collections import Counter

import pytest
from pyspark.sql import functions as F

from martloom.operators import catalogue
from martloom.operators.quality import (
    QualityError,
    Rule,
    audit,
    audit_passes,
    evaluate,
    failing_rows,
    gate,
    verdict,
)

DDL = "id INT, kind STRING, price DOUBLE, parent INT"


@pytest.fixture(scope="module")
def tables(spark):
    good = [(1, "a", 1.0, 10), (2, "b", 0.0, 11)]
    bad = [(1, "a", -1.0, 10), (1, "z", 7.0, 99), (None, None, None, None), (None, "a", 2.0, 10)]
    return {
        "good": spark.createDataFrame(good, DDL),
        "bad": spark.createDataFrame(bad, DDL),
        "empty": spark.createDataFrame([], DDL),
        "parents": spark.createDataFrame([(10,), (11,), (None,)], "pid INT"),
    }


def failed(tables, rule):
    row = evaluate(tables, [rule]).first()
    assert row.passed == (row.n_failed == 0)
    return row.n_rows, row.n_failed


def rules(table):
    return {
        "nn": Rule.not_null(table, "id"),
        "uq": Rule.unique(table, "id"),
        "uq_nulls": Rule.unique(table, "id", nulls_fail=True),
        "combo": Rule.unique(table, "id", "kind"),
        "av": Rule.accepted_values(table, "kind", ("a", "b")),
        "av_nulls": Rule.accepted_values(table, "kind", ("a", "b"), nulls_fail=True),
        "rng": Rule.accepted_range(table, "price", 0, 5),
        "rng_nulls": Rule.accepted_range(table, "price", 0, 5, nulls_fail=True),
        "rng_low": Rule.accepted_range(table, "price", 0),
        "fk": Rule.relationships(table, "parent", "parents", "pid"),
        "rows": Rule.row_count(table),
    }


BAD = {
    "nn": 2,
    "uq": 1,
    "uq_nulls": 2,
    "combo": 0,
    "av": 1,
    "av_nulls": 2,
    "rng": 2,
    "rng_nulls": 3,
    "rng_low": 1,
    "fk": 1,
    "rows": 0,
}


@pytest.mark.parametrize("name", BAD)
def test_each_rule(tables, name):
    assert failed(tables, rules("good")[name]) == (2, 0)
    assert failed(tables, rules("bad")[name]) == (4, BAD[name])
    assert failed(tables, rules("empty")[name]) == (0, 1 if name == "rows" else 0)


@pytest.mark.parametrize(
    "name, ids", [("nn", 2), ("uq", 2), ("uq_nulls", 4), ("av", 1), ("rng", 2), ("fk", 1)]
)
def test_failing_rows(tables, name, ids):
    assert failing_rows(tables, rules("bad")[name]).count() == ids
    assert failing_rows(tables, rules("good")[name]).count() == 0


def test_missing_column_fails_without_raising(tables):
    results = evaluate(
        tables,
        [
            Rule.required_columns("good", "id", "nope"),
            Rule.not_null("good", "nope"),
            Rule.unique("good", "nope"),
            Rule.required_columns("good", "id"),
        ],
    ).collect()
    assert Counter(r.passed for r in results) == {False: 3, True: 1}


def test_quoted_values(spark):
    df = spark.createDataFrame([("it's",), ("back\\slash",)], "v STRING")
    rule = Rule.accepted_values("t", "v", ("it's", "back\\slash"))
    assert evaluate({"t": df}, [rule]).first().passed


def test_gate_and_verdict(tables):
    gate(evaluate(tables, list(rules("good").values())))
    with pytest.raises(QualityError) as error:
        gate(evaluate(tables, list(rules("bad").values())))
    assert {f.rule for f in error.value.failures} >= {"not_null", "unique", "relationships"}
    warning = evaluate(tables, [Rule.not_null("bad", "id", severity="warn")])
    gate(warning)
    row = verdict(warning).first()
    assert row.passed and row.n_failed_rules == 1


def test_audit(tables):
    row = audit("positive_price", tables["bad"], F.col("price") < 0).first()
    assert (row.n_rows, row.n_failed, row.passed) == (4, 1, False)
    assert not audit_passes(tables["bad"], F.col("price") < 0)
    assert audit_passes(tables["good"], F.col("price") < 0)


def test_catalogue_counts():
    declared = (
        catalogue.source_rules() + catalogue.staging_rules(("x",)) + catalogue.mart_rules(("x",))
    )
    # Five of the 121 declarations repeat the staged tweets under the sources.
    assert len(declared) == 116
    kinds = Counter(r.kind for r in declared)
    assert kinds == {
        "not_null": 67,
        "accepted_range": 21,
        "unique": 17,
        "relationships": 7,
        "accepted_values": 3,
        "unique_combination": 1,
    }
    assert len(set(declared)) == len(declared)
    landing = Counter(r.table for r in catalogue.landing_rules())
    assert sum(landing.values()) == 44
    assert landing["raw_customers"] == 5 and landing["raw_tweets"] == 7
    assert len(catalogue.sentiment_rules()) == 8


def test_sentiment_rules_on_single_mention(spark):
    df = spark.createDataFrame(
        [("p", 0.3, 1, None, "Positive")],
        "product_name STRING, avg_sentiment DOUBLE, mention_count BIGINT, sentiment_std DOUBLE,"
        " sentiment_category STRING",
    )
    gate(evaluate({"product_sentiment": df}, catalogue.sentiment_rules()))
    with pytest.raises(QualityError):
        gate(evaluate({"product_sentiment": df}, catalogue.sentiment_rules(strict_null=True)))


def test_nan_is_missing_only_where_said(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x DOUBLE")
    rules = [
        Rule.not_null("t", "x"),
        Rule.not_null("t", "x", nan_is_null=True),
        Rule.accepted_range("t", "x", 0, nulls_fail=True),
        Rule.accepted_range("t", "x", 0, nulls_fail=True, nan_is_null=True),
        Rule.accepted_range("t", "x", 0, nan_is_null=True),
        Rule.accepted_values("t", "x", ()),
    ]
    failed = [evaluate({"t": df}, [rule]).first().n_failed for rule in rules]
    assert failed == [1, 2, 1, 2, 0, 2]
