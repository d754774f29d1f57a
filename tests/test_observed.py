import pytest
from pyspark.sql import functions as F

from martloom.operators import observed
from martloom.operators.quality import QualityError, Rule, evaluate
from martloom.session import scratch_path
from martloom.sources import tables
from martloom.workloads import Models

RULES = [
    Rule.not_null("people", "id"),
    Rule.accepted_values("people", "kind", ("a", "b"), nulls_fail=True),
    Rule.accepted_range("people", "size", 0, 10, nan_is_null=True, nulls_fail=True),
    Rule.row_count("people"),
    Rule.unique("people", "id"),
    Rule.relationships("people", "kind", "kinds", "kind"),
    Rule.not_null("people", "nowhere", severity="warn"),
    Rule.required_columns("people", "id", "nowhere", severity="warn"),
]
DDL = "id INT, kind STRING, size DOUBLE"
GOOD = [(1, "a", 1.0), (2, "b", 0.0), (3, "a", 10.0)]
BAD = [(1, "a", -1.0), (1, "c", float("nan")), (None, None, None), (4, "b", 11.0)]


@pytest.fixture
def kinds(spark):
    return spark.createDataFrame([("a",), ("b",)], "kind STRING")


@pytest.fixture
def table(spark):
    path = scratch_path(spark, "schema")
    schema = "observed_" + path.rsplit("-", 1)[1]
    tables.ensure_schema(spark, schema, path)
    return f"{schema}.people"


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("content", [GOOD, BAD, []])
def test_the_same_results_as_a_later_evaluation(spark, kinds, content):
    df = spark.createDataFrame(content, DDL)
    path = scratch_path(spark, "people")
    stored, results = observed.store_and_evaluate({"kinds": kinds}, "people", df, path, RULES)
    assert rows(stored) == rows(df)
    assert rows(results) == rows(evaluate({"people": df, "kinds": kinds}, RULES))
    assert len(results.collect()) == len(RULES)


def test_counts_are_right_behind_an_exchange(spark):
    df = spark.range(10_000).select((F.col("id") % 100).alias("k")).groupBy("k").count()
    _, results = observed.written_checked(
        df, scratch_path(spark, "counts"), [Rule.accepted_range("counts", "k", 0, 49), Rule.row_count("counts")]
    )
    assert [(r.n_rows, r.n_failed, r.passed) for r in results.collect()] == [(100, 50, False), (100, 0, True)]


def test_row_rules_take_no_scan_of_their_own(spark):
    """The input is computed once: a counter in the scan sees each row a single time."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(500).mapInArrow(count, "id BIGINT")
    rules = [Rule.not_null("ids", "id"), Rule.unique("ids", "id"), Rule.row_count("ids")]
    _, results = observed.store_and_evaluate({}, "ids", df, scratch_path(spark, "ids"), rules)
    assert all(r.passed for r in results.collect()) and seen.value == 500


def test_a_broken_table_is_never_shown(spark, kinds, table):
    frames = {"kinds": kinds}
    observed.publish(spark.createDataFrame(GOOD, DDL), table, RULES, frames)
    with pytest.raises(QualityError) as error:
        observed.publish(spark.createDataFrame(BAD, DDL), table, RULES, frames)
    assert {f.rule for f in error.value.failures} == {
        "not_null", "accepted_values", "accepted_range", "unique", "relationships"
    }
    assert rows(spark.table(table)) == rows(spark.createDataFrame(GOOD, DDL))
    # A replacement may read the table, and warnings do not stop it.
    more = spark.table(table).unionByName(spark.createDataFrame([(9, "b", 5.0)], DDL))
    results = observed.publish(more, table, RULES, frames)
    assert spark.table(table).count() == 4
    assert sum(not r.passed for r in results.collect()) == 2


def test_nothing_is_shown_when_the_first_version_fails(spark, kinds, table):
    with pytest.raises(QualityError):
        observed.publish(spark.createDataFrame(BAD, DDL), table, RULES, {"kinds": kinds})
    assert not spark.catalog.tableExists(table)


def test_checked_names_are_neither_copied_nor_exchanged(spark):
    """A product's name would travel with each of its items, although the rules ask only for NULLs."""
    folder = "/root/testdata/sf0.001"
    checked, plain = Models(spark, folder, stored=True), Models(spark, folder)
    assert {r.product_name for r in checked.v1_order_items().select("product_name").distinct().collect()} == {""}
    assert {r.name for r in checked.raw("raw_supplies").select("name").distinct().collect()} == {""}
    assert plain.products().filter("product_name <> ''").count() == plain.products().count()
    # A missing name stays missing.
    named = checked.star.raw_products().withColumn("name", F.when(F.col("sku") % 2 == 0, F.col("name")))
    checked.star.raw_products = lambda: named
    assert checked.products().filter("product_name IS NULL").count() == named.filter("name IS NULL").count() > 0
