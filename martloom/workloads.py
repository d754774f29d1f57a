"""Every model, report, check and operator as a query over a folder of star-schema tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.money import cents_to_dollars
from martloom.functions.names import quoted_parts, utc_to_epoch_ms
from martloom.functions.text import bin_rank, score_bin
from martloom.operators import (
    catalogue,
    contract,
    distinct_state,
    freshness,
    incremental,
    mentions,
    observed,
    quality,
    rules,
    sentiment,
    versions,
)
from martloom.operators.lookup import bounded
from martloom.operators.quality import Rule
from martloom.plans import colocated, delta, marts_v1, marts_v2, reports, staging
from martloom.plans.products import (
    priced_items,
    product_economics,
    supply_cost_by_product,
)
from martloom.schemas import LANDING, SEED_EVENTS
from martloom.session import scratch_path, written
from martloom.sources import files, tables
from martloom.sources.star import DRINK_TYPES, FOOD_TYPES, Star
from martloom.streaming.landing import drain_landing

Query = Callable[[SparkSession, str], DataFrame]

# Names looked for in the texts (the last two never occur) and token valences.
DICTIONARY = ("that", "tion", "thon", "erin", "anea", "thble", "fromage", "quix")
LEXICON = (
    ("with", 1.5),
    ("this", -1.2),
    ("that", 0.8),
    ("from", -2.0),
    ("than", 2.4),
    ("thin", -0.6),
    ("thor", 1.1),
    ("erin", -1.7),
)
# Words of the texts that take the part of negations, degree words and contrasts.
RULE_WORDS = rules.Words(("in", "as"), {"the": 0.293, "and": 0.293, "of": -0.293, "is": -0.293}, ("was",))
DELTA_BUCKETS = 16
COLOCATED_BUCKETS = 8
PRODUCT_TYPES = ("ECONOMY", "STANDARD", "MEDIUM", "SMALL", "PROMO", "LARGE")
RANGE = (dt.date(2024, 1, 5), dt.date(2024, 1, 14))
AS_OF = "2024-01-31 00:04:00"
# One bound per kind of event, plus a dataset that is never updated.
POLICIES = (
    ("click", 180, "error", None),
    ("error", 7200, "error", None),
    ("purchase", 3600, "error", 300),
    ("signup", 60, "warn", 86_400),
    ("view", 3600, "warn", None),
    ("refund", 3600, "error", 60),
)


# The dataset whose run each kind of event stands for.
RUN_OF = {
    "click": "customers",
    "error": "orders",
    "purchase": "stg_orders",
    "signup": "stg_products",
    "view": "tweets",
}


class Models:
    """Lazy frames of one folder, named as the marts know them.

    ``stored`` writes the landing tables that need a join to the shared folder once, for checks
    that read them many times. Of texts the checks only ask whether they are there, so no text is
    copied, nor exchanged with the items of its product.
    """

    JOINED = ("raw_orders", "raw_supplies", "raw_tweets")
    TEXTS = {"raw_tweets": "content", "raw_supplies": "name", "raw_products": "name"}

    def __init__(self, spark: SparkSession, folder: str, stored: bool = False):
        self.spark = spark
        self.star = Star(spark, folder)
        self._stored = stored
        self._written = {name: written(self._checked(name), name) for name in self.JOINED if stored}

    def _checked(self, name: str) -> DataFrame:
        df, text = getattr(self.star, name)(), self.TEXTS.get(name)
        if text is None:
            return df
        return df.withColumn(text, F.when(F.col(text).isNotNull(), F.lit("")))

    def raw(self, name: str) -> DataFrame:
        if name in self._written:
            return self._written[name]
        return self._checked(name) if self._stored else getattr(self.star, name)()

    def landing(self) -> dict[str, DataFrame]:
        return {name: self.raw(name) for name in catalogue.LANDING_REQUIRED}

    def customers(self) -> DataFrame:
        return staging.stg_customers(self.raw("raw_customers"))

    def orders(self) -> DataFrame:
        return staging.stg_orders(self.raw("raw_orders"))

    def items(self) -> DataFrame:
        return staging.stg_order_items(self.raw("raw_items"))

    def products(self) -> DataFrame:
        return staging.stg_products(self.raw("raw_products"), FOOD_TYPES, DRINK_TYPES)

    def stores(self) -> DataFrame:
        return staging.stg_stores(self.raw("raw_stores"))

    def supplies(self) -> DataFrame:
        return staging.stg_supplies(self.raw("raw_supplies"))

    def tweets(self) -> DataFrame:
        return staging.stg_tweets(self.raw("raw_tweets"))

    def staged(self) -> dict[str, DataFrame]:
        return {
            "stg_customers": self.customers(),
            "stg_orders": self.orders(),
            "stg_order_items": self.items(),
            "stg_products": self.products(),
            "stg_stores": self.stores(),
            "stg_supplies": self.supplies(),
            "stg_tweets": self.tweets(),
        }

    def economics(self, literal_macro: bool = False) -> DataFrame:
        return product_economics(self.products(), self.supplies(), literal_macro)

    def priced(self, literal_macro: bool = False) -> DataFrame:
        # A row a product; the check of its size and the join read it, and neither makes it again.
        return priced_items(self.items(), bounded(written(self.economics(literal_macro), "economics")))

    def v1_order_items(self, literal_macro: bool = False) -> DataFrame:
        return marts_v1.order_items(
            self.items(), self.orders(), self.products(), self.supplies(), literal_macro
        )

    def v1_orders(self, literal_macro: bool = False) -> DataFrame:
        return marts_v1.orders(self.orders(), marts_v1.item_dollars(self.priced(literal_macro)))

    def v1_customers(self, literal_macro: bool = False) -> DataFrame:
        return marts_v1.customers(self.customers(), self.v1_orders(literal_macro))

    def seed(self) -> DataFrame:
        return self.star.seed_events()

    def dictionary(self) -> DataFrame:
        return self.spark.createDataFrame([(n,) for n in DICTIONARY], "product_name STRING")

    def lexicon(self) -> DataFrame:
        return self.spark.createDataFrame(list(LEXICON), "token STRING, valence DOUBLE")

    def benchmark_words(self) -> DataFrame:
        words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
        return (
            self.star.table("benchmark").select(F.explode(words).alias("product_name")).distinct()
        )

    def run_models(self) -> DataFrame:
        """Quoted model names: one per event type and user."""
        return self.star.table("events").select(self._model().alias("model")).distinct()

    def runs(self) -> DataFrame:
        """Finished runs: every event that is not an error ends a run of its model."""
        return (
            self.star.table("events")
            .filter(F.col("event_type") != "error")
            .select(
                self._model().alias("model"),
                utc_to_epoch_ms(F.col("ts")).alias("end_ms"),
            )
        )

    @staticmethod
    def _model():
        return F.concat(
            F.lit('"mart"."'), "event_type", F.lit('"."user_'), F.col("user_id").cast("string"), F.lit('"')
        )


def _models(build: Callable[[Models], DataFrame], stored: bool = False) -> Query:
    return lambda spark, folder: build(Models(spark, folder, stored))


def _fn_cents_to_dollars(m: Models) -> DataFrame:
    balance = F.rint(F.col("c_acctbal") * 100).cast("bigint")
    return m.star.table("customer").select(
        F.col("c_custkey").alias("customer_id"),
        cents_to_dollars(balance).alias("dollars"),
        cents_to_dollars(balance, 1).alias("dollars_1"),
        cents_to_dollars(balance, 0).alias("dollars_0"),
    )


def _mention_scores(m: Models) -> DataFrame:
    return sentiment.scored_mentions(m.tweets(), m.dictionary(), m.lexicon())


def _repeated_tweets(m: Models) -> DataFrame:
    """Tweets whose ids repeat or are missing, a third of them twice."""
    number = F.col("id").cast("bigint")
    tweets = m.tweets().withColumn("id", F.when(number % 4 != 0, (number % 7).cast("string")))
    # Told twice in their own row, so that texts and authors meet once.
    times = F.when(F.col("user_id").cast("bigint") % 3 == 0, 2).otherwise(1)
    return tweets.withColumn("_time", F.explode(F.sequence(F.lit(1), times))).drop("_time")


def _repeated_sentiment(most_inline: int) -> Query:
    return _models(
        lambda m: sentiment.scored_mentions(
            _repeated_tweets(m), m.dictionary(), m.lexicon(), most_inline
        )
    )


def _spoken(m: Models) -> DataFrame:
    """Tweets of which some shout, exclaim or ask."""
    number, content = F.col("id").cast("bigint"), F.col("content")
    put = lambda c, old, new: F.replace(c, F.lit(old), F.lit(new))
    loud = F.when(number % 3 == 0, put(put(content, "that", "THAT"), " the ", " THE ")).otherwise(content)
    marked = F.when(number % 4 == 0, put(loud, ".", "!")).when(number % 5 == 0, put(loud, ".", "?"))
    return m.tweets().withColumn("content", marked.otherwise(loud))


def _sentiment_rules_score(m: Models) -> DataFrame:
    return rules.rule_scores(_spoken(m), m.lexicon(), RULE_WORDS)


def _sentiment_bins(m: Models) -> DataFrame:
    scores = sentiment.lexicon_scores(m.tweets(), m.lexicon())
    label = score_bin(F.col("sentiment_score"))
    return scores.select(
        "id",
        label.alias("sentiment_category"),
        bin_rank(label).cast("int").alias("category_rank"),
    )


def _mention_large(m: Models) -> DataFrame:
    names = m.benchmark_words()
    texts = m.star.documents().select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    found = mentions.block_mentions(texts, names, "id", "content", "product_name")
    return found.groupBy("product_name").agg(F.count(F.lit(1)).alias("mention_count"))


def _missing_intervals(m: Models) -> DataFrame:
    user = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    day = F.col("ts").cast("date")
    events = m.star.table("events").select(user.alias("model"), day.alias("day"))
    models = events.groupBy("model").agg(
        F.min("day").alias("start_day"), F.max("day").alias("end_day")
    )
    log = events.select(
        "model", F.col("day").alias("interval_start"), F.date_add("day", 1).alias("interval_end")
    )
    return incremental.missing_intervals(models, log)


def _freshness_policies(m: Models) -> DataFrame:
    """The declared policies against a run log in which five of the datasets have runs."""
    dataset = F.element_at(F.create_map(*(F.lit(x) for kv in RUN_OF.items() for x in kv)), F.col("event_type"))
    log = m.star.table("events").select(dataset.alias("dataset"), F.col("ts").alias("finished_at"))
    policies = m.spark.createDataFrame(list(freshness.DATASET_POLICIES), freshness.POLICY_DDL)
    return freshness.freshness(log, policies, F.lit(AS_OF).cast("timestamp_ntz"))


def _freshness(m: Models) -> DataFrame:
    log = m.star.table("events").select(
        F.col("event_type").alias("dataset"), F.col("ts").alias("finished_at")
    )
    policies = m.spark.createDataFrame(list(POLICIES), freshness.POLICY_DDL)
    return freshness.freshness(log, policies, F.lit(AS_OF).cast("timestamp_ntz"))


def _parse_model_name(m: Models) -> DataFrame:
    return m.run_models().select("model", F.array_join(quoted_parts(F.col("model")), "|").alias("parts"))


def full_model(m: Models) -> DataFrame:
    return incremental.orders_per_item(m.seed())


STAGED_CHECKS = {
    "check_not_null": [
        Rule.not_null("stg_orders", "customer_id"),
        Rule.not_null("stg_order_items", "order_id"),
        Rule.not_null("stg_supplies", "supply_cost"),
    ],
    "check_unique": [
        Rule.unique("stg_order_items", "order_item_id"),
        Rule.unique("stg_order_items", "order_id"),
        Rule.unique("stg_products", "product_name"),
    ],
    "check_unique_combo": [
        Rule.unique("stg_supplies", "supply_id", "product_id"),
        Rule.unique("stg_order_items", "order_id", "product_id"),
    ],
    "check_accepted_values": [
        Rule.accepted_values("stg_products", "product_type", PRODUCT_TYPES),
        Rule.accepted_values("stg_products", "product_type", FOOD_TYPES + DRINK_TYPES),
        Rule.accepted_values("stg_orders", "status", ("completed",), nulls_fail=True),
    ],
    "check_range": [
        Rule.accepted_range("stg_stores", "tax_rate", 0, 1),
        Rule.accepted_range("stg_supplies", "supply_cost", 50),
        Rule.accepted_range("stg_orders", "order_total", high=10_000_000),
    ],
    "check_relationships": [
        Rule.relationships("stg_order_items", "order_id", "stg_orders", "order_id"),
        Rule.relationships("stg_orders", "order_id", "stg_order_items", "order_id"),
        Rule.relationships("stg_supplies", "product_id", "stg_products", "product_id"),
    ],
    "check_row_count": [
        Rule.row_count("stg_orders"),
        Rule.row_count("stg_order_items"),
        Rule.row_count("stg_tweets"),
    ],
}
REQUIRED = [
    Rule.required_columns("stg_orders", "order_id", "customer_id"),
    Rule.required_columns("stg_tweets", "content"),
    Rule.row_count("stg_tweets"),
]
PUBLISHED = {
    "orders": [
        Rule.unique("orders", "order_id"),
        Rule.not_null("orders", "customer_id"),
        Rule.accepted_range("orders", "total_revenue", 0),
        Rule.accepted_range("orders", "food_profit", 1000, severity="warn"),
        Rule.relationships("orders", "customer_id", "stg_customers", "customer_id"),
        Rule.row_count("orders"),
    ],
    "customers": [
        Rule.unique("customers", "customer_id"),
        Rule.not_null("customers", "total_revenue", severity="warn"),
        Rule.accepted_range("customers", "number_of_orders", 1),
    ],
}
ORPHANS = Rule.relationships("stg_orders", "order_id", "stg_order_items", "order_id")
REPEATED = Rule.unique("stg_order_items", "order_id", "product_id")


def _staged_check(rules: list[Rule]) -> Query:
    return _models(lambda m: quality.evaluate(m.staged(), rules))


def all_rules() -> list[Rule]:
    return [
        *catalogue.landing_rules(),
        *catalogue.source_rules(),
        *catalogue.staging_rules(PRODUCT_TYPES),
        *catalogue.mart_rules(PRODUCT_TYPES),
    ]


def _check_all(m: Models) -> DataFrame:
    """Every rule of every table. The marts are written once, as a build would; their row rules are
    measured meanwhile."""
    rules = all_rules()
    stg = m.staged()
    frames = {
        **m.landing(),
        **stg,
        "products": marts_v1.products(stg["stg_products"]),
        "supplies": marts_v1.supplies(stg["stg_supplies"]),
        "tweets": marts_v1.tweets(stg["stg_tweets"]),
    }
    measured = []

    def store(name: str, df: DataFrame) -> DataFrame:
        mine = [r for r in rules if r.table == name and observed.observable(df, r)]
        frames[name], results = observed.written_checked(df, scratch_path(m.spark, name), mine)
        measured.append(results)
        rules[:] = [r for r in rules if r not in mine]
        return frames[name]

    orders = store("orders", marts_v1.orders(stg["stg_orders"], store("order_items", m.v1_order_items())))
    store("customers", marts_v1.customers(stg["stg_customers"], orders))
    return reduce(DataFrame.unionByName, measured, quality.evaluate(frames, rules))


def _publish_observed(m: Models) -> DataFrame:
    """Results of the rules of two marts that are shown only because they pass."""
    schema = _scratch_schema(m.spark)
    items = marts_v1.item_dollars(m.priced())
    orders = marts_v1.orders(m.orders(), items)
    frames = {"stg_customers": m.customers()}
    first = observed.publish(orders, f"{schema}.orders", PUBLISHED["orders"], frames)
    mart = marts_v1.customers(m.customers(), m.spark.table(f"{schema}.orders"))
    return first.unionByName(observed.publish(mart, f"{schema}.customers", PUBLISHED["customers"]))


def _gate_blocks(m: Models) -> DataFrame:
    """A published table after a replacement that has lost the status of some orders was refused."""
    name = f"{_scratch_schema(m.spark)}.stg_orders"
    rules = [Rule.not_null("stg_orders", "status"), Rule.unique("stg_orders", "order_id")]
    observed.publish(m.orders(), name, rules)
    broken = m.orders().withColumn("status", F.when(F.col("order_id") % 100 != 7, F.col("status")))
    try:
        observed.publish(broken, name, rules)
    except quality.QualityError:
        return m.spark.table(name)
    raise AssertionError("the replacement was not refused")


def _contract_check(m: Models) -> DataFrame:
    """Orders that keep their contract, and the report of a version that has drifted from it, with the
    values that each column has there."""
    spec = LANDING["raw_orders"]
    kept = m.raw("raw_orders").select(*[F.col(f.name).cast(f.dataType) for f in spec.schema.fields])
    contract.enforce_contract(kept, spec)
    drifted = (
        kept.drop("store_id")
        .withColumn("subtotal", F.col("subtotal").cast("double") / 100)
        .withColumn("channel", F.when(F.col("order_total") % 2 == 0, F.lit("web")))
    )
    values = [F.struct(F.lit(c).alias("column"), F.count(c).alias("n_values")) for c in drifted.columns]
    counted = drifted.agg(F.array(*values).alias("v")).select(F.inline("v"))
    return (
        contract.contract_report(drifted, spec)
        .join(counted, "column", "left")
        .withColumn("n_values", F.coalesce("n_values", F.lit(0)))
    )


def _materialize_kinds(m: Models) -> DataFrame:
    """One model as a view and as a table."""
    schema = _scratch_schema(m.spark)
    kinds = [
        tables.materialise(m.products(), name, kind, schema).withColumn("kind", F.lit(kind))
        for kind, name in (("view", f"{schema}_products"), ("table", "products"))
    ]
    return kinds[0].unionByName(kinds[1])


def _qualify_name(m: Models) -> DataFrame:
    """Tables under the default schema and under a custom one, written with blanks around its name."""
    default, custom = _scratch_schema(m.spark), _scratch_schema(m.spark)
    plain = tables.qualify("stores", default=default)
    other = tables.qualify("stores", f" {custom} ", default)
    tables.write_replace(m.stores(), plain)
    tables.write_replace(m.stores().filter("store_id % 2 = 0"), other)
    shown = lambda name, place: m.spark.table(name).withColumn("place", F.lit(place))
    return shown(f"{default}.stores", "default").unionByName(shown(f"{custom}.stores", "custom"))


def _catalogued(m: Models) -> str:
    schema = _scratch_schema(m.spark)
    for name, df in (("customers", m.customers()), ("orders", m.orders())):
        tables.write_replace(df, f"{schema}.{name}")
    m.spark.sql(f"CREATE VIEW {schema}.late_orders AS SELECT * FROM {schema}.orders WHERE order_id > 100")
    return schema


def _flush_schema(m: Models) -> DataFrame:
    """Rows and columns of the tables of a schema before and after it was flushed; views follow."""
    schema = _catalogued(m)

    def sizes(when: str) -> list[tuple]:
        names = [r.tableName for r in tables.list_tables(m.spark, schema).collect()]
        read = [(n, tables.read_table(m.spark, f"{schema}.{n}")) for n in sorted(names)]
        return [(when, n, len(df.columns), df.count()) for n, df in read]

    before = sizes("before")
    tables.flush_schema(m.spark, schema)
    return m.spark.createDataFrame(
        before + sizes("after"), "moment STRING, table_name STRING, n_columns INT, n_rows BIGINT"
    )


def _catalog_list(m: Models) -> DataFrame:
    """Columns, types and kinds of all that a schema has, and the rows of each."""
    schema = _catalogued(m)
    stored = tables.base_tables(m.spark, schema)
    parts = []
    for r in tables.list_tables(m.spark, schema).collect():
        name = f"{schema}.{r.tableName}"
        parts.append(
            tables.describe(m.spark, name).select(
                F.lit(r.tableName).alias("table_name"),
                F.lit(r.tableName in stored).alias("is_stored"),
                F.col("col_name").alias("column_name"),
                "data_type",
                F.lit(m.spark.table(name).count()).alias("n_rows"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _colocated(m: Models) -> dict[str, DataFrame]:
    items = marts_v1.item_dollars(m.priced())
    schema = _scratch_schema(m.spark)
    counted = [m.star.table(name) for name in ("customer", "orders", "lineitem")]
    return colocated.build(m.customers(), m.orders(), items, schema, COLOCATED_BUCKETS, counted)


def _check_sentiment(m: Models) -> DataFrame:
    mart = sentiment.product_sentiment(m.tweets(), m.dictionary(), m.lexicon())
    return quality.evaluate(
        {"product_sentiment": written(mart, "product_sentiment")}, catalogue.sentiment_rules()
    )


def _scratch_schema(spark: SparkSession) -> str:
    """A schema of its own in the shared folder."""
    path = scratch_path(spark, "schema")
    name = "martloom_" + path.rsplit("-", 1)[1]
    tables.ensure_schema(spark, name, path)
    return name


def _incremental_rerun(m: Models) -> DataFrame:
    """Load every day into a stored table, rebuild a range three times, and read the table."""
    name = tables.qualify("events", _scratch_schema(m.spark))
    incremental.create_day_table(m.seed(), name)
    # The second pass sees a source without errors: the range shrinks, the other days must stay.
    corrected = m.star.seed_events(F.col("event_type") != "error")
    for source in (m.seed(), corrected, corrected):
        incremental.rebuild_range(source, name, *RANGE)
    return m.spark.table(name).select("id", "item_id", "event_date")


def _rebuild_atomic(m: Models) -> DataFrame:
    """As above, in a table whose range is replaced at once; its days that lost all rows go too."""
    name = tables.qualify("events", _scratch_schema(m.spark))
    versions.create(m.seed(), name)
    corrected = m.star.seed_events(F.col("event_type") != "error")
    for source in (m.seed(), corrected, corrected.filter(F.col("event_date") != RANGE[0])):
        versions.replace_range(source, name, *RANGE)
    versions.vacuum(m.spark, name)
    return m.spark.table(name).select("id", "item_id", "event_date")


def _full_model_from_days(m: Models) -> DataFrame:
    """Distinct ids per item from daily states, after the first day of the range has lost its errors
    and its state alone has been made again."""
    name = tables.qualify("event_sets", _scratch_schema(m.spark))
    versions.create(distinct_state.daily_sets(m.seed()), name)
    day = F.col("event_date") == F.lit(RANGE[0])
    corrected = m.star.seed_events(F.col("event_type") != "error").filter(day)
    versions.replace_days(distinct_state.daily_sets(corrected), name, [RANGE[0]])
    return distinct_state.merged_counts(m.spark.table(name))


def _delta(m: Models) -> tuple[DataFrame, DataFrame]:
    """Both marts after one order in a hundred has lost its items, and half of these got others."""
    schema = _scratch_schema(m.spark)
    names = tables.qualify("order_states", schema), tables.qualify("customers", schema)
    economics = bounded(written(m.economics(), "economics"))
    priced = lambda items, *extra: marts_v1.item_dollars(priced_items(items, economics), extra)
    delta.create(m.customers(), m.orders(), priced(m.items()), *names, DELTA_BUCKETS)
    old = m.items().filter(F.col("order_id") % 100 == 7).withColumn("sign", F.lit(-1))
    other = (F.col("product_id") % 100 + 1).cast(old.schema["product_id"].dataType)
    new = old.filter(F.col("order_id") % 200 == 7).withColumn("product_id", other).withColumn("sign", F.lit(1))
    changes = written(priced(old.unionByName(new), "sign"), "changes")
    delta.apply(m.customers(), m.orders(), changes, "one in a hundred", *names, DELTA_BUCKETS)
    orders, customers = map(m.spark.table, names)
    return delta.orders_mart(orders), customers.drop("bucket")


def _catch_up_emptied_day(m: Models) -> DataFrame:
    """Catch up, then rebuild a listed day that has lost all its rows, and one that has not."""
    schema = _scratch_schema(m.spark)
    name, log = tables.qualify("events", schema), tables.qualify("run_log", schema)
    incremental.catch_up(m.seed(), name, "events", log, *RANGE, dt.datetime.fromisoformat(AS_OF))
    days = m.spark.createDataFrame([(d,) for d in RANGE], "event_date DATE")
    incremental.rebuild_days(m.seed().filter(F.col("event_date") != RANGE[1]), days, name)
    return m.spark.table(name).select("id", "item_id", "event_date")


def _catch_up(m: Models) -> DataFrame:
    """Build the days up to the middle of the range, then catch up with the rest."""
    schema = _scratch_schema(m.spark)
    name, log = tables.qualify("events", schema), tables.qualify("run_log", schema)
    start, end = RANGE
    now = dt.datetime.fromisoformat(AS_OF)
    for last in (start + (end - start) / 2, end):
        incremental.catch_up(m.seed(), name, "events", log, start, last, now)
    return m.spark.table(name).select("id", "item_id", "event_date")


def _streamed(m: Models) -> DataFrame:
    """Land the events in two waves of files and drain each into the day table."""
    landing = scratch_path(m.spark, "landing")
    checkpoint = scratch_path(m.spark, "stream")
    name = tables.qualify("events", _scratch_schema(m.spark))
    late = F.col("event_type") == "error"
    for where in (~late, late):
        # The stream's schema is narrower than the adapter's, so the keys are cast.
        wave = m.star.seed_events(where).select(
            *[F.col(f.name).cast(f.dataType) for f in SEED_EVENTS.schema.fields]
        )
        wave.write.mode("append").parquet(landing)
        drain_landing(m.spark, landing, name, checkpoint)
    return m.spark.table(name).select("id", "item_id", "event_date")


def _as_csv(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    files.export_csv(df, path)
    return path


def _typed_tweets(m: Models) -> DataFrame:
    """Tweets through text files and back, line breaks included."""
    return files.typed_tweets(files.csv_all_text(m.spark, _as_csv(m.raw("raw_tweets"), "tweets")))


def _write_replace(m: Models) -> DataFrame:
    """Replace a table by one with other columns, then read it."""
    name = tables.qualify("orders", _scratch_schema(m.spark))
    for frame in (m.customers(), m.orders()):
        tables.write_replace(frame, name)
    return tables.read_table(m.spark, name)


def _truncate_load(m: Models) -> DataFrame:
    """Load a table twice, the second time with its columns in another order."""
    name = tables.qualify("customers", _scratch_schema(m.spark))
    first = m.customers().withColumn("customer_name", F.upper("customer_name"))
    for frame in (first, m.customers().select("customer_name", "customer_id")):
        tables.write_truncate_load(frame, name)
    return tables.read_table(m.spark, name)


def _keyed_load(m: Models) -> DataFrame:
    """Full refresh from the files of a glob, key checked, run twice."""
    path = _as_csv(m.star.raw_customers(), "customers")
    name = tables.qualify("raw_customers", _scratch_schema(m.spark))
    for _ in range(2):
        tables.keyed_load(m.spark, LANDING["raw_customers"], f"{path}/*.csv", name)
    return tables.read_table(m.spark, name)


def _csv_roundtrip(m: Models) -> DataFrame:
    path = scratch_path(m.spark, "customers-csv")
    mart = m.v1_customers()
    files.export_csv(mart, path)
    return m.spark.read.options(**files.CSV_FORMAT, mode="FAILFAST").schema(mart.schema).csv(path)


def _json_roundtrip(m: Models) -> DataFrame:
    path = scratch_path(m.spark, "products-json")
    mart = marts_v1.products(m.products())
    files.export_json(mart, path)
    return m.spark.read.schema(mart.schema).json(path)


def _parquet_roundtrip(m: Models) -> DataFrame:
    path = scratch_path(m.spark, "orders-parquet")
    files.export_parquet(m.v1_orders(), path)
    return files.parquet_scan(m.spark, path)


QUERIES: dict[str, Query] = {
    # Staging
    "stg_customers": _models(Models.customers),
    "stg_orders": _models(Models.orders),
    "stg_order_items": _models(Models.items),
    "stg_products": _models(Models.products),
    "stg_stores": _models(Models.stores),
    "stg_supplies": _models(Models.supplies),
    "stg_tweets": _models(Models.tweets),
    # Marts in dollars
    "v1_order_items": _models(Models.v1_order_items),
    "v1_orders": _models(Models.v1_orders),
    "v1_customers": _models(Models.v1_customers),
    "v1_order_items_literal": _models(lambda m: m.v1_order_items(literal_macro=True)),
    "v1_orders_literal": _models(lambda m: m.v1_orders(literal_macro=True)),
    "v1_customers_literal": _models(lambda m: m.v1_customers(literal_macro=True)),
    "mart_products": _models(lambda m: marts_v1.products(m.products())),
    "mart_supplies": _models(lambda m: marts_v1.supplies(m.supplies())),
    "mart_tweets": _models(lambda m: marts_v1.tweets(m.tweets())),
    # Marts in cents
    "v2_order_items": _models(
        lambda m: marts_v2.order_items(m.items(), m.orders(), m.products(), m.supplies())
    ),
    "v2_orders": _models(lambda m: marts_v2.orders(m.orders(), m.priced())),
    # The same numbers with nearly every customer treated as hot.
    "v2_orders_hot_keys": _models(lambda m: marts_v2.orders(m.orders(), m.priced(), hot_rows=5)),
    "v2_customers": _models(lambda m: marts_v2.customers(m.customers(), m.orders())),
    "supply_cost_by_product": _models(lambda m: supply_cost_by_product(m.supplies())),
    "fn_cents_to_dollars": _models(_fn_cents_to_dollars),
    # Reports
    "report_top_customers": _models(lambda m: reports.top_customers(m.v1_customers())),
    "report_sales_by_type_month": _models(
        lambda m: reports.sales_by_type_month(m.items(), m.orders(), m.economics())
    ),
    "report_store_performance": _models(
        lambda m: reports.store_performance(m.v1_orders(), m.stores())
    ),
    "report_profitable_products": _models(
        lambda m: reports.profitable_products(m.items(), m.economics())
    ),
    # Text
    "mention_extract": _models(lambda m: mentions.extract_mentions(m.tweets(), m.dictionary())),
    "mention_extract_blocks": _models(
        lambda m: mentions.block_mentions(
            m.tweets(), m.dictionary(), "id", "content", "product_name"
        )
    ),
    "mention_large_dictionary": _models(_mention_large),
    # Ids that repeat or are missing, by either way of matching.
    "mention_repeated_ids": _repeated_sentiment(64),
    "mention_repeated_ids_blocks": _repeated_sentiment(0),
    "lexicon_score": _models(lambda m: sentiment.lexicon_scores(m.tweets(), m.lexicon())),
    "sentiment_rules_score": _models(_sentiment_rules_score),
    "sentiment_bins": _models(_sentiment_bins),
    "mention_stats": _models(
        lambda m: sentiment.mention_stats(_mention_scores(m)).drop("sentiment_category")
    ),
    "product_sentiment": _models(
        lambda m: sentiment.product_sentiment(m.tweets(), m.dictionary(), m.lexicon())
    ),
    # Incremental, run log, freshness
    "seed_events": _models(Models.seed),
    "incremental_range": _models(lambda m: incremental.in_range(m.seed(), *map(F.lit, RANGE))),
    "incremental_rerun": _models(_incremental_rerun),
    "full_model": _models(full_model),
    "missing_intervals": _models(_missing_intervals),
    "last_materialized": _models(
        lambda m: incremental.last_materialised(m.run_models(), m.runs())
    ),
    "parse_model_name": _models(_parse_model_name),
    "freshness": _models(_freshness),
    "freshness_policies": _models(_freshness_policies),
    "catch_up": _models(_catch_up),
    "catch_up_emptied_day": _models(_catch_up_emptied_day),
    "delta_orders": _models(lambda m: _delta(m)[0]),
    "delta_customers": _models(lambda m: _delta(m)[1]),
    "colocated_orders": _models(lambda m: _colocated(m)["orders"]),
    "colocated_customers": _models(lambda m: _colocated(m)["customers"]),
    "rebuild_atomic": _models(_rebuild_atomic),
    "full_model_from_days": _models(_full_model_from_days),
    "streamed_landing": _models(_streamed),
    # Scans, tables and exports, each written to the shared folder and read back
    "csv_scan": _models(
        lambda m: files.csv_scan(
            m.spark, LANDING["raw_products"], _as_csv(m.star.raw_products(), "products")
        )
    ),
    "csv_all_text": _models(
        lambda m: files.csv_all_text(m.spark, _as_csv(m.star.raw_stores(), "stores"))
    ),
    "typed_tweets": _models(_typed_tweets),
    "seed_load": _models(
        lambda m: files.seed(m.spark, SEED_EVENTS, _as_csv(m.seed(), "seed"))
    ),
    "keyed_load": _models(_keyed_load),
    "materialize_kinds": _models(_materialize_kinds),
    "qualify_name": _models(_qualify_name),
    "flush_schema": _models(_flush_schema),
    "catalog_list": _models(_catalog_list),
    "write_replace": _models(_write_replace),
    "write_truncate_load": _models(_truncate_load),
    "export_csv": _models(_csv_roundtrip),
    "export_json": _models(_json_roundtrip),
    "export_parquet": _models(_parquet_roundtrip),
    # Quality
    **{key: _staged_check(rules) for key, rules in STAGED_CHECKS.items()},
    "failing_relationships": _models(lambda m: quality.failing_rows(m.staged(), ORPHANS)),
    "failing_unique_combo": _models(lambda m: quality.failing_rows(m.staged(), REPEATED)),
    "audit_negative_items": _models(
        lambda m: quality.audit("positive_item_ids", full_model(m), F.col("item_id") < 0)
    ),
    "audit_negative_balance": _models(
        lambda m: quality.audit(
            "negative_balance", m.star.table("customer"), F.col("c_acctbal") < 0
        )
    ),
    "check_required_columns": _models(lambda m: quality.evaluate(m.staged(), REQUIRED)),
    "contract_check": _models(_contract_check),
    "gate_blocks": _models(_gate_blocks),
    "publish_observed": _models(_publish_observed),
    "check_sentiment": _models(_check_sentiment),
    "check_all": _models(_check_all, stored=True),
    "check_verdict": _models(
        lambda m: quality.verdict(
            quality.evaluate(
                {**m.landing(), **m.staged()},
                catalogue.landing_rules() + catalogue.staging_rules(PRODUCT_TYPES),
            )
        ),
        stored=True,
    ),
}
