import datetime as dt

import pytest
from pyspark.testing import assertDataFrameEqual

from martloom.operators import freshness, incremental
from martloom.operators.quality import QualityError
from martloom.schemas import SEED_EVENTS
from martloom.session import scratch_path
from martloom.sources.files import seed
from martloom.streaming.landing import drain_landing
from pyspark.sql import functions as F


def day(n: int) -> dt.date:
    return dt.date(2020, 1, n)


SEED = [
    (1, 2, day(1)),
    (2, 1, day(1)),
    (3, 3, day(3)),
    (4, 1, day(4)),
    (5, 1, day(5)),
    (6, 1, day(6)),
    (7, 1, day(7)),
]


def seed_frame(spark, rows=SEED):
    return spark.createDataFrame(rows, SEED_EVENTS.schema)


def test_seed_load_and_grain(spark, tmp_path):
    text = "id,item_id,event_date\n" + "".join(f"{a},{b},{c}\n" for a, b, c in SEED)
    path = tmp_path / "seed.csv"
    path.write_text(text)
    assertDataFrameEqual(seed(spark, SEED_EVENTS, str(path)), seed_frame(spark))
    path.write_text(text + "7,9,2020-01-07\n")
    with pytest.raises(QualityError):
        seed(spark, SEED_EVENTS, str(path))
    path.write_text(text + "8,x,2020-01-07\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        seed(spark, SEED_EVENTS, str(path)).collect()


def test_range_is_inclusive(spark):
    found = incremental.in_range(seed_frame(spark), F.lit(day(1)), F.lit(day(3)))
    assert sorted(r.id for r in found.collect()) == [1, 2, 3]


def test_full_model(spark):
    rows = [(1, 1, None), (2, 1, None), (3, 2, None)]
    expected = spark.createDataFrame([(1, 2), (2, 1)], "item_id INT, num_orders BIGINT")
    found = incremental.orders_per_item(seed_frame(spark, rows))
    assertDataFrameEqual(found, expected, ignoreNullable=True)
    counts = incremental.orders_per_item(seed_frame(spark)).collect()
    assert {r.item_id: r.num_orders for r in counts} == {1: 5, 2: 1, 3: 1}


def stored(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("id", "item_id", "event_date").collect())


def test_incremental_rerun(spark):
    table = "rerun_events"
    incremental.rebuild_range(seed_frame(spark), table, day(1), day(7))
    assert stored(spark, table) == SEED
    # Days 3 and 4 are corrected, day 5 becomes empty, day 6 lies outside the range.
    corrected = seed_frame(spark, [(3, 9, day(3)), (30, 9, day(3)), (4, 9, day(4)), (6, 9, day(6))])
    expected = sorted([*SEED[:2], (3, 9, day(3)), (30, 9, day(3)), (4, 9, day(4)), *SEED[5:]])
    for _ in range(2):
        incremental.rebuild_range(corrected, table, day(3), day(5))
        assert stored(spark, table) == expected


def test_range_over_plain_partitioned_table(spark):
    """A table made elsewhere keeps its other days too."""
    seed_frame(spark).write.partitionBy("event_date").saveAsTable("plain_events")
    incremental.rebuild_range(seed_frame(spark, [(9, 9, day(4))]), "plain_events", day(4), day(4))
    assert stored(spark, "plain_events") == sorted([*SEED[:3], (9, 9, day(4)), *SEED[4:]])


def test_streamed_landing(spark, tmp_path):
    folder, checkpoint = str(tmp_path / "landing"), scratch_path(spark, "stream")
    seed_frame(spark, SEED[:4]).write.parquet(folder)
    drain_landing(spark, folder, "streamed_events", checkpoint)
    assert stored(spark, "streamed_events") == SEED[:4]
    # A late file for day 1 and a new day.
    late = [(70, 7, day(1)), (5, 1, day(5))]
    seed_frame(spark, late).write.mode("append").parquet(folder)
    drain_landing(spark, folder, "streamed_events", checkpoint)
    assert stored(spark, "streamed_events") == sorted([*SEED[:4], *late])
    drain_landing(spark, folder, "streamed_events", checkpoint)
    assert len(stored(spark, "streamed_events")) == 6


def test_missing_intervals(spark):
    models = spark.createDataFrame(
        [("a", day(1), day(5)), ("b", day(1), day(2))], "model STRING, start_day DATE, end_day DATE"
    )
    log = spark.createDataFrame(
        [("a", day(1), day(3)), ("a", day(4), day(5)), ("a", day(4), day(4))],
        "model STRING, interval_start DATE, interval_end DATE",
    )
    found = incremental.missing_intervals(models, log).collect()
    assert sorted((r.model, r.day.day) for r in found) == [("a", 3), ("a", 5), ("b", 1), ("b", 2)]


def test_catch_up(spark):
    now = dt.datetime(2020, 2, 1)
    source = seed_frame(spark)

    def run(rows, end):
        return incremental.catch_up(rows, "caught", "m", "caught_log", day(1), end, now)

    assert run(source, day(3)) == [day(1), day(2), day(3)]
    assert stored(spark, "caught") == SEED[:3]
    # Days already logged are not built again, even if the source changed.
    changed = seed_frame(spark, [(99, 9, day(1)), *SEED[3:]])
    assert run(changed, day(4)) == [day(4)]
    assert run(changed, day(4)) == []
    assert stored(spark, "caught") == SEED[:4]


def test_deadlines(spark):
    policies = spark.createDataFrame(
        [("tweets", 60, "warn", 300), ("orders", 60, "error", None)], freshness.POLICY_DDL
    )
    log = spark.createDataFrame(
        [(n, dt.datetime(2024, 1, 1, 11, 59, 30)) for n in ("tweets", "orders")],
        "dataset STRING, finished_at TIMESTAMP_NTZ",
    )
    # 12:04 is judged at the 12:00 deadline where there is one.
    as_of = F.lit(dt.datetime(2024, 1, 1, 12, 4)).cast("timestamp_ntz")
    rows = {r.dataset: r for r in freshness.freshness(log, policies, as_of).collect()}
    assert (rows["tweets"].lag_seconds, rows["tweets"].passed) == (30, True)
    assert (rows["orders"].lag_seconds, rows["orders"].passed) == (270, False)


def test_last_materialised(spark):
    models = spark.createDataFrame([('"m"."x"',), ('"m"."y"',)], "model STRING")
    log = spark.createDataFrame(
        [('"m"."x"', 1000), ('"m"."x"', 61_500), ('"m"."x"', 2000)], "model STRING, end_ms BIGINT"
    )
    rows = {r.model_path: r for r in incremental.last_materialised(models, log).collect()}
    assert rows["m/x"].last_end_ms == 61_500
    assert rows["m/x"].label == "1970-01-01 00:01:01 (UTC)"
    assert rows["m/y"].last_end_at is None and rows["m/y"].label == "never materialized"


def test_freshness(spark):
    now = dt.datetime(2024, 1, 1, 12)
    log = spark.createDataFrame(
        [
            ("orders", now - dt.timedelta(seconds=180)),
            ("orders", now - dt.timedelta(hours=9)),
            ("customers", now - dt.timedelta(seconds=181)),
        ],
        "dataset STRING, finished_at TIMESTAMP_NTZ",
    )
    policies = spark.createDataFrame(freshness.mart_policies(), freshness.POLICY_DDL)
    rows = freshness.freshness(log, policies, F.lit(now).cast("timestamp_ntz")).collect()
    passed = {r.dataset: r.passed for r in rows}
    assert passed == {name: name == "orders" for name in freshness.MARTS}
    assert {r.dataset: r.lag_seconds for r in rows}["customers"] == 181


def test_a_listed_day_without_rows_is_emptied(spark):
    rows = [(1, 1, dt.date(2024, 1, 1)), (2, 1, dt.date(2024, 1, 2)), (3, 1, None)]
    df = spark.createDataFrame(rows, "id INT, item_id INT, event_date DATE")
    name = "default.emptied_days"
    incremental.create_day_table(df, name)
    days = spark.createDataFrame([(dt.date(2024, 1, 2),), (dt.date(2024, 1, 9),), (None,)], "event_date DATE")
    incremental.rebuild_days(df.filter("id <> 2"), days, name)
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 3]
    # A partition of rows without a day does not get in the way of a range.
    incremental.rebuild_range(df.filter("id = 2"), name, dt.date(2024, 1, 1), dt.date(2024, 1, 5))
    assert sorted(r.id for r in spark.table(name).collect()) == [2, 3]


def test_a_start_after_the_end_is_no_day(spark):
    models = [("late", dt.date(2024, 2, 1), dt.date(2024, 1, 1)), ("due", dt.date(2024, 1, 1), dt.date(2024, 1, 1))]
    frame = spark.createDataFrame(models, "model STRING, start_day DATE, end_day DATE")
    assert [r.model for r in incremental.expected_days(frame).collect()] == ["due"]
