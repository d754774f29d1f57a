import datetime as dt

import pytest
from pyspark.testing import assertDataFrameEqual

from martloom.operators.contract import ContractError, contract_report, enforce_contract
from martloom.operators.quality import QualityError
from martloom.schemas import LANDING
from martloom.session import written
from martloom.sources import files, tables

PRODUCTS = '''sku,name,type,price,description
P-1,plain,food,1100,simple
P-2,odd,food,1200,"pulled pork, in a bun"
P-3,trailing ,drink,700,daily
'''


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_scan(spark, tmp_path):
    path = write(tmp_path / "p.csv", PRODUCTS)
    rows = files.csv_scan(spark, LANDING["raw_products"], path).collect()
    assert rows[1].description == "pulled pork, in a bun"
    assert rows[2].name == "trailing "
    assert rows[0].price == 1100
    stores = write(tmp_path / "s.csv", "id,name,opened_at,tax_rate\ns,N,2018-09-01T00:00:00,0.06\n")
    row = files.csv_scan(spark, LANDING["raw_stores"], stores).first()
    assert row.opened_at == dt.datetime(2018, 9, 1) and row.tax_rate == 0.06
    supplies = write(tmp_path / "u.csv", "id,name,cost,perishable,sku\nu,n,7,False,P-1\nu,n,7,True,P-2\n")
    assert [r.perishable for r in files.csv_scan(spark, LANDING["raw_supplies"], supplies).collect()] == [
        False,
        True,
    ]


def test_csv_quotes_and_breaks(spark, tmp_path):
    text = 'id,name\n1,"said ""hi"", twice"\n2,"two\nlines"\n'
    path = write(tmp_path / "q.csv", text)
    rows = files.csv_scan(spark, LANDING["raw_customers"], path, multi_line=True).collect()
    assert [r.name for r in rows] == ['said "hi", twice', "two\nlines"]


def test_header_must_match(spark, tmp_path):
    path = write(tmp_path / "h.csv", "name,id\nAnn,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.csv_scan(spark, LANDING["raw_customers"], path).collect()


def test_trim_names(spark, tmp_path):
    from martloom.plans.staging import stg_products

    raw = files.csv_scan(spark, LANDING["raw_products"], write(tmp_path / "p.csv", PRODUCTS))
    assert [r.product_name for r in stg_products(raw).collect()][2] == "trailing "
    assert [r.product_name for r in stg_products(raw, trim_names=True).collect()][2] == "trailing"


TWEETS = "id,user_id,tweeted_at,content\n1,7,2024-01-01 10:00:00,hello\n"


def test_all_text_and_contract(spark, tmp_path):
    spec = LANDING["raw_tweets"]
    text = files.csv_all_text(spark, write(tmp_path / "t.csv", TWEETS))
    assert {f.dataType.simpleString() for f in text.schema} == {"string"}
    typed = written(files.typed_tweets(text), "typed_tweets")
    assert enforce_contract(typed, spec).count() == 1
    status = {r.column: r.status for r in contract_report(text, spec).collect()}
    assert status == {"id": "ok", "user_id": "ok", "tweeted_at": "type_mismatch", "content": "ok"}
    with pytest.raises(ContractError, match="tweeted_at: type_mismatch"):
        enforce_contract(text, spec)
    with pytest.raises(ContractError, match="content: missing.*extra: unexpected"):
        enforce_contract(typed.withColumnRenamed("content", "extra"), spec)
    holes = typed.selectExpr("id", "user_id", "tweeted_at", "nullif(content, 'hello') AS content")
    with pytest.raises(ContractError, match="content not_null"):
        enforce_contract(holes, spec)


def test_exports(spark, tmp_path):
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame(
        [
            (1, " a, b ", None, at, at.astimezone(dt.timezone.utc)),
            (2, 'say "c" \\ d', 1.5, None, None),
        ],
        "id INT, s STRING, d DOUBLE, n TIMESTAMP_NTZ, z TIMESTAMP",
    )
    files.export_parquet(df, str(tmp_path / "p"))
    assertDataFrameEqual(files.parquet_scan(spark, str(tmp_path / "p")), df)
    files.export_csv(df, str(tmp_path / "c"))
    assertDataFrameEqual(
        spark.read.options(**files.CSV_FORMAT).schema(df.schema).csv(str(tmp_path / "c")), df
    )
    files.export_json(df, str(tmp_path / "j"))
    assertDataFrameEqual(spark.read.schema(df.schema).json(str(tmp_path / "j")), df)


def test_replace_and_truncate_load(spark):
    tables.ensure_schema(spark, "main")
    first = spark.createDataFrame([(1, "x")], "id INT, s STRING")
    tables.write_truncate_load(first, "main.loaded")
    again = spark.createDataFrame([("y", 2), ("z", 3)], "s STRING, id INT")
    tables.write_truncate_load(again, "main.loaded")
    loaded = tables.read_table(spark, "main.loaded")
    assert loaded.columns == ["id", "s"]
    assert sorted(tuple(r) for r in loaded.collect()) == [(2, "y"), (3, "z")]
    tables.write_replace(spark.createDataFrame([(1.5,)], "d DOUBLE"), "main.loaded")
    assert tables.read_table(spark, "main.loaded").columns == ["d"]


def test_keyed_load(spark, tmp_path):
    tables.ensure_schema(spark, "main")
    spec = LANDING["raw_customers"]
    write(tmp_path / "a.csv", "id,name\n1,Ann\n")
    write(tmp_path / "b.csv", "id,name\n2,Bo\n")
    for _ in range(2):
        tables.keyed_load(spark, spec, str(tmp_path / "*.csv"), "main.raw_customers")
        assert spark.table("main.raw_customers").count() == 2
    write(tmp_path / "c.csv", "id,name\n2,Again\n")
    with pytest.raises(QualityError):
        tables.keyed_load(spark, spec, str(tmp_path / "*.csv"), "main.raw_customers")
    assert spark.table("main.raw_customers").count() == 2


def test_qualify():
    assert tables.qualify("orders") == "main.orders"
    assert tables.qualify("orders", " other ") == "other.orders"


def test_materialise_and_flush(spark):
    df = spark.range(3)
    assert tables.materialise(df, "lazy_ids", "view").count() == 3
    assert tables.materialise(df, "ids", "table", "flushme").count() == 3
    tables.materialise(df, "ids2", "table", "flushme")
    spark.sql("CREATE OR REPLACE VIEW flushme.v AS SELECT * FROM flushme.ids")
    with pytest.raises(ValueError):
        tables.materialise(df, "x", "other")
    assert "flushme" in {r[0] for r in tables.list_schemas(spark).collect()}
    assert {"ids", "ids2"} <= {r.tableName for r in tables.list_tables(spark, "flushme").collect()}
    assert tables.describe(spark, "flushme.ids").first().col_name == "id"
    assert tables.flush_schema(spark, "flushme") == ["ids", "ids2"]
    assert spark.table("flushme.ids").count() == 0 and spark.table("flushme.ids2").count() == 0
    tables.ensure_schema(spark, "void")
    assert tables.flush_schema(spark, "void") == []


def test_truncate_load_leaves_no_partition(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, day STRING")
    df.write.option("partitionOverwriteMode", "dynamic").partitionBy("day").saveAsTable("default.by_day")
    tables.write_truncate_load(df.filter("id = 2"), "default.by_day")
    assert [r.id for r in spark.table("default.by_day").collect()] == [2]


def test_line_breaks_in_texts(spark, tmp_path):
    rows = [("1", "first\nsecond, \"quoted\"\r\nthird"), ("2", "plain")]
    df = spark.createDataFrame(rows, "id STRING, content STRING")
    files.export_csv(df, str(tmp_path / "texts"))
    back = files.csv_all_text(spark, str(tmp_path / "texts"))
    assert sorted(map(tuple, back.collect())) == rows
