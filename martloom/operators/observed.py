"""Rules measured in the job that writes a table, and tables that show only what has passed.

Row rules are aggregates, so they ride along as observed metrics of the write and need no scan of their
own. Spark counts the metrics of a task once only in the last stage of a job; so they are placed right
before the files, behind every exchange. The files' own row count has to agree with them, else the rules
are evaluated on the files.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from martloom.operators.quality import RESULT_DDL, ROW_KINDS, Rule, evaluate, gate, violation
from martloom.session import scratch_path


def observable(df: DataFrame, rule: Rule) -> bool:
    """Whether a rule can be measured while the frame is written."""
    return rule.kind in ROW_KINDS and all(c in df.columns for c in rule.columns)


def written_checked(df: DataFrame, path: str, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Write a frame to ``path`` and measure its row rules meanwhile.

    Returns the written table and one result row per rule, as ``quality.evaluate`` gives them. All
    ``rules`` must be row rules on columns that the frame has.
    """
    spark = df.sparkSession
    types = dict(df.dtypes)
    metrics = [F.count(F.lit(1)).alias("n")]
    for i, rule in enumerate(rules):
        if rule.kind != "row_count":
            metrics.append(F.expr(f"count_if({violation(rule, types[rule.columns[0]])})").alias(f"f{i}"))
    seen = Observation()
    df.observe(seen, *metrics).write.parquet(path, compression="zstd")
    table = spark.read.schema(df.schema).parquet(path)
    found = seen.get
    # An empty frame may be planned away together with its metrics.
    if not rules or found.get("n") != table.count():
        return table, evaluate({r.table: table for r in rules}, rules) if rules else _results(table, [])
    rows = []
    for i, rule in enumerate(rules):
        failed = int(found["n"] == 0) if rule.kind == "row_count" else found[f"f{i}"]
        rows.append((rule.table, rule.label, rule.kind, rule.severity, found["n"], failed, failed == 0))
    return table, _results(table, rows)


def _results(df: DataFrame, rows: list[tuple]) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, RESULT_DDL)


def store_and_evaluate(
    frames: Mapping[str, DataFrame], name: str, df: DataFrame, path: str, rules: Sequence[Rule]
) -> tuple[DataFrame, DataFrame]:
    """Write ``df``, table ``name`` of the rules, and evaluate all of them.

    The row rules are measured while writing; uniqueness and relationships read the key columns of the
    files, ``frames`` gives the parents.
    """
    mine = [r for r in rules if observable(df, r)]
    others = [r for r in rules if not observable(df, r)]
    table, results = written_checked(df, path, mine)
    if others:
        results = results.unionByName(evaluate({**frames, name: table}, others))
    return table, results


def publish(
    df: DataFrame, table: str, rules: Sequence[Rule], frames: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Make ``df`` the content of ``table`` if the rules of error severity hold; returns all results.

    The rows are written to a folder of their own and checked there; then the table, a view of that
    folder, is replaced, in one change of the catalogue. When a rule fails, QualityError is raised and
    readers go on seeing the old content. ``df`` may read the table. The rules name the frame by the
    table's own name, without its schema.
    """
    name = table.rsplit(".", 1)[-1]
    path = scratch_path(df.sparkSession, name)
    _, results = store_and_evaluate(frames or {}, name, df, path, rules)
    # The rules that are not measured would be evaluated for the gate and for the caller.
    results = _results(df, [tuple(r) for r in results.collect()])
    gate(results)
    columns = ", ".join(f"`{c}`" for c in df.columns)
    df.sparkSession.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('content' = '{uuid.uuid4().hex}') "
        f"AS SELECT {columns} FROM parquet.`{path}`"
    )
    return results
