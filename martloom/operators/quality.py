"""Declarative data-quality rules, evaluated as aggregates.

All row rules of a table share one scan and one global aggregate. Uniqueness and relationships
count per key first, so a hot key is one row before anything is exchanged or joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_DDL = (
    "table_name STRING, column_name STRING, rule STRING, severity STRING, "
    "n_rows BIGINT, n_failed BIGINT, passed BOOLEAN"
)
RESULT_COLUMNS = tuple(part.split()[0] for part in RESULT_DDL.split(", "))

ROW_KINDS = ("not_null", "accepted_values", "accepted_range", "row_count")


@dataclass(frozen=True)
class Rule:
    """One check on one table. ``nulls_fail`` tells whether a NULL breaks the rule, and
    ``nan_is_null`` whether NaN counts as one."""

    table: str
    kind: str
    columns: tuple[str, ...] = ()
    severity: str = "error"
    nulls_fail: bool = False
    nan_is_null: bool = False
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    parent: str = ""
    parent_column: str = ""

    @property
    def label(self) -> str:
        return ",".join(self.columns)

    @classmethod
    def not_null(cls, table: str, column: str, **kw) -> Rule:
        return cls(table, "not_null", (column,), nulls_fail=True, **kw)

    @classmethod
    def unique(cls, table: str, *columns: str, **kw) -> Rule:
        """NULL keys are ignored, or with ``nulls_fail`` counted as equal to each other."""
        kind = "unique" if len(columns) == 1 else "unique_combination"
        return cls(table, kind, columns, **kw)

    @classmethod
    def accepted_values(cls, table: str, column: str, values: Sequence, **kw) -> Rule:
        return cls(table, "accepted_values", (column,), values=tuple(values), **kw)

    @classmethod
    def accepted_range(cls, table: str, column: str, low=None, high=None, **kw) -> Rule:
        """Both ends inclusive; either may be open."""
        return cls(table, "accepted_range", (column,), low=low, high=high, **kw)

    @classmethod
    def relationships(cls, table: str, column: str, parent: str, parent_column: str, **kw) -> Rule:
        """Every non-NULL value must exist in the parent."""
        return cls(
            table, "relationships", (column,), parent=parent, parent_column=parent_column, **kw
        )

    @classmethod
    def row_count(cls, table: str, **kw) -> Rule:
        return cls(table, "row_count", **kw)

    @classmethod
    def required_columns(cls, table: str, *columns: str, **kw) -> Rule:
        return cls(table, "required_columns", columns, **kw)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    if isinstance(value, datetime):
        return f"TIMESTAMP_NTZ '{value}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    return str(value)


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def violation(rule: Rule, kind: str = "") -> str:
    """SQL condition, true on the rows that break a row rule and never NULL. ``kind`` is the
    column's type, where it matters."""
    c = _name(rule.columns[0])
    if rule.nan_is_null and kind in ("float", "double"):
        c = f"nanvl({c}, NULL)"
    if rule.kind == "not_null":
        return f"{c} IS NULL"
    if rule.kind == "accepted_values":
        listed = ", ".join(map(_literal, rule.values))
        bad = f"{c} NOT IN ({listed})" if listed else f"{c} IS NOT NULL"
    elif rule.kind == "accepted_range":
        bounds = [
            f"{c} {op} {_literal(bound)}"
            for op, bound in (("<", rule.low), (">", rule.high))
            if bound is not None
        ]
        bad = " OR ".join(bounds) or "false"
    else:
        raise ValueError(f"{rule.kind} is not a row rule")
    return f"coalesce({bad}, {str(rule.nulls_fail).lower()})"


def _result(rule: Rule, n_rows: str, n_failed: str) -> str:
    """SQL struct of a result row. Whole suites are built of these, one text per rule."""
    return (
        f"named_struct('table_name', {_literal(rule.table)}, 'column_name', {_literal(rule.label)},"
        f" 'rule', {_literal(rule.kind)}, 'severity', {_literal(rule.severity)},"
        f" 'n_rows', bigint({n_rows}), 'n_failed', bigint({n_failed}),"
        f" 'passed', {n_failed} = 0)"
    )


def _result_rows(totals: DataFrame, results: Sequence[str]) -> DataFrame:
    return totals.selectExpr(f"inline(array({', '.join(results)}))")


def _row_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    counts = ["count(1) AS n"]
    results = []
    types = dict(df.dtypes)
    for i, rule in enumerate(rules):
        if rule.kind == "row_count":
            results.append(_result(rule, "n", "int(n = 0)"))
        else:
            counts.append(f"count_if({violation(rule, types[rule.columns[0]])}) AS f{i}")
            results.append(_result(rule, "n", f"f{i}"))
    return _result_rows(df.selectExpr(*counts), results)


def _key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))


def _repeated(rule: Rule) -> str:
    """SQL condition on key counts: a repeated key, with NULL keys ignored unless they count."""
    known = [] if rule.nulls_fail else [f"{_name(c)} IS NOT NULL" for c in rule.columns]
    return " AND ".join(["_n > 1", *known])


def _unique_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rules over the same columns of one table: a single count per key answers all of them."""
    failed = [f"count_if({_repeated(rule)}) AS f{i}" for i, rule in enumerate(rules)]
    totals = _key_counts(df, rules[0].columns).selectExpr("coalesce(sum(_n), 0) AS n", *failed)
    return _result_rows(totals, [_result(rule, "n", f"f{i}") for i, rule in enumerate(rules)])


def _parent_keys(tables: Mapping[str, DataFrame], rule: Rule) -> DataFrame:
    return tables[rule.parent].select(F.col(rule.parent_column).alias("_parent")).distinct()


def _relationship_rule(tables: Mapping[str, DataFrame], rule: Rule) -> DataFrame:
    column = rule.columns[0]
    children = _key_counts(tables[rule.table], [column])
    joined = children.join(
        _parent_keys(tables, rule), F.col(column) == F.col("_parent"), "left"
    )
    orphan = f"{_name(column)} IS NOT NULL AND _parent IS NULL"
    totals = joined.selectExpr(
        "coalesce(sum(_n), 0) AS n", f"coalesce(sum(if({orphan}, _n, 0)), 0) AS f"
    )
    return _result_rows(totals, [_result(rule, "n", "f")])


def _schema_result(df: DataFrame, rule: Rule) -> tuple:
    missing = [c for c in rule.columns if c not in df.columns]
    return rule.table, rule.label, rule.kind, rule.severity, None, len(missing), not missing


def evaluate(tables: Mapping[str, DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """One result row per rule.

    ``n_failed`` counts rows, for uniqueness repeated keys and for required columns missing ones.
    A rule on a column that the table lacks fails with NULL counts instead of raising.
    """
    rules = list(rules)
    spark = next(iter(tables.values())).sparkSession
    parts: list[DataFrame] = []
    fixed: list[tuple] = []
    for table in dict.fromkeys(r.table for r in rules):
        df = tables[table]
        row_rules: list[Rule] = []
        unique_rules: dict[tuple[str, ...], list[Rule]] = {}
        for rule in (r for r in rules if r.table == table):
            if rule.kind == "required_columns":
                fixed.append(_schema_result(df, rule))
            elif any(c not in df.columns for c in rule.columns):
                fixed.append((table, rule.label, rule.kind, rule.severity, None, None, False))
            elif rule.kind in ROW_KINDS:
                row_rules.append(rule)
            elif rule.kind == "relationships":
                parts.append(_relationship_rule(tables, rule))
            else:
                unique_rules.setdefault(rule.columns, []).append(rule)
        parts += [_unique_rules(df, same) for same in unique_rules.values()]
        if row_rules:
            parts.append(_row_rules(df, row_rules))
    if fixed:
        parts.append(spark.createDataFrame(fixed, RESULT_DDL))
    return reduce(DataFrame.unionByName, parts).select(*RESULT_COLUMNS)


def failing_rows(tables: Mapping[str, DataFrame], rule: Rule) -> DataFrame:
    """The rows of the table that break a rule, for drill-down."""
    df = tables[rule.table]
    if rule.kind == "relationships":
        column = rule.columns[0]
        return df.filter(F.col(column).isNotNull()).join(
            _parent_keys(tables, rule), F.col(column) == F.col("_parent"), "left_anti"
        )
    if rule.kind in ("unique", "unique_combination"):
        keys = [F.col(c).alias(f"_k_{c}") for c in rule.columns]
        repeated = _key_counts(df, rule.columns).filter(_repeated(rule)).select(*keys)
        same = reduce(
            lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in rule.columns]
        )
        return df.join(repeated, same, "left_semi")
    return df.filter(violation(rule, dict(df.dtypes).get(rule.label, "")))


def verdict(results: DataFrame) -> DataFrame:
    """Per table: does every error-severity rule pass?"""
    blocking = F.col("severity") == "error"
    return results.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_rules"),
        F.count_if(~F.col("passed")).alias("n_failed_rules"),
        F.bool_and(F.col("passed") | ~blocking).alias("passed"),
    )


class QualityError(RuntimeError):
    """Raised by ``gate``; carries one row per failing rule."""

    def __init__(self, failures: list):
        self.failures = failures
        lines = [f"{r.table_name}.{r.column_name or '*'} {r.rule}: {r.n_failed}" for r in failures]
        super().__init__("failed rules: " + "; ".join(lines))


def gate(results: DataFrame) -> None:
    """Stop the caller when an error-severity rule fails. Reads rule rows only."""
    failures = results.filter(~F.col("passed") & (F.col("severity") == "error")).collect()
    if failures:
        raise QualityError(failures)


def audit(name: str, df: DataFrame, bad: Column) -> DataFrame:
    """One row telling how many rows of a model satisfy a predicate that none should."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_failed")).select(
        F.lit(name).alias("audit"), "n_rows", "n_failed", (F.col("n_failed") == 0).alias("passed")
    )


def audit_passes(df: DataFrame, bad: Column) -> bool:
    """True when no row matches; stops reading at the first that does."""
    return df.filter(bad).isEmpty()
