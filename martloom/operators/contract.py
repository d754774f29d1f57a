"""Schema contracts: names, types and required columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.quality import QualityError, Rule, evaluate
from martloom.schemas import TableSpec


class ContractError(RuntimeError):
    """Raised when a frame does not keep its contract."""


def contract_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per column of either side: column, expected, actual, status."""
    expected = {f.name: f.dataType.simpleString() for f in spec.schema.fields}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def status(name: str) -> str:
        if name not in actual:
            return "missing"
        if name not in expected:
            return "unexpected"
        return "ok" if actual[name] == expected[name] else "type_mismatch"

    rows = [
        (name, expected.get(name), actual.get(name), status(name))
        for name in dict.fromkeys([*expected, *actual])
    ]
    return df.sparkSession.createDataFrame(
        rows, "column STRING, expected STRING, actual STRING, status STRING"
    )


def enforce_contract(
    df: DataFrame, spec: TableSpec, required: tuple[str, ...] | None = None
) -> DataFrame:
    """Return ``df`` when schema and required values hold; raise with every deviation otherwise."""
    broken = contract_report(df, spec).filter(F.col("status") != "ok").collect()
    if broken:
        raise ContractError(
            "; ".join(f"{r.column}: {r.status} (expected {r.expected}, got {r.actual})" for r in broken)
        )
    columns = spec.columns if required is None else required
    results = evaluate({spec.name: df}, [Rule.not_null(spec.name, c) for c in columns])
    failures = results.filter(~F.col("passed")).collect()
    if failures:
        raise ContractError(str(QualityError(failures)))
    return df
