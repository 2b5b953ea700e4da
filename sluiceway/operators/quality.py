"""Declared data-quality checks and their report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

REPORT = "table_name STRING, column_name STRING, check_name STRING, failures BIGINT"


@dataclass(frozen=True)
class Checks:
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Failing rows."""
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; NULL is not checked."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def _report_row(name: str, column: str, check: str, failures) -> list:
    return [
        F.lit(name).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"),
        failures.cast("bigint").alias("failures"),
    ]


def null_measures(checks: Checks) -> list[Column]:
    """Failures of the not-null checks, to be counted while a table is written."""
    return [F.count_if(F.col(name).isNull()).alias(name) for name in checks.not_null]


def observed_report(
    measured: Mapping[str, Observation], checks: Mapping[str, Checks]
) -> dict[str, dict[str, int]]:
    """Failures by table and column, of the tables that were measured."""
    return {name: dict(measured[name].get) for name in measured if checks.get(name)}


def table_report(
    name: str, df: DataFrame, checks: Checks, observed: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per check. All not-null checks of a table share one pass over it, or none where
    their failures were observed while it was written; a unique check reads its column."""
    parts = []
    if checks.not_null:
        if observed is None:
            counted = df.agg(*null_measures(checks))
            failures = {column: F.col(column) for column in checks.not_null}
        else:
            counted = df.sparkSession.range(1)
            failures = {column: F.lit(observed[column]) for column in checks.not_null}
        rows = [F.struct(*_report_row(name, c, "not_null", failures[c])) for c in checks.not_null]
        parts.append(counted.select(F.inline(F.array(*rows))))
    for column in checks.unique:
        failures = check_unique(df, column).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(failures.select(*_report_row(name, column, "unique", F.col("failures"))))
    return reduce(DataFrame.unionByName, parts)


def quality_report(
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, Checks],
    observed: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """Report over every table that declares a check. ``observed`` has what is known of its
    not-null checks already."""
    observed = observed or {}
    parts = [
        table_report(name, df, checks[name], observed.get(name))
        for name, df in tables.items()
        if name in checks and (checks[name].not_null or checks[name].unique)
    ]
    if not parts:
        raise ValueError("no check is declared for these tables")
    return reduce(DataFrame.unionByName, parts)


def failing_rows(df: DataFrame, checks: Checks) -> DataFrame:
    """Rows that fail a check, as JSON text with the check's column and name; a row that fails
    several is there for each."""
    text = F.to_json(F.struct(*df.columns)).alias("row")

    def marked(rows: DataFrame, column: str, check: str) -> DataFrame:
        return rows.select(F.lit(column).alias("column_name"), F.lit(check).alias("check_name"), text)

    parts = [marked(check_not_null(df, column), column, "not_null") for column in checks.not_null]
    for column in checks.unique:
        repeated = check_unique(df, column).select(column)
        parts.append(marked(df.join(repeated, column, "left_semi"), column, "unique"))
    return reduce(DataFrame.unionByName, parts)


def write_failures(
    tables: Mapping[str, DataFrame], checks: Mapping[str, Checks], path: str
) -> None:
    """Replace the failing rows below ``path``, a folder per table."""
    for name, df in tables.items():
        failing_rows(df, checks[name]).write.mode("overwrite").json(f"{path}/{name}")
