"""Aggregate expressions shared by the models."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sluiceway.functions.columns import _col


def count_all() -> Column:
    return F.count(F.lit(1))


def sum_as_double(value: Column | str) -> Column:
    return F.sum(_col(value)).cast("double")


def avg_as_double(value: Column | str) -> Column:
    return F.avg(_col(value)).cast("double")


def conditional_count(condition: Column) -> Column:
    """Rows for which the condition holds, as BIGINT; NULL conditions do not count."""
    return F.sum(F.when(condition, 1).otherwise(0))


def conditional_sum(condition: Column, value: Column | str) -> Column:
    """Sum over the rows for which the condition holds, 0 where none does."""
    return F.sum(F.when(condition, _col(value)).otherwise(0)).cast("double")


def conditional_avg(condition: Column, value: Column | str) -> Column:
    """Mean over the rows for which the condition holds, NULL where none does."""
    return F.avg(F.when(condition, _col(value))).cast("double")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0))


def mean_of_means(value: Column | str) -> Column:
    """Mean of doubles that does not depend on their order: they are added as decimals."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(value.cast("decimal(38,9)")).cast("double") / F.count(value)
