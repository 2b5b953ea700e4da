"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def newest_rank(
    partition_by: Sequence[str], newest_first: Sequence[str], tiebreak: Sequence[str] = ()
) -> Column:
    """``row_number`` with the newest row first and NULL ordering values last."""
    order = [F.desc_nulls_last(name) for name in (*newest_first, *tiebreak)]
    return F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order))


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the one with the highest ordering values.

    Rank and filter stay adjacent so that Spark plans a window group limit: every task
    keeps one row per key before the shuffle, and a key holding any share of the input
    sends one row per task. Without ``tiebreak`` rows with equal ordering values have no
    defined winner.
    """
    return (
        df.withColumn("_newest_rank", newest_rank(keys, newest_first, tiebreak))
        .where(F.col("_newest_rank") == 1)
        .drop("_newest_rank")
    )
