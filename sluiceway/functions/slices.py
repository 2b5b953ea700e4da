"""Time-slice arithmetic as column functions.

A slice is a half-open UTC interval ``[slice_start, slice_end)`` on an hour, day, month,
quarter or year grid.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sluiceway.functions.columns import _col

# Fixed values, finest first.
GRANULARITIES = ("hour", "day", "month", "quarter", "year")
ALIGNMENT_POLICIES = ("floor", "ceil", "strict")

_INTERVAL_OF_ONE = {
    "hour": ("hours", 1),
    "day": ("days", 1),
    "month": ("months", 1),
    "quarter": ("months", 3),
    "year": ("years", 1),
}


def check_granularity(granularity: str) -> str:
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {GRANULARITIES}, not {granularity!r}")
    return granularity


def slice_floor(ts: Column | str, granularity: str) -> Column:
    return F.date_trunc(check_granularity(granularity), _col(ts))


def slice_interval(granularity: str, count: Column | int = 1) -> Column:
    unit, size = _INTERVAL_OF_ONE[check_granularity(granularity)]
    count = F.lit(count) if isinstance(count, int) else count
    return F.make_interval(**{unit: count * size})


def slice_shift(ts: Column | str, granularity: str, count: Column | int) -> Column:
    """Move by a number of slices, forward or back."""
    return _col(ts) + slice_interval(granularity, count)


def slice_is_aligned(ts: Column | str, granularity: str) -> Column:
    return slice_floor(ts, granularity) == _col(ts)


def slice_ceil(ts: Column | str, granularity: str) -> Column:
    """First slice start at or after ``ts``."""
    ts = _col(ts)
    start = slice_floor(ts, granularity)
    return F.when(start == ts, ts).otherwise(slice_shift(start, granularity, 1))


def slice_start(ts: Column | str, granularity: str, alignment: str = "floor") -> Column:
    """Slice start under an alignment policy; ``strict`` fails the query off the grid."""
    ts = _col(ts)
    if alignment == "floor":
        return slice_floor(ts, granularity)
    if alignment == "ceil":
        return slice_ceil(ts, granularity)
    if alignment == "strict":
        problem = F.concat(ts.cast("string"), F.lit(f" is not the start of a {granularity}"))
        return F.when(ts.isNull() | slice_is_aligned(ts, granularity), ts).otherwise(
            F.raise_error(problem).cast("timestamp")
        )
    raise ValueError(f"alignment must be one of {ALIGNMENT_POLICIES}, not {alignment!r}")


def slice_bounds(ts: Column | str, granularity: str, alignment: str = "floor") -> Column:
    """Struct of ``slice_start`` and ``slice_end``."""
    start = slice_start(ts, granularity, alignment)
    return F.struct(
        start.alias("slice_start"), slice_shift(start, granularity, 1).alias("slice_end")
    )


def partition_value(ts: Column | str, field: str) -> Column:
    """Text value of one time partition field."""
    ts = _col(ts)
    if field == "quarter":
        return F.concat(F.lit("Q"), F.quarter(ts))
    if field == "year_quarter":
        return F.concat(F.date_format(ts, "yyyy"), F.lit("Q"), F.quarter(ts))
    # Date patterns of the remaining fields.
    pattern = {
        "year": "yyyy",
        "month": "MM",
        "year_month": "yyyy_MM",
        "day": "dd",
        "date": "yyyy_MM_dd",
        "hour": "HH",
    }[field]
    return F.date_format(ts, pattern)
