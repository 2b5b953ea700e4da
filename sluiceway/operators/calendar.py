"""Slice calendars: which time slices a job run covers, as a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.functions.slices import (
    ALIGNMENT_POLICIES,
    GRANULARITIES,
    check_granularity,
    slice_floor,
    slice_interval,
    slice_is_aligned,
    slice_shift,
    slice_start,
)
from sluiceway.session import configure

# Fixed values.
SELECTOR_MODES = ("current", "pinned", "range", "relative")
RANGE_POLICIES = ("overlap", "contained", "strict")
DIRECTIONS = ("backward", "forward")


def parse_iso_utc(text: str) -> datetime:
    """Parameter text to UTC: a date, a naive stamp (read as UTC), ``Z`` or an offset."""
    value = datetime.fromisoformat(text)
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


@dataclass(frozen=True)
class SliceSelector:
    """Parameters that pick slices. The mode follows from what is given, unless named."""

    granularity: str
    mode: str | None = None
    pinned_at: str | None = None
    range_start: str | None = None
    range_end: str | None = None
    relative_count: int | None = None
    relative_direction: str | None = None
    relative_anchor: str | None = None
    alignment: str = "floor"
    range_policy: str = "overlap"

    def resolved_mode(self) -> str:
        if self.mode is not None:
            return self.mode
        if self.range_start is not None or self.range_end is not None:
            return "range"
        if self.relative_count is not None or self.relative_direction is not None:
            return "relative"
        return "current" if self.pinned_at is None else "pinned"

    def validate(self) -> str:
        """Check the parameters the mode uses, ignoring the others; returns the mode."""
        check_granularity(self.granularity)
        mode = self.resolved_mode()
        _one_of("mode", mode, SELECTOR_MODES)
        _one_of("alignment", self.alignment, ALIGNMENT_POLICIES)
        _one_of("range_policy", self.range_policy, RANGE_POLICIES)
        needed = {
            "current": (),
            "pinned": ("pinned_at",),
            "range": ("range_start", "range_end"),
            "relative": ("relative_count", "relative_direction"),
        }[mode]
        for name in needed:
            if getattr(self, name) is None:
                raise ValueError(f"{name} is required in mode {mode!r}")
        if mode == "relative":
            _one_of("relative_direction", self.relative_direction, DIRECTIONS)
            if self.relative_count < 1:
                raise ValueError("relative_count must be greater than zero")
        if mode == "range" and parse_iso_utc(self.range_start) > parse_iso_utc(self.range_end):
            raise ValueError("range_start must not be after range_end")
        return mode

    @property
    def request_kind(self) -> str:
        return {"current": "live", "pinned": "slice"}.get(self.resolved_mode(), "multi_slice")


def _one_of(name: str, value, allowed) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, not {value!r}")


def slice_calendar(
    spark: SparkSession,
    selector: SliceSelector,
    now: datetime | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Slices of the selector: ``slice_start, slice_end, granularity, run_id``.

    Raises if the parameters are off the grid under a strict policy or select nothing.
    ``run_id`` defaults to a fresh one per slice.
    """
    configure(spark)
    mode = selector.validate()
    grain = selector.granularity
    now = now or datetime.now(timezone.utc)
    one = spark.range(1)

    if mode == "range":
        low, high = parse_iso_utc(selector.range_start), parse_iso_utc(selector.range_end)
        if selector.range_policy == "strict":
            on_grid = one.select(
                slice_is_aligned(F.lit(low), grain) & slice_is_aligned(F.lit(high), grain)
            ).first()[0]
            if not on_grid:
                raise ValueError(f"range bounds must be {grain} starts when range_policy='strict'")
        # Range ends are inclusive, and always floored whatever the alignment policy.
        first, last = slice_floor(F.lit(low), grain), slice_floor(F.lit(high), grain)
    else:
        if mode == "pinned":
            anchor = parse_iso_utc(selector.pinned_at)
        elif mode == "relative" and selector.relative_anchor is not None:
            anchor = parse_iso_utc(selector.relative_anchor)
        else:
            anchor = now
        first = last = slice_start(F.lit(anchor), grain, selector.alignment)
        if mode == "relative":
            steps = selector.relative_count - 1
            if selector.relative_direction == "backward":
                first = slice_shift(last, grain, -steps)
            else:
                last = slice_shift(first, grain, steps)

    starts = F.sequence(first, last, slice_interval(grain))
    calendar = one.select(F.explode(starts).alias("slice_start")).select(
        "slice_start",
        slice_shift("slice_start", grain, 1).alias("slice_end"),
        F.lit(grain).alias("granularity"),
    )
    if mode == "range" and selector.range_policy == "overlap":
        calendar = calendar.where(
            (F.col("slice_end") > F.lit(low)) & (F.col("slice_start") <= F.lit(high))
        )
    if mode == "range" and selector.range_policy == "contained":
        calendar = calendar.where(
            (F.col("slice_start") >= F.lit(low)) & (F.col("slice_end") <= F.lit(high))
        )
    # The rows are a function of the parameters alone: a local table keeps run ids stable
    # across the plans that use the calendar, and tells Spark how small it is.
    bounds = calendar.select(F.unix_micros("slice_start"), F.unix_micros("slice_end"))
    rows = [(*row, run_id or str(uuid4())) for row in bounds.sort("slice_start").collect()]
    if not rows:
        raise ValueError("the range and its policy do not include any slice")
    return spark.createDataFrame(rows, "first BIGINT, next BIGINT, run_id STRING").select(
        F.timestamp_micros("first").alias("slice_start"),
        F.timestamp_micros("next").alias("slice_end"),
        F.lit(grain).alias("granularity"),
        "run_id",
    )


def regrain_slices(calendar: DataFrame, granularity: str) -> DataFrame:
    """Calendar rolled up to a coarser grid."""
    check_granularity(granularity)
    order = F.create_map(
        *[F.lit(item) for pair in zip(GRANULARITIES, range(len(GRANULARITIES))) for item in pair]
    )
    too_fine = F.lit(GRANULARITIES.index(granularity)) < order[F.col("granularity")]
    problem = F.concat(F.lit(f"{granularity} is finer than "), F.col("granularity"))
    start = F.when(too_fine, F.raise_error(problem).cast("timestamp")).otherwise(
        slice_floor("slice_start", granularity)
    )
    return (
        calendar.select(start.alias("slice_start"))
        .distinct()
        .select(
            "slice_start",
            slice_shift("slice_start", granularity, 1).alias("slice_end"),
            F.lit(granularity).alias("granularity"),
        )
    )
