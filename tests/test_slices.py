import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from sluiceway.functions import slices as fn
from sluiceway.operators import layout
from sluiceway.operators.calendar import (
    SliceSelector,
    parse_iso_utc,
    regrain_slices,
    slice_calendar,
)
from sluiceway.operators.joins import (
    assign_rows_to_intervals,
    assign_rows_to_slice,
    reconcile_slices,
    require_reconciled,
)


def stamps(calendar, column="slice_start"):
    text = F.date_format(column, "yyyy-MM-dd HH:mm")
    return [row[0] for row in calendar.orderBy(column).select(text).collect()]


def bounds(spark, text, granularity, policy="floor"):
    ts = F.lit(text).cast("timestamp")
    pair = fn.slice_bounds(ts, granularity, policy)
    row = spark.range(1).select(
        F.date_format(pair["slice_start"], "yyyy-MM-dd HH:mm"),
        F.date_format(pair["slice_end"], "yyyy-MM-dd HH:mm"),
    ).first()
    return tuple(row)


@pytest.mark.parametrize(
    "text, granularity, policy, expected",
    [
        ("2026-03-18T14:25:00Z", "month", "floor", ("2026-03-01 00:00", "2026-04-01 00:00")),
        ("2026-05-11T09:30:00Z", "quarter", "floor", ("2026-04-01 00:00", "2026-07-01 00:00")),
        ("2026-03-18T14:25:00Z", "day", "ceil", ("2026-03-19 00:00", "2026-03-20 00:00")),
        ("2026-03-18T00:00:00Z", "day", "ceil", ("2026-03-18 00:00", "2026-03-19 00:00")),
        ("2026-12-31T23:59:59Z", "hour", "ceil", ("2027-01-01 00:00", "2027-01-01 01:00")),
        ("2026-11-30T00:00:00Z", "year", "floor", ("2026-01-01 00:00", "2027-01-01 00:00")),
        ("2026-03-18T00:00:00Z", "day", "strict", ("2026-03-18 00:00", "2026-03-19 00:00")),
    ],
)
def test_bounds(spark, text, granularity, policy, expected):
    assert bounds(spark, text, granularity, policy) == expected


def test_strict_bounds_fail_off_the_grid(spark):
    with pytest.raises(Exception, match="not the start of a day"):
        bounds(spark, "2026-03-18T14:25:00Z", "day", "strict")


def test_relative_backward_ends_at_now(spark):
    selector = SliceSelector("quarter", relative_count=3, relative_direction="backward")
    now = datetime(2026, 5, 11, 9, 30, tzinfo=timezone.utc)
    assert stamps(slice_calendar(spark, selector, now)) == [
        "2025-10-01 00:00",
        "2026-01-01 00:00",
        "2026-04-01 00:00",
    ]


def test_relative_forward_starts_at_anchor(spark):
    selector = SliceSelector(
        "month",
        relative_count=3,
        relative_direction="forward",
        relative_anchor="2026-03-18T12:00:00Z",
    )
    assert stamps(slice_calendar(spark, selector)) == [
        "2026-03-01 00:00",
        "2026-04-01 00:00",
        "2026-05-01 00:00",
    ]


def day_range(policy, end="2026-03-16T12:00:00Z", start="2026-03-13T12:00:00Z"):
    return SliceSelector("day", range_start=start, range_end=end, range_policy=policy)


def test_range_overlap_keeps_partial_edges(spark):
    found = stamps(slice_calendar(spark, day_range("overlap")))
    assert [s[:10] for s in found] == ["2026-03-13", "2026-03-14", "2026-03-15", "2026-03-16"]


def test_range_contained_drops_partial_edges(spark):
    found = stamps(slice_calendar(spark, day_range("contained")))
    assert [s[:10] for s in found] == ["2026-03-14", "2026-03-15"]


def test_contained_drops_the_last_day_that_ends_a_second_early(spark):
    selector = day_range("contained", start="2026-03-13", end="2026-03-14T23:59:59Z")
    assert [s[:10] for s in stamps(slice_calendar(spark, selector))] == ["2026-03-13"]


def test_range_end_is_inclusive(spark):
    selector = day_range("overlap", start="2026-03-13", end="2026-03-14")
    assert [s[:10] for s in stamps(slice_calendar(spark, selector))] == [
        "2026-03-13",
        "2026-03-14",
    ]


def test_strict_range(spark):
    with pytest.raises(ValueError, match="range_policy='strict'"):
        slice_calendar(spark, day_range("strict"))
    selector = day_range("strict", start="2026-03-13", end="2026-03-15")
    assert len(stamps(slice_calendar(spark, selector))) == 3


def test_empty_selection_is_an_error(spark):
    selector = day_range("contained", start="2026-03-13T01:00:00Z", end="2026-03-13T02:00:00Z")
    with pytest.raises(ValueError, match="do not include any slice"):
        slice_calendar(spark, selector)


def test_range_across_many_years_and_leap_days(spark):
    selector = SliceSelector("day", range_start="2019-12-31", range_end="2024-03-01")
    found = stamps(slice_calendar(spark, selector))
    assert len(found) == (datetime(2024, 3, 1) - datetime(2019, 12, 31)).days + 1
    assert "2024-02-29 00:00" in found


@pytest.mark.parametrize(
    "selector, problem",
    [
        (SliceSelector("week"), "granularity"),
        (SliceSelector("day", mode="pinned"), "pinned_at is required"),
        (SliceSelector("day", range_start="2026-01-01"), "range_end is required"),
        (SliceSelector("day", relative_count=2), "relative_direction is required"),
        (SliceSelector("day", relative_count=0, relative_direction="forward"), "greater than zero"),
        (SliceSelector("day", relative_count=1, relative_direction="up"), "relative_direction"),
        (SliceSelector("day", alignment="round"), "alignment"),
        (SliceSelector("day", range_start="2026-02-01", range_end="2026-01-01"), "not be after"),
    ],
)
def test_selector_validation(selector, problem):
    with pytest.raises(ValueError, match=problem):
        selector.validate()


def test_mode_follows_from_the_parameters():
    both = SliceSelector("day", range_start="2026-01-01", range_end="2026-01-02", pinned_at="x")
    assert both.resolved_mode() == "range"
    assert SliceSelector("day", pinned_at="2026-01-01").request_kind == "slice"
    assert SliceSelector("day").request_kind == "live"
    SliceSelector("day", mode="current", pinned_at="nonsense").validate()


def test_run_ids_are_one_per_slice_and_stable(spark):
    calendar = slice_calendar(spark, day_range("overlap"))
    first = [row.run_id for row in calendar.collect()]
    assert len(set(first)) == 4
    assert first == [row.run_id for row in calendar.collect()]


def test_parse_iso_utc():
    expected = datetime(2026, 3, 12, 6, tzinfo=timezone.utc)
    for text in ("2026-03-12T06:00:00Z", "2026-03-12T06:00:00", "2026-03-12T08:00:00+02:00"):
        assert parse_iso_utc(text) == expected
    assert parse_iso_utc("2026-03-12") == datetime(2026, 3, 12, tzinfo=timezone.utc)


def test_regrain_rolls_up_and_never_down(spark):
    hours = slice_calendar(
        spark, SliceSelector("hour", range_start="2026-03-30T22:00:00", range_end="2026-04-01T02:00:00")
    )
    assert stamps(regrain_slices(hours, "month")) == ["2026-03-01 00:00", "2026-04-01 00:00"]
    days = slice_calendar(spark, day_range("overlap"))
    with pytest.raises(Exception, match="hour is finer than day"):
        regrain_slices(days, "hour").collect()


def test_assign_rows_uses_an_equi_join(spark):
    calendar = slice_calendar(spark, day_range("overlap"))
    data = [(1, "2026-03-13 00:00:00"), (2, "2026-03-16 23:59:59"), (3, "2026-03-17 00:00:00")]
    df = spark.createDataFrame(data, "id INT, at STRING").withColumn("ts", F.col("at").cast("timestamp"))
    placed = assign_rows_to_slice(df, "ts", calendar, "day")
    assert sorted(row.id for row in placed.collect()) == [1, 2]
    plan = placed._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_reconcile(spark):
    calendar = slice_calendar(spark, day_range("overlap"))
    dates = ["2026-03-13", "2026-03-13", "2026-03-14", "2026-04-01", None]
    outputs = spark.createDataFrame([(d,) for d in dates], "d STRING").select(
        F.col("d").cast("timestamp").alias("logical_date")
    )
    found = {
        (row.slice_start and str(row.slice_start)[:10]): (row.status, row.output_count)
        for row in reconcile_slices(calendar, outputs).collect()
    }
    assert found == {
        "2026-03-13": ("matched", 2),
        "2026-03-14": ("matched", 1),
        "2026-03-15": ("missing", 0),
        "2026-03-16": ("missing", 0),
        "2026-04-01": ("unexpected", 1),
        None: ("unlabelled", 1),
    }
    with pytest.raises(ValueError, match="missing 2026-03-15.*unexpected 2026-04-01"):
        require_reconciled(reconcile_slices(calendar, outputs))
    require_reconciled(reconcile_slices(calendar, calendar.withColumnRenamed("slice_start", "logical_date")))


def test_reconcile_single_slice_takes_undated_outputs(spark):
    calendar = slice_calendar(spark, SliceSelector("day", pinned_at="2026-03-13"))
    outputs = spark.createDataFrame([(None,), (None,)], "logical_date TIMESTAMP")
    (row,) = reconcile_slices(calendar, outputs).collect()
    assert (row.status, row.output_count) == ("matched", 2)


def test_partition_fields(spark):
    assert layout.Layout("quarter").fields == ("year", "quarter")
    assert layout.Layout("year").fields == ("year",)
    whole = layout.Layout("hour", tuple(layout.FIELD_GRANULARITY))
    assert whole.constant("month") == ("year", "quarter", "year_quarter", "month", "year_month")
    with pytest.raises(ValueError, match="'date' changes within a quarter"):
        layout.Layout("quarter", ("year_quarter", "date"))
    with pytest.raises(ValueError, match="'week' is not a time field"):
        layout.Layout("day", ("week",))
    df = spark.range(1).withColumn("ts", F.lit("2025-03-16T12:00:00Z").cast("timestamp"))
    row = layout.partition_columns(df, "ts", list(layout.FIELD_GRANULARITY)).first()
    assert (row.year_quarter, row.date, row.year_month) == ("2025Q1", "2025_03_16", "2025_03")
    assert (row.year, row.quarter, row.month, row.day, row.hour) == ("2025", "Q1", "03", "16", "12")


def test_place():
    assert layout.place("/r/", "tenant=t/", "set=1", None, "") == "/r/tenant=t/set=1"
    assert layout.place("s3a://b/r", None) == "s3a://b/r"
    with pytest.raises(ValueError, match="not a folder name"):
        layout.Layout("day", None, ("a/b",))


def test_rows_in_overlapping_intervals(spark):
    """Wide, short, empty and open intervals, before 1970 as well, against comparing all."""
    draw = random.Random(3)
    points = [(i, draw.randrange(-4 * 10**6, 4 * 10**6)) for i in range(300)]
    points.append((300, None))
    spans = [(i, *sorted(draw.sample(range(-4 * 10**6, 4 * 10**6), 2))) for i in range(40)]
    spans += [(40 + i, s, s + length) for i, (_, s) in enumerate(points[:60]) for length in (1, 3600)]
    spans += [(200, 5, 5), (201, 9, 3), (202, None, 7), (203, 7, None), (204, *spans[0][1:])]
    rows = spark.createDataFrame(points, "p LONG, s LONG").selectExpr("p", "timestamp_seconds(s) as ts")
    intervals = spark.createDataFrame(spans, "i LONG, a LONG, b LONG").selectExpr(
        "i", "timestamp_seconds(a) as slice_start", "timestamp_seconds(b) as slice_end"
    )
    found = assign_rows_to_intervals(rows, "ts", intervals)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert found.columns == ["p", "ts", "i", "slice_start", "slice_end"]
    expected = sorted(
        (p, i)
        for p, s in points
        for i, a, b in spans
        if None not in (s, a, b) and a <= s < b
    )
    assert sorted((r.p, r.i) for r in found.collect()) == expected
    assert assign_rows_to_intervals(rows, "ts", intervals.limit(0)).isEmpty()
    assert assign_rows_to_intervals(rows.limit(0), "ts", intervals).isEmpty()


def test_totals_of_rows_in_intervals(spark):
    """The totals of an interval equal those of its pairs, and are found without making pairs."""
    draw = random.Random(4)
    hour = 3_600_000_000
    times = [draw.randrange(-30 * hour, 30 * hour) for _ in range(200)]
    times += [draw.randrange(20) for _ in range(60)] + [0, hour - 1, hour, -1, -hour]
    points = [(i, t, draw.choice([None, i])) for i, t in enumerate(times)] + [(999, None, 1)]
    spans = [tuple(sorted(draw.sample(range(-40 * hour, 40 * hour), 2))) for _ in range(60)]
    spans += [tuple(sorted(draw.sample(range(25), 2))) for _ in range(60)]
    spans += [(s, s + draw.choice([1, 2, 1000, hour, 3 * hour])) for s in times]
    spans += [(0, hour), (0, 5), (5, hour), (0, 4 * hour), (-hour, 0), (-9 * hour, 7 * hour)]
    spans += [(5, 5), (9, 3), (None, 7), (7, None), spans[0], spans[0]]
    rows = spark.createDataFrame(points, "p LONG, s LONG, v LONG").selectExpr(
        "p", "timestamp_micros(s) as ts", "v"
    )
    intervals = spark.createDataFrame(
        [(i, *span) for i, span in enumerate(spans)], "i LONG, a LONG, b LONG"
    ).selectExpr("i", "timestamp_micros(a) as slice_start", "timestamp_micros(b) as slice_end")
    totals = {"n": ("sum", F.lit(1)), "low": ("min", "p"), "high": ("max", "p"), "v": ("sum", "v")}
    found = assign_rows_to_intervals(rows, "ts", intervals, totals=totals)
    expected = []
    for i, (a, b) in enumerate(spans):
        inside = [(p, v) for p, s, v in points if None not in (s, a, b) and a <= s < b]
        known = [v for _, v in inside if v is not None]
        if inside:
            ids = [p for p, _ in inside]
            expected.append((i, len(ids), min(ids), max(ids), sum(known) if known else None))
    assert sorted((r.i, r.n, r.low, r.high, r.v) for r in found.collect()) == expected
    assert found.columns == ["i", "slice_start", "slice_end", "n", "low", "high", "v"]
    for few, some in ((rows.limit(0), intervals), (rows, intervals.limit(0))):
        assert assign_rows_to_intervals(few, "ts", some, totals=totals).isEmpty()
    crowd = spark.range(2000).selectExpr("id as p", "timestamp_micros(id * 1000) as ts", "id as v")
    wide = spark.range(2000).selectExpr(
        "id as i", "timestamp_micros(-id) as slice_start", "timestamp_micros(2000000 + id) as slice_end"
    )
    many = assign_rows_to_intervals(crowd, "ts", wide, totals=totals)
    assert {r.n for r in many.collect()} == {2000}
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
