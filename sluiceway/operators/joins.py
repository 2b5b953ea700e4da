"""Joins of the models and jobs.

None carries a broadcast hint. Sides that may be small are written tables, so Spark knows
their size and broadcasts them when they fit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sluiceway.functions.slices import slice_floor

DAILY_DIMENSIONS = ("event_date", "channel", "card_region", "merchant_category")


def left_join_answer_keys(
    transactions: DataFrame, answer_keys: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """All transactions, with the named answer-key columns where there is a key."""
    return transactions.join(
        answer_keys.select("transaction_id", *columns), "transaction_id", "left"
    )


def left_join_daily_dimensions(
    daily: DataFrame, other: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Left join on the four daily dimensions; a NULL dimension never matches."""
    return daily.join(other.select(*DAILY_DIMENSIONS, *columns), list(DAILY_DIMENSIONS), "left")


def attach_manifest_metadata(
    objects: DataFrame, manifests: DataFrame, key: str = "_landing_key"
) -> DataFrame:
    """Give each landed object the metadata its manifest recorded.

    Objects without a manifest keep an empty map; of several manifests of one object the
    newest counts. Join documents rather than exploded
    rows: it is one match per landed object.
    """
    recorded = F.col("payload.metadata")
    newest = F.struct(F.coalesce(recorded["ingested_at"], F.lit("")), F.to_json(recorded))
    metadata = manifests.groupBy(F.col("storage.payload_key").alias(key)).agg(
        F.max_by(recorded, newest).alias("_metadata_map")
    )
    empty = F.create_map().cast("map<string,string>")
    return objects.join(metadata, key, "left").withColumn(
        "_metadata_map", F.coalesce("_metadata_map", empty)
    )


def assign_rows_to_slice(
    df: DataFrame, ts: Column | str, calendar: DataFrame, granularity: str
) -> DataFrame:
    """Rows inside the calendar's slices, with their slice columns.

    Membership ``slice_start <= ts < slice_end`` on a grid is an equi-join on the floored
    time, so no range join is needed. A calendar comes from selector parameters, not from
    data, and stays small.
    """
    return df.withColumn("slice_start", slice_floor(ts, granularity)).join(
        calendar, "slice_start", "inner"
    )


def assign_rows_to_intervals(
    df: DataFrame,
    ts: Column | str,
    intervals: DataFrame,
    *,
    start: str = "slice_start",
    end: str = "slice_end",
    finest: int = 3600,
    totals: Mapping[str, tuple[str, Column | str]] | None = None,
) -> DataFrame:
    """Rows inside any intervals ``start <= ts < end``, which may overlap and lie off any grid.

    Time is cut into bins of ``finest`` seconds, and into bins four times as wide on each level
    above. An interval is put on the level whose bins are at least as long as it is, so it meets
    two bins at most however wide it is; a row is put into its bin on every level that is in
    use. Equal bins are joined and the bounds checked, so rows are compared with intervals near
    them only, and AQE splits a bin that many rows share. The levels reach the driver: one per
    factor of four between the shortest and the longest interval.

    An interval that ends where it starts, or before, holds no row; so does one without a bound,
    and a row without a time is in no interval. Equal intervals match each.

    The pairs of rows and intervals grow with the product of the two tables. Where only sums,
    least and greatest values of an interval's rows are wanted, ``totals`` names them, as
    ``{"n": ("sum", F.lit(1)), "first": ("min", "ts")}``: the result is then every interval that
    holds a row, with its totals, and no pair is made (:func:`_interval_totals`).
    """
    if totals is not None:
        return _interval_totals(df, ts, intervals, start, end, finest, totals)
    width = finest * 1_000_000
    first, last = F.unix_micros(F.col(start)), F.unix_micros(F.col(end)) - 1
    level = F.greatest(F.lit(0), F.ceil(F.log(4.0, (last - first + 1) / width))).cast("int")
    binned = (
        intervals.where(F.col(start) < F.col(end))
        .withColumn("_level", level)
        .withColumn("_size", F.expr(f"shiftleft({width}L, 2 * _level)"))
        .withColumn(
            "_bin", F.explode(F.sequence(_bin(first, F.col("_size")), _bin(last, F.col("_size"))))
        )
        .drop("_size")
    )
    levels = sorted(row[0] for row in binned.select("_level").distinct().collect())
    time = F.col(ts) if isinstance(ts, str) else ts
    places = F.array(
        *[
            F.struct(
                F.lit(used).alias("_level"),
                _bin(F.unix_micros("_time"), F.lit(width << 2 * used)).alias("_bin"),
            )
            for used in levels
        ]
    )
    if not levels:
        places = F.array().cast("array<struct<_level: int, _bin: bigint>>")
    rows = df.withColumn("_time", time).where(F.col("_time").isNotNull())
    placed = rows.withColumn("_place", F.explode(places)).select(
        *df.columns, "_time", "_place.*"
    )
    inside = (F.col("_time") >= F.col(start)) & (F.col("_time") < F.col(end))
    return (
        placed.join(binned, ["_level", "_bin"])
        .where(inside)
        .drop("_level", "_bin", "_time")
    )


def _bin(micros: Column, size: Column) -> Column:
    """Floor of whole numbers, also below zero."""
    return ((micros - F.pmod(micros, size)) / size).cast("bigint")


_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}
# Level of the bins themselves; lower levels cut a bin into parts of ``2 ** level`` microseconds.
_WHOLE = 62


def _interval_totals(
    df: DataFrame,
    ts: Column | str,
    intervals: DataFrame,
    start: str,
    end: str,
    finest: int,
    totals: Mapping[str, tuple[str, Column | str]],
) -> DataFrame:
    """Intervals with the totals of their rows, at a cost linear in rows and intervals.

    An interval is the end of its first bin, the beginning of its last bin and the bins between.
    Both edges are running totals over the times of a bin, read where the interval starts or ends.
    The bins between are taken as blocks of 1, 2, 4... bins, two of a size at most. An interval
    within one bin has its edges in the two adjacent parts of the bin, as wide as possible, that
    it touches; rows are put into parts on the levels in use only. Rows of equal time are added
    up first, and equal bounds are looked up once.
    """
    width = finest * 1_000_000
    kinds = {"_n": "sum", **{name: kind for name, (kind, _) in totals.items()}}
    merged = [_MERGE[kind](name).alias(name) for name, kind in kinds.items()]
    time = F.col(ts) if isinstance(ts, str) else ts
    values = {"_n": F.lit(1), **{name: value for name, (_, value) in totals.items()}}
    times = (
        df.select(
            F.unix_micros(time).alias("_at"),
            *[(F.col(v) if isinstance(v, str) else v).alias(name) for name, v in values.items()],
        )
        .where(F.col("_at").isNotNull())
        .groupBy("_at")
        .agg(*merged)
    )
    bounds = (
        intervals.where(F.col(start) < F.col(end))
        .select(F.unix_micros(start).alias("_start"), F.unix_micros(end).alias("_end"))
        .distinct()
        .withColumns({"_first": _bin(F.col("_start"), F.lit(width)),
                      "_last": _bin(F.col("_end") - 1, F.lit(width))})
    )
    edges = _interval_edges(bounds, width)
    levels = [row[0] for row in edges.select("_level").distinct().collect()]
    placed = (
        times.withColumn("_level", F.explode(F.lit(sorted(levels)).cast("array<int>")))
        .withColumn("_bin", _bin(F.col("_at"), F.lit(width)))
        .withColumn("_part", F.expr(f"shiftright(pmod(_at, {width}L), _level)"))
    )
    part = Window.partitionBy("_level", "_bin", "_part")
    # At equal times an edge stands before the row: rows from a start on, rows before an end.
    place = [F.col("_at"), F.col("_side").isNull()]
    before = part.orderBy(*place).rowsBetween(Window.unboundedPreceding, 0)
    onward = part.orderBy(*[c.desc() for c in place]).rowsBetween(Window.unboundedPreceding, 0)
    running = {
        name: F.when(F.col("_side") == "start", _MERGE[kind](name).over(onward)).otherwise(
            _MERGE[kind](name).over(before)
        )
        for name, kind in kinds.items()
    }
    at_edges = (
        placed.unionByName(edges, allowMissingColumns=True)
        .select("_start", "_end", "_side", *[value.alias(name) for name, value in running.items()])
        .where(F.col("_side").isNotNull())
        .drop("_side")
    )
    blocks = _interval_blocks(bounds)
    highest = blocks.agg(F.max("_level")).first()[0]
    sizes = F.sequence(F.lit(0), F.lit(highest or 0))
    bins = (
        times.groupBy(_bin(F.col("_at"), F.lit(width)).alias("_bin"))
        .agg(*merged)
        .withColumn("_level", F.explode(sizes))
        .groupBy("_level", F.expr("shiftright(_bin, _level)").alias("_block"))
        .agg(*merged)
    )
    between = blocks.join(bins, ["_level", "_block"]).select("_start", "_end", *kinds)
    found = (
        at_edges.where(F.col("_n") > 0)
        .unionByName(between)
        .groupBy("_start", "_end")
        .agg(*merged)
        .drop("_n")
    )
    return (
        intervals.withColumn("_start", F.unix_micros(start))
        .withColumn("_end", F.unix_micros(end))
        .join(found, ["_start", "_end"])
        .select(*intervals.columns, *totals)
    )


def _interval_edges(bounds: DataFrame, width: int) -> DataFrame:
    """Where each interval starts and ends, with the bin or part of a bin to add up there."""
    begin = F.pmod(F.col("_start"), F.lit(width))
    last = F.pmod(F.col("_end") - 1, F.lit(width))
    one_bin = F.col("_first") == F.col("_last")
    apart = F.length(F.bin(begin.bitwiseXOR(last))) - 1
    inside = one_bin & (begin > 0) & (last < width - 1)
    level = F.when(inside, apart).otherwise(_WHOLE).cast("int")
    # An interval that begins or ends with its only bin, or is one microsecond, has one edge.
    has_start = ~one_bin | (begin > 0)
    has_end = ~one_bin | (begin == 0) | (inside & (begin != last))

    def edge(side: str, bin: str, at: str, offset: Column) -> Column:
        return F.struct(
            F.lit(side).alias("_side"),
            F.col(bin).alias("_bin"),
            F.col(at).alias("_at"),
            offset.alias("_offset"),
        )

    both = F.array(
        F.when(has_start, edge("start", "_first", "_start", begin)),
        F.when(has_end, edge("end", "_last", "_end", last)),
    )
    return (
        bounds.select("_start", "_end", level.alias("_level"), F.explode(both).alias("_edge"))
        .where(F.col("_edge").isNotNull())
        .select("_start", "_end", "_level", "_edge.*")
        .withColumn("_part", F.expr("shiftright(_offset, _level)"))
        .drop("_offset")
    )


def _interval_blocks(bounds: DataFrame) -> DataFrame:
    """Blocks of ``2 ** level`` bins that make up the bins between an interval's first and last."""
    steps = F.length(F.bin(F.col("_last") - F.col("_first") - 1))
    odd_low = F.when(F.expr("_low & 1") == 1, F.col("_low"))
    odd_high = F.when(F.expr("_high & 1") == 1, F.col("_high") - 1)
    return (
        bounds.where(F.col("_last") - F.col("_first") > 1)
        .withColumn("_level", F.explode(F.sequence(F.lit(0), steps - 1)))
        .withColumn("_low", F.expr("-shiftright(-(_first + 1), _level)"))
        .withColumn("_high", F.expr("shiftright(_last, _level)"))
        .where(F.col("_low") < F.col("_high"))
        .select("_start", "_end", "_level", F.explode(F.array(odd_low, odd_high)).alias("_block"))
        .where(F.col("_block").isNotNull())
    )


def reconcile_slices(calendar: DataFrame, outputs: DataFrame) -> DataFrame:
    """Planned slices against delivered outputs, one row per slice start.

    ``outputs`` has a ``logical_date`` timestamp per delivered object. Status is
    ``matched``, ``missing`` (planned, nothing delivered), ``unexpected`` (delivered, not
    planned) or ``unlabelled`` (delivered without a logical date). Outputs are counted
    per date before the join, so many outputs on one date send one row per task.

    With a single planned slice an output without a date belongs to it.
    """
    planned = calendar.select("slice_start").withColumn("planned", F.lit(True))
    first_two = planned.limit(2).collect()
    outputs = outputs.select(F.col("logical_date").alias("slice_start"))
    if len(first_two) == 1:
        only = F.lit(first_two[0]["slice_start"])
        outputs = outputs.select(F.coalesce("slice_start", only).alias("slice_start"))
    delivered = outputs.groupBy("slice_start").agg(F.count(F.lit(1)).alias("output_count"))
    status = (
        F.when(F.col("slice_start").isNull(), "unlabelled")
        .when(F.col("planned").isNull(), "unexpected")
        .when(F.col("output_count").isNull(), "missing")
        .otherwise("matched")
    )
    return (
        planned.join(delivered, "slice_start", "full_outer")
        .select(
            "slice_start",
            status.alias("status"),
            F.coalesce("output_count", F.lit(0)).alias("output_count"),
        )
    )


def require_reconciled(reconciled: DataFrame) -> None:
    """Raise if a planned slice got no output, or an output has no planned slice.

    The error counts the slices per status and names the first few;
    :func:`unreconciled` has all of them.
    """
    problems = unreconciled(reconciled)
    totals = {row["status"]: row["count"] for row in problems.groupBy("status").count().collect()}
    if totals:
        counted = ", ".join(f"{totals[status]} {status}" for status in sorted(totals))
        first = [
            f"{row.status} {row.slice_start or ''}".strip()
            for row in problems.orderBy("status", "slice_start").limit(20).collect()
        ]
        raise ValueError(
            f"outputs do not match the planned slices: {counted}; the first: {', '.join(first)}"
        )


def unreconciled(reconciled: DataFrame) -> DataFrame:
    """The slices that :func:`require_reconciled` objects to."""
    return reconciled.where(F.col("status") != "matched")
