"""Which dates of a model change when rows are added to its source, and their new content.

The rows added since the last build come down the model graph as dates: each model learns from
its inputs which of its own dates change, computes those again and hands the dates on. How a
model does so is its ``refresh``:

``BY_DATE``: a date of the model depends on the same date of its inputs. Only those are read.

``BY_ROW``: each row comes from one source row. The dates of the added rows are computed again
from the source.

``BY_KEY``: newest row per key. The newest of the added rows meet the rows that the model has
now; a row that moves to another date changes both dates.

``BY_BUNDLE``: newest row per key among rows of the winning bundles. Added bundles may win over
others, whose rows then go, so the keys of all rows whose bundle won or lost are looked up in
the source again: one scan of the key and bundle columns, and one of the rows of these keys. Only
rows of these keys are shuffled.

``BY_DIFFERENCE``: a small model that any row may change. It is computed in full and compared
with what is there; only dates that differ are written.

All of them lead to the tables that a full build gives, and doing a step twice changes nothing.
Dates are collected by the driver: one entry per calendar date.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, functions as F

from sluiceway.operators.bundles import keep_canonical_rows
from sluiceway.session import materialize
from sluiceway.sinks.partitions import dates_of, on_dates

BY_DATE = "by_date"
BY_ROW = "by_row"
BY_KEY = "by_key"
BY_BUNDLE = "by_bundle"
BY_DIFFERENCE = "by_difference"

Dates = list[date | None]


@dataclass(frozen=True)
class Keyed:
    """The newest-row selection of a model: its key, its typed input, and the selection."""

    key: str
    typed: Callable[[DataFrame], DataFrame]
    newest: Callable[..., DataFrame]


@dataclass
class Added:
    """Rows added to the source, and what they have changed so far."""

    rows: DataFrame
    # By model: the dates that changed, and the rows that came or went (BY_DIFFERENCE).
    dates: dict[str, Dates] = field(default_factory=dict)
    differences: dict[str, DataFrame] = field(default_factory=dict)
    # By model: what the added rows become (BY_ROW).
    became: dict[str, DataFrame] = field(default_factory=dict)


def added_rows(raw: DataFrame, workflow: str, since: str) -> DataFrame:
    """Rows that came after the stamp ``since``: bundles standardized later, events delivered
    on its date or later. Both conditions reach the scan."""
    if workflow == "events":
        delivered = F.concat_ws("-", "year", "month", "day")
        return raw.where(delivered >= F.lit(since[:10]))
    stamp = F.try_to_timestamp(F.lit(since))
    return raw.where(F.try_to_timestamp("_raw_standardized_at") > stamp)


def by_date(model, inputs: Mapping[str, DataFrame], added: Added) -> tuple[DataFrame, Dates]:
    days: set[date | None] = set()
    for name in inputs:
        days |= set(added.dates[name])
    dates = sorted(days, key=lambda day: (day is not None, day))
    changed = [df.where(on_dates(model.partition, dates)) for df in inputs.values()]
    return model.build(*changed), dates


def by_row(model, inputs, added: Added, name: str) -> tuple[DataFrame, Dates]:
    (source,) = inputs.values()
    became = materialize(model.build(added.rows), "added-rows")
    added.became[name] = became
    dates = dates_of(became, column=model.partition)
    return model.build(source).where(on_dates(model.partition, dates)), dates


def by_key(model, inputs, added: Added, current: DataFrame, options) -> tuple[DataFrame, Dates]:
    (source,) = inputs
    key = model.keyed.key
    newest = materialize(model.keyed.newest(added.became[source], **options), "added-newest")
    moved = current.join(newest.select(key), key, "left_semi")
    dates = dates_of(moved, newest, column=model.partition)
    present = current.where(on_dates(model.partition, dates))
    return model.keyed.newest(present.unionByName(newest), **options), dates


def by_bundle(model, inputs, added: Added, current: DataFrame, options) -> tuple[DataFrame, Dates]:
    (raw, bundles), (_, bundle_model) = inputs.values(), inputs
    keyed = model.keyed
    switched = added.differences[bundle_model].select("raw_bundle_id")
    grown = added.rows.select(F.col("_raw_bundle_id").alias("raw_bundle_id"))
    touched = materialize(switched.unionByName(grown).distinct(), "touched-bundles")
    rows = keyed.typed(raw)
    keys = materialize(
        rows.join(touched, "raw_bundle_id", "left_semi").select(keyed.key).distinct(),
        "touched-keys",
    )
    again = rows.join(keys, keyed.key, "left_semi")
    newest = materialize(
        keyed.newest(keep_canonical_rows(again, bundles), **options).select(*current.columns),
        "touched-newest",
    )
    moved = current.join(keys, keyed.key, "left_semi")
    dates = dates_of(moved, newest, column=model.partition)
    present = current.where(on_dates(model.partition, dates)).join(keys, keyed.key, "left_anti")
    return present.unionByName(newest), dates


def by_difference(
    model, inputs, added: Added, current: DataFrame, options, name: str
) -> tuple[DataFrame, Dates]:
    whole = materialize(
        model.build(*inputs.values(), **options).select(*current.columns), "recomputed"
    )
    difference = materialize(
        whole.exceptAll(current).unionByName(current.exceptAll(whole)), "difference"
    )
    added.differences[name] = difference
    dates = dates_of(difference, column=model.partition)
    return whole.where(on_dates(model.partition, dates)), dates


def refresh(
    name: str,
    model,
    inputs: Mapping[str, DataFrame],
    added: Added,
    current: DataFrame,
    options: Mapping[str, object],
) -> tuple[DataFrame, Dates]:
    """New content of the dates of a model that change, and these dates."""
    if model.refresh == BY_ROW:
        frame, dates = by_row(model, inputs, added, name)
    elif model.refresh == BY_KEY:
        frame, dates = by_key(model, inputs, added, current, options)
    elif model.refresh == BY_BUNDLE:
        frame, dates = by_bundle(model, inputs, added, current, options)
    elif model.refresh == BY_DIFFERENCE:
        frame, dates = by_difference(model, inputs, added, current, options, name)
    else:
        frame, dates = by_date(model, inputs, added)
    added.dates[name] = dates
    return frame, dates
