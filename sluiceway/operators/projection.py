"""Projections and row filters used across the models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def typed_projection(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Cast and rename in one projection.

    Values are column expressions, or ``"source:type"`` text for a plain cast.
    """
    projected = []
    for name, spec in columns.items():
        if isinstance(spec, str):
            source, _, data_type = spec.partition(":")
            spec = F.col(source).cast(data_type) if data_type else F.col(source)
        projected.append(spec.alias(name))
    return df.select(*projected)


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names)


def without_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Audience view without the named columns; naming an absent column is an error."""
    missing = set(names) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.drop(*names)


def partition_last(df: DataFrame, partition: str) -> DataFrame:
    return df.select(*[name for name in df.columns if name != partition], partition)


def lineage_columns(
    df: DataFrame,
    metadata: str,
    *,
    label: str,
    preset_id: str,
    extra_keys: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add lineage from a metadata map, with the job's own settings as fallback.

    Needs ``_landing_key`` and ``slice_start`` (NULL outside any slice). ``extra_keys``
    maps further output columns to metadata keys that have no fallback.
    """
    if not preset_id:
        raise ValueError("preset_id must be a non-empty string")
    value = F.col(metadata)
    columns = {
        "_standardize_strategy": F.lit(label),
        "_source_preset_id": F.coalesce(value["preset_id"], F.lit(preset_id)),
        "_logical_date": F.coalesce(value["logical_date"], iso_text("slice_start")),
        "_ingested_at": value["ingested_at"],
    }
    for name, key in (extra_keys or {}).items():
        columns[name] = value[key]
    return df.withColumns(columns)


def iso_text(ts: Column | str) -> Column:
    """Timestamp as ISO 8601 text with the UTC offset, fractions only where there are any."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return F.when(F.date_trunc("second", ts) == ts, whole).otherwise(fraction)
