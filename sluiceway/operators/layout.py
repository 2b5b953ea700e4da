"""Where rows of a time lie: the directories of a table by time fields."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import takewhile

from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.functions.slices import GRANULARITIES, check_granularity, partition_value

# Each field and the coarsest granularity that can carry it.
FIELD_GRANULARITY = {
    "year": "year",
    "quarter": "quarter",
    "year_quarter": "quarter",
    "month": "month",
    "year_month": "month",
    "day": "day",
    "date": "day",
    "hour": "hour",
}

# Fields used when none are named.
DEFAULT_FIELDS = {
    "year": ("year",),
    "quarter": ("year", "quarter"),
    "month": ("year", "month"),
    "day": ("year", "month", "day"),
    "hour": ("year", "month", "day", "hour"),
}


@dataclass(frozen=True)
class Layout:
    """Directories ``<field>=<value>/.../<folder>/...`` for slices of one granularity.

    Making one checks it: every problem is named in a single error.
    """

    granularity: str
    fields: tuple[str, ...] | None = None
    folders: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        check_granularity(self.granularity)
        given = DEFAULT_FIELDS[self.granularity] if self.fields is None else self.fields
        object.__setattr__(self, "fields", tuple(given))
        object.__setattr__(self, "folders", tuple(self.folders))
        problems = [
            f"{name!r} is not a time field"
            if name not in FIELD_GRANULARITY
            else f"{name!r} changes within a {self.granularity}"
            for name in self.fields
            if name not in self.constant(self.granularity)
        ]
        problems += [f"{name!r} is not a folder name" for name in self.folders if not _plain(name)]
        if problems:
            raise ValueError("unusable layout: " + "; ".join(problems))

    def constant(self, granularity: str) -> tuple[str, ...]:
        """Fields of this layout that have one value throughout a slice."""
        reach = GRANULARITIES.index(check_granularity(granularity))
        return tuple(
            name
            for name in self.fields
            if name in FIELD_GRANULARITY
            and GRANULARITIES.index(FIELD_GRANULARITY[name]) >= reach
        )

    def directories(self, calendar: DataFrame, granularity: str) -> list[str]:
        """The topmost directories that hold the slices of a calendar, one per slice at most."""
        constant = self.constant(granularity)
        leading = list(takewhile(lambda name: name in constant, self.fields))
        parts = [
            F.concat(F.lit(f"{name}="), partition_value("slice_start", name)) for name in leading
        ]
        names = calendar.select(F.concat_ws("/", *parts).alias("name")).distinct()
        return sorted(row["name"] for row in names.collect())

    def in_folders(self, path: Column) -> Column:
        """Whether a file lies directly in the folders below the time fields."""
        if not self.folders:
            return F.lit(True)
        return F.regexp_extract(path, "^(.*)/[^/]*$", 1).endswith("/" + "/".join(self.folders))


def _plain(name: str) -> bool:
    return bool(name.strip()) and "/" not in name


def place(root: str, *names: str | None) -> str:
    """A path below a root; names that are missing or empty add nothing to it."""
    kept = [name.strip("/") for name in names if name and name.strip("/")]
    return "/".join([root.rstrip("/"), *kept])


def partition_columns(df: DataFrame, ts: Column | str, fields: Sequence[str]) -> DataFrame:
    """Add the named partition fields as text columns."""
    return df.withColumns({field: partition_value(ts, field) for field in fields})
