"""Date-partitioned Parquet tables whose dates are replaced as a whole.

Spark's dynamic overwrite stages the new files and moves them in once the job has succeeded, so
a failed write leaves the old rows. Dates that have no rows any more are removed afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Directory name that Spark gives a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def on_dates(column: str, dates: Sequence[date | None]) -> Column:
    """Membership in a list of dates, in which NULL is a date like any other."""
    known = [day for day in dates if day is not None]
    member = F.col(column).isin(known) if known else F.lit(False)
    member = F.coalesce(member, F.lit(False))
    return member | F.col(column).isNull() if None in dates else member


def dates_of(*frames: DataFrame, column: str = "event_date") -> list[date | None]:
    """Distinct dates of the frames. One entry per calendar date reaches the driver."""
    days: set[date | None] = set()
    for frame in frames:
        days |= {row[0] for row in frame.select(column).distinct().collect()}
    return sorted(days, key=lambda day: (day is not None, day))


def _file_system(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, name: str) -> bool:
    files, path = _file_system(spark, name)
    return files.exists(path)


def make_folder(spark: SparkSession, name: str) -> None:
    files, path = _file_system(spark, name)
    files.mkdirs(path)


def remove(spark: SparkSession, name: str) -> None:
    files, path = _file_system(spark, name)
    files.delete(path, True)


def folders(spark: SparkSession, name: str) -> list[str]:
    """Names of the folders directly below one."""
    files, path = _file_system(spark, name)
    return [status.getPath().getName() for status in files.listStatus(path) if status.isDirectory()]


def size_of(spark: SparkSession, name: str) -> int:
    """Bytes of all files below a folder, 0 if there is none."""
    files, path = _file_system(spark, name)
    return files.getContentSummary(path).getLength() if files.exists(path) else 0


def is_partitioned(spark: SparkSession, path: str, column: str) -> bool:
    """Whether all data below a folder lies in directories of the column's values."""
    files, folder = _file_system(spark, path)
    if not files.exists(folder):
        return False
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    data = [name for name in names if not name.startswith(("_", "."))]
    return bool(data) and all(name.startswith(f"{column}=") for name in data)


def table_files(spark: SparkSession, path: str) -> set[str]:
    """Data files, as Spark lists them for a scan; nothing is opened."""
    if not exists(spark, path):
        return set()
    return set(spark.read.schema("any STRING").parquet(path).inputFiles())


def _folder(file: str) -> str:
    return file.rpartition("/")[0]


def _remove_all(spark: SparkSession, names: Iterable[str]) -> None:
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def replace_all(df: DataFrame, path: str, options: dict[str, str]) -> None:
    """Replace a table without partitions: the old files go once the new ones are there."""
    spark = df.sparkSession
    before = table_files(spark, path)
    df.write.mode("append").options(**options).parquet(path)
    _remove_all(spark, before)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition: str,
    dates: Sequence[date | None] | None = None,
    options: dict[str, str] | None = None,
    kind: str = "parquet",
) -> None:
    """Make the rows the whole content of the table, or of ``dates`` alone.

    The table may be among the inputs of ``df``: nothing of it is touched before all rows
    are written.
    """
    spark = df.sparkSession
    before = table_files(spark, path)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**(options or {}))
        .partitionBy(partition)
        .format(kind)
        .save(path)
    )
    old = {_folder(file) for file in before}
    if dates is not None:
        values = [NULL_PARTITION if day is None else str(day) for day in dates]
        named = {f"{partition}={value}" for value in values}
        old = {folder for folder in old if folder.rpartition("/")[2] in named}
    if old:
        written = {_folder(file) for file in table_files(spark, path) - before}
        _remove_all(spark, sorted(old - written))


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table with its declared columns, whatever its files and directories look like."""
    return spark.read.schema(schema).parquet(path)
