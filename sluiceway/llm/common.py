"""What the operators share: reading tables, narrow inputs, staging, in-task helpers."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluiceway import session

# Rows and bytes per Arrow batch: a batch ends where it reaches the first of them, so long texts
# come in small batches.
BATCH_ROWS = 512
BATCH_BYTES = "16MB"
# Bits of a bitmap that tells which rows are wanted: 4 MB, broadcast. If it fills up, more
# texts are shuffled than need to be.
SLOTS = 1 << 25
BITMAP = 1 << 15


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the library to the executors, once per application: tasks import it."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(session.__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="ship-")) / root.name
        archive = shutil.make_archive(str(target), "zip", root.parent, root.name)
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this package on top of the library's."""
    session.configure(spark)
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long and ``text`` without nulls; other columns do not take part."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *[F.col(name) for name in more],
    )


def remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids count as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def row_hash(*columns: str) -> Column:
    return F.xxhash64(*[F.col(name) for name in columns])


def likely(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key``, a hash, ``wanted`` has, and those few whose hash falls on the same
    bit; the others need not be shuffled."""
    slot = F.pmod(F.col(key), F.lit(SLOTS))
    part, bit = F.floor(slot / BITMAP), slot % BITMAP
    bitmaps = wanted.groupBy(part.alias("part")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, 1)), 16, 10)
    is_set = F.getbit(byte.cast("long"), (bit % 8).cast("int")) == 1
    marked = rows.withColumn("part", part).join(F.broadcast(bitmaps), "part")
    return marked.where(is_set).select(*rows.columns)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    return session.materialize(df, label)


class Scratch:
    """Staged tables that go when the block ends. What outlives it must not read them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def stage(self, df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
        path = session.scratch_dir(self.spark, label)
        df.write.option("compression", compression).parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *exc) -> None:
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in self.paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)


def map_batches(
    df: DataFrame, function: Callable[[Iterator[dict]], Iterator[dict]], schema: str
) -> DataFrame:
    """``mapInArrow`` with batches as dicts of Python lists, in and out."""
    fields = [part.strip().split(" ")[0] for part in _fields(schema)]
    target = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in function(batch.to_pydict() for batch in batches if batch.num_rows):
            arrays = [pa.array(out[name], type=target.field(name).type) for name in fields]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)


def _fields(schema: str) -> list[str]:
    """Split a DDL string at its top-level commas."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(schema[start:i])
            start = i + 1
    return [*parts, schema[start:]]


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
