"""Token ids as files of frequency-ranked, byte-aligned codes.

Ids are renumbered by falling frequency over the whole corpus, so common ids need one byte.
Each takes one to four bytes; a separate control byte holds the lengths of four ids in two
bits each. A reader looks the control bytes up in a table and gathers all ids of a block at
once, without a loop over them.

A file is a set of blocks, one row each, in Parquet as the container every executor can
write to a shared store: documents and their lengths, control bytes, data bytes. Files are
written by ranges of the id, blocks within a file ascend. The ranks are a table beside them.

Defined results: null and empty texts are the end id alone; rows with equal ids follow each
other by a hash of their text; null ids come first; an empty table writes no block. Extra
columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway import session
from sluiceway.llm.common import Scratch, map_batches, narrow, prepare
from sluiceway.llm.tokens import WordLevel

END = 2
# Ids of a block, unless one document has more.
BLOCK = 1 << 16

RAW = "part int, block int, begin long, docs binary, lengths binary, ids binary"
CODED = (
    "part int, block int, begin long, docs binary, lengths binary, control binary, data binary"
)
RANKS = "rank long, id long"
# Lengths of the four ids of each control byte, and how many bytes they take.
WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3
WIDTHS = (WIDTHS + 1).astype(np.uint8)


def encode(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below 2**32."""
    ranks = np.asarray(ranks, dtype="<u4")
    width = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    codes[: len(ranks)] = width - 1
    control = codes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < width[:, None]]
    return np.bitwise_or.reduce(control, axis=1).astype(np.uint8).tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, count: int) -> np.ndarray:
    """Ranks of a block: widths by table lookup, bytes gathered in four steps."""
    width = WIDTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:count]
    begin = np.cumsum(width, dtype=np.int64) - width
    source = np.frombuffer(data, dtype=np.uint8)
    ranks = np.zeros(count, dtype=np.uint32)
    for byte in range(4):
        has = np.flatnonzero(width > byte)
        ranks[has] |= source[begin[has] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


def _blocks(tokenizer: str):
    """Documents of a task as blocks of raw ids."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        encoder = WordLevel(tokenizer)
        end = np.array([END], dtype="<u4")
        part = TaskContext.get().partitionId()
        begin = block = held = 0
        docs: list[int] = []
        arrays: list[np.ndarray] = []

        def flush() -> dict:
            nonlocal begin, block, held
            ids = np.concatenate(arrays)
            row = {
                "part": [part],
                "block": [block],
                "begin": [begin],
                "docs": [_doc_bytes(docs)],
                "lengths": [np.array([len(a) for a in arrays], dtype="<u4").tobytes()],
                "ids": [ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes()],
            }
            begin, block, held = begin + len(ids), block + 1, 0
            docs.clear()
            arrays.clear()
            return row

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.concatenate([encoder.encode(text), end])
                docs.append(doc_id)
                arrays.append(ids)
                held += len(ids)
                if held >= BLOCK:
                    yield flush()
        if docs:
            yield flush()

    return run


# Stands for a null id, which no long value of the column may take.
NO_ID = np.iinfo(np.int64).min


def _doc_bytes(docs: list[int | None]) -> bytes:
    return np.array([NO_ID if d is None else d for d in docs], dtype="<i8").tobytes()


def _ids(raw: bytes, lengths: bytes) -> np.ndarray:
    total = int(np.frombuffer(lengths, dtype="<u4").sum(dtype=np.int64))
    return np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * total else "<u4")


def _count(batches: Iterator[dict]) -> Iterator[dict]:
    counts = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for raw, lengths in zip(batch["ids"], batch["lengths"]):
            found = np.bincount(_ids(raw, lengths))
            if len(found) > len(counts):
                counts = np.concatenate([counts, np.zeros(len(found) - len(counts), np.int64)])
            counts[: len(found)] += found
    at = np.flatnonzero(counts)
    yield {"id": at.tolist(), "times": counts[at].tolist()}


def write(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the files of all documents below ``path``: ``blocks`` and ``ranks``."""
    spark = prepare(docs.sparkSession)
    ordered = (
        narrow(docs)
        .withColumns({"turn": F.xxhash64("text"), "copy": F.monotonically_increasing_id()})
        .repartitionByRange("doc_id", "turn", "copy")
        .sortWithinPartitions("doc_id", "turn", "copy")
        .drop("turn", "copy")
    )
    with Scratch(spark) as scratch:
        raw = scratch.stage(map_batches(ordered, _blocks(tokenizer), RAW), "token-ids")
        counts = (
            map_batches(raw.select("ids", "lengths"), _count, "id long, times long")
            .groupBy("id")
            .agg(F.sum("times").alias("times"))
        )
        # One row per id of the vocabulary, which bounds what comes to the driver.
        order = [row["id"] for row in counts.orderBy(F.desc("times"), "id").collect()]
        spark.createDataFrame(
            [(rank, id_) for rank, id_ in enumerate(order)], RANKS
        ).coalesce(1).write.parquet(f"{path}/ranks")
        shared = spark.sparkContext.broadcast(order)

        def run(batches: Iterator[dict]) -> Iterator[dict]:
            order = np.array(shared.value, dtype=np.int64)
            rank = np.zeros(int(order.max(initial=-1)) + 1, dtype="<u4")
            rank[order] = np.arange(len(order))
            for batch in batches:
                coded = [
                    encode(rank[_ids(raw, lengths)])
                    for raw, lengths in zip(batch["ids"], batch["lengths"])
                ]
                del batch["ids"]
                yield {
                    **batch,
                    "control": [control for control, _ in coded],
                    "data": [data for _, data in coded],
                }

        map_batches(raw, run, CODED).write.option("compression", "none").parquet(
            f"{path}/blocks"
        )


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids`` of every document in the files."""
    prepare(spark)
    blocks = spark.read.schema(CODED).parquet(f"{path}/blocks")
    # One row per file, so the driver holds no more than the number of tasks.
    sizes = blocks.groupBy("part").agg(
        F.max_by("begin", "block").alias("begin"), F.max_by("lengths", "block").alias("last")
    )
    starts, total = {}, 0
    for row in sizes.orderBy("part").collect():
        starts[row["part"]] = total
        total += row["begin"] + int(np.frombuffer(row["last"], "<u4").sum(dtype=np.int64))
    ranks = spark.read.schema(RANKS).parquet(f"{path}/ranks")
    order = [row["id"] for row in ranks.orderBy("rank").collect()]
    shared = spark.sparkContext.broadcast((starts, order))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        starts, order = shared.value
        ids_of = np.array(order, dtype="<u4")
        for batch in batches:
            for i in range(len(batch["part"])):
                lengths = np.frombuffer(batch["lengths"][i], dtype="<u4").astype(np.int64)
                ends = np.cumsum(lengths)
                ids = ids_of[decode(batch["control"][i], batch["data"][i], int(ends[-1]))]
                begin = starts[batch["part"][i]] + batch["begin"][i]
                docs = np.frombuffer(batch["docs"][i], dtype="<i8").tolist()
                yield {
                    "doc_id": [None if d == NO_ID else d for d in docs],
                    "start": (ends - lengths + begin).tolist(),
                    "n_tokens": lengths.tolist(),
                    "ids": [ids[e - n : e].tobytes() for e, n in zip(ends, lengths)],
                }

    return map_batches(blocks, run, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents, read the files back, and digest what they hold."""
    spark = docs.sparkSession
    path = session.scratch_dir(spark, "token-files")
    write(docs, path, tokenizer)
    return read(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
