"""Removal of repeated multi-line chunks with content-defined boundaries.

A rolling hash over the hashes of the last lines decides after which line a chunk ends, so
an inserted line moves the boundaries near it only and equal passages fall into equal chunks
wherever they stand. Chunks of several lines that occur more than once, in any document, are
compared by their bytes and all but the first are cut out.

Defined results: the first occurrence, by id (null first) and place, stays; rows with equal
ids count as one document, whose first occurrence stays in each of the rows; chunks with
fewer than two non-blank lines are never removed; null text has no line and stays null. An
empty table gives an empty table. Extra columns are carried along and play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.llm.common import Scratch, map_batches, prepare, stage

# Lines the rolling hash covers, and one in how many of its values ends a chunk.
ROLLING_LINES = 2
DIVISOR = 3
# Shortest chunk that is removed, in non-blank lines.
LEAST_LINES = 2

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # any odd number serves
_DROP = pow(_BASE, ROLLING_LINES, 1 << 64)

CHUNKS = (
    "doc_id long, text_hash long, chunk int, first_line int, lines int, "
    "begin int, stop int, key string, body string"
)


def cut(text: str) -> list[tuple[int, int, int, int]]:
    """Chunks as (first line, line after the last, begin, stop); offsets in characters, the
    line break after a chunk belongs to it."""
    lines = text.split("\n")
    hashes = [xxhash.xxh64_intdigest(line) for line in lines]
    chunks, rolling, first, begin, at = [], 0, 0, 0, 0
    for i, line in enumerate(lines):
        rolling = (rolling * _BASE + hashes[i]) & _MASK
        if i >= ROLLING_LINES:
            rolling = (rolling - hashes[i - ROLLING_LINES] * _DROP) & _MASK
        at += len(line) + 1
        # The high bits depend on all lines of the window.
        if (rolling >> 32) % DIVISOR == 0 and i - first + 1 >= LEAST_LINES:
            chunks.append((first, i + 1, begin, min(at, len(text))))
            first, begin = i + 1, at
    if first < len(lines):
        chunks.append((first, len(lines), begin, len(text)))
    return chunks


def text_hash() -> Column:
    return F.xxhash64("text")


def chunk_table(docs: DataFrame) -> DataFrame:
    """All chunks of several lines, see ``CHUNKS``. ``key`` is a hash of the bytes."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_hash().alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    ).where(F.col("text").isNotNull())

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        names = [part.split()[0] for part in CHUNKS.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, digest, text in zip(batch["doc_id"], batch["text_hash"], batch["text"]):
                for number, (first, last, begin, stop) in enumerate(cut(text)):
                    body = text[begin:stop].rstrip("\n")
                    filled = sum(1 for line in body.split("\n") if line.strip())
                    if filled >= LEAST_LINES:
                        key = hashlib.blake2b(body.encode(), digest_size=16).hexdigest()
                        rows.append(
                            (doc_id, digest, number, first, last - first, begin, stop, key, body)
                        )
            if rows:
                yield dict(zip(names, zip(*rows)))

    return map_batches(source, run, CHUNKS)


def repeated(chunks: DataFrame) -> DataFrame:
    """Keys of chunks that occur more than once, with the id of the first document.

    Grouping by the body compares the bytes; copies fold in the map tasks, so a chunk of a
    third of all documents is a few rows. A key that stands for different bytes is left out.
    """
    lowest = F.coalesce("doc_id", F.lit(-(2**63)))
    bodies = chunks.groupBy("key", "body").agg(
        F.count(F.lit(1)).alias("times"), F.min(lowest).alias("first_doc")
    )
    keys = bodies.groupBy("key").agg(
        F.count(F.lit(1)).alias("bodies"),
        F.sum("times").alias("times"),
        F.min("first_doc").alias("first_doc"),
    )
    return keys.where("bodies = 1 AND times > 1").select("key", "first_doc")


def removals(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` that loses chunks: their spans and number of lines.

    Staged in the shared folder; rows are named by id and hash of the text.
    """
    spark = prepare(docs.sparkSession)
    with Scratch(spark) as scratch:
        chunks = scratch.stage(chunk_table(docs), "line-chunks")
        # Written first, so that the join can split the rows of a hot chunk.
        keys = scratch.stage(repeated(chunks), "repeated-chunks")
        again = chunks.drop("body").join(keys, "key")
        # All chunks of a document meet in one row, which its length bounds.
        spans = again.groupBy("doc_id", "text_hash").agg(
            F.sort_array(
                F.collect_set(
                    F.struct(
                        "chunk",
                        "begin",
                        "stop",
                        "lines",
                        "key",
                        (F.coalesce("doc_id", F.lit(-(2**63))) == F.col("first_doc")).alias(
                            "home"
                        ),
                    )
                )
            ).alias("spans")
        )

        def run(batches: Iterator[dict]) -> Iterator[dict]:
            for batch in batches:
                out = {"doc_id": [], "text_hash": [], "spans": []}
                for doc_id, digest, spans in zip(
                    batch["doc_id"], batch["text_hash"], batch["spans"]
                ):
                    seen, gone = set(), []
                    for span in spans:
                        if span["home"] and span["key"] not in seen:
                            seen.add(span["key"])
                        else:
                            gone.append({k: span[k] for k in ("begin", "stop", "lines")})
                    if gone:
                        out["doc_id"].append(doc_id)
                        out["text_hash"].append(digest)
                        out["spans"].append(gone)
                if out["doc_id"]:
                    yield out

        found = map_batches(
            spans,
            run,
            "doc_id long, text_hash long, spans array<struct<begin:int,stop:int,lines:int>>",
        )
        return stage(found, "line-removals")


def with_removals(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` as a struct ``row`` beside its ``spans``; null where nothing goes."""
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_hash().alias("text_hash"),
    )
    same = rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["text_hash"] == gone["text_hash"])
    # Merged at every size: few removals would be broadcast, many could not be.
    return rows.join(gone.hint("merge"), same, "left").select("row", "spans")


def kept_text(text: Column, spans: Column) -> Column:
    """The text without the spans, which ascend and do not overlap."""
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["stop"]))
    stops = F.concat(F.transform(spans, lambda s: s["begin"]), F.array(F.length(text)))
    parts = F.transform(
        F.arrays_zip(starts.alias("a"), stops.alias("b")),
        lambda part: F.substring(text, part["a"] + 1, part["b"] - part["a"]),
    )
    joined = F.regexp_replace(F.array_join(parts, ""), "\n+\\z", "")
    return F.when(spans.isNull(), text).otherwise(joined)


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated chunks cut out of ``text``, and ``n_chars`` to match; documents
    of which nothing remains go."""
    joined = with_removals(docs, removals(docs))
    text = kept_text(F.col("row.text"), F.col("spans"))
    rows = joined.select("row", "spans", text.alias("kept")).where(
        F.col("spans").isNull() | (F.trim(F.col("kept")) != "")
    )
    columns = []
    for field in docs.schema.fields:
        column = F.col(f"row.`{field.name}`")
        if field.name == "text":
            column = F.col("kept")
        elif field.name == "n_chars":
            changed = F.length("kept").cast(field.dataType)
            column = F.when(F.col("spans").isNull(), column).otherwise(changed)
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def report(docs: DataFrame) -> DataFrame:
    """Per row: its lines, what was removed, and a digest of what stays."""
    joined = with_removals(docs, removals(docs))
    text = kept_text(F.coalesce("row.text", F.lit("")), F.col("spans"))
    lines = F.size(F.split("row.text", "\n"))
    gone = F.aggregate("spans", F.lit(0), lambda total, span: total + span["lines"])
    return joined.select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        F.when(F.col("row.text").isNull(), 0).otherwise(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_removed_chunks"),
        F.coalesce(gone, F.lit(0)).cast("long").alias("n_removed_lines"),
        F.sha2(text, 256).alias("kept_sha256"),
    )
