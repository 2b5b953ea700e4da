"""Benchmark decontamination: n-gram seeds, then local alignment.

Words of a document that occur in the benchmark are numbered, all others become a hole. Every
n-gram of a test item is a seed: which of them an edited copy keeps is not known, so none is
left out as common. An item that has too few of its words in the document to reach the least
score is passed over. Around the seeds a document shares with an item, a Smith-Waterman
alignment of words scores the passage; edited and paraphrased copies lose a little of the
score for each change.

The test items come in blocks of a fixed number, each small enough to send to every task;
all documents are compared with every block.

Defined results: null and empty texts or items match nothing, nor do items of fewer words
than a seed; equal items are found each by
itself; rows with equal ids are scored each and the best per id and item is returned; an
empty table gives no row. Extra columns play no part.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, functions as F

from sluiceway.llm.common import map_batches, narrow, prepare, stage

WORD = re.compile(r"\w+")
# Words of a seed.
SEED_WORDS = 3
# Points of an alignment; the score is their sum per word of the item.
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
LEAST_SCORE = 0.5
# Test items sent to the tasks at once.
ITEMS_PER_BLOCK = 2_000

HITS = "doc_id long, text_hash long, item_id long, score double, begin int, stop int, seeds int"


class Items:
    """A block of test items with numbered words and n-grams."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        for item_id, text in rows:
            words = WORD.findall((text or "").lower())
            if words:
                number = self.vocabulary
                ids = [number.setdefault(word, len(number)) for word in words]
                self.items.append((item_id, np.array(ids, dtype=np.int32)))
        self.base = len(self.vocabulary) + 1
        owners: dict[int, set[tuple[int, int]]] = {}
        for at, (_, ids) in enumerate(self.items):
            for place, key in enumerate(self.keys(ids)[0].tolist()):
                owners.setdefault(key, set()).add((at, place))
        self.grams = np.array(sorted(owners), dtype=np.int64)
        self.owners = [sorted(owners[key]) for key in self.grams.tolist()]
        # Words of all items in a row, where each begins, and how many it has.
        self.lengths = np.array([len(ids) for _, ids in self.items], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.concatenate([ids for _, ids in self.items] or [np.empty(0, np.int32)])

    def keys(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the n-grams without holes, and their places."""
        count = len(ids) - SEED_WORDS + 1
        if count < 1:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        full = np.ones(count, dtype=bool)
        key = np.zeros(count, dtype=np.int64)
        for k in range(SEED_WORDS):
            part = ids[k : k + count]
            full &= part >= 0
            key = key * self.base + part + 1
        places = np.flatnonzero(full)
        return key[places], places

    def possible(self, ids: np.ndarray) -> np.ndarray:
        """Whether enough words of an item stand anywhere in a document to reach the score."""
        present = np.zeros(len(self.vocabulary), dtype=np.int64)
        present[ids[ids >= 0]] = 1
        words = np.add.reduceat(present[self.flat], self.starts)
        return words * MATCH >= LEAST_SCORE * self.lengths

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the known n-grams in a document, and their places."""
        keys, places = self.keys(ids)
        if not len(keys) or not len(self.grams):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
        known = self.grams[at] == keys
        return at[known], places[known]


def numbered(vocabulary: dict[str, int], text: str) -> np.ndarray:
    """Words of a document as numbers of the block's vocabulary, holes as -1.

    Nothing is remembered between documents: most parts of texts are rare, and to remember
    them costs more than to split them again.
    """
    words = WORD.findall(text.lower())
    return np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int32, len(words))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: its points, and where it begins and stops in the passage.

    Row by row over the item; gaps along a row are a running maximum.
    """
    width = len(passage)
    steps = np.arange(width + 1) * GAP
    above = np.zeros(width + 1)
    origin = np.arange(width + 1)
    best = (0.0, 0, 0)
    for word in item:
        gain = np.where(passage == word, MATCH, MISMATCH)
        row = np.zeros(width + 1)
        begun = np.arange(width + 1)
        diagonal, down = above[:-1] + gain, above[1:] + GAP
        take = diagonal >= down
        value = np.where(take, diagonal, down)
        source = np.where(take, origin[:-1], origin[1:])
        alive = value > 0
        row[1:] = np.where(alive, value, 0.0)
        begun[1:] = np.where(alive, source, begun[1:])
        # A gap of k words costs k * GAP: compare values with the cost so far taken out.
        level = row - steps
        peak = np.maximum.accumulate(level)
        last = np.maximum.accumulate(np.where(level >= peak, np.arange(width + 1), 0))
        above, origin = peak + steps, begun[last]
        end = int(above.argmax())
        if above[end] > best[0]:
            best = (float(above[end]), int(origin[end]), end)
    return best


def score_document(items: Items, ids: np.ndarray) -> list[tuple]:
    """Items that the document holds: item id, score, begin, stop, number of seeds."""
    grams, places = items.find(ids)
    if not len(grams):
        return []
    possible = items.possible(ids).tolist()
    touched: dict[int, list[int]] = {}
    for gram, place in zip(grams.tolist(), places.tolist()):
        for at, inside in items.owners[gram]:
            if possible[at]:
                touched.setdefault(at, []).append(place - inside)
    found = []
    for at, begins in touched.items():
        item_id, item = items.items[at]
        margin = len(item)
        best = None
        for low, high in _merge(sorted(begins), margin):
            begin, stop = max(0, low - margin), min(len(ids), high + 2 * margin)
            passage = ids[begin:stop]
            # No alignment has more matches than words of the item in the passage.
            inside = int(np.isin(passage, item).sum())
            if min(inside, len(item)) * MATCH < LEAST_SCORE * len(item):
                continue
            points, first, last = align(item, passage)
            result = (points / len(item), begin + first, begin + last, len(begins))
            if best is None or result[0] > best[0]:
                best = result
        if best and best[0] >= LEAST_SCORE:
            found.append((item_id, *best))
    return found


def _merge(begins: list[int], margin: int) -> list[tuple[int, int]]:
    """Starts that lie near each other as ranges."""
    ranges: list[list[int]] = []
    for begin in begins:
        if ranges and begin - ranges[-1][1] <= margin:
            ranges[-1][1] = begin
        else:
            ranges.append([begin, begin])
    return [(low, high) for low, high in ranges]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and test item it holds: best score and where, in words."""
    best = F.max_by(F.struct("score", "begin", "stop", "seeds"), F.struct("score", -F.col("begin")))
    return (
        _hits(docs, benchmark)
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "item_id", "best.*")
    )


def _hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` and test item it holds, see ``HITS``."""
    prepare(docs.sparkSession)
    source = narrow(docs).where("text != ''").withColumn("text_hash", F.xxhash64("text"))
    tests = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string")
    ).where("text IS NOT NULL AND text != ''")
    blocks = max(1, math.ceil(tests.count() / ITEMS_PER_BLOCK))
    found = None
    for block in range(blocks):
        rows = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = Items(sorted(map(tuple, rows.collect()), key=repr))
        part = stage(_block(source, items), "decontaminate")
        found = part if found is None else found.unionByName(part)
    return found


def _block(source: DataFrame, items: Items) -> DataFrame:
    context = source.sparkSession.sparkContext
    shared = context.broadcast(items)

    def score(batches: Iterator[dict]) -> Iterator[dict]:
        items = shared.value
        names = [part.split()[0] for part in HITS.split(", ")]
        for batch in batches:
            rows = [
                (doc_id, digest, *hit)
                for doc_id, digest, text in zip(
                    batch["doc_id"], batch["text_hash"], batch["text"]
                )
                for hit in score_document(items, numbered(items.vocabulary, text))
            ]
            if rows:
                yield dict(zip(names, zip(*rows)))

    return map_batches(source, score, HITS)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold no test item; a row is named by its id and text, so a clean
    one stays whatever others have its id or none."""
    hits = _hits(docs, benchmark).select(
        F.col("doc_id").alias("_hit"), F.col("text_hash").alias("_hit_text")
    )
    hits = stage(hits.distinct(), "contaminated")
    same = docs["doc_id"].cast("long").eqNullSafe(hits["_hit"]) & (
        F.xxhash64(docs["text"].cast("string")) == hits["_hit_text"]
    )
    return docs.join(hits, same, "left_anti")
