"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order of distance. The index is a set of
blocks of vectors; each block holds an inverted file per pivot, the places of its vectors
whose permutation has the pivot, with its rank there. A query walks the lists of its own
pivots and adds up the footrule distance, the sum of differences in rank, where a pivot that
one side lacks counts as just behind the last rank. The vectors of smallest footrule are
reranked by Euclidean distance on the original components in double precision.

Pivots are fitted on a bounded sample; every vector is indexed. Queries are sent to the
blocks in batches of a fixed number, so what a task receives does not grow with the input.
Each task keeps the nearest few of each query over all its blocks.

Defined results: vectors that are null, zero, of another length than most of the sample, or
hold null or non-finite components take no part, nor do rows without an id; rows equal in id
and vector count once; equal vectors are one entry of a block, so copies take no place from
others among the candidates; ties go to the smaller id; a query gets as many neighbours as
there are. An empty table gives no rows. Extra columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluiceway.llm.common import Scratch, map_batches, prepare, stage

NEIGHBOURS = 10
# Pivots, and how many of the nearest stand for a vector.
PIVOTS = 256
PERMUTATION = 64
# Rows the pivots are picked from, by a hash of the id.
SAMPLE = 4_096
# Share of the usual distance that pivots keep from each other if they can.
SPREAD = 0.5
# Vectors of a block and queries of a batch, on average.
BLOCK = 8_192
BATCH = 4_096
# Candidates reranked per query over the whole index: this times the root of its size,
# and some more per block, as blocks differ.
CANDIDATES = 32
SLACK = 24
# Footrule, as a share of the greatest, up to which every vector is reranked: a dense
# cluster may hold more vectors than the candidates, with nearly equal permutations.
CLOSE = 0.25

FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` of the rows that take part."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return rows.where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & finite
        & F.exists("vector", lambda x: x != 0)
    )


def fit_pivots(rows: DataFrame, total: int) -> np.ndarray:
    """Distinct vectors of a bounded sample, all of the usual length."""
    share = min(1.0, SAMPLE / max(1, total))
    picked = rows.where(
        F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < math.ceil(share * 1_000_000)
    )
    sample = picked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    lengths = [len(row["vector"]) for row in sample]
    if not lengths:
        return np.zeros((0, 0))
    usual = max(sorted(set(lengths)), key=lengths.count)
    found = np.array([row["vector"] for row in sample if len(row["vector"]) == usual])
    return spread(np.array(list({vector.tobytes(): vector for vector in found}.values())))


def spread(vectors: np.ndarray) -> np.ndarray:
    """Pivots in order of the sample, but none near an earlier one as long as there are
    others: pivots from one dense cluster would all say the same."""
    apart = SPREAD * np.median(np.linalg.norm(vectors - vectors[0], axis=1))
    nearest = np.full(len(vectors), np.inf)
    chosen: list[int] = []
    for i, vector in enumerate(vectors):
        if len(chosen) < PIVOTS and nearest[i] >= apart:
            chosen.append(i)
            nearest = np.minimum(nearest, np.linalg.norm(vectors - vector, axis=1))
    rest = [i for i in range(len(vectors)) if i not in set(chosen)]
    return vectors[[*chosen, *rest][:PIVOTS]]


def permutations(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Numbers of the nearest pivots of each vector, nearest first."""
    kept = min(PERMUTATION, len(pivots))
    squares = (pivots**2).sum(axis=1) - 2 * vectors @ pivots.T
    return np.argsort(squares, axis=1, kind="stable")[:, :kept]


class Block:
    """Distinct vectors with their inverted files."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray):
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), dtype=bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        repeat = ~new
        repeat[1:] &= ids[1:] == ids[:-1]
        repeat[0] = False
        ids, vectors, new = ids[~repeat], vectors[~repeat], new[~repeat]
        self.ids = ids  # ascending within an entry
        self.begins = np.flatnonzero(new)
        self.ends = np.append(self.begins[1:], len(ids))
        self.vectors = vectors[self.begins]
        near = permutations(self.vectors, pivots)
        self.kept = near.shape[1]
        entry = np.repeat(np.arange(len(near)), self.kept)
        rank = np.tile(np.arange(self.kept), len(near))
        by_pivot = np.argsort(near.ravel(), kind="stable")
        self.entries = entry[by_pivot].astype(np.int32)
        self.ranks = rank[by_pivot].astype(np.int32)
        self.lists = np.searchsorted(near.ravel()[by_pivot], np.arange(len(pivots) + 1))

    def footrule(self, near: np.ndarray) -> np.ndarray:
        """Distance of one permutation to every entry. Without a common pivot it is the
        most; each posting takes off what the pivot would cost on both sides."""
        kept = self.kept
        total = np.full(len(self.vectors), kept * (kept + 1), dtype=np.int32)
        for rank, pivot in enumerate(near.tolist()):
            low, high = self.lists[pivot], self.lists[pivot + 1]
            theirs = self.ranks[low:high]
            total[self.entries[low:high]] += (
                np.abs(theirs - rank) - (kept - theirs) - (kept - rank)
            )
        return total

    def search(
        self, query_id: int, query: np.ndarray, near: np.ndarray, candidates: int
    ) -> tuple[list[float], list[int]]:
        """Scores and ids of the nearest, after reranking the entries of least footrule."""
        total = self.footrule(near)
        if candidates < len(total):
            limit = np.partition(total, candidates - 1)[candidates - 1]
            limit = max(limit, int(CLOSE * self.kept * (self.kept + 1)))
            picked = np.flatnonzero(total <= limit)
        else:
            picked = np.arange(len(total))
        distance = np.sqrt(((self.vectors[picked] - query) ** 2).sum(axis=1))
        found: list[tuple[float, int]] = []
        # One more than asked for: the query may be among the copies of an entry.
        for at in np.argsort(distance, kind="stable"):
            score = float(distance[at])
            if len(found) >= NEIGHBOURS and score > found[NEIGHBOURS - 1][0]:
                break
            entry = picked[at]
            copies = self.ids[self.begins[entry] : self.ends[entry]][: NEIGHBOURS + 1]
            found += [(score, int(i)) for i in copies if i != query_id]
            found.sort()
            del found[NEIGHBOURS:]
        return [s for s, _ in found], [i for _, i in found]


def build(rows: DataFrame, pivots: np.ndarray, total: int) -> DataFrame:
    """The index: one row per block, dealt by id so that copies of a vector spread."""
    blocks = max(1, math.ceil(total / BLOCK))
    dimension = pivots.shape[1]

    def pack(pdf):
        import pandas as pd

        return pd.DataFrame(
            {
                "block": [int(pdf["block"].iloc[0])],
                "ids": [pdf["vec_id"].to_numpy("<i8").tobytes()],
                "vectors": [np.stack(pdf["vector"].to_list()).astype("<f8").tobytes()],
            }
        )

    fitting = rows.where(F.size("vector") == dimension)
    dealt = fitting.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(pack, "block int, ids binary, vectors binary")


def search(
    index: DataFrame, queries: list[tuple[int, list[float]]], pivots: np.ndarray, total: int
) -> DataFrame:
    """The nearest of each query within each task, for one batch of queries."""
    context = index.sparkSession.sparkContext
    vectors = np.array([vector for _, vector in queries])
    shared = context.broadcast(
        ([i for i, _ in queries], vectors, permutations(vectors, pivots), pivots)
    )
    wanted = CANDIDATES * math.sqrt(max(1, total))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        query_ids, vectors, near, pivots = shared.value
        best: list[list[tuple[float, int]]] = [[] for _ in query_ids]
        for batch in batches:
            for raw_ids, raw in zip(batch["ids"], batch["vectors"]):
                ids = np.frombuffer(raw_ids, "<i8")
                block = Block(ids, np.frombuffer(raw, "<f8").reshape(len(ids), -1), pivots)
                candidates = math.ceil(wanted * len(ids) / total) + SLACK
                for k, query_id in enumerate(query_ids):
                    scores, found = block.search(query_id, vectors[k], near[k], candidates)
                    best[k] = sorted([*best[k], *zip(scores, found)])[:NEIGHBOURS]
        rows = [(q, i, s) for q, nearest in zip(query_ids, best) for s, i in nearest]
        if rows:
            yield dict(zip(("query_id", "vec_id", "score"), zip(*rows)))

    return map_batches(index.select("ids", "vectors"), run, FOUND)


def nearest(vectors: DataFrame, query: Column) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for the rows where ``query`` holds."""
    spark = prepare(vectors.sparkSession)
    rows = usable(vectors)
    total = rows.count()
    pivots = fit_pivots(rows, total)
    found = None
    with Scratch(spark) as scratch:
        if len(pivots):
            index = scratch.stage(build(rows, pivots, total), "permutation-index")
            asked = rows.where(query & (F.size("vector") == pivots.shape[1]))
            batches = max(1, math.ceil(asked.count() / BATCH))
            for batch in range(batches):
                part = asked.where(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(batches)) == batch)
                picked = sorted({(r["vec_id"], tuple(r["vector"])) for r in part.collect()})
                if picked:
                    near = stage(search(index, picked, pivots, total), "neighbours")
                    found = near if found is None else found.unionByName(near)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= NEIGHBOURS)
        .select("query_id", "rank", "vec_id", "score")
    )
