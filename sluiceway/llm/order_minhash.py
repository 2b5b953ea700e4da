"""Near-duplicate classes by order MinHash, verified by banded alignment.

A document is the sequence of its shingles of five words, each labelled with how often it
occurred before. Every sketch takes the few smallest of them under its own hash and keeps
them in the order of the text, so two documents share a sketch when they share shingles in
the same order: the measure is edit similarity, not overlap of sets. Documents that share a
sketch are candidates. Of short documents, whose sketches hold too much of the text, those that
share one of their rarest shingles are candidates as well, as many of them as no similar pair
can do without. A pair is linked if the alignment of its shingle sequences reaches
``aligned / (a + b - aligned) >= 0.8``; classes are the connected components.

Equal word sequences are folded first and one of them stands for all. In a bucket of a
sketch, the smallest documents are compared with all that are not yet in their class, then
leave the bucket, until one class is left; so no pair of a bucket is lost, and copies of one
text never meet in pairs. Members of a bucket become a pair only if the parities of their
shingles, counted in a fixed number of cells, leave the similarity possible: shingles that only
one of two documents has are at least as many as the cells they differ in. So a large group of
texts whose distance is just beyond the threshold makes few pairs, and loses no link.

Defined results: a class is named by its smallest id; documents without a word, or of which
no other is near, are their own class; rows with equal ids take the smallest class of them;
rows without an id take no part and get a null class. An empty table gives no rows. Extra
columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from sluiceway.llm.common import Scratch, likely, map_batches, narrow, prepare, stage

WORD = re.compile(r"\w+")
SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Sketches per document, and shingles in each. At similarity 0.8 a sketch agrees with
# probability 0.8 ** 6 = 0.26 at least, so all 24 miss a pair once in 1400 times.
SKETCHES = 24
SAMPLED = 6
# Shingles of a short document. Pairs of which one is short are found by single shingles, so
# documents up to SHORT / SIMILARITY take part.
SHORT = 30
# Documents of a bucket that are compared with all others in the first round. Each round
# takes eight times as many of what is left, so the number of rounds stays small.
CENTRES = 1
GROWTH = 8
# Parity cells of a document, in words of 64. They tell documents of up to some 2,300 shingles
# apart; of longer ones more pairs are aligned.
CELLS = 1024
REMEMBERED = 400_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class Shingler:
    """Shingle sequences of texts; one per task."""

    def __init__(self):
        self.seen: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
        digest = hashlib.blake2b(word.encode(), digest_size=8).digest()
        found = self.seen[word] = int.from_bytes(digest, "little")
        return found

    def words(self, text: str) -> np.ndarray:
        words = WORD.findall(text.lower())
        found = list(map(self.seen.get, words))
        if None in found:
            found = [self._hash(w) if h is None else h for w, h in zip(words, found)]
        return np.array(found, dtype=np.uint64)

    def shingles(self, words: np.ndarray) -> np.ndarray:
        if not len(words):
            return words
        size = min(SHINGLE_WORDS, len(words))
        count = len(words) - size + 1
        keys = np.zeros(count, dtype=np.uint64)
        for k in range(size):
            keys = _mix(keys * _ODD + words[k : k + count])
        return keys


def labelled(keys: np.ndarray) -> np.ndarray:
    """Keys with the number of earlier occurrences mixed in."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    if len(starts) == len(keys):
        return keys
    lengths = np.diff(np.concatenate([starts, [len(keys)]]))
    earlier = np.empty(len(keys), dtype=np.uint64)
    earlier[order] = np.arange(len(keys)) - np.repeat(starts, lengths)
    return np.where(earlier > 0, _mix(keys + earlier * _ODD), keys)


def sketches(keys: np.ndarray) -> list[int]:
    """One signed number per sketch: its sampled keys, in text order, folded."""
    keys = labelled(keys)
    numbers = np.arange(1, SKETCHES + 1, dtype=np.uint64)
    if len(keys) > SAMPLED:
        salts = _mix(numbers * _ODD)
        together = max(1, (1 << 20) // len(keys))  # sketches of a long text in parts
        picked = [
            np.argpartition(_mix(keys ^ salts[at : at + together, None]), SAMPLED, axis=1)[
                :, :SAMPLED
            ]
            for at in range(0, SKETCHES, together)
        ]
        sample = keys[np.sort(np.concatenate(picked), axis=1)]
    else:
        sample = np.broadcast_to(keys, (SKETCHES, len(keys)))
    folded = numbers
    for place in range(sample.shape[1]):
        folded = _mix(folded * _ODD + sample[:, place])
    return folded.view(np.int64).tolist()


def parities(keys: np.ndarray) -> list[int]:
    """Whether the number of shingles in each cell is odd, as words of 64 cells."""
    cells = (labelled(keys) % np.uint64(CELLS)).astype(np.int64)
    odd = (np.bincount(cells, minlength=CELLS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8").tolist()


@lru_cache
def _share(least: float) -> Fraction:
    """Aligned shingles a pair needs, as a share of the shingles of both."""
    exact = Fraction(str(least))
    return exact / (1 + exact)


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether the alignment of two sequences reaches the similarity.

    The number of aligned shingles is their longest common subsequence. It is bounded from
    above by the common shingles of any order; where those stand in the same order once
    each, that is the answer. Else a band around the diagonal, as wide as the similarity
    allows insertions, is filled row by row.
    """
    if not len(a) or not len(b):
        return False
    share = _share(least)
    needed = -(-share.numerator * (len(a) + len(b)) // share.denominator)
    if min(len(a), len(b)) < needed:
        return False
    head = 0
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b, needed = a[head:], b[head:], needed - head
    short = min(len(a), len(b))
    if short:
        differ = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
        tail = int(differ[0]) if len(differ) else short
        a, b, needed = a[: len(a) - tail], b[: len(b) - tail], needed - tail
    if needed <= 0:
        return True
    keys_a, counts_a = np.unique(a, return_counts=True)
    keys_b, counts_b = np.unique(b, return_counts=True)
    both, at_a, at_b = np.intersect1d(keys_a, keys_b, assume_unique=True, return_indices=True)
    if int(np.minimum(counts_a[at_a], counts_b[at_b]).sum()) < needed:
        return False
    single = both[(counts_a[at_a] == 1) & (counts_b[at_b] == 1)]
    order_b = np.argsort(b, kind="stable")
    in_a = np.flatnonzero(np.isin(a, single))
    in_b = order_b[np.searchsorted(b, a[in_a], sorter=order_b)]
    if len(in_a) >= needed and bool(np.all(np.diff(in_b) > 0)):
        return True
    # Insertions and deletions that may remain, so no aligned pair lies further off.
    band = int(len(a) + len(b) - 2 * needed) + 1
    row = np.zeros(2 * band + 1, dtype=np.int32)  # row[k]: columns up to i + k - band
    columns = np.arange(-band, band + 1)
    for i, key in enumerate(a):
        at = columns + i
        inside = (at >= 0) & (at < len(b))
        equal = np.zeros(2 * band + 1, dtype=np.int32)
        equal[inside] = b[at[inside]] == key
        above = np.concatenate([row[1:], row[-1:]])
        row = np.maximum.accumulate(np.maximum(row + equal, above))
    return int(row.max()) >= needed


SIGNED = "doc long, exact string, size int, sketches array<long>, singles array<long>"


def signatures(docs: DataFrame) -> DataFrame:
    """Per row: a digest of its words, the number of shingles, the sketches, and the shingles
    themselves where a document is short."""
    longest = int(SHORT / SIMILARITY)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        shingler = Shingler()
        for batch in batches:
            out = {"doc": [], "exact": [], "size": [], "sketches": [], "singles": []}
            for doc, text in zip(batch["doc_id"], batch["text"]):
                words = shingler.words(text)
                if len(words):
                    keys = shingler.shingles(words)
                    out["doc"].append(doc)
                    out["exact"].append(
                        hashlib.blake2b(words.tobytes(), digest_size=16).hexdigest()
                    )
                    out["size"].append(len(keys))
                    out["sketches"].append(sketches(keys))
                    single = labelled(keys) if len(keys) <= longest else keys[:0]
                    out["singles"].append(single.view(np.int64).tolist())
            if out["doc"]:
                yield out

    return map_batches(narrow(docs).where("doc_id IS NOT NULL"), run, SIGNED)


def _rarest(heads: DataFrame, scratch: Scratch) -> DataFrame:
    """Buckets of short documents: their rarest shingles, each in a bucket of its own.

    A similar partner holds at least 0.8 of a document's shingles, so it lacks a fifth at most;
    in an order that is the same for all, two similar documents share one of the first fifth of
    their shingles and one more. The rarest come first, so few documents meet in a bucket.
    """
    singles = scratch.stage(
        heads.select("node", "size", F.explode("singles").alias("key")), "singles"
    )
    times = singles.groupBy("key").agg(F.count(F.lit(1)).alias("times"))
    times = scratch.stage(times, "shingle-counts")
    order = Window.partitionBy("node").orderBy("times", "key")
    return (
        singles.join(times, "key")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= F.floor(F.col("size") / 5) + 1)
        .where("times > 1")
        .select("node", "size", F.xxhash64(F.lit("single"), "key").alias("bucket"))
    )


def sequences(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Shingle sequences of the documents in ``wanted``, a column ``node`` of ids, with their
    lengths and parities."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        shingler = Shingler()
        for batch in batches:
            keys = [shingler.shingles(shingler.words(text)) for text in batch["text"]]
            yield {
                "node": batch["doc_id"],
                "keys": [k.tobytes() for k in keys],
                "length": [len(k) for k in keys],
                "odd": [parities(k) for k in keys],
            }

    # Few texts are wanted: a bitmap of their ids keeps most others from being shuffled.
    rows = narrow(docs).withColumn("one", F.xxhash64("doc_id"))
    rows = likely(rows, wanted.withColumn("one", F.xxhash64("node")), "one")
    rows = rows.join(wanted, F.col("doc_id") == F.col("node"), "left_semi")
    # Rows with equal ids: the first text in order stands for them.
    first = rows.groupBy("doc_id").agg(F.min("text").alias("text"))
    return map_batches(first, run, "node long, keys binary, length int, odd array<long>")


def verified(pairs: DataFrame, keys: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) that are similar. Large sequences move once per pair."""
    left = pairs.join(keys.select(F.col("node").alias("a"), F.col("keys").alias("keys_a")), "a")
    full = left.join(keys.select(F.col("node").alias("b"), F.col("keys").alias("keys_b")), "b")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            near = [
                similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                for x, y in zip(batch["keys_a"], batch["keys_b"])
            ]
            if any(near):
                yield {
                    name: [v for v, ok in zip(batch[name], near) if ok] for name in ("a", "b")
                }

    return map_batches(full.select("a", "b", "keys_a", "keys_b"), run, "a long, b long")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with.

    Each round every node takes the smallest label among its neighbours and follows the
    label of that label, so long chains shorten by more than a step a round.
    """
    edges = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    edges = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    edges = scratch.stage(edges.distinct(), "links")
    labels = edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label"))
    labels = scratch.stage(labels, "labels")
    while True:
        beside = labels.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
        heard = edges.join(beside, "other").groupBy("node").agg(F.min("theirs").alias("theirs"))
        nearer = labels.join(heard, "node").select(
            "node", "label", F.least("label", "theirs").alias("found")
        )
        jump = labels.select(F.col("node").alias("found"), F.col("label").alias("further"))
        updated = nearer.join(jump, "found", "left").select(
            "node",
            F.least("found", F.coalesce("further", "found")).alias("label"),
            F.col("label").alias("before"),
        )
        updated = scratch.stage(updated, "labels")
        labels = updated.select("node", "label")
        if updated.where("label != before").isEmpty():
            return labels


def _merged(labels: DataFrame | None, near: DataFrame, scratch: Scratch) -> DataFrame:
    """Labels after new links: only the classes that these links join are gone through again."""
    if labels is None:
        return components(near, scratch)
    of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    ends = near.join(of_a, "a", "left").join(of_b, "b", "left")
    ends = ends.select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")
    )
    joined = components(ends.distinct(), scratch)
    now = joined.select(F.col("node").alias("label"), F.col("label").alias("now"))
    known = labels.join(now, "label", "left").select("node", F.coalesce("now", "label").alias("label"))
    fresh = joined.join(labels, "node", "left_anti").select("node", "label")
    return scratch.stage(known.unionByName(fresh), "labels")


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``class_id`` of every row, staged in the shared folder."""
    spark = prepare(docs.sparkSession)
    with Scratch(spark) as scratch:
        signed = scratch.stage(signatures(docs), "sketches")
        texts = scratch.stage(
            signed.groupBy("exact").agg(F.min("doc").alias("node"), F.min("size").alias("size")),
            "texts",
        )
        own = signed.join(texts.select("exact", "node"), "exact")
        heads = own.where("doc = node").dropDuplicates(["node"])
        heads = heads.select("node", "size", "sketches", "singles")
        # A node is once in a bucket, as its sketches and shingles differ.
        own_buckets = F.explode(F.array_distinct("sketches"))
        members = heads.select("node", "size", own_buckets.alias("bucket"))
        members = scratch.stage(members.unionByName(_rarest(heads, scratch)), "buckets")
        shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = scratch.stage(members.join(shared.select("bucket"), "bucket"), "buckets")
        keys = scratch.stage(
            sequences(docs, members.select("node").distinct()), "sequences"
        )
        known = keys.select("node", "length", "odd")
        members = members.join(known, "node").withColumn("label", F.col("node"))
        members = scratch.stage(members, "buckets")
        compared, labels = None, None
        number = CENTRES
        while not members.isEmpty():
            centres = scratch.stage(_centres(members, number), "centres")
            number *= GROWTH
            pairs = _pairs(members, centres)
            if compared is not None:
                pairs = pairs.join(compared, ["a", "b"], "left_anti")
            pairs = scratch.stage(pairs, "pairs")
            compared = pairs if compared is None else compared.unionByName(pairs)
            near = scratch.stage(verified(pairs, keys), "near")
            if not near.isEmpty():
                labels = _merged(labels, near, scratch)
            members = scratch.stage(_rest(members, centres, labels), "buckets")
        named = own.select("doc", "node").distinct()
        if labels is not None:
            named = named.join(labels, "node", "left")
        else:
            named = named.withColumn("label", F.lit(None).cast("long"))
        best = named.groupBy("doc").agg(F.min(F.coalesce("label", "node")).alias("class_id"))
        ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
        result = ids.join(best, ids["doc_id"] == best["doc"], "left").select(
            "doc_id", F.coalesce("class_id", "doc_id").alias("class_id")
        )
        return stage(result, "near-classes")


def _centres(members: DataFrame, number: int) -> DataFrame:
    """The smallest documents of each bucket."""
    order = Window.partitionBy("bucket").orderBy("node")
    first = members.withColumn("place", F.row_number().over(order)).where(F.col("place") <= number)
    names = {"node": "a", **{name: f"{name}_a" for name in ("size", "length", "odd", "label")}}
    return first.select("bucket", *[F.col(name).alias(new) for name, new in names.items()])


def _pairs(members: DataFrame, centres: DataFrame) -> DataFrame:
    """Centres with the rest of their bucket, as far as class, length and parities leave it open."""
    # The similarity leaves a ninth of the shingles of both to one of them alone.
    alone = sum(
        F.bit_count(F.col("odd")[word].bitwiseXOR(F.col("odd_a")[word]))
        for word in range(CELLS // 64)
    )
    both = members.join(centres, "bucket").where(
        (F.col("a") < F.col("node"))
        & (F.col("label") != F.col("label_a"))
        & (5 * F.least("size", "size_a") >= 4 * F.greatest("size", "size_a"))
        & (9 * alone <= F.col("length") + F.col("length_a"))
    )
    return both.select("a", F.col("node").alias("b")).distinct()


def _rest(members: DataFrame, centres: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members that still have somebody of another class in their bucket."""
    left = members.join(
        centres.select("bucket", F.col("a").alias("node")), ["bucket", "node"], "left_anti"
    )
    if labels is not None:
        now = labels.withColumnRenamed("label", "now")
        left = left.join(now, "node", "left")
        left = left.withColumn("label", F.coalesce("now", "label")).drop("now")
    open_ = (
        left.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low != high")
        .select("bucket")
    )
    return left.join(open_, "bucket", "left_semi")


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that name their class; rows without an id stay."""
    gone = classes(docs).where("class_id != doc_id").select(F.col("doc_id").alias("_gone"))
    gone = stage(gone.distinct(), "near-duplicates")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")
