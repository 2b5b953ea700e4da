"""License scans by diagonal voting.

Texts to look for (``license_texts``) are phrases, notices and passages of licenses, each a
template of words. A task hashes all runs of ``GRAM`` words of a document, rolling over the whole
text, and of two words for the shorter phrases. Spark joins all these hashes to the positions of
the templates; a hit lies on the diagonal ``place in the document - place in the template``. Hits
are counted by diagonal, and neighbouring diagonals are merged, as an inserted or deleted word
moves the rest of a copy by one. Bands of diagonals with enough votes become spans, and each is
verified by the edit distance of its words to the template.

A copy scores ``1 - edits / words of the template`` and counts from ``LEAST`` on. With so many
edits at least ``len - 2 - 3 * edits`` hits remain, all on diagonals at most ``edits`` apart, and
bands overlap by as many, so no such copy is missed. Where that leaves no hit (notices of five words
with one edited) there is nothing to find it by. A notice must hold the name of its license
unedited. Of spans that overlap by half, the one of the best score stays, of equal ones the
longest template. Phrases must stand word by word, and all their places count.

Templates are a fixed list in the code, so they are broadcast. Hits are counted in the map task
before they are shuffled. Texts meet the spans that were found by a hash of id and text of 128 bits.
Before they are shuffled for that, a bitmap of the hashes with spans, of ``SLOTS`` bits at most,
tells the others apart: those stay where they are, and a document without spans gets its row from a
join of counts alone.

Defined results: null and empty texts have no words and no labels; rows that are equal in id and
text get equal results; an empty table gives an empty one. Extra columns play no part. The score
of a document is 1 if a phrase stands in it, else the best of its spans, else 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.llm.common import likely, map_batches, narrow, prepare, stage
from sluiceway.llm.license_texts import NAMES, NOTICES, PASSAGES, PHRASES

GRAM = 3
LEAST = 0.8
# Word hashes that a task remembers.
REMEMBERED = 500_000

# Words are digits, letters a to z and all that is not ASCII; A to Z are lowered.
TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)
# Odd numbers for the rolling hashes of three and of two words.
FACTORS = [
    np.random.default_rng(width).integers(1, 1 << 62, width).astype(np.uint64) * 2 + 1
    for width in (GRAM, GRAM - 1)
]

FINDINGS = (
    "one long, two long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double"
)


class Template(NamedTuple):
    label: str
    words: list[bytes]
    name: list[bytes]  # words that must stand there unedited
    phrase: bool

    @property
    def edits(self) -> int:
        """Most edits of a copy that counts."""
        return 0 if self.phrase else int(len(self.words) * (1 - LEAST) + 1e-9)

    @property
    def votes(self) -> int:
        """Fewest hits of such a copy."""
        return max(1, len(self.words) - GRAM + 1 - GRAM * self.edits)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(TO_WORDS).split()


@cache
def templates() -> list[Template]:
    made = [Template(label, words_of(text), [], True) for text, label in PHRASES.items()]
    for label, names in NAMES.items():
        for name in names:
            made += [
                Template(label, words_of(f"{notice} {name}"), words_of(name), False)
                for notice in NOTICES
            ]
    for label, passages in PASSAGES.items():
        made += [Template(label, words_of(text), [], False) for text in passages]
    return made


class _Hashes(dict):
    """64-bit hash of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        self[word] = found
        return found


def rolling(words: list[bytes], hashes: _Hashes) -> list[np.ndarray]:
    """Hashes of all runs of three words, and of all runs of two."""
    one = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    made = []
    for factors in FACTORS:
        stop = len(one) - len(factors) + 1
        if stop <= 0:
            made.append(one[:0])
            continue
        total = sum(one[i : i + stop] * factor for i, factor in enumerate(factors))
        made.append(total ^ (total >> np.uint64(29)))
    return made


def gram_table(spark: SparkSession) -> DataFrame:
    """Positions of the hashes of all templates, with what merging needs to know."""
    rows, hashes = [], _Hashes()
    for number, template in enumerate(templates()):
        width = min(GRAM, len(template.words))
        grams = rolling(template.words, hashes)[GRAM - width]
        band = max(1, template.edits)
        rows += [
            (int(gram), at, number, band, template.votes, template.phrase)
            for at, gram in enumerate(grams.view(np.int64))
        ]
    return spark.createDataFrame(
        rows, "gram long, at int, template int, band int, needed int, phrase boolean"
    )


def document_grams(docs: DataFrame) -> DataFrame:
    """``one`` and ``two``, the number of threes, and all hashes: threes, then twos."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            threes, parts, sizes = [], [], [0]
            for text in batch["text"].to_pylist():
                three, two = rolling(words_of(text), hashes)
                threes.append(len(three))
                parts += [three, two]
                sizes.append(sizes[-1] + len(three) + len(two))
            grams = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["one"],
                    batch["two"],
                    pa.array(threes, type=pa.int32()),
                    pa.ListArray.from_arrays(pa.array(sizes, type=pa.int32()), pa.array(grams)),
                ],
                names=["one", "two", "threes", "grams"],
            )

    texts = docs.where("text <> ''").select("one", "two", "text")
    return texts.mapInArrow(run, "one long, two long, threes int, grams array<long>")


def vote(docs: DataFrame) -> DataFrame:
    """Spans with enough votes: ``template``, ``low`` and ``high`` diagonal, by document."""
    spark = docs.sparkSession
    grams = document_grams(docs).select("one", "two", "threes", F.posexplode("grams"))
    hits = grams.join(F.broadcast(gram_table(spark)), F.col("col") == F.col("gram"))
    place = F.when(F.col("pos") < F.col("threes"), F.col("pos")).otherwise(
        F.col("pos") - F.col("threes")
    )
    keys = ["one", "two", "template", "band", "needed", "phrase"]
    diagonals = (
        hits.select(*keys, (place - F.col("at")).alias("diagonal"))
        .groupBy(*keys, "diagonal")
        .agg(F.count("*").alias("votes"))
    )
    # A band is twice as wide as copies drift and overlaps the next one by half.
    number = F.floor(F.col("diagonal") / F.col("band"))
    numbers = F.when(F.col("phrase"), F.array("diagonal")).otherwise(F.array(number, number - 1))
    return (
        diagonals.withColumn("number", F.explode(numbers.cast("array<long>")))
        .groupBy(*keys, "number")
        .agg(
            F.sum("votes").alias("votes"),
            F.min("diagonal").alias("low"),
            F.max("diagonal").alias("high"),
        )
        .where("votes >= needed")
        .select("one", "two", "template", "low", "high")
        .distinct()
    )


def edits_within(template: list[bytes], words: list[bytes]) -> tuple[int, int]:
    """Least number of edits from the template to any stretch of the words, and its end."""
    numbers = {word: i for i, word in enumerate(template)}
    expected = np.array([numbers[word] for word in template])
    steps = np.arange(len(template) + 1)
    column = steps.copy()
    best, end = len(template), 0
    for at, word in enumerate(words, 1):
        other = expected != numbers.get(word, -1)
        moved = np.minimum(column[1:] + 1, column[:-1] + other)
        column = np.r_[0, moved]
        column = np.minimum.accumulate(column - steps) + steps
        if column[-1] < best:
            best, end = int(column[-1]), at
    return best, end


def _holds(words: list[bytes], name: list[bytes]) -> bool:
    size = len(name)
    return any(words[i : i + size] == name for i in range(len(words) - size + 1))


def verify(words: list[bytes], spans: list[dict]) -> tuple:
    """What the spans of a document come to: see ``FINDINGS``, without the hash."""
    places, base, scored = set(), set(), []
    for span in spans:
        template = templates()[span["template"]]
        size = len(template.words)
        if template.phrase:
            begin = span["low"]
            if words[begin : begin + size] == template.words:
                places.add((begin, template.label))
                base.add(template.label)
            continue
        # Edits before the first hit or after the last one move the ends.
        begin = max(0, span["low"] - template.edits)
        stretch = words[begin : span["high"] + size + template.edits]
        if template.name and not _holds(stretch, template.name):
            continue
        edits, end = edits_within(template.words, stretch)
        if edits <= template.edits:
            scored.append((1 - edits / size, size, begin + end, template.label))
    labels, taken = set(base), []
    for score, size, end, label in sorted(scored, key=lambda s: (-s[0], -s[1], s[2], s[3])):
        begin = end - size
        if all(min(end, e) - max(begin, b) < min(size, e - b) / 2 for b, e in taken):
            taken.append((begin, end))
            labels.add(label)
    starts = [at for at, _ in places]
    return (
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        1.0 if places else max((s[0] for s in scored), default=0.0),
    )


def findings(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """A row per document that has spans."""
    names = [part.split()[0] for part in FINDINGS.split(", ")]

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            rows = [
                (one, two, *verify(words_of(text), found))
                for one, two, text, found in zip(
                    batch["one"], batch["two"], batch["text"], batch["spans"]
                )
            ]
            yield dict(zip(names, zip(*rows)))

    by_document = spans.groupBy("one", "two").agg(
        F.collect_list(F.struct("template", "low", "high")).alias("spans")
    )
    by_document = stage(by_document, "spans")
    texts = likely(docs.select("one", "two", "text"), by_document, "one")
    texts = texts.join(by_document, ["one", "two"])
    return map_batches(texts, run, FINDINGS).dropDuplicates(["one", "two"])


def count_words(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            yield {
                "doc_id": batch["doc_id"],
                "one": batch["one"],
                "two": batch["two"],
                "n_words": [len(words_of(text)) for text in batch["text"]],
            }

    return map_batches(docs, run, "doc_id long, one long, two long, n_words long")


def scan(docs: DataFrame) -> DataFrame:
    """Labels of every document, with the places of the phrases."""
    prepare(docs.sparkSession)
    texts = narrow(docs).select(
        "*", F.xxhash64("doc_id", "text").alias("one"), F.xxhash64("text", "doc_id").alias("two")
    )
    found = findings(texts, vote(texts))
    return (
        count_words(texts)
        .join(found, ["one", "two"], "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_base", F.lit(0)).alias("n_base"),
            "first_word",
            "last_word",
            F.coalesce("base_labels", F.lit("")).alias("base_labels"),
            F.coalesce("labels", F.lit("")).alias("labels"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )
