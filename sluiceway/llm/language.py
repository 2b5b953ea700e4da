"""Language identification by word-first backoff.

Known words are scored by their log frequency in each language. A word that no language
knows falls back to its character n-grams, from the longest to the shortest length at which
any of them is known. The document takes the language of the highest sum.

Defined results: null text or text without a letter is ``und`` with score 0; with no labelled
row to learn from, every text is ``und``; rows with equal ids are predicted one by one; ties
go to the language that sorts first. Extra columns play no part.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from sluiceway.llm.common import BATCH_ROWS, map_batches, narrow, prepare, remainder, stage

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
LONGEST = 5

# The classifier is fitted on labelled documents chosen by hash, about this many of each
# language, and all of a language that has fewer. The model holds all their words and n-grams, so
# this is what bounds its size.
TRAINING_DOCUMENTS = 2_000
# Scores of words out of the vocabulary that a task remembers.
REMEMBERED = 200_000
# The pipeline rejects a document whose words say nothing: a score of no more than this
# times an even guess among the languages, from words of which the model knows any.
EVIDENCE = 1.05


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of the word with its ends marked."""
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(max(1, len(marked) - n + 1))]


def fit(docs: DataFrame, documents: int = TRAINING_DOCUMENTS) -> dict:
    """Log frequencies per language, from labelled documents outside the held-out part.

    ``documents`` bounds the sample of each language: rows are taken by a hash of id and text.
    The model keeps every word and n-gram of the sample, so its size is bounded by the sample's.
    """
    prepare(docs.sparkSession)
    labelled = narrow(docs, "lang").where(
        F.col("lang").isNotNull() & (F.col("text") != "") & (remainder("doc_id", 4) != 2)
    )
    shares = stage(
        labelled.groupBy("lang").agg((documents / F.count(F.lit(1))).alias("share")),
        "language-shares",
    )
    picked = (
        labelled.join(shares, "lang")
        .where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < F.col("share") * 1_000_000)
        .select("lang", "text")
    )
    words = (
        map_batches(picked, _count_words, "lang string, gram string, times long")
        .groupBy("lang", "gram")
        .agg(F.sum("times").alias("times"))
    )
    words = stage(words, "language-words")
    counted = (
        map_batches(words, _count_grams, "lang string, n int, gram string, times long")
        .groupBy("lang", "n", "gram")
        .agg(F.sum("times").alias("times"))
        .unionByName(words.withColumn("n", F.lit(0)))
    )
    found = counted.select("lang", "n", "gram", "times").toArrow()
    return _tables(row for batch in found.to_batches(BATCH_ROWS) for row in batch.to_pylist())


def _count_words(batches: Iterator[dict]) -> Iterator[dict]:
    counts: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            counts[lang].update(WORD.findall(text.lower()))
        if sum(map(len, counts.values())) > REMEMBERED:
            yield from _flush(counts)
    yield from _flush(counts)


def _flush(counts: dict[str, Counter]) -> Iterator[dict]:
    for lang, counter in counts.items():
        yield {
            "lang": [lang] * len(counter),
            "gram": list(counter),
            "times": list(counter.values()),
        }
    counts.clear()


def _count_grams(batches: Iterator[dict]) -> Iterator[dict]:
    """Character n-grams of distinct words, each counted as often as its word occurs."""
    counts: Counter = Counter()
    for batch in batches:
        for lang, word, times in zip(batch["lang"], batch["gram"], batch["times"]):
            for n in range(1, LONGEST + 1):
                for gram in grams(word, n):
                    counts[lang, n, gram] += times
        if len(counts) > REMEMBERED:
            yield _columns(counts)
            counts.clear()
    yield _columns(counts)


def _columns(counts: Counter) -> dict:
    return {
        "lang": [key[0] for key in counts],
        "n": [key[1] for key in counts],
        "gram": [key[2] for key in counts],
        "times": list(counts.values()),
    }


def _tables(rows: Iterable) -> dict:
    """Rows of counts as one table of log frequencies per length (0: whole words)."""
    seen: dict[str, int] = {}
    indexes: dict[int, dict[str, int]] = defaultdict(dict)
    cells: dict[int, tuple[array, array, array]] = defaultdict(
        lambda: (array("q"), array("q"), array("q"))
    )
    for row in rows:
        index = indexes[row["n"]]
        cell = (
            index.setdefault(row["gram"], len(index)),
            seen.setdefault(row["lang"], len(seen)),
            row["times"],
        )
        for column, value in zip(cells[row["n"]], cell):
            column.append(value)
    langs = sorted(seen)
    column = np.zeros(len(langs), dtype=np.int64)
    column[[seen[lang] for lang in langs]] = np.arange(len(langs))
    tables = {}
    for n, index in indexes.items():
        at, lang, times = (np.array(part, dtype=np.int64) for part in cells[n])
        lang = column[lang]
        totals = np.bincount(lang, times, minlength=len(langs))
        base = math.log(0.5) - np.log(totals + 0.5 * len(index))
        values = np.tile(base.astype(np.float32), (len(index), 1))
        values[at, lang] += np.log((times + 0.5) / 0.5).astype(np.float32)
        tables[n] = (index, values)
    return {"langs": langs, "tables": tables}


class Scorer:
    """Scores texts with a fitted model; one per task."""

    def __init__(self, model: dict):
        self.langs = model["langs"]
        self.tables = model["tables"]
        index, values = self.tables.get(0, ({}, np.zeros((0, len(self.langs)), np.float32)))
        self.known = len(index)
        self.words = index
        self.place = dict(index)
        self.values = np.vstack(
            [values, np.zeros((REMEMBERED, len(self.langs)), np.float32)]
        )
        self.used = self.known

    def backoff(self, word: str) -> np.ndarray:
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            index, values = self.tables.get(n, ({}, None))
            at = [index[gram] for gram in grams(word, n) if gram in index]
            if at:
                return values[at].mean(axis=0)
        return np.zeros(len(self.langs), np.float32)

    def row(self, word: str) -> int:
        if self.used == len(self.values):  # forget the remembered words
            self.place = dict(self.words)
            self.used = self.known
        at = self.used
        self.values[at] = self.backoff(word)
        self.place[word] = at
        self.used += 1
        return at

    def knows(self, text: str) -> bool:
        """Whether the model has any letter of the text; the marks of a word's ends, which
        every language has, tell nothing."""
        letters, _ = self.tables.get(1, ({}, None))
        return any(c in letters for word in WORD.findall(text.lower()) for c in word)

    def score(self, text: str | None) -> tuple[str, float]:
        words = WORD.findall(text.lower()) if text else []
        if not self.langs or not any(c.isalpha() for word in words for c in word):
            return UNKNOWN, 0.0
        total = np.zeros(len(self.langs))
        for start in range(0, len(words), 4096):
            part = words[start : start + 4096]
            if self.used + len(part) > len(self.values):
                self.place, self.used = dict(self.words), self.known
            get, row = self.place.get, self.row
            at = [i if (i := get(word)) is not None else row(word) for word in part]
            total += self.values[at].sum(axis=0, dtype=np.float64)
        # Words of a text depend on each other: the sum counts as the root of their number.
        total /= math.sqrt(len(words))
        weights = np.exp(total - total.max())
        best = int(weights.argmax())
        return self.langs[best], float(weights[best] / weights.sum())


def predict(docs: DataFrame, model: dict, *carry: str) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row, with the columns in ``carry``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.score(text) for text in batch["text"]]
            yield {
                **{name: batch[name] for name in ("doc_id", *carry)},
                "lang_pred": [lang for lang, _ in found],
                "score": [score for _, score in found],
            }

    source = narrow(docs, *carry)
    types = dict(source.dtypes)
    kept = "".join(f", {name} {types[name]}" for name in carry)
    return map_batches(source, run, f"doc_id long{kept}, lang_pred string, score double")


def identify(docs: DataFrame, documents: int = TRAINING_DOCUMENTS) -> DataFrame:
    """Fit on the labelled part and predict every row."""
    prepare(docs.sparkSession)
    predicted = predict(docs, fit(docs, documents))
    return predicted.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def keep_identified(docs: DataFrame, evidence: float = EVIDENCE) -> DataFrame:
    """Rows with a letter, all columns unchanged, except where words that the model knows tell
    no language. A text of which it knows nothing, such as one in a script that no labelled
    row has, stays. Without any labelled document there is no language to know and no row
    stays."""
    prepare(docs.sparkSession)
    model = fit(docs)
    least_score = evidence / max(1, len(model["langs"])) if len(model["langs"]) > 1 else 0.0
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            kept = [
                i
                for i, (lang, score) in enumerate(map(scorer.score, texts))
                if lang != UNKNOWN and (score > least_score or not scorer.knows(texts[i]))
            ]
            if kept:
                yield batch.take(kept)

    return docs.mapInArrow(run, docs.schema)
