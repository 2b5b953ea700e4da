"""Toxicity scores after noisy-channel deobfuscation.

Hidden words are written with digits or signs for letters, with signs or blanks between
letters, or with letters repeated. A part of a text that shows one of these is read as a
lattice of characters: each sign may stand for letters or for nothing, each run of a letter
for one or two of it. Viterbi decoding picks the path of highest probability under a
character trigram model of the corpus and the costs of the channel. All other parts have a
lattice of one path and stay as they are.

The restored text is scored with a lexicon of words and word beginnings that mark labelled
toxic documents, chosen greedily: each entry must explain toxic documents that earlier
entries do not. The score is the probability that at least one of the found entries is
right, each by its precision.

The character model counts all documents. The lexicon is fitted on a bounded sample of the
labelled documents outside the held-out part.

Defined results: null and empty texts have the score of a text without any entry; with no
toxic label to learn from, all scores are 0; a document with several labels is toxic if one
says so; rows with equal ids are scored each. Extra columns play no part.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from sluiceway.llm.common import Scratch, map_batches, narrow, prepare, remainder

# Labelled documents of each label that the lexicon is fitted on, about.
SAMPLE = 6_000
# Documents an entry must explain, and its least precision.
LEAST_SUPPORT = 3
LEAST_PRECISION = 0.6
# Entries that may explain the same document.
COVERS = 6
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
REMEMBERED = 100_000

WORD = re.compile(r"[^\W\d_]+")
# Signs that stand for letters.
SIGNS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
_SIGNS = re.escape("".join(SIGNS))
# Where a text may hide something: a sign at a letter, a separator between letters, a run of
# a letter, single letters in a row.
SIGN = re.compile(
    r"[^\W\d_][0-9@$|+€£]|[0-9@$|+€£][^\W\d_]|[^\W\d_][!*.\-_][^\W\d_]"
)
RUN = re.compile(r"([^\W\d_])\1\1")
SPACED = re.compile(
    rf"(?<![\w{_SIGNS}])[\w{_SIGNS}]([ .*_\-]{{1,2}})[\w{_SIGNS}](?:\1[\w{_SIGNS}])+(?![\w{_SIGNS}])"
)
TOKEN = re.compile(rf"(?:[^\W_]|[{_SIGNS}*._\-])+")
TAIL = "!.*-_|"
# Runs of signs after words are decoration, not letters.
DECORATION = re.compile(rf"([{_SIGNS}*#%&])\1+")

# Channel costs as log probabilities: a sign read as a letter or as nothing, a letter of a
# run dropped, a doubled letter kept, a separator kept as the end of a word.
READ, NOTHING, DROPPED, BREAK = -1.0, -9.0, -0.7, -3.0

# Symbols of the character model: word end, letters a to z, Latin letters with marks, rest.
_EDGE, _OTHER, _SYMBOLS = 0, 63, 64


def _symbol_table() -> np.ndarray:
    table = np.full(0x180, _OTHER, dtype=np.int32)
    for code in range(0x180):
        letter = chr(code)
        if "a" <= letter <= "z":
            table[code] = 1 + code - ord("a")
        elif not letter.isalpha():
            table[code] = _EDGE
        elif 0xDF <= code <= 0xFF:
            table[code] = 27 + code - 0xDF
    return table


SYMBOL = _symbol_table()


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return SYMBOL[np.minimum(codes, len(SYMBOL) - 1)]


def count_trigrams(docs: DataFrame) -> np.ndarray:
    """Trigrams of symbols over all documents. The alphabet bounds the table."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        total = np.zeros(_SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                s = symbols(f"  {text.lower()} ")
                # A run of signs is one edge.
                s = s[np.concatenate([[True], (s[1:] != _EDGE) | (s[:-1] != _EDGE)])]
                s = np.concatenate([[_EDGE], s])
                keys = (s[:-2] * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:]
                if len(keys) > 20_000:
                    total += np.bincount(keys, minlength=len(total))
                else:
                    np.add.at(total, keys, 1)
        at = np.flatnonzero(total)
        yield {"gram": at.tolist(), "times": total[at].tolist()}

    counts = map_batches(narrow(docs).select("text"), run, "gram long, times long")
    table = np.zeros(_SYMBOLS**3)
    for row in counts.groupBy("gram").agg(F.sum("times").alias("times")).collect():
        table[row["gram"]] = row["times"]
    return table


def character_model(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of a symbol after two others, smoothed by the shorter contexts."""
    three = counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
    one = three.sum(axis=(0, 1)) + 1.0
    one /= one.sum()
    two = three.sum(axis=0) + 8.0 * one
    two /= two.sum(axis=1, keepdims=True)
    three = three + 8.0 * two[None, :, :]
    return np.log(three / three.sum(axis=2, keepdims=True)).astype(np.float32)


class Restorer:
    """Restores texts under a character model; one per task."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.seen: dict[str, str] = {}

    def restore(self, text: str) -> str:
        """Lower-case text with its suspicious parts decoded."""
        text = text.lower()
        if SPACED.search(text):
            text = SPACED.sub(self._spaced, text)
        if SIGN.search(text) or RUN.search(text):
            text = DECORATION.sub(lambda m: " " if len(m[0]) > 2 else m[0], text)
            text = TOKEN.sub(self._token, text)
        return text

    def _spaced(self, match: re.Match) -> str:
        part, separator = match[0], match[1]
        letters = part.split(separator) if separator.strip() else part.split()
        if sum(letter.isalpha() for letter in letters) < 2:
            return part
        return self._decode(part, spaced=True)

    def _token(self, match: re.Match) -> str:
        part = match[0]
        core = part.rstrip(TAIL)
        if SIGN.search(core) or RUN.search(core):
            return self._decode(core) + part[len(core) :]
        return part

    def _decode(self, part: str, spaced: bool = False) -> str:
        found = self.seen.get(part)
        if found is None:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            found = self.seen[part] = self.decode(lattice(part, spaced))
        return found

    def decode(self, steps: list[list[tuple[str, float]]]) -> str:
        """Viterbi over the last two symbols; each step offers strings with their costs."""
        best: dict[tuple[int, int], tuple[float, str]] = {(_EDGE, _EDGE): (0.0, "")}
        model = self.model
        for options in [*steps, [(" ", 0.0)]]:
            following: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, text) in best.items():
                for emitted, cost in options:
                    x, y, total = a, b, score + cost
                    for symbol in symbols(emitted).tolist() if emitted else ():
                        if symbol == _EDGE and y == _EDGE:
                            continue
                        total += float(model[x, y, symbol])
                        x, y = y, symbol
                    if (x, y) not in following or following[x, y][0] < total:
                        following[x, y] = (total, text + emitted)
            best = following
        return max(best.values())[1].strip()


def lattice(part: str, spaced: bool) -> list[list[tuple[str, float]]]:
    """Per run of a character what it may stand for, with the cost of reading it so."""
    steps = []
    for match in re.finditer(r"(.)\1*", part, re.DOTALL):
        c, length = match[1], len(match[0])
        if c.isalpha():
            if length == 1:
                steps.append([(c, 0.0)])
            else:
                steps.append([(c * 2, 0.0), (c, DROPPED if length == 2 else 0.0)])
        elif c in SIGNS:
            options = [("", NOTHING)]
            for letter in SIGNS[c]:
                options.append((letter, READ))
                if length > 1:
                    options.append((letter * 2, READ + DROPPED))
            steps.append(options)
        elif c.isspace() and not spaced:
            steps.append([(" ", 0.0)])
        elif spaced:
            steps.append([("", -0.2), (" ", BREAK)])
        else:
            steps.append([(" ", 0.0), ("", BREAK)] if c == "." else [("", -1.0), (" ", -1.0)])
    return steps


def features(restored: str) -> set[str]:
    """Words and beginnings of longer words, the latter marked with a star."""
    words = set(WORD.findall(restored))
    return words | {f"{w[:n]}*" for w in words for n in PREFIXES if len(w) > n}


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Character model and lexicon. ``sample`` bounds the documents of each label."""
    spark = prepare(docs.sparkSession)
    model = character_model(count_trigrams(docs))
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .where(remainder("doc_id", 3) != 1)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {row["toxic"]: row["count"] for row in marked.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    share = {kind: min(1.0, sample / max(1, size)) for kind, size in sizes.items()}
    picked = marked.where(
        F.when(F.col("toxic") > 0, place < int(share.get(1, 0) * 1_000_000)).otherwise(
            place < int(share.get(0, 0) * 1_000_000)
        )
    )
    # The sample is bounded, so it goes to the documents and no text is shuffled.
    chosen = narrow(docs).join(F.broadcast(picked), "doc_id")
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        restorer = Restorer(shared.value)
        for batch in batches:
            out = {"doc_id": [], "toxic": [], "feature": []}
            for doc_id, toxic, text in zip(batch["doc_id"], batch["toxic"], batch["text"]):
                found = sorted(features(restorer.restore(text)))
                out["doc_id"] += [doc_id] * len(found)
                out["toxic"] += [toxic] * len(found)
                out["feature"] += found
            yield out

    with Scratch(spark) as scratch:
        held = scratch.stage(
            map_batches(chosen, run, "doc_id long, toxic int, feature string"), "toxic-words"
        )
        counts = held.groupBy("feature").agg(
            F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("bad"),
            F.sum(F.when(F.col("toxic") > 0, 0).otherwise(1)).alias("good"),
        )
        able = counts.where(
            (F.col("bad") >= LEAST_SUPPORT)
            & (F.col("bad") / (F.col("bad") + F.col("good") + 2) >= LEAST_PRECISION)
        )
        # At most the documents of the sample times their words of that kind.
        rows = (
            held.where("toxic > 0")
            .join(able, "feature")
            .groupBy("feature")
            .agg(F.collect_set("doc_id").alias("docs"), F.first("good").alias("good"))
            .collect()
        )
    total = {kind: min(size, sample) for kind, size in sizes.items()}
    return {"model": model, **lexicon(rows, total.get(1, 0), total.get(0, 0))}


def lexicon(rows: list, toxic: int, clean: int) -> dict:
    """Greedy cover of the toxic documents, each up to ``COVERS`` times, purest entries first."""
    entries = {row["feature"]: (set(row["docs"]), row["good"]) for row in rows}
    need: dict[int, int] = defaultdict(lambda: COVERS)
    chosen: dict[str, float] = {}
    ordered = sorted(entries.items(), key=lambda e: (-len(e[1][0]) / (1 + 4 * e[1][1]), e[0]))
    for feature, (docs, good) in ordered:
        gain = sum(1 for doc in docs if need[doc] > 0)
        if gain < LEAST_SUPPORT or gain < 0.3 * len(docs):
            continue
        for doc in docs:
            need[doc] -= 1
        chosen[feature] = len(docs) / (len(docs) + good + 2.0)
    covered = sum(1 for doc, left in need.items() if left < COVERS)
    rest = (max(0, toxic - covered) + 0.5) / (max(0, toxic - covered) + clean + 1.0)
    return {"entries": chosen, "rest": rest if toxic else 0.0}


class Scorer:
    """Scores texts with a fitted model; one per task."""

    def __init__(self, model: dict):
        self.restorer = Restorer(model["model"])
        self.words = {f: p for f, p in model["entries"].items() if not f.endswith("*")}
        self.starts = {f[:-1]: p for f, p in model["entries"].items() if f.endswith("*")}
        self.rest = model["rest"]

    def score(self, text: str) -> float:
        words, starts = self.words, self.starts
        miss = 1.0
        for word in set(WORD.findall(self.restorer.restore(text))):
            # A word and its beginnings are one piece of evidence.
            best = words.get(word, 0.0)
            for n in PREFIXES:
                if len(word) > n and word[:n] in starts:
                    best = max(best, starts[word[:n]])
            miss *= 1 - best
        return self.rest if miss == 1.0 else max(self.rest, 1.0 - miss)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        scorer = Scorer(shared.value)
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "score": [scorer.score(t) for t in batch["text"]]}

    return map_batches(narrow(docs), run, "doc_id long, score double")


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled part and score every row."""
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
