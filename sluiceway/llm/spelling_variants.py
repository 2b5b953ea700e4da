"""Spelling variants: words one edit apart, each led to its most frequent form.

Tasks count the words of whole texts. Words that differ by one inserted, deleted or replaced
letter differ by one or two in their letter counts, so near words are found by the squared
distance of their letter counts: 1 if one is a letter longer, 2 if both are of one length.

Words meet in blocks. The letters are dealt into ``GROUPS`` groups of about equal use; an edit
touches at most two of them, so near words agree in the counts of all other groups. A block holds
the words that agree in all groups but two, and every choice of the two makes its own blocks. In
a block the words are ordered by length, and NumPy products of the count matrices of a length
with those of the same and the next length give all squared distances. Pairs of distance two at most
are verified letter by letter, and a pair counts only in the first choice that covers its edit,
so it is found once. A block of more than ``TILE`` words is dealt into tiles by a hash, and every
two tiles meet in a task of their own: no task holds more than two tiles, nothing is left out.
Blocks are reduced to one row per word before they are shuffled.

Roots follow the forms by pointer jumping. Each form is five times as frequent as its word, so
the rounds are at most the logarithm of the logarithm of the greatest frequency.

Defined results: null and empty texts have no words; repeated rows count each time; a null id
counts as empty text; an empty table gives an empty one. Extra columns play no part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluiceway.llm.common import map_batches, prepare, stage

SHORTEST = 6
LEAST_USE = 5
# A form is at least so many times as frequent as its word.
FACTOR = 5
# One run in so many loses a letter.
MISPRINT = 199
GROUPS = 5
TILE = 2048
# Words of small blocks that are multiplied together, and rows of a product.
TOGETHER = 512
ROWS = 1024
# Distinct words that a task counts before it hands them on.
HELD = 200_000

# Letters are a byte each: a to z, and U+00C0 to U+00FF.
LETTERS = bytes([*range(97, 123), *range(0xC0, 0x100)])
# Other bytes become blanks, and only A to Z are lowered.
TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b in LETTERS else 32 for b in range(256)
)
NUMBER = np.zeros(256, dtype=np.uint8)
NUMBER[list(LETTERS)] = np.arange(1, len(LETTERS) + 1)
CHOICES = list(combinations(range(GROUPS), 2))
# The first choice that holds two groups.
FIRST_CHOICE = np.array(
    [
        [next(c for c, pair in enumerate(CHOICES) if {a, b} <= set(pair)) for b in range(GROUPS)]
        for a in range(GROUPS)
    ]
)


def words_of(text: str, doc_id: int | None) -> Counter[bytes]:
    """Words of a text in Latin-1, misprints made, those too short left out."""
    runs = text.encode("latin-1", "replace").translate(TO_WORDS).split()
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter[bytes] = Counter()
    for run, n in Counter(runs).items():
        if len(run) < SHORTEST:  # a misprint is shorter still
            continue
        plain = run if run.isascii() else run.decode("latin-1").encode()
        checksum = zlib.crc32(plain, seed)
        if not checksum % MISPRINT:
            at = checksum % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < SHORTEST:
                continue
        found[run] += n
    return found


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of all words in use."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        held: Counter[bytes] = Counter()

        def rows() -> dict:
            return {"word": [w.decode("latin-1") for w in held], "n": list(held.values())}

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                held.update(words_of(text, doc_id))
                if len(held) >= HELD:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    texts = docs.where("text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    counted = map_batches(texts, run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_USE)


def deal_letters(words: DataFrame) -> np.ndarray:
    """Group of each letter: by falling use among the words, dealt out to and fro. At most
    one row per letter reaches the driver."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter"))
    used = {row["letter"]: row["count"] for row in letters.groupBy("letter").count().collect()}
    order = sorted(LETTERS.decode("latin-1"), key=lambda c: (-used.get(c, 0), c))
    groups = np.zeros(len(LETTERS) + 1, dtype=np.int64)
    for i, letter in enumerate(order):
        lap, step = divmod(i, GROUPS)
        groups[NUMBER[ord(letter)]] = GROUPS - 1 - step if lap % 2 else step
    return groups


def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row per word, a column per letter."""
    kinds = len(LETTERS) + 1
    letters = NUMBER[np.frombuffer(b"".join(words), dtype=np.uint8)]
    rows = np.repeat(np.arange(len(words)) * kinds, [len(word) for word in words])
    counts = np.bincount(rows + letters, minlength=len(words) * kinds)
    return counts.reshape(len(words), kinds)[:, 1:]


def post(words: DataFrame, groups: np.ndarray) -> DataFrame:
    """A row per word and choice of two groups, with a hash of the counts of all others."""
    # Sums of random odd numbers, modulo 2 ** 64: equal counts have equal sums.
    draw = np.random.default_rng(0).integers(1, 1 << 62, len(LETTERS)).astype(np.uint64) * 2 + 1
    kept = np.array([[g not in pair for g in groups[1:]] for pair in CHOICES]).T
    weights = np.where(kept, draw[:, None], 0).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            plain = [w.encode("latin-1") for w in batch["word"].to_pylist()]
            sums = letter_counts(plain).astype(np.uint64) @ weights
            for choice in range(len(CHOICES)):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["word"],
                        batch["n"],
                        pa.array(np.full(len(plain), choice, dtype=np.int32)),
                        pa.array(sums[:, choice].view(np.int64)),
                    ],
                    names=["word", "n", "choice", "block"],
                )

    return words.mapInArrow(run, "word string, n long, choice int, block long")


def cells(posted: DataFrame) -> DataFrame:
    """Rows of the tiles that meet: ``tile`` is the row's own, ``one`` and ``two`` name the
    cell. A block that fits is one cell; blocks of a single word are left out."""
    sizes = posted.groupBy("choice", "block").agg(F.count("*").alias("size")).where("size > 1")
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    dealt = posted.join(sizes, ["choice", "block"]).select(
        "word",
        "n",
        "choice",
        "block",
        tiles.alias("tiles"),
        F.pmod(F.xxhash64("word"), tiles).cast("int").alias("tile"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    return dealt.select("*", other.alias("other")).select(
        "word",
        "n",
        "choice",
        "block",
        "tile",
        F.least("tile", "other").alias("one"),
        F.greatest("tile", "other").alias("two"),
    )


def one_edit(words: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of words are one edit apart: those of ``b`` have one length, those of ``a``
    the same, or all one less."""
    some, place = np.unique(np.r_[a, b], return_inverse=True)
    width = len(words[b[0]])
    joined = b"".join(words[i].ljust(width, b"\0") for i in some)
    letters = np.frombuffer(joined, dtype=np.uint8).reshape(len(some), width)
    left, right = letters[place[: len(a)]], letters[place[len(a) :]]
    differs = left != right
    if len(words[a[0]]) == width:
        return differs.sum(axis=1) == 1
    # Equal up to a place, and from there on with one place between.
    after = np.arange(width - 1) >= differs.argmax(axis=1)[:, None]
    return ~(after & (left[:, :-1] != right[:, 1:])).any(axis=1)


def near_pairs(
    words: list[bytes], key: np.ndarray, meets: np.ndarray, groups: np.ndarray, choice: int
) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all pairs that are one edit apart, of one ``key``, first found by ``choice``.

    ``meets`` is 0 or 1 for the words of two tiles that meet, -1 where all meet.
    """
    size = np.array([len(word) for word in words])
    order = np.argsort(size, kind="stable")
    size, key, meets = size[order], key[order], meets[order]
    words = [words[i] for i in order]
    counts = letter_counts(words)
    # Distances are exact: float32 holds whole numbers up to 2 ** 24.
    short = size[-1] < 2048
    counts = counts.astype(np.float32 if short else np.float64)
    square = (counts * counts).sum(axis=1)
    one = np.ones_like(square)
    # One product gives |a|^2 - 2ab + |b|^2.
    left = np.column_stack([-2 * counts, square, one])
    right = np.column_stack([counts, one, square])
    found = [np.empty((2, 0), dtype=np.int64)]
    for length in np.unique(size):
        low, high = np.searchsorted(size, [length, length + 1])
        stop = np.searchsorted(size, length + 2)
        for at in range(low, high, ROWS):
            upto = min(at + ROWS, high)
            a, b = np.nonzero(left[at:upto] @ right[at:stop].T <= 2.5)
            a, b = a + at, b + at
            ok = (a < b) & (key[a] == key[b]) & ((meets[a] < 0) | (meets[a] != meets[b]))
            a, b = a[ok], b[ok]
            for longer in (length, length + 1):
                some = size[b] == longer
                if not some.any():
                    continue
                c, d = a[some], b[some]
                some = one_edit(words, c, d)
                found.append(np.stack([c[some], d[some]]))
    a, b = np.concatenate(found, axis=1)
    # Groups of the letters that the edit takes away and adds.
    change = (counts[a] - counts[b]).astype(np.int64)
    added = groups[1:][change.argmin(axis=1)]
    taken = np.where(change.max(axis=1) > 0, groups[1:][change.argmax(axis=1)], added)
    mine = FIRST_CHOICE[added, taken] == choice
    return order[a[mine]], order[b[mine]]


def best_forms(words: list[bytes], n: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple:
    """Per word with near words: its index, how many, and index of the best of them."""
    source, other = np.r_[a, b], np.r_[b, a]
    place = np.empty(len(words), dtype=np.int64)
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((place[other], -n[other], source))
    source, other = source[order], other[order]
    first = np.flatnonzero(np.r_[True, source[1:] != source[:-1]][: len(source)])
    return source[first], np.diff(np.r_[first, len(source)]), other[first]


def forms_in_cells(dealt: DataFrame, groups: np.ndarray) -> DataFrame:
    """``word``, how many near words a cell holds, and the best of them."""
    spread = dealt.repartition("choice", "block", "one", "two").sortWithinPartitions(
        "choice", "block", "one", "two"
    )

    def solve(rows: dict[str, list], choice: int, key: list[int]) -> dict:
        words = [word.encode("latin-1") for word in rows["word"]]
        n = np.array(rows["n"], dtype=np.int64)
        apart = np.array(rows["one"]) != np.array(rows["two"])
        meets = np.where(apart, np.array(rows["tile"]) == np.array(rows["two"]), -1)
        a, b = near_pairs(words, np.array(key), meets, groups, choice)
        source, near, best = best_forms(words, n, a, b)
        return {
            "word": [rows["word"][i] for i in source],
            "near": near.tolist(),
            "best_n": n[best].tolist(),
            "best": [rows["word"][i] for i in best],
        }

    names = ["word", "n", "tile", "one", "two"]

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        # Small cells of one choice are solved together; ``key`` tells them apart.
        held: dict[str, list] = {name: [] for name in names}
        key: list[int] = []
        cell, number = None, 0
        for batch in batches:
            cells_ = list(zip(batch["choice"], batch["block"], batch["one"], batch["two"]))
            for i, mine in enumerate(cells_):
                if mine != cell:
                    if key and (len(key) >= TOGETHER or mine[0] != cell[0]):
                        yield solve(held, cell[0], key)
                        held, key = {name: [] for name in names}, []
                    cell, number = mine, number + 1
                for name in names:
                    held[name].append(batch[name][i])
                key.append(number)
        if key:
            yield solve(held, cell[0], key)

    return map_batches(spread, run, "word string, near long, best_n long, best string")


def find_roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` from ``word`` and ``form``: each round doubles the steps made."""
    roots = stage(
        forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots"
    )
    while not roots.where("moved").isEmpty():
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stage(
            roots.join(further, "root", "left").select(
                "word",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "roots",
        )
    return roots.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """Every word in use with its number of near words, its form and its root."""
    prepare(docs.sparkSession)
    words = stage(count_words(docs), "words")
    groups = deal_letters(words)
    posted = stage(post(words, groups), "posted")
    found = forms_in_cells(cells(posted), groups)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    near = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.n")
    named = stage(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(form_n >= FACTOR * F.col("n"), F.col("best.word")).alias("form"),
            F.when(form_n >= FACTOR * F.col("n"), form_n).alias("form_n"),
        ),
        "forms",
    )
    roots = find_roots(named.where("form is not null"))
    return named.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
