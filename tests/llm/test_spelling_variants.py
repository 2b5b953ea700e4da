"""Spelling variants against wildcards and deletions held in one dictionary."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sluiceway.llm import spelling_variants
from sluiceway.llm.common import table
from sluiceway.llm.queries import QUERIES


def counted(docs):
    words = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda found: found[0].lower(), run)
            checksum = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if checksum % 199 == 0:
                at = checksum % len(run)
                run = run[:at] + run[at + 1 :]
            words[run] += 1
    return {word: n for word, n in words.items() if len(word) >= 6 and n >= 5}


def near_words(words):
    near, masked = defaultdict(set), defaultdict(set)
    for word in words:
        for i in range(len(word)):
            masked[word[:i] + "*" + word[i + 1 :]].add(word)
            shorter = word[:i] + word[i + 1 :]
            if shorter in words:
                near[word].add(shorter)
                near[shorter].add(word)
    for group in masked.values():
        for word in group:
            near[word] |= group - {word}
    return near


def expected(docs):
    words = counted(docs)
    near = near_words(words)
    form = {}
    for word, n in words.items():
        best = min(near[word], key=lambda other: (-words[other], other), default=None)
        if best and words[best] >= 5 * n:
            form[word] = best
    rows = []
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        to = form.get(word)
        rows.append((word, n, len(near[word]), to, words[to] if to else None, root))
    return sorted(rows)


def found(df):
    columns = ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(tuple(row) for row in df.select(columns).collect())


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_the_query_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    rows = found(QUERIES["op11_spelling_variants"](spark, sf_dir))
    assert rows == expected([tuple(row) for row in docs])
    assert any(row[3] for row in rows)


def made_words(seed, letters, size):
    draw = random.Random(seed)
    made = ["".join(draw.choices(letters, k=draw.randint(6, 9))) for _ in range(size)]
    return [word for word in made for _ in range(draw.choice([4, 5, 6, 30, 200]))]


@pytest.mark.parametrize("tile", [3, 16, 2048])
def test_hot_blocks_are_cut_into_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(spelling_variants, "TILE", tile)
    docs = [(i, word) for i, word in enumerate(made_words(tile, "abcéÉ", 260))]
    assert found(spelling_variants.variants(frame(spark, docs))) == expected(docs)


def test_every_pair_is_found_once():
    draw = random.Random(7)
    words = sorted({"".join(draw.choices("abcdé", k=draw.randint(6, 8))) for _ in range(800)})
    plain = [word.encode("latin-1") for word in words]
    groups = np.zeros(len(spelling_variants.LETTERS) + 1, dtype=np.int64)
    groups[1:] = np.arange(len(spelling_variants.LETTERS)) % spelling_variants.GROUPS
    same, all_ = np.zeros(len(words)), np.full(len(words), -1)
    pairs = Counter()
    for choice in range(len(spelling_variants.CHOICES)):
        a, b = spelling_variants.near_pairs(plain, same, all_, groups, choice)
        pairs.update(tuple(sorted((words[i], words[j]))) for i, j in zip(a, b))
    near = near_words(set(words))
    assert set(pairs.values()) == {1}
    assert set(pairs) == {(a, b) for a in near for b in near[a] if a < b}


def test_roots_follow_chains(spark):
    # Each word is one letter from the next and five times rarer.
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"]
    docs = [(i, f"{word} " * 5 ** (i + 1)) for i, word in enumerate(chain)]
    rows = found(spelling_variants.variants(frame(spark, docs)))
    assert rows == expected(docs)
    assert {row[5] for row in rows} == {"abbbbb"}


def test_letters_capitals_and_repeated_rows(spark):
    text = "ÉCOLES école_écoles ßstraße STRASSEN strassen1strassen"
    docs = [(i % 3, text) for i in range(12)] + [(None, text)] * 6 + [(1, None), (2, "")]
    assert found(spelling_variants.variants(frame(spark, docs))) == expected(docs)


def test_no_words(spark):
    assert found(spelling_variants.variants(frame(spark, []))) == []
    assert found(spelling_variants.variants(frame(spark, [(1, "short"), (2, "words only")]))) == []


def test_words_of_a_hundred_thousand_letters(spark):
    long = "x" * 100_000
    words = [long, long[:-1] + "y", long[1:], long[:50_000], "common"]
    docs = [(i, " ".join(words)) for i in range(6)]
    near = {row[0]: row[2] for row in found(spelling_variants.variants(frame(spark, docs)))}
    assert near == dict(zip(words, [2, 2, 2, 0, 0]))
