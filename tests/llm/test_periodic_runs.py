"""Periodic runs against comparing every word with the word a period before."""

import random
import re
import zlib
from hashlib import sha256

import pytest

from sluiceway.llm import periodic_runs
from sluiceway.llm.common import table
from sluiceway.llm.queries import QUERIES


def brute(words):
    """Runs by start, then period."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        start = 0
        while start + period < len(words):
            stop = start
            while stop + period < len(words) and words[stop] == words[stop + period]:
                stop += 1
            if stop + period - start >= max(6, 4 * period):
                found.setdefault((start, stop + period), period)
            start = stop + 1
    return sorted(((s, e, p) for (s, e), p in found.items()), key=lambda run: (run[0], run[2]))


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    size = len(words)
    checksum = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = checksum // 10
    if checksum % 10 == 0 and size:
        a = g % size
        p = 1 + (size - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    lines = "".join(f"{s},{e - s},{p}\n" for s, e, p in runs)
    best = (None,) * 4
    if runs:
        s, e, p = min(runs, key=lambda run: (run[0] - run[1], run[0], run[2]))
        best = (s, e - s, p, 1000 * (e - s) // p)
    gone = {i for s, e, p in runs for i in range(s + p, e)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    digests = [sha256(part.encode()).hexdigest() for part in (lines, kept)]
    return (doc_id, len(runs), *best, *digests)


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_runs_of_random_words(letters):
    draw = random.Random(letters)
    for _ in range(150):
        block = []
        for _ in range(draw.randint(1, 6)):
            size = draw.choice([0, 1, 5, 6, 24, 60])
            words = [b"%d" % draw.randrange(letters) for _ in range(size)]
            if words and draw.random() < 0.5:
                a = draw.randrange(len(words))
                p = 1 + (len(words) - a) // draw.randint(3, 10)
                words = words[:a] + [words[a + i % p] for i in range(len(words) - a)]
            block.append(words)
        for words, runs in zip(block, periodic_runs.solve(block)):
            assert [tuple(run) for run in runs.tolist()] == brute(words)


def test_the_query_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    found = [tuple(row) for row in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()]
    assert sorted(found) == sorted(expected(*row) for row in docs)
    assert any(row[1] for row in found)


def test_texts_cut_into_several_blocks(spark, sf_dir, monkeypatch):
    docs = [(i, "a b " * (i % 7) + "c " * (i % 9)) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(periodic_runs, "BLOCK", 40)
    found = [tuple(row) for row in periodic_runs.report(df).collect()]
    assert sorted(found) == sorted(expected(*row) for row in docs)


def test_spaces_that_are_not_ascii_belong_to_words(spark):
    rows = [(1, "a b " * 6), (2, "x " * 6), (3, "\x0b\x0cé\r\n" * 6), (4, "\x1cz " * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(row) for row in periodic_runs.report(df).collect()]
    assert sorted(found) == sorted(expected(*row) for row in rows)


def test_a_long_run_and_many_runs():
    (one,) = periodic_runs.solve([[b"a"] * 200_000])
    assert one.tolist() == [[0, 200_000, 1]]
    words = ([b"a", b"b"] * 5 + [b"c"]) * 3 + [b"d"] * 9 + [b"e", b"f", b"g"] * 1000
    (runs,) = periodic_runs.solve([words])
    assert [tuple(run) for run in runs.tolist()] == brute(words)
