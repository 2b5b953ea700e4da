"""Periodic runs of words, found in enhanced suffix arrays.

A run is a stretch of consecutive words with smallest period ``q``, at least ``RUN_WORDS`` and
``RUN_POWER * q`` words long, that no neighbouring word extends keeping the period. Each run has one
square at its right end that branches: two equal halves of ``q`` words, not followed by the same
word. Such squares show in the interval of depth ``q`` of the suffix array: its suffixes ``i`` and
``i + q`` lie in different children. So for every interval the suffixes of all children but the
largest look up ``ISA[i + q]`` and ``ISA[i - q]``, which is ``n log n`` look-ups in all. A square is
then rotated to the left as far as it goes, and squares of one stretch become one run.

Nothing is shuffled: a document is one row. Tasks take several short documents at once, as numpy
arrays; words of different documents have different ids, so nothing matches across them. Memory
is about ``4 * log2(longest repeat)`` bytes a word of these documents or of one long one.

Defined results: null and empty texts have no words and no runs; rows with equal ids or texts are
judged each by itself; a null id counts as empty text. An empty table gives an empty one. Extra
columns play no part.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256
from itertools import compress, count

import numpy as np
from pyspark.sql import DataFrame

from sluiceway.llm.common import map_batches, narrow, prepare

RUN_WORDS = 6
RUN_POWER = 4
# Words of short documents that are solved together.
BLOCK = 1 << 16

REPORT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def prefix_ranks(keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array, and ranks of all prefixes of 1, 2, 4, ... words until all differ.

    Prefixes are equal if their ranks are. Only suffixes that are not told apart yet are sorted
    again. The last key of every document must be unique.
    """
    suffixes = np.argsort(keys, kind="stable")
    ordered = keys[suffixes]
    places = np.arange(len(keys))
    fresh = np.r_[True, ordered[1:] != ordered[:-1]]
    starts = np.maximum.accumulate(np.where(fresh, places, 0))
    ranks = np.empty(len(keys), dtype=np.int32)
    ranks[suffixes] = starts
    levels, reach = [ranks], 1
    while True:
        open_ = np.flatnonzero(~(fresh & np.r_[fresh[1:], True]))
        if not len(open_):
            return suffixes, levels
        some = suffixes[open_]
        pairs = ranks[some].astype(np.int64) * len(keys) + ranks[some + reach]
        turn = np.argsort(pairs)
        pairs, some = pairs[turn], some[turn]
        suffixes[open_] = some
        fresh[open_] = np.r_[True, pairs[1:] != pairs[:-1]]
        ranks = ranks.copy()
        ranks[some] = np.maximum.accumulate(np.where(fresh[open_], open_, 0))
        levels.append(ranks)
        reach *= 2


def common_prefixes(suffixes: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length of the prefix that each suffix shares with the one before it."""
    lcp = np.zeros(len(suffixes), dtype=np.int32)
    some = 1 + np.flatnonzero(levels[0][suffixes[1:]] == levels[0][suffixes[:-1]])
    left, right = suffixes[some - 1], suffixes[some]
    length = np.zeros(len(some), dtype=np.int64)
    for k in reversed(range(len(levels))):
        same = levels[k][left + length] == levels[k][right + length]
        length[same] += 1 << k
    lcp[some] = length
    return lcp


def _reach(lcp: np.ndarray, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Last place before ``at`` whose value is ``depth`` or less, first place after it whose value
    is less (or the end), both by descent in tables of range minima."""
    tables = [lcp]
    while 2 << (len(tables) - 1) <= len(lcp):
        last, half = tables[-1], 1 << (len(tables) - 1)
        tables.append(np.minimum(last[:-half], last[half:]))
    left, right = at.copy(), at + 1
    for k in reversed(range(len(tables))):
        width, table = 1 << k, tables[k]
        start = left - width
        ok = start >= 0
        ok[ok] = table[start[ok]] > depth[ok]
        left[ok] -= width
        ok = right + width <= len(lcp)
        ok[ok] = table[right[ok]] >= depth[ok]
        right[ok] += width
    return left - 1, right


def branching_squares(
    suffixes: np.ndarray, lcp: np.ndarray, longest: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Start and half length of all squares whose halves are followed by different words.

    A run of power four has four suffixes in the interval of its period, so smaller intervals
    are left out, and deeper ones than a fourth of the document (``longest``, by suffix).
    """
    size = len(lcp)
    padded = np.zeros(size + 4, dtype=lcp.dtype)
    padded[2:-2] = lcp
    before2, before, after, after2 = (padded[k : k + size] for k in (0, 1, 3, 4))
    neighbours = np.minimum(before, after)
    for one, two in ((before2, before), (after, after2)):
        neighbours = np.maximum(neighbours, np.minimum(one, two))
    at = np.flatnonzero((lcp > 0) & (neighbours >= lcp) & (lcp <= longest[suffixes]))
    depth = lcp[at]
    first, end = _reach(lcp, at, depth)
    # Intervals: places of one depth and one end. A place closes the child on its left, the last
    # place of an interval also opens the last child.
    order = np.lexsort((at, depth, end))
    at, depth, first, end = at[order], depth[order], first[order], end[order]
    opens = np.r_[True, (end[1:] != end[:-1]) | (depth[1:] != depth[:-1])][: len(at)]
    number = np.cumsum(opens) - 1
    begin = first[opens][number]
    wide = end - begin >= RUN_POWER
    at, depth, first, end = at[wide], depth[wide], first[wide], end[wide]
    number, begin, opens = number[wide], begin[wide], opens[wide]
    last = np.r_[opens[1:], True][: len(at)]
    low = np.r_[first, at[last]]
    high = np.r_[at, end[last]]
    owner = np.r_[np.arange(len(at)), np.flatnonzero(last)]
    order = np.lexsort((high - low, number[owner]))
    low, high, owner = low[order], high[order], owner[order]
    group = number[owner]
    smaller = np.r_[group[1:] == group[:-1], False][: len(group)]
    low, high, owner = low[smaller], high[smaller], owner[smaller]

    sizes = high - low
    child = np.repeat(np.arange(len(low)), sizes)
    place = np.arange(len(child)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[child]
    inverse = np.empty(size, dtype=np.int64)
    inverse[suffixes] = np.arange(size)
    here = suffixes[place]
    half = depth[owner][child].astype(np.int64)
    from_, to = begin[owner][child], end[owner][child]
    starts, halves = [], []
    for other, start in ((here + half, here), (here - half, here - half)):
        rank = inverse[np.clip(other, 0, size - 1)]
        hit = (other >= 0) & (rank >= from_) & (rank < to)
        hit &= (rank < low[child]) | (rank >= high[child])
        starts.append(start[hit])
        halves.append(half[hit])
    return np.concatenate(starts), np.concatenate(halves)


def find_runs(keys: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """Rows of start, end and period of all runs, by start, then period."""
    suffixes, levels = prefix_ranks(keys)
    lcp = common_prefixes(suffixes, levels)
    start, period = branching_squares(suffixes, lcp, longest)
    end = start + 2 * period
    left = start.copy()
    for k in reversed(range(len(levels))):  # rotate to the left
        ok = left >= 1 << k
        back = left[ok] - (1 << k)
        ok[ok] = levels[k][back] == levels[k][back + period[ok]]
        left[ok] -= 1 << k
    runs = np.stack([left, end, period], axis=1)
    runs = runs[end - left >= np.maximum(RUN_WORDS, RUN_POWER * period)]
    # A stretch also has the multiples of its period.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        runs = runs[np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def looped(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, of which the id's checksum makes one in ten documents periodic."""
    checksum = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    size, g = len(words), checksum // 10
    if checksum % 10 or not size:
        return words
    start = g % size
    period = 1 + (size - start) // (3 + g % 8)
    return words[:start] + [words[start + i % period] for i in range(size - start)]


def solve(words: list[list[bytes]]) -> list[np.ndarray]:
    """Runs of each list of words, places counted from its own begin."""
    sizes = np.array([len(part) for part in words])
    offsets = np.cumsum(sizes + 1) - sizes - 1
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.empty(int(sizes.sum()) + len(sizes), dtype=np.int64)
    for offset, part in zip(offsets.tolist(), words):
        ids[offset : offset + len(part)] = list(map(number.__getitem__, part))
    ids[offsets + sizes] = len(number)
    document = np.repeat(np.arange(len(sizes)), sizes + 1)
    keys = document * (len(number) + 1) + ids
    runs = find_runs(keys, np.repeat(sizes // RUN_POWER, sizes + 1))
    bounds = np.searchsorted(runs[:, 0], np.r_[offsets, len(ids)])
    shift = np.array([1, 1, 0])
    return [
        runs[low:high] - offset * shift
        for low, high, offset in zip(bounds[:-1], bounds[1:], offsets.tolist())
    ]


def describe(doc_id: int | None, words: list[bytes], runs: np.ndarray) -> tuple:
    lines, best = sha256(), (None,) * 4
    if len(runs):
        length = runs[:, 1] - runs[:, 0]
        lines.update(
            "".join(
                f"{start},{end - start},{period}\n" for start, end, period in runs.tolist()
            ).encode()
        )
        top = int(np.argmax(length))  # the first of equals: least start, then period
        size, period = int(length[top]), int(runs[top, 2])
        best = (int(runs[top, 0]), size, period, 1000 * size // period)
        gone = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
        np.add.at(gone, runs[:, 1], -1)
        words = list(compress(words, np.cumsum(gone[:-1]) == 0))
    kept = sha256(b" ".join(words)).hexdigest()
    return doc_id, len(runs), *best, lines.hexdigest(), kept


def report(docs: DataFrame) -> DataFrame:
    """The runs of every document, see ``REPORT``; the longest one in full."""
    prepare(docs.sparkSession)
    names = [part.split()[0] for part in REPORT.split(", ")]

    def rows(block: list[tuple[int | None, list[bytes]]]) -> dict:
        found = solve([words for _, words in block])
        described = [describe(*row, runs) for row, runs in zip(block, found)]
        return dict(zip(names, zip(*described)))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        block, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                # Splits at the bytes 09 to 0D and 20 only.
                words = looped(text.encode().split(), doc_id)
                block.append((doc_id, words))
                size += len(words)
                if size >= BLOCK:
                    yield rows(block)
                    block, size = [], 0
        if block:
            yield rows(block)

    return map_batches(narrow(docs), run, REPORT)
