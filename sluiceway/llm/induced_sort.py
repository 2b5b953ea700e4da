"""External induced sorting of suffixes with their common prefixes.

A suffix is L if it is larger than the one behind it, else S; an S suffix after an L one is
a seed. Seeds are cut into seed substrings, sorted with runs on disk and named; the string
of names is sorted by recursion, which gives the order of the seeds. From them two scans
induce all suffixes: in ascending order each suffix puts the one before it, if that is L,
into a priority queue under its first symbol; in descending order the same for S. A queue
receives the suffixes of one symbol in their final order, so it is a heap of symbols with a
first-in first-out list each, and lists that do not fit into memory wait on disk.

Each entry carries the length of the prefix it shares with its neighbour: what precedes two
suffixes with one symbol shares one more than the least value between them in the scan, kept
on a stack. Lengths are cut off at ``cap``, so the stack never holds more than that.

Strings, names, queues beyond their limit and results lie in files of ``folder``. Memory holds
the tops of the queues, the places of the seeds (at most half as many as symbols), and what
the caller gives and gets: the bytes and one mark for each.
"""

from __future__ import annotations

import heapq
import mmap
import pickle
import tempfile
from array import array
from bisect import bisect_right
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np

# Entries of all lists of a queue, or keys of a sort, that memory holds.
IN_MEMORY = 2_000_000
_CHUNK = 1 << 20


class Tape:
    """Pairs of integers in a file, written once and read from either end."""

    def __init__(self, folder: str | None):
        self.file = tempfile.TemporaryFile(dir=folder)
        self.rows = array("q")
        self.stored = 0

    def append(self, a: int, b: int) -> None:
        rows = self.rows
        rows.append(a)
        rows.append(b)
        if len(rows) >= 2 * 65536:
            self.flush()

    def flush(self) -> None:
        self.file.seek(0, 2)
        self.file.write(self.rows.tobytes())
        self.stored += len(self.rows) // 2
        self.rows = array("q")

    def _blocks(self, starts: Iterable[int]) -> Iterator[array]:
        for start in starts:
            self.file.seek(16 * start)
            block = array("q")
            block.frombytes(self.file.read(16 * min(65536, self.stored - start)))
            yield block

    def forward(self) -> Iterator[tuple[int, int]]:
        self.flush()
        for block in self._blocks(range(0, self.stored, 65536)):
            yield from zip(block[::2], block[1::2])

    def backward(self) -> Iterator[tuple[int, int]]:
        """From the last to the first, each with the value of the pair read before it: the
        prefix shared with a neighbour belongs to the other one in this direction."""
        self.flush()
        carried = 0
        for block in self._blocks(reversed(range(0, self.stored, 65536))):
            for i in range(len(block) - 2, -1, -2):
                yield block[i], carried
                carried = block[i + 1]


class SymbolQueue:
    """Priority queue of pairs under symbols; equal symbols leave as they came.

    Of each symbol, the front is in memory, what follows may lie on disk, and the back, which
    takes new pairs, is in memory until it is sent behind the parts on disk.
    """

    def __init__(self, folder: str | None, sign: int, in_memory: int):
        self.folder, self.sign, self.limit = folder, sign, in_memory
        self.heap: list[int] = []
        self.fronts: dict[int, deque[tuple[int, int]]] = {}
        self.backs: dict[int, deque[tuple[int, int]]] = {}
        self.parts: dict[int, deque[tuple[int, int]]] = {}  # place and number on disk
        self.file = None
        self.size = 0

    def push(self, symbol: int, a: int, b: int) -> None:
        back = self.backs.get(symbol)
        if back is None:
            back = self.backs[symbol] = deque()
            self.fronts[symbol] = deque()
            heapq.heappush(self.heap, self.sign * symbol)
        back.append((a, b))
        self.size += 1
        if self.size > self.limit:
            self.spill()

    def spill(self) -> None:
        """Send the longest backs to disk until half of the memory is free."""
        if self.file is None:
            self.file = tempfile.TemporaryFile(dir=self.folder)
        for symbol in sorted(self.backs, key=lambda s: -len(self.backs[s])):
            back = self.backs[symbol]
            if self.size <= self.limit // 2 or not back:
                break
            place = self.file.seek(0, 2)
            self.file.write(array("q", [x for pair in back for x in pair]).tobytes())
            self.parts.setdefault(symbol, deque()).append((place, len(back)))
            self.size -= len(back)
            back.clear()

    def top(self) -> int | None:
        return self.sign * self.heap[0] if self.heap else None

    def pop(self) -> tuple[int, int]:
        symbol = self.sign * self.heap[0]
        front = self.fronts[symbol]
        if not front:
            if symbol in self.parts:
                place, number = self.parts[symbol].popleft()
                if not self.parts[symbol]:
                    del self.parts[symbol]
                self.file.seek(place)
                block = array("q")
                block.frombytes(self.file.read(16 * number))
                front = self.fronts[symbol] = deque(zip(block[::2], block[1::2]))
                self.size += number
            else:
                front = self.fronts[symbol] = self.backs[symbol]
                self.backs[symbol] = deque()
        item = front.popleft()
        self.size -= 1
        if not front and not self.backs[symbol] and symbol not in self.parts:
            heapq.heappop(self.heap)
            del self.fronts[symbol], self.backs[symbol]
        return item


class DiskInts:
    """Integers in a mapped file: plain reads for loops, numpy for whole parts."""

    def __init__(self, folder: str | None, length: int):
        file = tempfile.TemporaryFile(dir=folder)
        file.truncate(max(8, 8 * length))
        self.map = mmap.mmap(file.fileno(), max(8, 8 * length))
        self.read = memoryview(self.map).cast("q")
        self.array = np.frombuffer(self.map, dtype=np.int64)[:length]


def _seeds(text: np.ndarray) -> np.ndarray:
    """Places of S suffixes behind L ones, from right to left in parts."""
    found = []
    behind = True  # the last suffix counts as S
    for stop in range(len(text) - 1, 0, -_CHUNK):
        start = max(0, stop - _CHUNK)
        part, following = text[start:stop], text[start + 1 : stop + 1]
        kind = np.where(part < following, 1, np.where(part > following, 0, -1)).astype(np.int8)
        kind = np.append(kind, 1 if behind else 0)
        # Equal symbols take the kind of the next place that has one.
        known = np.where(kind >= 0, np.arange(len(kind)), len(kind))
        kind = kind[np.minimum.accumulate(known[::-1])[::-1]]
        at = np.flatnonzero((kind[1:] == 1) & (kind[:-1] == 0)) + 1 + start
        found.append(at)
        behind = bool(kind[0])
        text_is_done = start == 0
        if text_is_done:
            break
    return np.concatenate(found[::-1]) if found else np.zeros(0, np.int64)


def _shared(text: np.ndarray, i: int, j: int, known: int, cap: int) -> int:
    """Common prefix of two suffixes that share ``known`` symbols already."""
    while known < cap:
        width = min(64, cap - known)
        a, b = text[i + known : i + known + width], text[j + known : j + known + width]
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        if len(differ):
            return known + int(differ[0])
        known += n
        if n < width:
            return known
    return cap


def _named(text: np.ndarray, seeds: np.ndarray, folder: str | None, in_memory: int):
    """Names of the seed substrings in text order, and whether all differ."""
    runs, held, size = [], [], 0
    edge = (1 << 63) - 1  # behind a substring: of two, the longer one is the smaller
    for k in range(len(seeds)):
        stop = seeds[k + 1] + 1 if k + 1 < len(seeds) else seeds[k] + 1
        key = np.append(text[seeds[k] : stop], edge).astype(">i8").tobytes()
        held.append((key, k))
        size += len(key) // 64 + 1
        if size >= in_memory:
            held.sort()
            run = tempfile.TemporaryFile(dir=folder)
            for start in range(0, len(held), 4096):
                pickle.dump(held[start : start + 4096], run)
            runs.append(run)
            held, size = [], 0
    held.sort()

    def reread(run) -> Iterator[tuple[bytes, int]]:
        run.seek(0)
        while True:
            try:
                yield from pickle.load(run)
            except EOFError:
                return

    names = DiskInts(folder, len(seeds))
    name, before = -1, None
    for key, k in heapq.merge(held, *map(reread, runs)):
        if key != before:
            name, before = name + 1, key
        names.array[k] = name
    return names, name + 1 == len(seeds)


def _ordered_seeds(text, seeds, cap, folder, in_memory) -> Iterator[tuple[int, int]]:
    """Seeds in ascending order, each with the prefix shared with the one before."""
    names, unique = _named(text, seeds, folder, in_memory)
    if unique:
        order = np.empty(len(seeds), dtype=np.int64)
        order[names.array] = np.arange(len(seeds))
        ranked = ((int(k), 0) for k in order)
    else:
        ranked = sort_suffixes(names, cap, folder, in_memory).backward()
    before = None
    for k, equal in ranked:
        place = int(seeds[k])
        if before is None:
            yield place, 0
        else:
            # As many symbols as the equal names span are known to be shared.
            known = int(seeds[k + equal]) - place if equal else 0
            yield place, _shared(text, before, place, min(known, cap), cap)
        before = place


class _Least:
    """Least prefix between an earlier place of a scan and the present one."""

    def __init__(self):
        self.ranks: list[int] = []
        self.values: list[int] = []

    def add(self, rank: int, value: int) -> None:
        values, ranks = self.values, self.ranks
        while values and values[-1] >= value:
            values.pop()
            ranks.pop()
        values.append(value)
        ranks.append(rank)

    def since(self, rank: int) -> int:
        return self.values[bisect_right(self.ranks, rank)]


def _run(read, place: int, symbol: int, cap: int) -> int:
    length = 0
    while length < cap and read[place + length] == symbol:
        length += 1
    return length


def _scan(text: DiskInts, given, queue: SymbolQueue, sign: int, cap: int):
    """One scan: merges the given suffixes with the induced ones and induces from both.

    Ascending (``sign`` 1) induces L suffixes from seeds, descending (-1) S suffixes from L
    ones; of equal symbols the induced kind comes first in either direction. Yields the
    place, the prefix shared with the suffix before, and whether it was induced.
    """
    read = text.read
    least = _Least()
    last: dict[int, int] = {}
    given = iter(given)
    waiting = next(given, None)
    rank, before, was_induced, symbol_before = 0, -1, False, None
    while True:
        top = queue.top()
        if top is None and waiting is None:
            return
        if waiting is None or top is not None and sign * top <= sign * read[waiting[0]]:
            place, shared = queue.pop()
            induced = True
        else:
            place, shared = waiting
            waiting = next(given, None)
            induced = False
        symbol = read[place]
        if symbol != symbol_before:
            shared = 0
        elif was_induced and not induced:
            # An L and an S suffix of one symbol differ where the first run of it ends.
            shared = min(_run(read, before, symbol, cap), _run(read, place, symbol, cap))
        least.add(rank, shared)
        yield place, shared, induced
        if place:
            ahead = read[place - 1]
            if sign * ahead > sign * symbol or induced and ahead == symbol:
                seen = last.get(ahead)
                value = min(cap, 1 + least.since(seen)) if seen is not None else 0
                last[ahead] = rank
                queue.push(ahead, place - 1, value)
        rank, before, was_induced, symbol_before = rank + 1, place, induced, symbol


def sort_suffixes(
    text: DiskInts, cap: int, folder: str | None = None, in_memory: int = IN_MEMORY
) -> Tape:
    """All suffixes in descending order, each with the prefix shared with the one before.

    The last symbol of the text must be 0 and occur there only; others are positive.
    """
    result = Tape(folder)
    size = len(text.array)
    if size > 1:
        seeds = _seeds(text.array)
        ordered = _ordered_seeds(text.array, seeds, cap, folder, in_memory)
        ascending = Tape(folder)
        for place, shared, induced in _scan(
            text, ordered, SymbolQueue(folder, 1, in_memory), 1, cap
        ):
            if induced:
                ascending.append(place, shared)
        for place, shared, _ in _scan(
            text, ascending.backward(), SymbolQueue(folder, -1, in_memory), -1, cap
        ):
            result.append(place, shared)
    result.append(size - 1, 0)
    return result


def repeated_starts(
    pieces: list[bytes | np.ndarray],
    length: int,
    folder: str | None = None,
    in_memory: int = IN_MEMORY,
) -> list[np.ndarray]:
    """Per piece the starts of strings of ``length`` symbols that start elsewhere too, in this
    piece or another. Symbols are bytes or other integers from 0 on."""
    total = sum(map(len, pieces)) + len(pieces)
    text = DiskInts(folder, total)
    at = 0
    begins = []
    for number, piece in enumerate(pieces):
        begins.append(at)
        body = np.frombuffer(piece, dtype=np.uint8) if isinstance(piece, bytes) else piece
        text.array[at : at + len(body)] = body
        text.array[at : at + len(body)] += len(pieces)
        at += len(body)
        # Every piece ends in a symbol of its own, the last one in the least.
        text.array[at] = len(pieces) - 1 - number
        at += 1
    marked = np.zeros(total, dtype=bool)
    before = -1
    for place, shared in sort_suffixes(text, length, folder, in_memory).forward():
        if shared >= length:
            marked[place] = marked[before] = True
        before = place
    stops = [*begins[1:], total]
    return [np.flatnonzero(marked[b:e]) for b, e in zip(begins, stops)]
