"""Order-preserving packing of token streams into fixed windows.

Documents are sorted by id and dealt to tasks by ranges of it. Each task sees its documents
as one stream of ids and chooses the cuts by dynamic programming: a window between two cuts
costs its padding, a cut costs nothing between documents, a little at the end of a sentence
and more elsewhere. Cuts may lie at the ends of documents and sentences, and inside a
sentence only at every ``STRIDE`` ids. As the cost of a window is linear in its two ends, the
best start is the least of a value over a sliding range, kept in a monotone queue: each
boundary enters and leaves it once. The result is the least cost of the whole stream of a task. A cut
is final when the best ways to all boundaries that a window can still begin at go through it; then
its documents are handed on. Where the ways stay apart, a task holds what it has until its end: two
bytes an id and 16 bytes a boundary, so its memory is bounded by the size of its range.

Defined results: null and empty texts are the end id alone; rows with equal ids are packed
one after the other, by a hash of their text; null ids come first. Rows equal in both have a
running number, so any number of them is dealt to several tasks. An empty table gives no
pieces. Extra columns play no part.
"""

from __future__ import annotations

import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sluiceway.llm.common import map_batches, narrow, prepare
from sluiceway.llm.tokens import ByteLevel

WINDOW = 2048
END = 1
# What a cut costs, in ids of padding: after a sentence, and inside one.
SENTENCE_PENALTY = 1.0
INNER_PENALTY = 8.0
STRIDE = 64
PENALTIES = np.array([0.0, INNER_PENALTY, SENTENCE_PENALTY])
# Ids of "!", ".", "?" and the line break in the byte-level vocabulary.
SENTENCE_ENDS = [0, 13, 30, 198]
ENDS = np.isin(np.arange(1 << 16), SENTENCE_ENDS)
# Boundaries after which final cuts are looked for.
LOOK = 1 << 12
# Sequence ids are task number times this plus a running number.
SEQUENCES_PER_TASK = 1 << 36

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


class Cuts:
    """The best cuts of a stream of boundaries, decided as soon as they are final.

    Positions ascend from 0, neighbours at most ``window`` apart. The padding of all windows plus
    the penalties of the cuts is least: with ``f`` the least cost up to a boundary, ``f(i) =
    penalty(i) + window - p(i) + min(f(j) + p(j))`` over the ``j`` within reach, whose minimum
    stands at the head of the queue.
    """

    def __init__(self, window: int = WINDOW):
        self.window = window
        # Of the boundaries from the last final cut on: place, and the one before it on its best way.
        self.places, self.source = array("q", [0]), array("q", [0])
        # Value, place and number of boundaries that a window may begin at; least value first.
        self.queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])

    def add(self, places: list[int], penalties: list[float]) -> None:
        window, queue, source = self.window, self.queue, self.source
        number = len(self.places)
        for here, penalty in zip(places, penalties):
            reach = here - window
            while queue[0][1] < reach:
                queue.popleft()
            value, _, start = queue[0]
            source.append(start)
            value += penalty + window
            while queue and queue[-1][0] > value:
                queue.pop()
            queue.append((value, here, number))
            number += 1
        self.places.extend(places)

    def final(self) -> list[int]:
        """Places of the cuts that no boundary to come can change; they are given once."""
        source = self.source
        # The ways of all open boundaries, from the latest on, until they are one.
        ways = {number for _, _, number in self.queue}
        while len(ways) > 1:
            last = max(ways)
            ways.remove(last)
            ways.add(source[last])
        (meet,) = ways
        return self._cut_to(meet)

    def end(self) -> list[int]:
        """Places of the remaining cuts; the last boundary is one."""
        return self._cut_to(len(self.places) - 1)

    def _cut_to(self, number: int) -> list[int]:
        cuts, at = [], number
        while at:
            cuts.append(self.places[at])
            at = self.source[at]
        if number:
            self.places = self.places[number:]
            self.source = array("q", [0, *[max(0, s - number) for s in self.source[number + 1 :]]])
            self.queue = deque((v, p, n - number) for v, p, n in self.queue)
        return cuts[::-1]


def choose_cuts(
    positions: list[int], penalties: list[float], window: int = WINDOW
) -> list[int]:
    """Places to cut at, the last position included, of a stream that is known as a whole."""
    cuts = Cuts(window)
    cuts.add(positions[1:], penalties[1:])
    return cuts.end()


def inner_boundaries(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places inside a document where a cut may lie, and its penalties there."""
    kind = np.zeros(len(ids), dtype=np.uint8)
    kind[STRIDE::STRIDE] = 1
    kind[1:][ENDS[ids[:-1]]] = 2
    places = np.flatnonzero(kind)
    return places, PENALTIES[kind[places]]


class Packer:
    """The stream of one task: takes documents, gives the pieces of finished windows."""

    def __init__(self, task: int, window: int = WINDOW):
        self.window = window
        self.next = task * SEQUENCES_PER_TASK
        self.documents: list[tuple[int | None, np.ndarray, int]] = []  # id, ids, used
        self.cuts = Cuts(window)
        self.begun = self.total = self.looked = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        places, penalties = inner_boundaries(ids)
        small = ids.astype("<u2") if ids.max() < 1 << 16 else ids
        self.documents.append((doc_id, small, 0))
        self.cuts.add(
            [*(places + self.total).tolist(), self.total + len(ids)], [*penalties.tolist(), 0.0]
        )
        self.total += len(ids)
        if len(self.cuts.places) < max(LOOK, 2 * self.looked):
            return []
        pieces = self._windows(self.cuts.final())
        self.looked = len(self.cuts.places)  # of which none was final
        return pieces

    def finish(self) -> list[tuple]:
        """Pieces of all windows that remain."""
        return self._windows(self.cuts.end())

    def _windows(self, places: list[int]) -> list[tuple]:
        if not places:
            return []
        pieces = self._emit([place - self.begun for place in places])
        self.begun = places[-1]
        return pieces

    def _emit(self, places: list[int]) -> list[tuple]:
        pieces, offset, begun, window = [], 0, 0, iter(places)
        stop = next(window)
        for at, (doc_id, ids, used) in enumerate(self.documents):
            while used < len(ids):
                if begun == stop:
                    self.next += 1
                    offset = 0
                    stop = next(window, None)
                    if stop is None:
                        self.documents = [(doc_id, ids, used), *self.documents[at + 1 :]]
                        return pieces
                length = min(len(ids) - used, stop - begun)
                crc = zlib.crc32(ids[used : used + length].astype("<u4").tobytes())
                pieces.append((doc_id, used, length, crc, len(ids), self.next, offset))
                used, begun, offset = used + length, begun + length, offset + length
        self.documents = []
        self.next += 1
        return pieces


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """One row per piece of a document, see ``PIECES``. ``tokenizer``: path of its file,
    readable by every task."""
    prepare(docs.sparkSession)
    ordered = (
        narrow(docs)
        .withColumns({"turn": F.xxhash64("text"), "copy": F.monotonically_increasing_id()})
        .repartitionByRange("doc_id", "turn", "copy")
        .sortWithinPartitions("doc_id", "turn", "copy")
    )

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        encoder = ByteLevel(tokenizer)
        packer = Packer(TaskContext.get().partitionId(), window)
        end = np.array([END], dtype="<u4")
        for batch in batches:
            pieces = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.concatenate([encoder.encode(text), end])
                pieces += packer.add(doc_id, ids)
            if pieces:
                yield _rows(pieces)
        if pieces := packer.finish():
            yield _rows(pieces)

    return map_batches(ordered.drop("turn", "copy"), run, PIECES)


def _rows(pieces: list[tuple]) -> dict:
    names = [part.split()[0] for part in PIECES.split(", ")]
    return dict(zip(names, zip(*pieces)))
