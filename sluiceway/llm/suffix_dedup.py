"""Removal of repeated byte strings by external suffix sorting in shards.

Every string of ``LENGTH`` bytes has an anchor, the least hash of the short strings in it.
Equal strings have equal anchors, so a text falls into sections, runs of starts with one
anchor, and only sections of one anchor can hold copies of each other. Equal sections fold
into one by a hash of their bytes; a section that occurs again is repeated as a whole. What
is left, different sections of one anchor, is dealt to shards by the anchor. There the starts
of a section fall into stretches, by how far behind them the anchor stands; strings of one
stretch have the bytes around the anchor in common, so a stretch whose bytes there no other has
holds no repeated start. Equal stretches fold like equal sections. A shard sorts the suffixes of
what remains, different stretches with the same bytes around the anchor, by external induced
sorting (``induced_sort``), and neighbours that share ``LENGTH`` bytes mark repeated starts.

Strings are judged on the input: what another document loses does not count. Matches never
cross documents.

Defined results: null and empty texts lose nothing; equal rows are different places, so all
their long strings repeat; rows are named by id and hash of the text, which may be null; an
empty table gives no rows. Extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from sluiceway.llm.common import Scratch, map_batches, narrow, prepare, stage
from sluiceway.llm.induced_sort import repeated_starts

LENGTH = 400
# Bytes of the strings an anchor is chosen from.
ANCHOR = 32
# Bytes of the sections that a task sorts at once; a larger group is sorted as one shard.
SHARD = 1 << 20
# Starts of a stretch: its strings have LENGTH - STRETCH + 1 bytes around the anchor in common.
STRETCH = 8

_BASE = 0x9E3779B97F4A7C15
_TOP = (1 << 64) - 1

SECTIONS = (
    "doc_id long, text_hash long, begin int, length int, anchor long, "
    "twice boolean, high long, low long"
)


class Anchors:
    """Sections of texts; one per task, with powers for its longest text so far."""

    def __init__(self, length: int = LENGTH, anchor: int = ANCHOR):
        self.length, self.anchor = length, anchor
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, count: int) -> None:
        if count > len(self.up):
            count = max(count, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(count, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums, whose differences are the hashes of the strings between."""
        self._powers(len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(data * self.down[: len(data)], dtype=np.uint64, out=sums[1:])
        return sums

    def hashes(self, sums: np.ndarray) -> np.ndarray:
        """Hash of the ``anchor`` bytes from every place."""
        count = len(sums) - self.anchor
        values = (sums[self.anchor :] - sums[: -self.anchor]) * self.up[:count]
        values ^= values >> np.uint64(32)
        values *= np.uint64(0xD6E8FEB86659FD93)
        return values ^ (values >> np.uint64(32))

    def repeats(self, sums: np.ndarray, begin: int, stop: int) -> bool:
        """Whether two strings of ``length`` from these starts have one hash."""
        values = sums[begin + self.length : stop + self.length] - sums[begin:stop]
        return len(np.unique(values * self.up[begin:stop])) < stop - begin

    def sections(self, raw: bytes) -> list[tuple[int, int, int, bool]]:
        """Begin, length, anchor, and whether the section may repeat itself."""
        if len(raw) < self.length:
            return []
        sums = self.sums(np.frombuffer(raw, dtype=np.uint8).astype(np.uint64))
        values = self.hashes(sums)
        width = self.length - self.anchor + 1
        rows = np.full(-(-len(values) // width) * width, _TOP, dtype=np.uint64)
        rows[: len(values)] = values
        rows = rows.reshape(-1, width)
        # Least of each window: the end of one row and the beginning of the next.
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        before = np.minimum.accumulate(rows, axis=1).ravel()
        starts = len(values) - width + 1
        least = np.minimum(after[:starts], before[width - 1 : len(values)])
        cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
        begins = np.concatenate([[0], cuts])
        stops = np.concatenate([cuts, [starts]])
        anchors = least[begins]
        # Only a section in which its anchor stands twice can repeat itself.
        found = []
        for begin, stop, anchor in zip(begins.tolist(), stops.tolist(), anchors.tolist()):
            inside = values[begin : stop + width - 1] == anchor
            twice = int(np.count_nonzero(inside)) > 1 and self.repeats(sums, begin, stop)
            signed = anchor - (1 << 64) if anchor >> 63 else anchor
            found.append((begin, stop - begin - 1 + self.length, signed, twice))
        return found

    def stretches(self, raws: list[bytes], anchors: list[int]) -> tuple[np.ndarray, ...]:
        """Stretches of sections: a key of the bytes around the anchor, the number of the
        section, and the first start, the last start and the place where the common bytes begin,
        counted in the section.

        The place of the first anchor in a string depends on the string alone, so equal strings
        lie in stretches of one key.
        """
        sizes = np.array([len(raw) for raw in raws])
        stops = np.cumsum(sizes)
        begins = stops - sizes
        sums = self.sums(np.frombuffer(b"".join(raws), dtype=np.uint8).astype(np.uint64))
        values = self.hashes(sums)
        signed = np.array(anchors, dtype=np.int64).view(np.uint64)
        owner = np.repeat(np.arange(len(raws)), sizes)[: len(values)]
        at = np.flatnonzero(values == signed[owner])
        at = at[at + self.anchor <= stops[owner[at]]]
        owner = owner[at]
        first = np.maximum(begins[owner], at - (self.length - self.anchor))
        same = np.flatnonzero(owner[1:] == owner[:-1]) + 1
        first[same] = np.maximum(first[same], at[same - 1] + 1)
        last = np.minimum(at, stops[owner] - self.length)
        some = first <= last
        at, owner, first, last = at[some], owner[some], first[some], last[some]
        # The stretches of each anchor, the nearest to it first.
        nearest = (at - last) // STRETCH
        number = (at - first) // STRETCH - nearest + 1
        row = np.repeat(np.arange(len(at)), number)
        step = nearest[row] + np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
        around = at[row] - step * STRETCH
        keys = sums[around + self.length - STRETCH + 1] - sums[around]
        keys *= self.up[around]
        keys ^= (keys >> np.uint64(32)) ^ signed[owner[row]]
        keys = (keys + step.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        base = begins[owner[row]]
        return (
            keys,
            owner[row],
            np.maximum(first[row], around - STRETCH + 1) - base,
            np.minimum(last[row], around) - base,
            around - base,
        )


def repeated_ranges(
    sections: Anchors, raws: list[bytes], anchors: list[int]
) -> dict[int, list[tuple[int, int]]]:
    """Per number of a section the ranges of its bytes that are repeated in this or another one.

    Sections are read in parts, only their stretches are held. For the sort, the bytes around the
    anchor that different stretches have in common are one symbol.
    """
    parts, at = [], 0
    while at < len(raws):
        stop, size = at, 0
        while stop < len(raws) and size < SHARD:
            size += len(raws[stop])
            stop += 1
        keys, *columns = sections.stretches(raws[at:stop], anchors[at:stop])
        columns[0] += at
        parts.append((keys, *columns))
        at = stop
    keys, *columns = (np.concatenate(column) for column in zip(*parts))
    _, group, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = np.flatnonzero(times[group] > 1)
    shared = sections.length - STRETCH + 1
    commons: dict[bytes, int] = {}
    contents: dict[tuple[int, bytes, bytes], list[tuple[int, int, int]]] = {}
    for number, first, last, around in zip(*[column[again].tolist() for column in columns]):
        raw = raws[number]
        digest = hashlib.blake2b(raw[around : around + shared], digest_size=16).digest()
        common = commons.setdefault(digest, len(commons))
        stop = last + sections.length
        content = (common, raw[first:around], raw[around + shared : stop])
        contents.setdefault(content, []).append((number, first, stop))
    # As with sections: different contents with the same middle are sorted, each once.
    different = Counter(common for common, *_ in contents)
    alone = {common for (common, *_), places in contents.items() if len(places) == 1}
    ranges: dict[int, list[tuple[int, int]]] = {}
    pieces, where = [], []
    for (common, before, behind), places in contents.items():
        if len(places) > 1:
            for number, first, stop in places:
                ranges.setdefault(number, []).append((first, stop))
        if different[common] > 1 and common in alone:
            pieces.append(np.array([*before, 256 + common, *behind]))
            where.append(places[0])
    if pieces:
        for (number, first, _), starts in zip(where, repeated_starts(pieces, STRETCH)):
            if len(starts):
                found = covered((starts + first).tolist(), sections.length)
                ranges.setdefault(number, []).extend(found)
    return {number: merged(found) for number, found in ranges.items()}


def sections_of(docs: DataFrame) -> DataFrame:
    """All sections of all texts, see ``SECTIONS``; ``high`` and ``low`` hash the bytes."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        names = [part.split()[0] for part in SECTIONS.split(", ")]
        anchors = Anchors()
        for batch in batches:
            rows = []
            for doc_id, text_hash, text in zip(
                batch["doc_id"], batch["text_hash"], batch["text"]
            ):
                raw = text.encode()
                for begin, length, anchor, twice in anchors.sections(raw):
                    digest = hashlib.blake2b(raw[begin : begin + length], digest_size=16)
                    high, low = np.frombuffer(digest.digest(), dtype="<i8").tolist()
                    rows.append((doc_id, text_hash, begin, length, anchor, twice, high, low))
            if rows:
                yield dict(zip(names, zip(*rows)))

    return map_batches(docs, run, SECTIONS)


def shared_contents(sections: DataFrame) -> DataFrame:
    """Different sections whose anchor occurs again: how often, where one of them is, and
    whether suffix sorting has something to decide about them."""
    contents = sections.groupBy("anchor", "high", "low", "length", "twice").agg(
        F.count(F.lit(1)).alias("times"),
        # Equal contents: any place will do.
        F.first("doc_id").alias("doc_id"),
        F.first("text_hash").alias("text_hash"),
        F.first("begin").alias("begin"),
    )
    anchors = contents.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("contents"),
        F.min("times").alias("fewest"),
        F.max("times").alias("most"),
        F.max("twice").alias("any_twice"),
    )
    several = F.col("contents") > 1
    wanted = anchors.where(several | (F.col("most") > 1) | F.col("any_twice")).select(
        "anchor", ((several | F.col("any_twice")) & (F.col("fewest") == 1)).alias("sorted")
    )
    return contents.join(wanted, "anchor")


def keyed(docs: DataFrame) -> DataFrame:
    return narrow(docs).withColumn("text_hash", F.xxhash64("text"))


def with_rows(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Documents beside a list per document, merged at every size."""
    same = docs["doc_id"].eqNullSafe(lists["doc_id"]) & (docs["text_hash"] == lists["text_hash"])
    right = lists.hint("merge")
    return docs.join(right, same, how).select(docs["doc_id"], docs["text"], "list")


def bytes_of(docs: DataFrame, contents: DataFrame) -> DataFrame:
    """The bytes of the contents that are to be sorted."""
    wanted = contents.where("sorted").groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("begin", "length", "anchor", "high", "low")).alias("list")
    )

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            out = {"anchor": [], "high": [], "low": [], "raw": []}
            for text, wanted in zip(batch["text"], batch["list"]):
                raw = text.encode()
                for item in wanted:
                    for name in ("anchor", "high", "low"):
                        out[name].append(item[name])
                    out["raw"].append(raw[item["begin"] : item["begin"] + item["length"]])
            yield out

    return map_batches(
        with_rows(docs, wanted, "inner").select("text", "list"),
        run,
        "anchor long, high long, low long, raw binary",
    )


def sort_shards(sections: DataFrame) -> DataFrame:
    """Repeated parts of each section, found by sorting the suffixes of its shard."""
    spark = sections.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = sections.repartition(parts, "anchor").sortWithinPartitions("anchor", "high", "low")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        anchors = Anchors()
        group: list[tuple] = []
        shard: list[tuple] = []
        size = 0

        def flush() -> dict:
            raws = [raw for *_, raw in shard]
            ranges = repeated_ranges(anchors, raws, [anchor for anchor, *_ in shard])
            out = {"high": [], "low": [], "found": []}
            for number, found in ranges.items():
                _, high, low, _ = shard[number]
                out["high"].append(high)
                out["low"].append(low)
                out["found"].append([{"from": a, "to": b} for a, b in found])
            return out

        for batch in batches:
            for item in zip(batch["anchor"], batch["high"], batch["low"], batch["raw"]):
                if group and group[-1][0] != item[0]:
                    shard += group
                    size += sum(len(g[3]) for g in group)
                    group = []
                    if size >= SHARD:
                        yield flush()
                        shard, size = [], 0
                if not group or group[-1][:3] != item[:3]:  # equal rows give equal sections
                    group.append(item)
        shard += group
        if shard:
            yield flush()

    return map_batches(dealt, run, "high long, low long, found array<struct<from:int,to:int>>")


def covered(starts: list[int], length: int) -> list[tuple[int, int]]:
    """Bytes covered by strings from the ascending starts, as ranges."""
    ranges: list[list[int]] = []
    for start in starts:
        if ranges and start <= ranges[-1][1]:
            ranges[-1][1] = start + length
        else:
            ranges.append([start, start + length])
    return [(a, b) for a, b in ranges]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges as one."""
    result: list[tuple[int, int]] = []
    for begin, stop in sorted(ranges):
        if result and begin <= result[-1][1]:
            result[-1] = (result[-1][0], max(stop, result[-1][1]))
        else:
            result.append((begin, stop))
    return result


def spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Per document that loses bytes, the ranges that its sections lose."""
    sections = scratch.stage(sections_of(docs), "sections")
    contents = scratch.stage(shared_contents(sections), "contents")
    found = scratch.stage(sort_shards(bytes_of(docs, contents)), "suffix-marks")
    known = (
        contents.select("high", "low", "length", "times")
        .join(found, ["high", "low"], "left")
        .where("times > 1 OR found IS NOT NULL")
        .select(
            "high",
            "low",
            F.when(
                F.col("times") > 1,
                F.array(F.struct(F.lit(0).alias("from"), F.col("length").alias("to"))),
            )
            .otherwise(F.col("found"))
            .alias("found"),
        )
    )
    known = scratch.stage(known, "repeated-sections")
    places = sections.select("doc_id", "text_hash", "begin", "high", "low").join(
        known, ["high", "low"]
    )
    # All ranges of a document meet in one row, which its length bounds.
    lists = places.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("begin", "found")).alias("list")
    )
    return scratch.stage(lists, "suffix-spans")


def kept(docs: DataFrame) -> DataFrame:
    """Per row: its bytes, what is removed, and what stays as binary."""
    spark = prepare(docs.sparkSession)
    rows = keyed(docs)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            out = {
                "doc_id": batch["doc_id"],
                "n_bytes": [],
                "n_removed": [],
                "n_spans": [],
                "kept_sha256": [],
            }
            for text, found in zip(batch["text"], batch["list"]):
                raw = text.encode()
                gone = merged(
                    [
                        (part["begin"] + span["from"], part["begin"] + span["to"])
                        for part in found or ()
                        for span in part["found"]
                    ]
                )
                rest, at = [], 0
                for begin, stop in gone:
                    rest.append(raw[at:begin])
                    at = stop
                rest.append(raw[at:])
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(sum(stop - begin for begin, stop in gone))
                out["n_spans"].append(len(gone))
                out["kept_sha256"].append(hashlib.sha256(b"".join(rest)).hexdigest())
            yield out

    with Scratch(spark) as scratch:
        joined = with_rows(rows, spans(rows, scratch), "left")
        return stage(
            map_batches(
                joined,
                run,
                "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
            ),
            "suffix-dedup",
        )
