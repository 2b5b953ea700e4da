"""Personal data by fixed patterns and bootstrapped contextual extraction.

Fixed patterns find e-mail addresses, network addresses, card numbers and phone numbers;
these are the seeds. Other strings that look like identifiers are candidates. The words
beside a span are its lexical patterns: the word before, the two words before, the word
after, each together with the shape of the span. Patterns and instances form a graph that is
scored in rounds: a pattern is as good for a kind as the share of its instances known to be
of that kind, an instance as probable as at least one of its good patterns being right. A
candidate that reaches the least score for a kind is added as a span of it, and in the next
round it counts like a seed, so it can bring up patterns of its own.

All of it is DataFrame functions; matches are located by splitting a text at them.

Defined results: null and empty texts have no span and the digest of an empty text; rows
with equal ids are handled each, as are equal rows; an empty table gives no rows. Patterns
need a number of different seeds or added candidates, so equal copies of one text do not make a pattern. Extra
columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sluiceway.llm.common import Scratch, prepare, stage

# Kinds in their order, each with its pattern. Where a match may begin and how
# far it goes is the same as without the possessive signs, which keep Java from recursing.
KINDS = {
    "email": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
    ),
    "ip": r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# Strings that look like identifiers: something at a place, or many digits with signs.
CANDIDATE = (
    r"(?:\G|(?<![\p{L}\p{N}._%+@-]))[\p{L}\p{N}._%+-]++@[\p{L}\p{N}.-]*[\p{L}\p{N}]"
    r"|(?<![\p{L}\p{N}])[+(]{0,2}[0-9](?:[\x20().-]{0,2}[0-9]){5,40}+(?![\p{L}\p{N}])"
)
LEAST_DIGITS = 7

# Rounds of scoring. A pattern needs so many different seeds or added candidates of a kind
# and, smoothed by PRIOR instances, so high a share of it; an instance needs so high a score.
ROUNDS = 3
LEAST_SEEDS = 3
LEAST_CONFIDENCE = 0.6
LEAST_SCORE = 0.8
PRIOR = 1.0
# Characters on either side that are looked at for context words.
REACH = 60

# Matches that are numbered together, and characters of a piece of a text: so that neither adding a
# match to an array nor looking beside it costs more the longer the text is.
TOGETHER = 256
PIECE = 4096

SPAN = "array<struct<start:int,stop:int,value:string>>"


def located(text: Column, pattern: str) -> Column:
    """Matches with their places in code points: the pieces between them are measured."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(pieces, 1, F.size(values)).alias("gap"), values.alias("value"))

    def none(at: Column) -> Column:
        return F.struct(at.alias("at"), F.array().cast(SPAN).alias("found"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        stop = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), stop.alias("stop"), pair["value"].alias("value"))
        return F.struct(
            stop.alias("at"), F.concat(state["found"], F.array(span)).alias("found")
        )

    def group(state: Column, first: Column) -> Column:
        inner = F.aggregate(F.slice(pairs, first, TOGETHER), none(state["at"]), step)
        return F.struct(
            inner["at"].alias("at"), F.concat(state["found"], inner["found"]).alias("found")
        )

    firsts = F.sequence(F.lit(1), F.size(values), F.lit(TOGETHER))
    spans = F.aggregate(firsts, none(F.lit(0)), group, lambda state: state["found"])
    return F.when(F.size(values) > 0, spans).otherwise(F.array().cast(SPAN))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether every second digit from the right, doubled, sums with the others to tens."""
    places = F.sequence(F.lit(1), F.length(number))

    def weight(i: Column) -> Column:
        digit = F.substring(F.reverse(number), i, F.lit(1)).cast("int")
        twice = digit * 2
        folded = F.when(twice > 9, twice - 9).otherwise(twice)
        return F.when(i % 2 == 0, folded).otherwise(digit)

    total = F.aggregate(F.transform(places, weight), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    length = F.length(digits(value))
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.when(length.between(16, 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return length.between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Spans of one kind, in order; the scan of texts without a digit or sign is skipped."""
    found = F.filter(located(text, KINDS[kind]), lambda s: valid(kind, s["value"]))
    mark = "@" if kind == "email" else "[0-9]"
    return F.when(text.rlike(mark), found).otherwise(F.array().cast(SPAN))


def candidate_spans(text: Column) -> Column:
    found = F.filter(
        located(text, CANDIDATE),
        lambda s: (F.length(digits(s["value"])) >= LEAST_DIGITS) | s["value"].contains("@"),
    )
    return F.when(text.rlike("[0-9@]"), found).otherwise(F.array().cast(SPAN))


def part(pieces: Column, begin: Column, length: Column) -> Column:
    """At most ``PIECE`` characters of a text that is given in pieces."""
    at = (begin / PIECE).cast("int")
    near = F.concat(
        F.coalesce(F.get(pieces, at), F.lit("")), F.coalesce(F.get(pieces, at + 1), F.lit(""))
    )
    return F.substring(near, begin - at * PIECE + 1, length)


def in_context(pieces: Column, spans: Column, kind: str | None) -> Column:
    """Spans with the words beside them and their shape."""

    def describe(s: Column) -> Column:
        begin = F.greatest(F.lit(0), s["start"] - REACH)
        before = F.lower(part(pieces, begin, s["start"] - begin))
        after = F.lower(part(pieces, s["stop"], F.lit(REACH)))
        shape = F.when(s["value"].contains("@"), "@").otherwise(
            F.regexp_replace(F.regexp_replace(s["value"], "[0-9]+", "0"), "[+()\\x20-]+", "")
        )
        return F.struct(
            F.lit(kind).cast("string").alias("kind"),
            s["start"].alias("start"),
            s["stop"].alias("stop"),
            s["value"].alias("value"),
            F.concat(F.lit("1|"), F.regexp_extract(before, r"(\S+)\s*$", 1)).alias("one"),
            F.concat(F.lit("2|"), F.regexp_extract(before, r"(\S+\s+\S+)\s*$", 1)).alias("two"),
            F.concat(F.lit("3|"), F.regexp_extract(after, r"^\s*(\S+)", 1)).alias("next"),
            F.when(shape.rlike("^0+$"), "0").otherwise(F.substring(shape, 1, 8)).alias("shape"),
        )

    return F.transform(spans, describe)


def spans_of(docs: DataFrame) -> DataFrame:
    """Per row of the table: ``row``, ``doc_id``, seeds, and candidates, which may overlap seeds."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    text = F.col("text")
    every = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    located_spans = rows.select(
        "row",
        "doc_id",
        *[base_spans(text, kind).alias(kind) for kind in KINDS],
        candidate_spans(text).alias("other"),
        F.when(text.rlike("[0-9@]"), every).otherwise(F.array().cast("array<string>")).alias("pieces"),
    )
    pieces = F.col("pieces")
    seeds = F.concat(*[in_context(pieces, F.col(kind), kind) for kind in KINDS])
    return located_spans.select(
        "row",
        "doc_id",
        seeds.alias("seeds"),
        in_context(pieces, F.col("other"), None).alias("other"),
    )


def free_candidates(spans: DataFrame) -> DataFrame:
    """Candidates that overlap no seed, one row each.

    Only rows with both have any to drop. There, seeds stand at their start and candidates at
    their last character; the farthest end of the seeds up to there tells.
    """
    both = (F.size("seeds") > 0) & (F.size("other") > 0)
    alone = spans.where(~both).select("row", F.explode("other").alias("s"))
    placed = spans.where(both).select("row", F.explode(F.concat("seeds", "other")).alias("s"))
    is_seed = F.col("s.kind").isNotNull()
    order = Window.partitionBy("row").orderBy("_at").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    reached = F.max(F.when(is_seed, F.col("s.stop"))).over(order)
    checked = (
        placed.withColumn("_at", F.when(is_seed, F.col("s.start")).otherwise(F.col("s.stop") - 1))
        .withColumn("_reached", F.coalesce(reached, F.lit(0)))
        .where(~is_seed & (F.col("_reached") <= F.col("s.start")))
    )
    return alone.unionByName(checked.select("row", "s")).select("row", "s.*")


def discovered(spans: DataFrame, candidates: DataFrame, scratch: Scratch) -> DataFrame:
    """``value`` and ``kind`` of candidates that the context of seeds identifies."""
    seeded = spans.select("row", F.explode("seeds").alias("s")).select("row", "s.*")
    edges = seeded.unionByName(candidates).select(
        "value",
        "kind",
        F.explode(F.array("one", "two", "next")).alias("words"),
        "shape",
    ).where(F.length("words") > 2)
    # An instance counts once per pattern, however often it is repeated.
    edges = scratch.stage(
        edges.groupBy("value", "words", "shape").agg(F.max("kind").alias("kind")), "pii-edges"
    )
    seeds = edges.where("kind IS NOT NULL").select("value", "kind").distinct()
    known = seeds.withColumn("score", F.lit(1.0))
    added = None
    pattern = ["words", "shape"]
    sizes = scratch.stage(
        edges.groupBy(*pattern).agg(F.count(F.lit(1)).alias("instances")), "pii-sizes"
    )
    for _ in range(ROUNDS):
        support = (
            edges.join(known.withColumnRenamed("kind", "as"), "value")
            .groupBy(*pattern, F.col("as").alias("kind"))
            .agg(
                F.sum("score").alias("mass"),
                F.count(F.when(F.col("score") >= LEAST_SCORE, 1)).alias("seeds"),
            )
            .where(F.col("seeds") >= LEAST_SEEDS)
        )
        patterns = (
            support.join(sizes, pattern)
            .withColumn("confidence", F.col("mass") / (F.col("instances") + PRIOR))
            .where(F.col("confidence") >= LEAST_CONFIDENCE)
            .select(*pattern, F.col("kind").alias("as"), "confidence")
        )
        scored = (
            edges.where("kind IS NULL")
            .join(patterns, pattern)
            .groupBy("value", "as")
            # Compared as a sum of logarithms: many patterns bring the score itself to 1.0.
            .agg(F.sum(F.log(1.0 - F.col("confidence") + 1e-9)).alias("doubt"))
            .groupBy("value")
            .agg(F.max(F.struct((-F.col("doubt")).alias("sure"), "as")).alias("best"))
            .select(
                "value",
                F.col("best.as").alias("kind"),
                (1 - F.exp(-F.col("best.sure"))).alias("score"),
            )
        )
        added = scratch.stage(scored, "pii-scores")
        known = seeds.withColumn("score", F.lit(1.0)).unionByName(
            added.join(seeds.select("value"), "value", "left_anti")
        )
    return added.where(F.col("score") >= LEAST_SCORE).select("value", "kind")


def written(spans: Column) -> Column:
    """``kind:start:end`` of spans, in the order they have."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def find(docs: DataFrame) -> DataFrame:
    """Counts, digest of the fixed patterns' spans, and all spans of every row."""
    spark = prepare(docs.sparkSession)
    with Scratch(spark) as scratch:
        spans = scratch.stage(spans_of(docs), "pii-spans")
        candidates = scratch.stage(free_candidates(spans), "pii-candidates")
        new = scratch.stage(discovered(spans, candidates, scratch), "pii-found")
        extra = (
            candidates.select("row", "value", "start", "stop")
            .join(new, "value")
            .groupBy("row")
            .agg(F.collect_list(F.struct("kind", "start", "stop")).alias("more"))
        )
        joined = spans.join(extra, "row", "left")
        narrow = "array<struct<kind:string,start:int,stop:int>>"
        more = F.coalesce(F.col("more"), F.array()).cast(narrow)
        seeds = F.transform("seeds", lambda s: F.struct(s["kind"], s["start"], s["stop"]))
        order = F.array_sort(
            F.concat(seeds.cast(narrow), more),
            lambda a, b: F.when(_place(a) != _place(b), _place(a) - _place(b)).otherwise(
                a["start"] - b["start"]
            ),
        )
        counts = [_count(F.col("all"), kind).alias(f"n_{kind}") for kind in KINDS]
        result = joined.select("doc_id", "seeds", order.alias("all")).select(
            "doc_id",
            *counts,
            F.sha2(written(F.col("seeds")), 256).alias("base_sha256"),
            written(F.col("all")).alias("spans"),
        )
        return stage(result, "pii")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _place(span: Column) -> Column:
    """Number of the span's kind in the order of ``KINDS``."""
    return F.array_position(F.array(*[F.lit(kind) for kind in KINDS]), span["kind"]).cast("int")
