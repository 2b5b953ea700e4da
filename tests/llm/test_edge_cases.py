"""Nulls, empty and long texts, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import (
    decontaminate,
    language,
    license_scan,
    line_chunks,
    order_minhash,
    packing,
    periodic_runs,
    permutation_index,
    pii,
    spelling_variants,
    suffix_dedup,
    token_files,
    toxicity,
)
from sluiceway.llm.queries import tokenizer_path

# Names that the operators use inside, as columns of the caller.
EXTRA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, "
    "row string, spans string, node long, label string, chunk int, list string, ids binary, "
    "text_hash string, kept string, doc long, bucket int, turn int"
)
LONG = "word and again " * 20_000


def rows():
    texts = [None, "", " ", "\n\n", "a", LONG, LONG, "same\nlines\nhere", "same\nlines\nhere"]
    made = [(i, text) for i, text in enumerate(texts)]
    made += [(7, "same\nlines\nhere"), (7, "another text"), (None, "no id"), (None, None)]
    tail = (None, "x", 3, 0.5, "r", "s", 1, "l", 2, "q", b"", "h", "k", 5, 6, 7)
    langs = ["en", "de", None]
    return [
        (doc_id, text, langs[i % 3], *tail[1:]) for i, (doc_id, text) in enumerate(made)
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(), EXTRA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], EXTRA)


def labels(spark, made=((5, 1, 1), (7, 0, 0), (8, None, None), (None, 1, 1))):
    return spark.createDataFrame(list(made), "doc_id long, quality int, toxic int")


def benchmark(spark, made=((1, "word and again word and"), (2, None), (3, ""), (4, "x"))):
    return spark.createDataFrame(list(made), "item_id long, text string")


def per_row(spark):
    """Operators that return a row per row of the table."""
    return {
        "line_chunks": line_chunks.report,
        "token_files": lambda d: token_files.round_trip(d, tokenizer_path("word_bpe_49k.json")),
        "suffix_dedup": suffix_dedup.kept,
        "language": language.identify,
        "pii": pii.find,
        "order_minhash": order_minhash.classes,
        "toxicity": lambda d: toxicity.detect(d, labels(spark)),
        "periodic_runs": periodic_runs.report,
        "license_scan": license_scan.scan,
    }


@pytest.mark.parametrize("name", list(per_row(None)))
def test_a_row_for_every_row(name, spark, odd):
    found = per_row(spark)[name](odd).collect()
    ids = sorted((row["doc_id"] for row in found), key=repr)
    assert ids == sorted((row[0] for row in rows()), key=repr)


@pytest.mark.parametrize("name", list(per_row(None)))
def test_empty_table(name, spark, empty):
    if name == "token_files":
        operator = per_row(spark)[name]
        assert operator(empty).collect() == []
    else:
        assert per_row(spark)[name](empty).count() == 0


def test_words_of_odd_rows(spark, odd, empty):
    found = spelling_variants.variants(odd).collect()
    assert found == []  # no word of six letters is used five times
    assert spelling_variants.variants(empty).count() == 0


def test_empty_labels_score_nothing(spark, odd):
    found = toxicity.detect(odd, labels(spark, ())).collect()
    assert {row["score"] for row in found} == {0.0}


def test_packing_edges(spark, odd, empty):
    path = tokenizer_path("byte_bpe_50k.json")
    found = packing.pack(odd, path).collect()
    assert {row["doc_id"] for row in found} == {row[0] for row in rows()}
    assert packing.pack(empty, path).count() == 0


def test_decontamination_edges(spark, odd, empty):
    found = decontaminate.contaminated(odd, benchmark(spark)).collect()
    assert {(row["doc_id"], row["item_id"]) for row in found} == {(5, 1), (6, 1)}
    assert decontaminate.contaminated(empty, benchmark(spark)).count() == 0
    assert decontaminate.contaminated(odd, benchmark(spark, ())).count() == 0


@pytest.mark.parametrize(
    "stage",
    [
        language.keep_identified,
        line_chunks.deduplicate,
        order_minhash.keep_one,
    ],
)
def test_stages_keep_the_columns(stage, spark, odd, empty):
    assert stage(odd).columns == odd.columns
    assert stage(empty).count() == 0
    stage(odd).write.format("noop").mode("overwrite").save()


def test_clean_documents_keep_the_columns(spark, odd):
    kept = decontaminate.keep_clean(odd, benchmark(spark))
    assert kept.columns == odd.columns
    assert {row["doc_id"] for row in kept.collect()} == {row[0] for row in rows()} - {5, 6}


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    made = [
        (0, [1.0, 0.0]),
        (100, [0.0, 1.0]),
        (1, [1.0, 1.0]),
        (1, [1.0, 1.0]),
        (2, [0.0, 0.0]),
        (3, [nan, 1.0]),
        (4, [inf, 1.0]),
        (5, [None, 1.0]),
        (6, None),
        (7, [1.0, 2.0, 3.0]),
        (None, [1.0, 0.5]),
        (8, [1.0, 1.0]),
    ]
    table = spark.createDataFrame(
        [(*row, "x") for row in made], "vec_id long, embedding array<float>, rank string"
    )
    found = permutation_index.nearest(table, F.col("vec_id") % 100 == 0).collect()
    by_query = {}
    for row in found:
        by_query.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"]))
    assert {q: sorted(n) for q, n in by_query.items()} == {
        0: [(1, 1), (2, 8), (3, 100)],
        100: [(1, 1), (2, 8), (3, 0)],
    }
    assert permutation_index.nearest(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0
