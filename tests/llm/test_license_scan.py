"""License scans against edit distances to every template at every place."""

import random
import re

import pytest

from sluiceway.llm import license_scan
from sluiceway.llm.common import table
from sluiceway.llm.license_texts import PHRASES
from sluiceway.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda found: found[0].lower(), text or "")


def base(text):
    words = WORD.findall(lowered(text))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        phrase = phrase.split()
        for at in range(len(words)):
            if words[at : at + len(phrase)] == phrase:
                places.append(at)
                labels.add(label)
    ends = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *ends, ",".join(sorted(labels)))


def least_edits(template, words):
    """Plain dynamic programming: template to any stretch of the words."""
    above = [0] * (len(words) + 1)
    for i, expected in enumerate(template, 1):
        row = [i]
        for j, word in enumerate(words, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (word != expected)))
        above = row
    return min(above)


def best_score(text):
    """Score of a document without phrases, from all templates over the whole text."""
    words = [word.encode() for word in WORD.findall(lowered(text))]
    best = 0.0
    for template in license_scan.templates():
        size = len(template.words)
        if template.phrase:
            continue
        if template.votes + 3 * template.edits > size - 2 and not any(
            license_scan._holds(words, template.words[i : i + 3]) for i in range(size - 2)
        ):
            continue  # nothing to find it by
        if template.name and not license_scan._holds(words, template.name):
            continue
        edits = least_edits(template.words, words)
        if edits <= template.edits:
            best = max(best, 1 - edits / size)
    return best


def scanned(df):
    return df.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    ).collect()


def test_the_query_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    rows = {row[0]: row for row in scanned(QUERIES["op12_license_scan"](spark, sf_dir))}
    assert {key: tuple(row[1:6]) for key, row in rows.items()} == {
        doc_id: base(text) for doc_id, text in docs
    }
    for doc_id, text in docs:
        row = rows[doc_id]
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        if "licen" in lowered(text) and len(text) < 3000:
            assert row["score"] == pytest.approx(1.0 if row["n_base"] else best_score(text))
    assert any(row["labels"] == "cc-by-nc" for row in rows.values())


def edited(draw, words, edits, keep):
    words = list(words)
    for _ in range(edits):
        at = draw.randrange(len(words))
        kind = draw.randrange(3)
        if kind == 0 and words[at] not in keep:
            words[at] = b"changed"
        elif kind == 1:
            words.insert(at, b"added")
        elif words[at] not in keep:
            del words[at]
    return words


def test_edited_copies_among_other_words(spark):
    draw = random.Random(5)
    wanted = [t for t in license_scan.templates() if not t.phrase and len(t.words) > 5]
    docs = []
    for i, template in enumerate(wanted):
        copy = edited(draw, template.words, draw.randrange(0, template.edits + 2), template.name)
        noise = [draw.choice([b"the", b"of", b"software", b"x"]) for _ in range(30)]
        text = b" ".join([*noise[:15], *copy, *noise[15:]]).decode()
        docs.append((i, text))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {row["doc_id"]: row for row in scanned(license_scan.scan(df))}
    for doc_id, text in docs:
        row = rows[doc_id]
        assert row["score"] == pytest.approx(1.0 if row["n_base"] else best_score(text)), text
    hits = sum(wanted[i].label in rows[i]["labels"].split(",") for i, _ in docs)
    assert hits > 0.7 * len(docs)


@pytest.mark.parametrize("template", [t for t in license_scan.templates() if not t.phrase][::9])
def test_a_whole_copy_has_its_label_alone(template):
    spans = [
        {"template": number, "low": at, "high": at}
        for number in range(len(license_scan.templates()))
        for at in range(len(template.words))
    ]
    labels = license_scan.verify(template.words, spans)[4].split(",")
    assert template.label in labels
    joined = b" ".join(template.words).decode()
    phrases = {label for text, label in PHRASES.items() if text in joined}
    assert set(labels) <= {template.label} | phrases


def test_phrases_at_the_ends_and_many_of_them(spark):
    docs = [
        (1, "MIT License"),
        (2, "mit-LICENSE " * 5000),
        (3, "a general public License; the Apache\nlicense"),
        (4, "mit licenses, général public license"),
        (5, "general public mit license license"),
        (None, "mit license"),
        (None, "mit license"),
        (6, "commit license"),
        (7, None),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = [tuple(row)[:6] for row in scanned(license_scan.scan(df))]
    assert sorted(rows, key=repr) == sorted(((i, *base(text)) for i, text in docs), key=repr)
