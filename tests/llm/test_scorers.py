"""Language and toxicity scores against plain formulas, and Viterbi against all paths."""

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sluiceway.llm import language, toxicity
from sluiceway.llm.common import table
from sluiceway.llm.queries import QUERIES


def path_score(model, picks):
    """Log probability of one path through a lattice, symbol by symbol."""
    first = second = toxicity._EDGE
    total = 0.0
    for text, cost in [*picks, (" ", 0.0)]:
        total += cost
        for symbol in toxicity.symbols(text).tolist() if text else ():
            if symbol == toxicity._EDGE == second:
                continue
            total += float(model[first, second, symbol])
            first, second = second, symbol
    return total


@pytest.mark.parametrize("seed", range(4))
def test_decoding_finds_the_best_of_all_paths(seed):
    draw, rng = random.Random(seed), np.random.default_rng(seed)
    model = rng.normal(-3, 2, (64, 64, 64)).astype(np.float32)
    restorer = toxicity.Restorer(model)
    for _ in range(60):
        part = "".join(draw.choices("abté013@$!|.-*  ", k=draw.randint(1, 7)))
        steps = toxicity.lattice(part, draw.random() < 0.5)
        scores = defaultdict(lambda: -math.inf)
        for picks in itertools.product(*steps):
            text = "".join(text for text, _ in picks).strip()
            scores[text] = max(scores[text], path_score(model, picks))
        assert scores[restorer.decode(steps)] == pytest.approx(max(scores.values()), abs=1e-4)


def test_toxicity_of_the_table_by_the_plain_formula(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels)
    texts = {row["doc_id"]: row["text"] or "" for row in docs.select("doc_id", "text").collect()}
    marked = {
        row["doc_id"]: row["toxic"]
        for row in labels.collect()
        if row["toxic"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 != 1
    }
    bad, good = Counter(), Counter()
    for doc_id, toxic in marked.items():
        found = toxicity.features(toxicity.Restorer(model["model"]).restore(texts[doc_id]))
        (bad if toxic else good).update(found)
    for entry, precision in model["entries"].items():
        assert bad[entry] >= toxicity.LEAST_SUPPORT
        assert precision == pytest.approx(bad[entry] / (bad[entry] + good[entry] + 2))
        assert precision >= toxicity.LEAST_PRECISION
    rows = {row["doc_id"]: row for row in QUERIES["op9_toxicity"](spark, sf_dir).collect()}
    assert set(rows) == set(texts)
    for doc_id, text in texts.items():
        restored = toxicity.Restorer(model["model"]).restore(text)
        miss = 1.0
        for word in sorted(set(toxicity.WORD.findall(restored))):
            keys = [word, *[f"{word[:n]}*" for n in toxicity.PREFIXES if len(word) > n]]
            miss *= 1 - max(model["entries"].get(key, 0.0) for key in keys)
        score = max(model["rest"], 1 - miss)
        row = rows[doc_id]
        assert row["score"] == pytest.approx(score, abs=1e-6)
        assert row["predicted"] == (score >= 0.7)
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)


def test_languages_of_the_table_by_the_plain_formula(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").collect()
    counts = defaultdict(Counter)  # by length (0: words) and language
    for row in rows:
        if row["lang"] is None or not row["text"]:
            continue
        if zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2:
            continue
        for word in language.WORD.findall(row["text"].lower()):
            counts[0, row["lang"]][word] += 1
            for n in range(1, language.LONGEST + 1):
                counts[n, row["lang"]].update(language.grams(word, n))
    langs = sorted({lang for _, lang in counts})
    totals = {key: sum(counter.values()) for key, counter in counts.items()}
    entries = {n: set().union(*[counts[n, lang] for lang in langs]) for n in range(6)}

    def log_frequency(n, gram):
        return np.array(
            [
                math.log(counts[n, lang][gram] + 0.5)
                - math.log(totals[n, lang] + 0.5 * len(entries[n]))
                for lang in langs
            ]
        )

    remembered = {}

    def word_score(word):
        if word not in remembered:
            remembered[word] = np.zeros(len(langs))
            for n in [0, *range(min(language.LONGEST, len(word) + 2), 0, -1)]:
                known = [g for g in ([word] if not n else language.grams(word, n)) if g in entries[n]]
                if known:
                    remembered[word] = np.mean([log_frequency(n, g) for g in known], axis=0)
                    break
        return remembered[word]

    found = {row["doc_id"]: row for row in QUERIES["op6_language_id"](spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for row in rows:
        words = language.WORD.findall((row["text"] or "").lower())
        mine = found[row["doc_id"]]
        if not words:
            assert (mine["lang_pred"], mine["score"]) == ("und", 0.0)
            continue
        total = np.sum([word_score(word) for word in words], axis=0) / math.sqrt(len(words))
        weights = np.exp(total - total.max())
        assert mine["lang_pred"] == langs[int(weights.argmax())]
        assert mine["score"] == pytest.approx(weights.max() / weights.sum(), abs=1e-3)
