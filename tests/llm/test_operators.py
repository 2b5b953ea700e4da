"""Operators and the pipeline on the smallest tables, against brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from sluiceway.llm import (
    decontaminate,
    language,
    line_chunks,
    order_minhash,
    pii,
    suffix_dedup,
    toxicity,
)
from sluiceway.llm.common import likely, stage, table
from sluiceway.llm.queries import QUERIES, SQL, tokenizer_path

WORD = re.compile(r"\w+")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    return sorted((row["doc_id"], row["text"] or "") for row in rows)


def run(name, spark, sf_dir):
    return QUERIES[name](spark, sf_dir).collect()


def test_all_operators_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    registered = entry_points.queries()
    assert set(QUERIES) <= set(registered) and "pipeline" in registered
    assert set(SQL) <= set(QUERIES)


def without(text, spans):
    rest, at = [], 0
    for begin, stop in spans:
        rest.append(text[at:begin])
        at = stop
    return "".join([*rest, text[at:]])


def test_line_dedup(spark, sf_dir, documents):
    places = defaultdict(list)
    for doc_id, text in documents:
        for number, (first, last, begin, stop) in enumerate(line_chunks.cut(text)):
            body = text[begin:stop].rstrip("\n")
            if sum(1 for line in body.split("\n") if line.strip()) >= 2:
                places[body].append((doc_id, number, begin, stop, last - first))
    gone = defaultdict(list)
    for found in places.values():
        for doc_id, _, begin, stop, lines in sorted(found)[1:]:
            gone[doc_id].append((begin, stop, lines))
    rows = {row["doc_id"]: row for row in run("op1_line_dedup", spark, sf_dir)}
    assert gone
    for doc_id, text in documents:
        spans = sorted(gone[doc_id])
        kept = without(text, [span[:2] for span in spans])
        kept = kept.rstrip("\n") if spans else kept
        row = rows[doc_id]
        assert row["n_removed_lines"] == sum(lines for *_, lines in spans)
        assert row["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").collect()
    ids = np.array([row["vec_id"] for row in vectors])
    values = np.array([row["embedding"] for row in vectors], dtype=np.float64)
    found = defaultdict(list)
    for row in run("op2_nearest_neighbours", spark, sf_dir):
        found[row["query_id"]].append((row["rank"], row["vec_id"], row["score"]))
    assert set(found) == set(ids[ids % 100 == 0].tolist())
    hits = 0
    for query, nearest in found.items():
        distance = np.sqrt(((values - values[ids == query][0]) ** 2).sum(axis=1))
        distance[ids == query] = np.inf
        best = ids[np.lexsort((ids, distance))[:10]].tolist()
        nearest.sort()
        assert [rank for rank, *_ in nearest] == list(range(1, 11))
        assert [(score, i) for _, i, score in nearest] == sorted(
            (distance[ids == i][0], i) for _, i, _ in nearest
        )
        hits += len({i for _, i, _ in nearest} & set(best))
    assert hits / (10 * len(found)) >= 0.9


def all_ids(documents, name, end):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path(name))
    return {
        doc_id: np.array(whole.encode(text, add_special_tokens=False).ids + [end], dtype="<u4")
        for doc_id, text in documents
    }


def test_packing(spark, sf_dir, documents):
    ids = all_ids(documents, "byte_bpe_50k.json", 1)
    pieces, filled = defaultdict(list), Counter()
    rows = sorted(run("op3_packing", spark, sf_dir), key=lambda r: (r["sequence_id"], r["offset"]))
    for row in rows:
        assert row["offset"] == filled[row["sequence_id"]] and row["length"] > 0
        filled[row["sequence_id"]] += row["length"]
        pieces[row["doc_id"]].append(row)
    assert max(filled.values()) <= 2048
    # The last sequence of each task is the only one that may be far from full.
    tasks = len({sequence >> 36 for sequence in filled})
    assert sum(2048 - n for n in filled.values()) <= 2048 * tasks + 0.03 * sum(filled.values())
    assert [row["doc_id"] for row in rows] == sorted(row["doc_id"] for row in rows)
    for doc_id, expected in ids.items():
        at = 0
        for row in sorted(pieces[doc_id], key=lambda r: r["start"]):
            part = expected[at : at + row["length"]]
            assert (row["start"], row["doc_tokens"]) == (at, len(expected))
            assert row["ids_crc32"] == zlib.crc32(part.tobytes())
            at += row["length"]
        assert at == len(expected)


def test_token_files(spark, sf_dir, documents):
    ids = all_ids(documents, "word_bpe_49k.json", 2)
    rows = {row["doc_id"]: row for row in run("op4_token_files", spark, sf_dir)}
    start = 0
    for doc_id, _ in documents:
        expected = (doc_id, start, len(ids[doc_id]), zlib.crc32(ids[doc_id].tobytes()))
        row = rows[doc_id]
        assert (doc_id, row["start"], row["n_tokens"], row["ids_crc32"]) == expected
        start += len(ids[doc_id])


def check_byte_strings(documents, rows):
    length = suffix_dedup.LENGTH
    raws = [(doc_id, (text or "").encode()) for doc_id, text in documents]
    strings = Counter(raw[i : i + length] for _, raw in raws for i in range(len(raw) - length + 1))
    expected = []
    for doc_id, raw in raws:
        lost = np.zeros(len(raw) + 1, dtype=int)
        for i in range(len(raw) - length + 1):
            if strings[raw[i : i + length]] > 1:
                lost[i] += 1
                lost[i + length] -= 1
        lost = np.cumsum(lost)[: len(raw)] > 0
        runs = int((np.diff(np.concatenate([[0], lost.astype(int)])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~lost].tobytes()
        digest = hashlib.sha256(kept).hexdigest()
        expected.append((doc_id, len(raw), int(lost.sum()), runs, digest))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


def test_suffix_dedup(spark, sf_dir, documents):
    check_byte_strings(documents, run("op5_suffix_dedup", spark, sf_dir))


def test_suffix_dedup_of_overlaps_runs_and_copies(spark):
    rng = np.random.default_rng(1)
    base = "".join(rng.choice(list("abcé "), 2500))
    texts = [
        (0, base),
        (1, base),
        (1, base),
        (None, base[100:500]),
        (2, base[100:499]),
        (3, base[100:500] + "x" + base[500:901]),
        (4, "a" * 1000),
        (5, "a" * 400),
        (6, "ab" * 700),
        (7, base[::-1] * 2),
        (8, None),
        (9, ""),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    check_byte_strings(texts, suffix_dedup.kept(docs).collect())


def test_language_of_held_out_documents(spark, sf_dir):
    truth = {r["doc_id"]: r["lang"] for r in table(spark, sf_dir, "documents").collect()}
    rows = run("op6_language_id", spark, sf_dir)
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1
    held = [row for row in rows if row["held_out"]]
    right = sum(truth[row["doc_id"]] == row["lang_pred"] for row in held)
    assert right >= 0.95 * len(held)


def test_a_rare_language_is_learned_from(spark):
    made = [(i, f"the house number {i} is on a hill", "en") for i in range(800)]
    made += [(1000 + i, f"το σπίτι {i} είναι εδώ", "el") for i in range(8)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string")
    model = language.fit(docs, 20)
    assert model["langs"] == ["el", "en"]
    found = language.predict(docs, model).collect()
    assert {r["lang_pred"] for r in found if r["doc_id"] >= 1000} == {"el"}


def test_a_script_without_labels_is_not_rejected(spark):
    made = [(i, "aba bab baba", "x") for i in range(40)]
    made += [(i, "cdc dcd dcdc", "y") for i in range(40)]
    made += [(200, "სახლი აქ არის", None), (201, "12 ?!", None), (202, "acac bdbd", None)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in language.keep_identified(docs).collect()}
    assert kept == {*range(40), 200}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for place, digit in enumerate(map(int, reversed(number))):
        doubled = digit * 2 if place % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def base_spans(text):
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text):
            number = re.sub("[^0-9]", "", match[0])
            if kind == "ip" and max(map(int, match[0].split("."))) > 255:
                continue
            if kind == "card" and not (16 <= len(number) <= 19 and luhn(number)):
                continue
            if kind == "phone" and not 8 <= len(number) <= 15:
                continue
            yield f"{kind}:{match.start()}:{match.end()}"


def check_personal_data(texts, rows):
    for row in rows:
        base = list(base_spans(texts[row["doc_id"]] or ""))
        assert row["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = row["spans"].split(",") if row["spans"] else []
        assert set(base) <= set(spans)
        for kind in PATTERNS:
            assert row[f"n_{kind}"] == sum(span.startswith(kind) for span in spans)


def test_personal_data(spark, sf_dir, documents):
    check_personal_data(dict(documents), run("op7_personal_data", spark, sf_dir))


def test_personal_data_of_odd_texts(spark):
    texts = dict(
        enumerate(
            [
                "a@b.c.d@e.f x@y.z",
                "a@b.c_x@y.z",
                "1.2.3.4.5.6.7.8 256.1.1.1 007.08.9.255",
                "+1 (555) 123-4567. ok +12",
                "4111 1111 1111 1111 x 4111-1111-1111-1112",
                "é中 4111111111111111@x.y",
                "@@a@b.c",
                "0" * 9000,
                "a." * 5000 + "@b" + ".c" * 5000,
                "1 " * 5000,
                "\U0001f600 +1 (555) 123-4567 \U0001f600 a@b.co",
                None,
            ]
        )
    )
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_personal_data(texts, pii.find(docs).collect())


def test_personal_data_of_a_text_with_many_spans(spark):
    addresses = [f"10.{i % 250}.{i // 250}.7" for i in range(8000)]
    texts = {
        1: " ".join(addresses),
        2: "é\U0001f600 ".join(addresses[:3000]),
        3: " ".join(f"+1 555 {i:07d}, or 555 {i:07d};" for i in range(3000)),
        4: "x" * 5000 + " a@b.co " + "y" * 5000,
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    began = time.monotonic()
    rows = pii.find(docs).collect()
    assert time.monotonic() - began < 60
    check_personal_data(texts, rows)
    assert {row["doc_id"]: row["n_ip"] for row in rows} == {1: 8000, 2: 3000, 3: 0, 4: 0}


def test_candidates_beside_seeds_overlap_none(spark):
    rng = random.Random(4)
    parts = ["+1 555 010 1234", "555 010 7777", "10.0.0.1", "a@b.c", "4111 1111 1111 1111", "7-7-7-7-7-7-7",
             "word", "+1 (555) 123-4567 12", "é@x", "1.2.3.4.5.6.7.8", "@", "x"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = stage(pii.spans_of(docs), "spans")
    found = [tuple(r) for r in pii.free_candidates(spans).select("row", "start", "stop").collect()]
    expected = [
        (row["row"], s["start"], s["stop"])
        for row in spans.collect()
        for s in row["other"]
        if all(k["stop"] <= s["start"] or s["stop"] <= k["start"] for k in row["seeds"])
    ]
    assert sorted(found) == sorted(expected) and len(found) > 100
    for row in spans.collect():
        text = texts[row["doc_id"]]
        for s in [*row["seeds"], *row["other"]]:
            before = re.search(r"(\S+)\s*$", text[: s["start"]][-pii.REACH :].lower())
            assert s["value"] == text[s["start"] : s["stop"]]
            assert s["one"] == "1|" + (before[1] if before else "")


def test_context_discovers_what_the_patterns_miss(spark):
    known = [f"please call +1 555 010 {i:04d} today" for i in range(8)]
    unseen = ["please call 555 010 7777 today", "we sold 555 010 7777 units"]
    docs = spark.createDataFrame(list(enumerate(known + unseen)), "doc_id long, text string")
    rows = {row["doc_id"]: row for row in pii.find(docs).collect()}
    assert rows[8]["n_phone"] == 1
    assert rows[8]["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_context_discovers_a_value_of_many_contexts(spark):
    places = [f"{a}{b}" for a in ("alpha", "beta", "gamma") for b in ("one", "two", "six")]
    texts = [
        f"please call {place} +1 555 {n:03d} {i:04d} {place} now"
        for n, place in enumerate(places)
        for i in range(30)
    ]
    hot = [f"please call {place} 555 010 7777 {place} now" for place in places]
    docs = spark.createDataFrame(list(enumerate(texts + hot)), "doc_id long, text string")
    rows = {row["doc_id"]: row for row in pii.find(docs).collect()}
    assert all(rows[i]["n_phone"] == 1 for i in range(len(texts), len(texts + hot)))


def test_context_discovers_by_what_it_discovered(spark):
    known = [f"please call +1 555 010 {i:04d} today" for i in range(12)]
    bridge = [f"please call 555 010 {i:04d} today" for i in range(7000, 7006)]
    further = [f"dial mobile 555 010 {i:04d} anytime" for i in range(7000, 7007)]
    texts = known + bridge + further
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {row["doc_id"]: row for row in pii.find(docs).collect()}
    assert rows[len(texts) - 1]["n_phone"] == 1


def test_near_duplicates(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts, group = [], []
    for family in range(25):
        words = list(rng.choice(vocabulary, 250))
        for copy in range(family % 5 + 1):
            changed = words[:]
            for at in rng.choice(250, copy % 4, replace=False):
                changed[at] = "new"
            texts.append(" ".join(changed))
            group.append(family)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {row["doc_id"]: row["class_id"] for row in order_minhash.classes(docs).collect()}
    assert found == {i: group.index(g) for i, g in enumerate(group)}
    kept = {row["doc_id"] for row in order_minhash.keep_one(docs).collect()}
    assert kept == {group.index(g) for g in group}


def test_near_duplicates_of_short_texts(spark):
    texts = []
    for size in (9, 10, 11, 14, 19, 30):
        for copy in range(5):
            words = [f"s{size}c{copy}w{i}" for i in range(size)]
            lost = (size - 4) // 5  # shingles the shorter may lack
            texts += [" ".join(words), " ".join(words[: size - lost])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {row["doc_id"]: row["class_id"] for row in order_minhash.classes(docs).collect()}
    assert found == {i: i - i % 2 for i in range(len(texts))}


def test_a_pair_at_the_very_threshold_is_similar():
    for short in range(4, 400, 4):
        keys = np.arange(short // 4 * 5, dtype=np.uint64)
        assert order_minhash.similar(keys, keys[:short])
        assert not order_minhash.similar(keys, keys[: short - 1])


def test_texts_just_beyond_the_threshold_make_few_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for copy in range(60):  # each pair shares three quarters of its shingles, and sketches
        changed = words[:]
        for at in rng.choice(np.arange(5, 190, 5), 5, replace=False):
            changed[at] = f"new{copy}at{at}"
        texts.append(" ".join(changed))
    compared = []
    verified = order_minhash.verified

    def counted(pairs, keys):
        compared.extend((row["a"], row["b"]) for row in pairs.collect())
        return verified(pairs, keys)

    monkeypatch.setattr(order_minhash, "verified", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {row["doc_id"]: row["class_id"] for row in order_minhash.classes(docs).collect()}
    shingler = order_minhash.Shingler()
    keys = [shingler.shingles(shingler.words(text)) for text in texts]
    near = {
        (a, b)
        for b in range(len(keys))
        for a in range(b)
        if order_minhash.similar(keys[a], keys[b])
    }
    assert all(found[a] == found[b] for a, b in near)
    assert len(set(found.values())) > 10
    assert len(compared) < len(near) + 100  # of 1,770


def test_parities_keep_every_similar_pair():
    rng = np.random.default_rng(6)
    for size in (3, 30, 300, 6000):
        for _ in range(50):
            a = rng.integers(0, size, size).astype(np.uint64)
            keep = rng.random(size) > rng.choice([0.02, 0.08, 0.12])
            b = np.concatenate([a[keep], rng.integers(size, 2 * size, size // 30).astype(np.uint64)])
            odd = [np.array(order_minhash.parities(x)).astype(np.uint64) for x in (a, b)]
            alone = int(np.bitwise_count(odd[0] ^ odd[1]).sum())
            if order_minhash.similar(a, b):
                assert 9 * alone <= len(a) + len(b)


def test_near_duplicates_of_the_table(spark, sf_dir, documents):
    shingler = order_minhash.Shingler()
    keys = {i: shingler.shingles(shingler.words(text)) for i, text in documents}
    owners = defaultdict(set)
    for i, found in keys.items():
        for key in found.tolist():
            owners[key].add(i)
    parent = {i: i for i in keys}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in {(a, b) for found in owners.values() for a in found for b in found if a < b}:
        if order_minhash.similar(keys[a], keys[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    rows = run("op8_near_duplicates", spark, sf_dir)
    assert {row["doc_id"]: row["class_id"] for row in rows} == {i: root(i) for i in keys}


def test_toxicity_of_planted_documents(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"{a}{b}{c}" for a in ("ka", "lo", "mi") for b in ("ne", "ru") for c in "aeiou"]
    insults = ["idiot", "moron", "stupid"]
    hidden = ["1d10t", "m o r o n", "stuuuupid"]
    texts, toxic = [], []
    for i in range(240):
        words = list(rng.choice(vocabulary, 40))
        if i % 4 == 0:
            form = hidden if i % 8 == 0 else insults
            words[7], words[20] = rng.choice(form, 2)
        texts.append(" ".join(words))
        toxic.append(int(i % 4 == 0))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    for row in toxicity.detect(docs, labels).collect():
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert row["predicted"] == int(row["score"] >= 0.7) == toxic[row["doc_id"]]


def test_decontamination(spark, sf_dir, documents):
    items = {
        row["item_id"]: " ".join(WORD.findall(row["text"].lower()))
        for row in table(spark, sf_dir, "benchmark").collect()
    }
    exact = {
        (doc_id, item_id)
        for doc_id, text in documents
        for item_id, item in items.items()
        if f" {item} " in f" {' '.join(WORD.findall(text.lower()))} "
    }
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in run("op10_decontamination", spark, sf_dir)}
    assert exact and all(found[pair] == 1.0 for pair in exact)
    assert all(score >= decontaminate.LEAST_SCORE for score in found.values())


def test_edited_and_common_test_items_are_found(spark):
    item = "one two three four five six seven eight nine ten eleven twelve".split()
    filler = [f"f{i}" for i in range(60)]
    edited = [*item[:4], "x", *item[5:8], *item[9:]]
    texts = [
        " ".join(filler + edited + filler),
        " ".join(filler),
        " ".join(filler + item[:4] + filler),
        *[" ".join([f"g{i}"] * 9 + item) for i in range(30)],
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tests = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(item))], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, tests).collect()}
    assert found == {(d, i) for d in (0, *range(3, 33)) for i in (7, 8)}


def test_lone_copies_with_every_fourth_word_edited_are_found(spark):
    items = [[f"i{i}w{k}" for k in range(16)] for i in range(8)]
    copies = [[f"x{k}" if k % 4 == 2 else w for k, w in enumerate(item)] for item in items]
    texts = [" ".join([*(f"f{k}" for k in range(20)), *copy, "end"]) for copy in copies]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = [(i, " ".join(item)) for i, item in enumerate(items)]
    tests = spark.createDataFrame(made, "item_id long, text string")
    found = decontaminate.contaminated(docs, tests).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i) for i in range(8)}
    assert all(r["score"] > 0.5 for r in found)


def test_clean_rows_with_the_id_of_a_contaminated_one_stay(spark):
    item = "one two three four five six seven eight"
    made = [(None, item), (None, "clean without id"), (5, item), (5, "clean with id"), (None, None)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    tests = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = {(r["doc_id"], r["text"]) for r in decontaminate.keep_clean(docs, tests).collect()}
    assert kept == {(None, "clean without id"), (5, "clean with id"), (None, None)}


def test_pipeline_stages(spark, sf_dir, documents):
    """Each stage against the operators' own results on what the stage before has kept."""
    docs = table(spark, sf_dir, "documents")
    columns, kept = docs.columns, {}
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, stage(function(spark, docs, sf_dir), name)
        kept[name] = {row["doc_id"] for row in docs.select("doc_id").distinct().collect()}
        if name != "packing":
            assert docs.columns == columns
        if name == "line_dedup":
            changed = docs.where(F.col("n_chars") != F.length("text"))
            assert changed.isEmpty()
        if name == "near_dedup":
            near = order_minhash.classes(before).where("doc_id = class_id").collect()
            assert kept[name] == {row["doc_id"] for row in near}
        if name == "decontamination":
            tests = table(spark, sf_dir, "benchmark")
            hits = decontaminate.contaminated(before, tests).collect()
            assert kept["near_dedup"] - kept[name] == {row["doc_id"] for row in hits}
            texts = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert kept["language_id"] == {doc_id for doc_id, _ in documents}
    ids = all_ids(texts, "byte_bpe_50k.json", 1)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    length = Counter()
    for row in rows:
        part = ids[row["doc_id"]][row["start"] : row["start"] + row["length"]]
        assert row["ids_crc32"] == zlib.crc32(part.tobytes())
        length[row["doc_id"]] += row["length"]
    assert length == {doc_id: len(found) for doc_id, found in ids.items()}


def test_near_duplicates_shuffle_wanted_texts_only(spark):
    texts = [(i, f"text number {i} of many") for i in range(3000)]
    texts += [(None, "no id"), (7, "another row of this id")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    wanted = spark.createDataFrame([(7,), (500,), (9999,)], "node long")
    found = order_minhash.sequences(docs, wanted)
    assert {row["node"] for row in found.collect()} == {7, 500}
    # The bitmap that keeps other texts where they are.
    assert "bitmap_construct_agg" in found._jdf.queryExecution().toString()
    kept = likely(
        docs.withColumn("one", F.xxhash64("doc_id")),
        wanted.select(F.xxhash64("node").alias("one")),
        "one",
    )
    ids = [row["doc_id"] for row in kept.collect()]
    assert sorted(i for i in ids if i in (7, 500)) == [7, 7, 500] and len(ids) < 10
