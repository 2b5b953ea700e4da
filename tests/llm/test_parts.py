"""The parts that run inside tasks, against plain versions of themselves."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from sluiceway.llm import (
    decontaminate,
    language,
    line_chunks,
    order_minhash,
    packing,
    permutation_index,
    suffix_dedup,
    token_files,
    toxicity,
)
from sluiceway.llm.induced_sort import DiskInts, repeated_starts, sort_suffixes
from sluiceway.llm.queries import tokenizer_path
from sluiceway.llm.suffix_dedup import Anchors, merged
from sluiceway.llm.tokens import ByteLevel, WordLevel


@pytest.mark.parametrize("in_memory", [2, 7, 10**6])
def test_suffix_order_and_prefixes(in_memory):
    rng = random.Random(in_memory)
    for _ in range(150):
        letters = b"abcdef"[: rng.choice([1, 2, 3, 6])]
        pieces = [bytes(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(rng.randint(1, 4))]
        symbols = []
        for number, piece in enumerate(pieces):
            symbols += [b + len(pieces) for b in piece] + [len(pieces) - 1 - number]
        text = DiskInts(None, len(symbols))
        text.array[:] = symbols
        found = list(sort_suffixes(text, 6, None, in_memory).forward())
        order = sorted(range(len(symbols)), key=lambda i: symbols[i:], reverse=True)
        assert [place for place, _ in found] == order
        for (a, _), (b, shared) in zip(found, found[1:]):
            same = 0
            while same < 6 and max(a, b) + same < len(symbols):
                if symbols[a + same] != symbols[b + same]:
                    break
                same += 1
            assert shared == same
        length = rng.choice([1, 2, 4])
        strings = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
        assert [starts.tolist() for starts in repeated_starts(pieces, length, None, in_memory)] == [
            [i for i in range(len(p) - length + 1) if strings[p[i : i + length]] > 1]
            for p in pieces
        ]


def test_equal_strings_have_equal_anchors():
    rng = random.Random(5)
    finder = Anchors(length=40, anchor=8)
    base = bytes(rng.choices(b"abcd", k=300))
    texts = [base, b"xyz" + base[50:200] + b"q", base[:41], b"a" * 100, base[:39]]
    owners = {}
    for raw in texts:
        sections = finder.sections(raw)
        starts = [s for begin, size, *_ in sections for s in range(begin, begin + size - 39)]
        assert starts == list(range(max(0, len(raw) - 39)))
        for begin, size, anchor, _ in sections:
            for start in range(begin, begin + size - 39):
                owners.setdefault(raw[start : start + 40], set()).add(anchor)
    assert all(len(anchors) == 1 for anchors in owners.values())
    assert merged([(5, 9), (0, 3), (3, 4), (8, 12)]) == [(0, 4), (5, 12)]


def test_repeated_ranges_of_sections():
    rng = random.Random(8)
    finder = Anchors(length=40, anchor=8)
    for _ in range(60):
        letters = b"abcdefgh"[: rng.choice([1, 2, 8])]
        base = bytes(rng.choices(letters, k=150))
        texts = [base, base[rng.randint(0, 60) :], base[20:90] + b"x" + base[91:], base * 2]
        texts.append(bytes(rng.choices(letters, k=120)))
        raws, anchors = [], []
        for raw in texts:
            for begin, size, anchor, _ in finder.sections(raw):
                if raw[begin : begin + size] not in raws:
                    raws.append(raw[begin : begin + size])
                    anchors.append(anchor)
        strings = Counter(raw[i : i + 40] for raw in raws for i in range(len(raw) - 39))
        expected = {}
        for number, raw in enumerate(raws):
            starts = [i for i in range(len(raw) - 39) if strings[raw[i : i + 40]] > 1]
            if starts:
                expected[number] = suffix_dedup.covered(starts, 40)
        assert suffix_dedup.repeated_ranges(finder, raws, anchors) == expected


def test_sections_that_share_a_line_only_are_not_sorted(monkeypatch):
    rng = random.Random(9)
    line = bytes(rng.choices(b"abcdefgh", k=300))
    sorted_symbols = []

    def count(pieces, length):
        sorted_symbols.extend(map(len, pieces))
        return repeated_starts(pieces, length)

    monkeypatch.setattr(suffix_dedup, "repeated_starts", count)

    def sections(texts):
        found = [(raw, section) for raw in texts for section in Anchors().sections(raw)]
        shared = Counter(anchor for _, (_, _, anchor, _) in found)
        found = [f for f in found if shared[f[1][2]] > 1]
        return [r[b : b + n] for r, (b, n, *_) in found], [a for _, (_, _, a, _) in found]

    texts = [
        bytes(rng.choices(b"ijklmnop", k=500)) + line + bytes(rng.choices(b"ijklmnop", k=500))
        for _ in range(20)
    ]
    raws, anchors = sections(texts)
    assert raws and suffix_dedup.repeated_ranges(Anchors(), raws, anchors) == {}
    assert not sorted_symbols
    # Of a copied passage only the stretches at its ends are sorted.
    passage = texts[0][:900]
    raws, anchors = sections([b"q" + passage + texts[1], b"r" + passage + texts[2]])
    found = suffix_dedup.repeated_ranges(Anchors(), raws, anchors)
    assert found and sum(sorted_symbols) < sum(map(len, raws)) / 20


@pytest.mark.parametrize(
    "kind, name", [(ByteLevel, "byte_bpe_50k.json"), (WordLevel, "word_bpe_49k.json")]
)
def test_ids_equal_those_of_the_tokenizer(kind, name):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path(name))
    whole.encode_special_tokens = True
    ours = kind(tokenizer_path(name))
    rng = random.Random(2)
    letters = " \n\t'sabZ9,.é²½ÀİΣς中 ́<|end|>\r\x1c\x85\xa0_-"
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 30)))
        expected = whole.encode(text, add_special_tokens=False).ids
        assert ours.encode(text).tolist() == expected, repr(text)
    ours.parts.clear()


def test_codes_of_all_widths():
    rng = np.random.default_rng(0)
    for count in (0, 1, 3, 4, 5, 1000):
        ranks = rng.integers(0, 1 << 32, count) >> rng.integers(0, 32, count)
        control, data = token_files.encode(ranks.astype("<u4"))
        assert len(control) == -(-count // 4)
        assert token_files.decode(control, data, count).tolist() == ranks.tolist()


def cost_of(cuts, penalty, window):
    return sum(window - (b - a) + penalty[b] for a, b in zip([0, *cuts], cuts))


def test_cuts_cost_the_least():
    rng = random.Random(3)
    for _ in range(100):
        window = 12
        places = [0]
        while places[-1] < 60:
            places.append(places[-1] + rng.randint(1, 7))
        penalties = [0.0, *[rng.choice([0.0, 1.0, 4.0]) for _ in places[1:]]]
        best = {0: 0.0}
        for i in range(1, len(places)):
            best[i] = penalties[i] + min(
                best[j] + window - (places[i] - places[j])
                for j in range(i)
                if places[i] - places[j] <= window
            )
        cuts = packing.choose_cuts(places, penalties, window)
        assert cost_of(cuts, dict(zip(places, penalties)), window) == best[len(places) - 1]


@pytest.mark.parametrize("window", [12, 2048])
def test_cuts_given_early_are_those_of_the_whole_stream(window):
    """Cuts are handed on as they become final, and none costs more."""
    rng = random.Random(window)
    places, penalties = [0], [0.0]
    for _ in range(60_000):
        places.append(places[-1] + rng.randint(1, min(window, 90)))
        penalties.append(rng.choice([0.0, 1.0, 1.0, 8.0]))
    cuts, found, early = packing.Cuts(window), [], 0
    for at in range(1, len(places), 100):
        cuts.add(places[at : at + 100], penalties[at : at + 100])
        found += cuts.final()
        early += len(found) > 0
    found += cuts.end()
    assert found[-1] == places[-1]
    assert all(0 < b - a <= window for a, b in zip([0, *found], found))
    penalty = dict(zip(places, penalties))
    whole = packing.choose_cuts(places, penalties, window)
    assert cost_of(found, penalty, window) == cost_of(whole, penalty, window)
    assert early


def plain_alignment(item, passage):
    table = np.zeros((len(item) + 1, len(passage) + 1))
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            table[i, j] = max(
                0.0,
                table[i - 1, j - 1] + (decontaminate.MATCH if a == b else decontaminate.MISMATCH),
                table[i - 1, j] + decontaminate.GAP,
                table[i, j - 1] + decontaminate.GAP,
            )
    return table.max()


def test_alignment_scores():
    rng = np.random.default_rng(1)
    for _ in range(200):
        item, passage = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(-1, 4, 14)
        assert decontaminate.align(item, passage)[0] == plain_alignment(item, passage)


def test_similarity_is_the_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(400):
        a = [rng.randint(0, 9) for _ in range(rng.randint(1, 30))]
        b = [x for x in a if rng.random() > 0.12]
        for _ in range(rng.randint(0, 3)):
            b.insert(rng.randint(0, len(b)), rng.randint(0, 9))
        row = [0] * (len(b) + 1)
        for x in a:
            before = row[:]
            for j, y in enumerate(b):
                row[j + 1] = max(before[j + 1], row[j], before[j] + (x == y))
        expected = bool(b) and row[-1] / (len(a) + len(b) - row[-1]) >= 0.8 - 1e-12
        found = order_minhash.similar(np.array(a, np.uint64), np.array(b, np.uint64))
        assert found == expected, (a, b)


def test_sketches_keep_the_order():
    keys = order_minhash._mix(np.arange(100, dtype=np.uint64))
    mixed = keys.copy()
    random.Random(1).shuffle(mixed)
    same = order_minhash.sketches(keys)
    assert same == order_minhash.sketches(keys.copy())
    assert not set(same) & set(order_minhash.sketches(mixed))
    repeated = order_minhash.labelled(np.array([5, 5, 6], dtype=np.uint64))
    assert len(set(repeated.tolist())) == 3


def test_chunks_move_with_the_text():
    rng = random.Random(6)
    lines = ["".join(rng.choices("abc ", k=9)) for _ in range(60)]
    text = "\n".join(lines)
    bodies = {text[b:e].rstrip("\n") for _, _, b, e in line_chunks.cut(text)}
    shifted = "one more\n" + text
    moved = {shifted[b:e].rstrip("\n") for _, _, b, e in line_chunks.cut(shifted)}
    assert len(bodies & moved) >= len(bodies) - 2
    for whole in (text, "", "\n", "a\n\n\nb"):
        pieces = [whole[b:e] for _, _, b, e in line_chunks.cut(whole)]
        assert "".join(pieces) == whole


def test_footrule_of_inverted_files():
    rng = np.random.default_rng(7)
    vectors, pivots = rng.normal(size=(50, 5)), rng.normal(size=(16, 5))
    block = permutation_index.Block(np.arange(50), vectors, pivots)
    near = permutation_index.permutations(block.vectors, pivots)
    kept = near.shape[1]
    query = permutation_index.permutations(rng.normal(size=(1, 5)), pivots)[0]
    place = {p: i for i, p in enumerate(query.tolist())}
    for entry, found in enumerate(block.footrule(query)):
        theirs = {p: i for i, p in enumerate(near[entry].tolist())}
        assert found == sum(
            abs(place.get(p, kept) - theirs.get(p, kept)) for p in set(place) | set(theirs)
        )


def test_hidden_words_are_restored():
    words = "the idiot is stupid and worthless but the moron was pathetic or a loser now".split()
    counts = np.zeros(64**3)
    for _ in range(200):
        s = toxicity.symbols("  " + " ".join(words) + " ")
        keys = (s[:-2] * 64 + s[1:-1]) * 64 + s[2:]
        np.add.at(counts, keys, 1)
    restorer = toxicity.Restorer(toxicity.character_model(counts))
    for hidden, plain in {
        "an 1d10t here": "an idiot here",
        "i d i o t": "idiot",
        "m-o-r-0-n": "moron",
        "stuuuupid": "stupid",
        "p@thet1c": "pathetic",
        "l0$er": "loser",
        "clean words, 2 of 10.": "clean words, 2 of 10.",
    }.items():
        assert restorer.restore(hidden) == plain


def test_unseen_words_fall_back_to_their_parts():
    rows = [
        {"lang": lang, "n": n, "gram": gram, "times": 5, "all": 50}
        for lang, word in (("en", "thing"), ("de", "schule"))
        for n in range(0, 6)
        for gram in ([word] if n == 0 else language.grams(word, n))
    ]
    scorer = language.Scorer(language._tables(rows))
    assert scorer.score("thing")[0] == "en"
    assert scorer.score("schulen schule")[0] == "de"
    assert scorer.score("things")[0] == "en"
    assert scorer.score("12 ?!") == (language.UNKNOWN, 0.0)
    assert scorer.score(None) == (language.UNKNOWN, 0.0)


def test_words_of_documents_are_numbered_in_one_pass():
    """Rare words, words joined by marks and text without words; nothing is kept."""
    vocabulary = {"alpha": 0, "beta": 1, "x_1": 2}
    cases = {
        "Alpha  beta\x1cgamma": [0, 1, -1],
        "alpha-beta, (x_1) ... \u0130 --": [0, 1, 2, -1],
        "alphabeta ALPHA\u00a0Beta": [-1, 0, 1],
        " -- ": [],
        "": [],
    }
    for text, expected in cases.items():
        words = [vocabulary.get(w, -1) for t in text.lower().split() for w in re.findall(r"\w+", t)]
        found = decontaminate.numbered(vocabulary, text)
        assert found.dtype == np.int32 and found.tolist() == words
        assert [n for n in words if n >= 0] == [n for n in expected if n >= 0]
    assert vocabulary == {"alpha": 0, "beta": 1, "x_1": 2}
