"""Ids of texts by a public tokenizer, with the parts of a text remembered.

Both tokenizers cut a text into pieces before they merge, and a space never joins two
pieces. So a text is the chain of its space-separated parts, each part is encoded once per
task as long as it is remembered, and only unseen parts reach the tokenizer's model.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import regex

# Parts a task remembers: those of the present and of the last generation of this size.
REMEMBERED = 500_000
# Up to here, letters have the same classes and lower case in all Unicode versions.
LATIN = "ɏ"


class _Encoder:
    """Common part of both tokenizers. ``ahead`` is what a part takes from the space."""

    pattern: regex.Pattern
    ahead = ""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # parts are remembered here
        self.letters = _byte_letters()
        self.mark = self.ahead.translate(self.letters)
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def pieces(self, text: str) -> bytes:
        """A text without a space inside, cut into pieces here."""
        if not text:
            return b""
        if max(text) > LATIN:
            return self.whole(text)
        tokenize, letters = self.model.tokenize, self.letters
        return array(
            "I",
            [
                token.id
                for piece in self.pattern.findall(text)
                for token in tokenize(piece.encode().decode("latin-1").translate(letters))
            ],
        ).tobytes()

    def word(self, word: str) -> bytes:
        """A part of letters only, which is one piece."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(self.mark + word)]).tobytes()

    def end(self, marks: str) -> bytes:
        """Points and commas after a word, which are one piece."""
        if marks not in self.ends:
            if len(self.ends) >= 1000:
                self.ends.clear()
            self.ends[marks] = self.pieces(marks)
        return self.ends[marks]

    def remember(self, part: str) -> bytes:
        found = self.older.get(part)
        if found is None:
            found = self.fresh(part)
        if len(self.parts) >= REMEMBERED:
            self.older, self.parts = self.parts, {}
        self.parts[part] = found
        return found

    def fresh(self, part: str) -> bytes:
        stem = part.rstrip(".,")
        word = self.fold(stem)
        if not word.isalpha() or max(word) > LATIN:
            return self.pieces(self.ahead + part)
        if len(stem) == len(part):
            return self.word(word)
        found = self.parts.get(stem) or self.older.get(stem) or self.word(word)
        return found + self.end(part[len(stem) :])

    def chain(self, parts: list[str]) -> bytes:
        found = list(map(self.parts.get, parts))
        if None in found:
            remember = self.remember
            found = [remember(p) if ids is None else ids for p, ids in zip(parts, found)]
        return b"".join(found)

    def fold(self, word: str) -> str:
        return word


class ByteLevel(_Encoder):
    """Byte-level BPE: a piece takes the space before it."""

    pattern = regex.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    )
    ahead = " "
    # A space inside a run of white space belongs to the run: such texts are not cut.
    run = re.compile(r"\s \s|\s \Z")

    def encode(self, text: str) -> np.ndarray:
        if self.run.search(text):
            return np.frombuffer(self.whole(text), dtype="<u4")
        first, *rest = text.split(" ")
        return np.frombuffer(self.pieces(first) + self.chain(rest), dtype="<u4")


class WordLevel(_Encoder):
    """BPE with word ends, lower case, white space dropped."""

    pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

    def encode(self, text: str) -> np.ndarray:
        parts = text.replace("\n", " ").split(" ")
        return np.frombuffer(self.chain(parts), dtype="<u4")

    def pieces(self, text: str) -> bytes:
        return super().pieces(text.lower() if text and max(text) <= LATIN else text)

    def fold(self, word: str) -> str:
        return word.lower()


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {byte: chr(byte) for byte in plain}
    for byte in range(256):
        if byte not in table:
            table[byte] = chr(256 + len(table) - len(plain))
    return table
