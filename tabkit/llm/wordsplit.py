"""Normalising and splitting text as a word-end BPE file of the tokenizers library asks for, with class tables for numpy."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: The endings that an apostrophe at the start of a run of signs takes with it, in the order they are tried.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
SEGMENT = 1 << 19


@lru_cache(1)
def char_classes() -> np.ndarray:
    """Class of every code point."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.full(0x110000, OTHER, np.uint8)
    for cls, pattern in ((SPACE, r"\p{White_Space}"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        for m in regex.finditer(pattern + "+", every):
            table[codes(m[0])] = cls
    return table


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """Cut a long text before white space that follows something else, where every pattern used here parts it anyway."""
    start = 0
    while len(text) - start > size:
        cut = regex.compile(r"(?<=\P{White_Space})\p{White_Space}").search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def normalised(text: str) -> str:
    """NFC and lower case character by character (no final sigma)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class WordFile:
    """What a word-end BPE file says: special strings, vocabulary and merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model = said["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def parts(self, text: str) -> list[str]:
        """Ordinary text at even places, special strings at odd ones."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            return [text]
        return self.special_pattern.split(text)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


def piece_starts(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For normalised code points: whether each is part of a piece, and whether a piece begins there."""
    cls = char_classes()[points]
    before = np.empty_like(cls)
    before[:1], before[1:] = SPACE, cls[:-1]
    begins = (cls != before) | (cls == NUMBER)
    quotes = np.flatnonzero((points == 39) & begins)
    if quotes.size:
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        free = np.ones(quotes.size, bool)
        for ending in ENDINGS:
            hit = free.copy()
            for k, c in enumerate(ending):
                hit &= padded[quotes + 1 + k] == ord(c)
            at = quotes[hit]
            begins[at + 1] = False
            after = at + 1 + len(ending)
            after = after[after < points.size]
            begins[after] = True
            free &= ~hit
    inside = cls != SPACE
    return inside, begins & inside
