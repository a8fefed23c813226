"""Hashed sets of word shingles, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD)]
BASE = 0x5851F42D4C957F2D
BLOCK = 1 << 20
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * MUL[0])


@lru_cache(4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of some bytes."""
    inside = np.concatenate([[False], ~BLANK[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    size = max(BLOCK, 1 << int(len(data)).bit_length())
    up, down = _powers(size + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=run[1:])
    return starts, mixed((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64) * MUL[1])


def _cuts(text: bytes) -> Iterator[bytes]:
    """Blocks of a long text, cut at white space."""
    start = 0
    while len(text) - start > BLOCK:
        at = start + BLOCK
        while at < len(text) and not BLANK[text[at]]:
            at += 1
        yield text[start:at]
        start = at
    yield text[start:]


def words_of(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of each text after A-Z are lower-cased."""
    held: list[bytes] = []
    owners: list[int] = []
    size = made = seen = 0
    words: dict[int, list[np.ndarray]] = {}

    def pour():
        nonlocal held, owners, size
        if held:
            starts, hashes = word_hashes(np.frombuffer(b"\n".join(held), np.uint8))
            limits = np.cumsum([len(h) + 1 for h in held])
            cuts = np.searchsorted(starts, limits)
            for owner, part in zip(owners, np.split(hashes, cuts[:-1])):
                words.setdefault(owner, []).append(part)
        held, owners, size = [], [], 0

    for text in texts:
        for block in _cuts((text or "").encode().lower()):
            held.append(block)
            owners.append(seen)
            size += len(block)
            if size > BLOCK:
                pour()
        seen += 1
        while made < seen - 1 and (made not in owners):
            yield np.concatenate(words.pop(made))
            made += 1
    pour()
    while made < seen:
        yield np.concatenate(words.pop(made))
        made += 1


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of fewer words the whole run; of none nothing."""
    if not len(words):
        return words
    if len(words) < size:
        whole = np.array([np.uint64(len(words))])
        for k, w in enumerate(words):
            whole = mixed(whole * MUL[3] + w + np.uint64(k))
        return whole
    n = len(words) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * MUL[2] + words[k : k + n] * MUL[0]
        total ^= total >> np.uint64(29)
    return np.unique(mixed(total))


def shingle_sets(texts: Iterable[str | None], size: int) -> Iterator[np.ndarray]:
    for words in words_of(texts):
        yield shingle_set(words, size)
