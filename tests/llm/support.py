"""Brute-force versions and odd inputs for the corpus operators."""

from __future__ import annotations

import re

import pandas as pd

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile("[^\x20\x09-\x0D]+")

ODD = [None, "", " \n\t ", "a", "Ünïcode ß 😀 中文 words", "x" * 3000, "one two three", "l1\nl2\nl3\nl4", "l1\nl2\nl3\nl4", "\n\n\n\n", "don't it's 'tis ''s"]


def documents(spark, texts, langs=None):
    rows = [(i + 1, t, (langs[i] if langs else "en"), "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns named like results."""
    docs = documents(spark, ODD)
    docs = docs.union(docs.filter("doc_id = 8"))
    more = spark.createDataFrame([(None, "null id text here", None, None, None), (3, "second row of id three", "en", None, 1)], SCHEMA)
    out = docs.union(more)
    for name in ("n_words", "kept", "score", "lang_pred", "_words", "n_lines", "label", "node", "ids", "h1"):
        out = out.withColumn(name, out.doc_id)
    return out


def words(text):
    return WORD.findall(text or "")


def shingles(text, size):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def linked(texts: dict, size: int, percent: int) -> dict:
    """Least id of each component, by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def quality(text: str | None) -> dict:
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = pd.Series(windows, dtype=object).duplicated(keep=False) if windows else []
    covered = {i + k for i, again in enumerate(often) if again for k in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def without_repeats(texts: dict, size: int = 3) -> dict:
    """Line dedup by looking at all windows in order of id and position."""
    first, gone = {}, {}
    for i in sorted(texts):
        lines = texts[i].split("\n")
        gone[i] = set()
        for p in range(len(lines) - size + 1):
            window = tuple(lines[p : p + size])
            if not "".join(window).strip(" "):
                continue
            if first.setdefault(window, (i, p)) != (i, p):
                gone[i] |= set(range(p, p + size))
    return {i: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i]) for i, t in texts.items()}
