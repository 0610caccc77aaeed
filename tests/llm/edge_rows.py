"""Awkward rows that every operator must take, and plain recomputations to hold results against."""

from __future__ import annotations

import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __n long, score string"

_BASE = " ".join(f"word{i}" for i in range(60))


def documents(spark):
    """Null ids and texts, empty and blank ones, equal rows, near copies, one very long text, odd characters."""
    rows = [
        (1, _BASE),
        (2, _BASE),
        (2, _BASE),
        (3, _BASE.replace("word59", "other")),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "one two"),
        (8, "ONE Two"),
        (9, "Ünïcode éèà ‘quotes’ don't 3.5% ß — 日本語 x" + chr(0x301) + " ​y"),
        (10, "spam " * 30_000),
        (11, "Licensed under CC BY-NC 4.0. All rights reserved, cc-by; GNU General  Public\nLicense v3"),
        (None, _BASE),
        (None, None),
        (12, "<|endoftext|> a<|startoftext|>b"),
    ]
    full = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"s{k % 2}", None if t is None else len(t), k, "x") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOC_SCHEMA)


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text: str | None, width: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def components(n: int, links) -> list[int]:
    """The smallest number reachable from each of n nodes."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]
