"""Plain versions of the operators, to compare with, and rows that every operator must bear."""

from __future__ import annotations

import re
from collections import defaultdict

import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, key string, `row` int"


def documents(spark, rows):
    """Rows of (doc_id, text[, lang]) with extra columns whose names clash with inner ones."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), "x", "y", 1) for r in rows]
    return spark.createDataFrame(full, DOCS)


class Groups:
    """Union-find; the name of a group is its smallest member."""

    def __init__(self) -> None:
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b) -> None:
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def words(text: str) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall("[^\x20\x09-\x0d]+", low)


def simhash(text: str | None, width: int = 4) -> int:
    found = words(text or "")
    parts = [" ".join(found[i: i + width]) for i in range(len(found) - width + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows: list[tuple[int, str | None]], distance: int = 4) -> dict[int, int]:
    prints, groups = defaultdict(list), Groups()
    for doc, text in rows:
        prints[simhash(text)].append(doc)
    items = list(prints.items())
    for i, (a, left) in enumerate(items):
        for doc in left:
            groups.join(left[0], doc)
        for b, right in items[:i]:
            if (a ^ b).bit_count() <= distance:
                groups.join(left[0], right[0])
    return {doc: groups.find(doc) for doc, _ in rows}


def line_groups(rows: list[tuple[int, str | None]], width: int = 5, similarity: float = 0.8) -> dict[tuple[int, int], tuple[int, int]]:
    """For every line that is not blank, the first line of its group, comparing all pairs."""
    places = defaultdict(list)
    for doc, text in rows:
        for number, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\r\x0b\x0c"):
                places[line.strip(" \t\r\x0b\x0c")].append((doc, number))
    items = [({t[i: i + width] for i in range(max(1, len(t) - width + 1))}, at) for t, at in places.items()]
    groups = Groups()
    for i, (a, left) in enumerate(items):
        for at in left:
            groups.join(left[0], at)
        for b, right in items[:i]:
            small, large = sorted((len(a), len(b)))
            if small >= similarity * large and len(a & b) >= similarity * len(a | b):
                groups.join(left[0], right[0])
    return {at: groups.find(at) for at in list(groups.up)}
