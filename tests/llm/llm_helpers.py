"""Small frames and brute-force versions for the corpus operators' tests."""

from __future__ import annotations

import re
from itertools import combinations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WHITE = re.compile(r"[\x20\x09-\x0D]+")


def documents(spark, rows, extra=""):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *("en", "s0")[len(r) - 2:]) if len(r) < 4 else r for r in rows]
    return spark.createDataFrame([(i, t, la, s, None if t is None else len(t)) for i, t, la, s in full], SCHEMA)


def save(df, tmp_path, name="documents"):
    df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


class Groups:
    """Union by smallest member."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingle_set(t):
    w = [x for x in WHITE.split(ascii_lower(t or "")) if x]
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def near_components(docs, percent):
    """{doc_id: component} by comparing all pairs of (doc_id, text)."""
    g, sets = Groups(), [(i, shingle_set(t)) for i, t in docs]
    for i, _ in sets:
        g.find(i)
    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            g.link(a, b)
    return {i: g.find(i) for i, _ in sets}
