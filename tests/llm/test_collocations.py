"""Phrase counts and scores against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from helpers import canon
from llm_helpers import ascii_lower, documents, save
from souk.llm import collocations as c


def pieces(text):
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text or ""))]


def brute(rows, least=30, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by the words of the contract."""
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        for p in pieces(text):
            n[lang or "und"] += len(p)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(p[i:i + k]) for i in range(len(p) - k + 1))
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and inside(p, q) for q, b in cand.items()):
                continue
            score, k = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def corpus(seed=3, docs=150):
    rng = random.Random(seed)
    words = ["sun", "Moon", "the", "of", "é", "été", "\x01odd", "a-b", "ЖЗ", " x", "it"]
    fixed = ["the sun of été", "it the the the the", "a-b ЖЗ"]
    rows = []
    for i in range(docs):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 60))]
        text = "".join(p + rng.choice([" ", " ", "  ", "\t", ", ", "\n", ".", "\x0b", " ! "]) for p in parts)
        rows.append((i, text if i % 17 else None, rng.choice(["en", "de", None, "und"]), "s"))
    return rows


def result(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


def test_query_against_brute_force_and_its_sql(spark, tmp_path):
    rows = corpus()
    sf = save(documents(spark, rows), tmp_path)
    got = c.op12_collocations(spark, sf)
    want = brute(rows)
    assert len(want) > 10 and result(got) == want
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet/*.parquet')")
    cur = con.execute(c.OP12_SQL)
    assert canon([d[0] for d in cur.description], cur.fetchall()) == canon(got.columns, [tuple(r) for r in got.collect()])


def test_top_of_a_group_by_score_count_and_bytes(spark):
    rows = corpus(seed=4)
    got = c.collocations(documents(spark, rows), least=5, top=7)
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r[x] for x in cols) for r in got.collect()) == brute(rows, least=5, top=7)


@pytest.mark.parametrize("block", [64, 1 << 20])
@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_scan_counts_all_prefixes(block, batch, monkeypatch):
    monkeypatch.setattr(c, "BLOCK", block)
    texts = [t or "" for _, t, _, _ in corpus(seed=5, docs=60)]
    stream = Counter()
    for b in c.blocks(texts):
        phrases, n = c.count_windows(b, 4)
        stream.update(dict(zip(phrases.to_pylist(), n.tolist(), strict=True)))
    rows = sorted(((p.encode(), k) for p, k in stream.items()))
    got = Counter()
    for half in (rows[:len(rows) // 3], rows[len(rows) // 3:]):
        scan = c.PrefixScan(4, 6)
        parts = []
        for i in range(0, len(half), batch):
            some = half[i:i + batch]
            import numpy as np
            parts += scan.feed(pa.array(["en"] * len(some)), pa.array([p.decode() for p, _ in some]), np.array([k for _, k in some]))
        for _, phrase, words, n in parts + scan.end():
            got[phrase.rstrip(" "), words] += n
    want = Counter()
    for t in texts:
        for p in pieces(t):
            want["", 0] += len(p)
            for k in range(1, 5):
                want.update((" ".join(p[i:i + k]), k) for i in range(len(p) - k + 1))
    assert {k: v for k, v in got.items() if v >= 6} == {k: v for k, v in want.items() if v >= 6}


def test_nothing_to_count_and_other_columns(spark):
    empty = documents(spark, [(1, None), (2, ""), (3, " .,;\n")])
    assert c.collocations(empty).collect() == []
    assert c.collocations(empty.limit(0)).collect() == []
    long = documents(spark, [(1, "ab cd " * 300_000)]).selectExpr("doc_id AS phrase", "text", "lang", "source AS f", "n_chars AS words")
    got = {r["phrase"]: (r["a"], r["n"]) for r in c.collocations(long).collect()}
    assert got == {"ab cd ab cd": (299_999, 600_000), "cd ab cd ab": (299_998, 600_000)}


def test_scores_beyond_64_bits(spark, monkeypatch):
    huge = 9_000_000_000_000_000
    counts = spark.createDataFrame([("en", "", 0, 3 * huge), ("en", "a", 1, huge), ("en", "b", 1, huge), ("en", "a b", 2, huge - 1)],
                                   "lang string, phrase string, words int, f long")
    monkeypatch.setattr(c, "phrase_counts", lambda *a: counts)
    [r] = c.collocations(counts).collect()
    assert r["score"] == 2_000_000 * (huge - 1) // (2 * huge)
