import hashlib
import random
from collections import Counter

import numpy as np
from conftest import SF001
from llm_helpers import SCHEMA, documents
from pyspark.sql import functions as F

from souk.llm.fingerprints import SAMPLES, edited_fingerprints, fingerprint, op6_fingerprints


def jaccard(a, b):
    """Generalised Jaccard similarity of the word counts."""
    a, b = Counter(a.split()), Counter(b.split())
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 1.0


def edited(texts):
    """Brute force: texts in descending order of ids -> their edited texts."""
    out = []
    for k, t in enumerate(texts):
        after, third = texts[(k + 1) % len(texts)], len(t) // 3
        out.append(t[:len(t) - third] + after[:third])
    return out


def test_collisions_estimate_generalised_jaccard(spark):
    rng, rows = random.Random(2), []
    for i in range(0, 300, 2):
        # words of the pair's own: all pairs draw on the same random numbers per
        # term, so pairs over a common vocabulary would err together
        words = [f"{i}x{k}" for k in range(60)]
        common, own = rng.randint(0, 60), [rng.choice([1, 1, 1, 2, 5]) for _ in words]
        rows.append((i, " ".join(w for w, n in zip(words, own, strict=True) for _ in range(n))))
        rows.append((i + 1, " ".join(w if k < common else w + "y" for k, w in enumerate(words) for _ in range(rng.choice([own[k], own[k] + 1])))))
    got = {r.doc_id: r.fingerprint for r in fingerprint(documents(spark, rows)).collect()}
    errors = []
    for i in range(0, 300, 2):
        a, b = got[i], got[i + 1]
        same = np.mean([a[k:k + 5] == b[k:k + 5] for k in range(0, 5 * SAMPLES, 5)])
        errors.append(same - jaccard(rows[i][1], rows[i + 1][1]))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.12


def test_odd_texts(spark):
    rows = [(1, "a b"), (2, "b\t\n a"), (3, None), (4, ""), (5, " \n"), (6, "a b"), (7, "a a b"), (None, "x"), (None, "y"), (8, "w " * 60000)]
    df = documents(spark, rows).withColumn("fingerprint", F.lit(1)).withColumn("_word", F.lit("x"))
    got = {r.doc_id: r.fingerprint for r in fingerprint(df).collect()}
    assert len(got) == 9 and got[1] == got[2] == got[6] != got[7]
    assert got[3] == got[4] == got[5] == "" and len(got[8]) == 5 * SAMPLES
    empty = spark.createDataFrame([], SCHEMA)
    assert fingerprint(empty).count() == 0 and edited_fingerprints(empty).count() == 0


def test_edited_neighbours_over_blocks(spark):
    rng = random.Random(9)
    ids = sorted(rng.sample(range(-500, 10 ** 7), 60)) + [2 ** 40, 2 ** 40 + 1]
    rows = [(i, "".join(rng.choice("abc é\n") for _ in range(rng.choice([0, 1, 2, 3, 10, 50])))) for i in ids]
    rows[5] = (rows[5][0], None)
    got = {r.doc_id: r for r in edited_fingerprints(documents(spark, rows), block=4).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    texts = [t or "" for _, t in order]
    assert len(got) == len(rows)
    for (i, t), e, after in zip(order, edited(texts), texts[1:] + texts[:1], strict=True):
        r = got[i]
        assert r.n_chars == len(t or "") and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert (r.fingerprint == "") == ((t or "").split() == [])
        if (t or "").split() == after.split() or sorted((t or "").split()) == sorted(after.split()):
            assert r.near_next == 1
        if sorted((t or "").split()) == sorted(e.split()):
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint


def test_one_row_and_null_ids(spark):
    r = edited_fingerprints(documents(spark, [(4, "abc def ghi")])).collect()
    assert len(r) == 1 and r[0].near_next == 1
    assert r[0].edited_sha256 == hashlib.sha256(b"abc def abc").hexdigest()
    got = edited_fingerprints(documents(spark, [(1, "one two three"), (None, "four five six"), (1, "one two three")])).collect()
    assert sorted(str(x.doc_id) for x in got) == ["1", "1", "None"]


def test_query(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    order = sorted(rows, key=lambda r: -r.doc_id)
    texts = [r.text or "" for r in order]
    got = {r.doc_id: r for r in op6_fingerprints(spark, SF001).collect()}
    assert len(got) == len(rows)
    errors = []
    for r, e, after in zip(order, edited(texts), texts[1:] + texts[:1], strict=True):
        g = got[r.doc_id]
        assert g.edited_sha256 == hashlib.sha256(e.encode()).hexdigest() and g.n_chars == len(r.text or "")
        errors += [g.near_edited - jaccard(r.text or "", e), g.near_next - jaccard(r.text or "", after)]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.1
    same = {}
    for r in rows:
        assert same.setdefault(r.text, got[r.doc_id].fingerprint) == got[r.doc_id].fingerprint


def test_texts_cross_one_shuffle(spark):
    """Samples and facts read the same shuffled texts."""
    rows = [(i, f"w{i} " * (i % 7 + 1)) for i in range(300)]
    df = edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), samples=8)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    texts = [line for line in final.splitlines() if "Exchange hashpartitioning(_block" in line]
    assert ["ReusedExchange" in line for line in texts] == [False, True]
