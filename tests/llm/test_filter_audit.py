"""All orders of the filters against removing documents one filter at a time."""

import random
import re
from itertools import permutations

import duckdb
import numpy as np

from helpers import canon
from llm_helpers import documents, save
from souk.llm import filter_audit as fa


def fails(docs):
    """{row: set of letters} straight from the conditions."""
    out = []
    for i, text, _ in docs:
        t = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        smaller = any(i is not None and j is not None and j < i and (u or "") == t for j, u, _ in docs)
        out.append({c for c, bad in zip("ABCDE", [
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search("[#$%&*|]", t)), smaller], strict=True) if bad})
    return out


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    bad, rows = fails(docs), {}
    for part in {la or "" for _, _, la in docs}:
        mine = [(docs[k][0], bad[k]) for k in range(len(docs)) if (docs[k][2] or "") == part]
        credit = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            alive, gone = mine, []
            for step, f in enumerate(order, 1):
                lost = [d for d in alive if f in d[1]]
                rows[part, "".join(order), step] = [
                    len(alive) - len(lost), len(lost), sum(f in d[1] for d in gone), sum(d[1] == {f} for d in mine),
                    sum(d[0] in good for d in lost), sum(d[0] in toxic for d in lost)]
                credit[f] += len(lost)
                alive, gone = [d for d in alive if f not in d[1]], gone + lost
        for (p, order, step), r in rows.items():
            if p == part:
                r.append(credit[order[step - 1]])
    return {k: tuple(v) for k, v in rows.items()}


def corpus(seed=1):
    rng = random.Random(seed)
    texts = [None, "", " ", "#", "A B C", "x " * 120, " ".join(f"w{i}" for i in range(130)),
             "\t".join(f"w{i}" for i in range(100)), " ".join(f"W{i}X" for i in range(110)), "é " * 99,
             " ".join(["same"] * 30 + [f"u{i}" for i in range(90)]) + " 100%"]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(70)] + [(None, "#", "en"), (3, "#", "en"), (3, "#", "de")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 70, 2)] + [(None, 1, 1), (4, 1, 0), (4, 0, 1)]
    return docs, labels


def test_query_against_brute_force_and_its_sql(spark, tmp_path):
    docs, labels = corpus()
    sf = save(documents(spark, [(i, t, la, "s") for i, t, la in docs]).withColumnRenamed("n_chars", "mask"), tmp_path)
    save(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), tmp_path, "labels")
    got = fa.op13_filter_audit(spark, sf)
    rows = got.collect()
    want = brute(docs, labels)
    assert len(rows) == len(want) == 3 * 120 * 5
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in rows} == want
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet/*.parquet')")
    cur = con.execute(fa.OP13_SQL)
    assert canon([d[0] for d in cur.description], cur.fetchall()) == canon(got.columns, [tuple(r) for r in rows])


def test_walk_stores_every_subset():
    rng = np.random.default_rng(0)
    masks, counts = np.arange(32), rng.integers(0, 9, (32, 3))
    state = fa.survivors(masks, counts, 5)
    for s in range(32):
        assert (state[s] == counts[(masks & s) == 0].sum(axis=0)).all()


def test_no_documents(spark):
    none = documents(spark, [(1, "x")]).limit(0)
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert fa.filter_audit(fa.document_cells(none, labels)).collect() == []


def test_a_very_long_text(spark):
    docs = documents(spark, [(1, "word " * 2_000_000), (2, "word " * 2_000_000)])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    cells = {r["mask"]: r["n"] for r in fa.document_cells(docs, labels).collect() if r["n"]}
    assert cells == {2: 1, 18: 1}
