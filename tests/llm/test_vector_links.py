"""Near-duplicate vectors against all pairs in double precision."""

import math

import numpy as np
import pytest

from llm_helpers import Groups, save
from souk.llm import vector_links as v

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    ok = lambda e: bool(e) and all(x is not None and math.isfinite(x) for x in e) and any(e)
    g, n = Groups(), [0] * len(rows)
    for i, (a, x, p) in enumerate(rows):
        g.find(i)
        for j, (b, y, q) in enumerate(rows[:i]):
            if p is not None and p == q and ok(x) and ok(y) and len(x) == len(y):
                x64, y64 = np.float32(x).astype(float), np.float32(y).astype(float)
                if x64 @ y64 / np.linalg.norm(x64) / np.linalg.norm(y64) >= cosine:
                    n[i] += 1
                    n[j] += 1
                    g.link(i, j)
    ids = {}
    for i, (a, _, _) in enumerate(rows):
        ids.setdefault(g.find(i), []).append(a)
    comp = [min((x for x in ids[g.find(i)] if x is not None), default=None) for i in range(len(rows))]
    return sorted(((a, n[i], comp[i], a == comp[i]) for i, (a, _, _) in enumerate(rows)), key=repr)


def vectors(seed=5, dim=24):
    rng = np.random.default_rng(seed)
    rows, vid = [], 0
    for label in (0, 1):
        for noise, copies in ((0.02, 30), (0.1, 25), (0.14, 25), (0.2, 20), (0, 6), (1, 40)):
            base = rng.standard_normal(dim)
            base /= np.linalg.norm(base)
            for _ in range(copies):
                x = base + noise * rng.standard_normal(dim) / math.sqrt(dim)
                rows.append((vid, [float(np.float32(y)) for y in x * rng.uniform(0.5, 4 if noise else 0.5)], label))
                vid += 1
    return rows


ODD = [(9000, None, 0), (9001, [], 0), (9002, [0.0] * 24, 0), (9003, [1.0] * 23 + [None], 0), (9004, [math.nan] * 24, 0),
       (9005, [math.inf] + [1.0] * 23, 0), (9006, [1.0] * 24, None), (9007, [1.0] * 24, None), (9008, [1.0, 1.0], 0),
       (9009, [2.0, 2.0], 0), (9010, [1e-40] * 24, 1), (9011, [3e38] * 24, 1), (9011, [3e38] * 24, 1)]


def result(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize("tile", [2048, 7])
def test_links_of_all_pairs(spark, tile, monkeypatch):
    monkeypatch.setattr(v, "TILE", tile)
    rows = vectors() + ODD
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(v.vector_links(df)) == brute(rows)


def test_wide_buckets_go_through_a_further_code(spark, monkeypatch):
    monkeypatch.setattr(v, "PAIRED", 2)
    rows = vectors(seed=6)
    assert result(v.vector_links(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_clashing_names_null_ids_and_the_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 3, 7, "x"), (None, [1.0, 0.0], 3, 8, "y"), (None, [0.0, 1.0], 3, 9, "z")],
                               "vec_id long, embedding array<double>, label int, node long, _row string").withColumnRenamed("node", "n_links")
    out = v.vector_links(df)
    assert sorted(out.columns) == sorted(["vec_id", "embedding", "label", "_row", "n_links", "component_id", "kept"])
    got = {r["_row"]: (r.n_links, r.component_id, r.kept) for r in out.collect()}
    assert got == {"x": (1, 1, True), "y": (1, 1, False), "z": (0, None, True)}
    assert v.vector_links(df.limit(0)).collect() == []


def test_query(spark, tmp_path):
    rows = vectors(seed=7)
    assert result(v.op11_vector_links(spark, save(spark.createDataFrame(rows, SCHEMA), tmp_path, "embeddings"))) == brute(rows)


@pytest.mark.parametrize("vectors_", [1200, 10**6])
def test_recall_of_the_filters_at_the_threshold(vectors_):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.standard_normal(x.shape)
    u -= (u * x).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * u / np.linalg.norm(u, axis=1, keepdims=True)
    met = np.zeros(len(x), dtype=bool)
    for turn in range(v.TURNS):
        code = v.ProductCode(64, vectors_, seed=turn)
        met |= [len(np.intersect1d(a, b)) > 0 for a, b in zip(code.decode(x), code.decode(y), strict=True)]
    assert met.mean() >= 0.99


def test_decoding_finds_exactly_the_directions_above_the_height():
    code = v.ProductCode(16, 500)
    x = np.random.default_rng(2).standard_normal((20, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turned = np.zeros((20, code.blocks * code.width))
    turned[:, :16] = x @ code.turn
    shares = np.einsum("nbw,bsw->nbs", turned.reshape(20, code.blocks, code.width), code.words)
    total = shares[:, 0]
    for b in range(1, code.blocks):
        total = (total[:, :, None] + shares[:, b][:, None, :]).reshape(20, -1)
    for got, all_ in zip(code.decode(x), total, strict=True):
        assert sorted(got) == np.flatnonzero(all_ >= code.height).tolist()
