import random

import numpy as np
import pytest
from conftest import SF001
from llm_helpers import SCHEMA, documents, near_components, shingle_set
from pyspark.sql import functions as F

from souk.llm import near_dedup as nd
from souk.llm.graph import components
from souk.llm.near_dedup import drop_near_copies, near_dedup, op10_near_dedup


def edits(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(out)


def family(rng, start, size, n_words=150, changes=3):
    base = [f"w{rng.randrange(500)}" for _ in range(n_words)]
    return [(start + k, edits(rng, base, rng.randint(0, changes))) for k in range(size)]


def test_near_dedup_brute_force(spark):
    """Families whose members are linked through each other or not at all,
    chains, copies, and short and empty texts."""
    rng = random.Random(11)
    rows = []
    for f in range(6):
        rows += family(rng, 1000 * f, 12, changes=2 + f)
    text = [f"c{k}" for k in range(200)]
    for k in range(12):  # a chain: neighbours linked, ends far apart
        text = edits(rng, text, 2).split()
        rows.append((9000 - k, " ".join(text)))
    rows += [(20, None), (21, ""), (22, " \n"), (23, "a b"), (24, "A  b"), (25, "a b c"), (26, "a b c d e"), (27, "a b c d e"),
             (28, "É b c d e"), (29, "é b c d e"), (30, "x y z " * 20000), (31, "x y z " * 20000 + "end")]
    rng.shuffle(rows)
    df = documents(spark, rows).withColumn("id", F.lit("clash")).withColumn("kept", F.lit(0))
    for percent in (85, 60):
        got = {r.doc_id: r for r in near_dedup(df, percent=percent).collect()}
        want = near_components(rows, percent)
        assert {i: r.component_id for i, r in got.items()} == want
        assert all(r.n_shingles == len(shingle_set(dict(rows)[i])) and r.kept == (i == r.component_id) for i, r in got.items())
    kept = {r.doc_id for r in drop_near_copies(df, percent=85).collect()}
    assert kept == {i for i, c in near_components(rows, 85).items() if i == c}


def test_hub_that_is_not_the_smallest(spark):
    """Edited copies linked to their original only, which is the largest id."""
    rng = random.Random(12)
    base = [f"h{k}" for k in range(300)]
    rows = [(k, edits(rng, base, 4)) for k in range(40)] + [(999, " ".join(base))]
    want = near_components(rows, 85)
    assert len(set(want.values())) < 5
    assert {r.doc_id: r.component_id for r in near_dedup(documents(spark, rows), percent=85).collect()} == want


def test_tiles_join_what_is_linked(spark):
    """Members of one bucket and of two: whatever the tiles' size, the links
    found join exactly the components that links on full sets join."""
    from llm_helpers import Groups
    rng = random.Random(3)
    rows = [r for f in range(3) for r in family(rng, 100 * f, 25, n_words=120, changes=4)]
    source = documents(spark, rows)
    sig = nd.signatures(source, "doc_id", "text").withColumn("comp", F.col("id"))
    both = sig.select("id", "comp", "bands", *nd.ODD, F.explode(F.slice("bands", 1, 4)).alias("bucket"))
    sizes = both.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    members = both.join(sizes.where("n > 1"), "bucket")
    keys = {r.id: set(r.bands[:4]) for r in sig.collect()}
    sets = {i: shingle_set(t) for i, t in rows}
    want = Groups()
    linked = [(i, j) for i in sets for j in sets if i < j and keys[i] & keys[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    for i, j in linked:
        want.link(i, j)
    for tile in (4, 1000):
        got = nd.tile_links(members, source.select(F.col("doc_id").alias("id"), "text"), nd.most_bits(0.65), 85, tile).collect()
        mine = Groups()
        for r in got:
            assert (min(r.a, r.b), max(r.a, r.b)) in linked
            mine.link(r.a, r.b)
        assert linked and {i: mine.find(i) for i in sets} == {i: want.find(i) for i in sets}


def test_signatures_estimate(spark):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(400)]
    for changes in (2, 8, 25):
        a, b = nd.shingles(" ".join(base)), nd.shingles(edits(rng, base, changes))
        s = nd.minhash([a, b])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[:, 0] == s[:, 1]).mean() - true) < 0.15
        apart = sum(int(np.bitwise_count(x)) for x in nd.odd_sketch(s)[0] ^ nd.odd_sketch(s)[1])
        assert abs(apart - nd.most_bits(true)) < 30


def test_minhash_in_pieces(monkeypatch):
    sets = [nd.shingles(" ".join(f"w{k * 31 % 997}" for k in range(n))) for n in (1, 5, 900, 6, 3000)]
    whole = nd.minhash(sets)
    monkeypatch.setattr(nd, "PIECE", 64)
    assert (nd.minhash(sets) == whole).all()


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_dedup(empty).count() == 0
    got = near_dedup(documents(spark, [(None, "a b c d e f"), (None, None), (4, "a b c d e f"), (4, "a b c d e f"), (3, None)])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [
        ("3", "3", True), ("4", "4", True), ("4", "4", True), ("None", "None", True), ("None", "None", True)]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    from llm_helpers import Groups
    rng, g = random.Random(seed), Groups()
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(40)]
    edges = [e for e in edges if e[0] != e[1]]
    for a, b in edges:
        g.link(a, b)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: g.find(x) for e in edges for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert {r.doc_id: r.component_id for r in op10_near_dedup(spark, SF001).collect()} == near_components(rows, 85)


def test_dropping_keeps_columns_of_any_name(spark):
    from souk.llm.line_dedup import drop_lines
    from souk.llm.near_dedup import drop_near_copies
    text = " ".join(f"word{i}" for i in range(40))
    df = documents(spark, [(1, text), (2, text + " more"), (3, None)])
    for name in ("_gone", "_id", "_row"):
        d = df.withColumn(name, df.doc_id + 10)
        assert sorted((r.doc_id, r[name]) for r in drop_near_copies(d).collect()) == [(1, 11), (3, 13)]
        lines = drop_lines(d)
        assert lines.columns == d.columns and sorted((r.doc_id, r[name]) for r in lines.collect()) == [(1, 11), (2, 12), (3, 13)]
