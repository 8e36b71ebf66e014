import hashlib
import math
import random

import pytest
from llm_helpers import SCHEMA, WHITE, documents
from pyspark.sql import functions as F

from souk.llm.exact_dedup import drop_copies, exact_dedup
from souk.llm.mixing import emit_copies, mix_sources, source_targets


def norm(t):
    return WHITE.sub(" ", t or "")


def test_exact_dedup_brute_force(spark):
    long = "word " * 40000
    rows = [(5, "a b"), (3, "a \t\nb"), (9, "a b "), (1, "A b"), (7, None), (2, ""), (4, " "), (8, "\n"), (6, "x" * 64 + "1"),
            (10, "x" * 64 + "2"), (11, "x" * 64 + "1"), (12, long + "a"), (13, long + "b"), (14, long.replace(" ", "\n") + "a"),
            (15, "a b"), (20, "dup"), (20, "dup"), (21, "dup"), (None, "dup"), (None, "only"), (22, "é")]
    got = exact_dedup(documents(spark, rows).withColumn("copy_of", F.col("text")), carry=["doc_id", "copy_of"]).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    for r in got:
        members = groups[norm(r.copy_of)]
        ids = [i for i in members if i is not None]
        keep = min(ids) if ids else None
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(members), r.doc_id == keep), r


def test_exact_dedup_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "a", "x", 5), (2, "a", "y", 6)], "doc_id long, text string, kept string, _row int")
    got = exact_dedup(df, carry=df.columns).orderBy("doc_id").collect()
    assert [(r.doc_id, r.kept, r["_row"], r.group_size) for r in got] == [(1, True, 5, 2), (2, False, 6, 2)]
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(empty).count() == 0 and drop_copies(empty).count() == 0


def test_drop_copies_keeps_rows_whole(spark):
    rows = [(3, "a  b", "de", "s"), (3, "other", "de", "s"), (1, "a b", None, None), (1, "a b", None, None), (None, None), (None, "z"), (5, "")]
    got = drop_copies(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "z"), (1, "a b"), (3, "other"), (5, "")]
    assert drop_copies(documents(spark, rows)).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def level_targets(sizes, weights, cap):
    """Deal again and again, as the words say."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left, weight = total - sum(fixed.values()), sum(w[s] for s in free)
        target = fixed | {s: left * w[s] / weight for s in free}
        over = [s for s in free if target[s] > cap * sizes[s] + 1e-9]
        if not over:
            return target
        fixed |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(6))
def test_source_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {rng.choice([None, f"s{k}", f"é{k}", f"Z{k}"]): int(10 ** rng.uniform(0, 5)) for k in range(rng.randint(1, 12))}
    if seed == 0:
        sizes["empty"] = 0
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    want = level_targets(sizes, (1, 2, 3), 3)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        s = rng.choice(["b", "b", "b", "b", "a", "c", None, "é"])
        rows.append((i * 7, " ".join(["w"] * int(10 ** rng.uniform(0, 2.5))) if i % 50 else None, "en", s))
    df = documents(spark, rows).withColumn("size", F.lit("clash")).withColumn("_id", F.lit(1))
    out = mix_sources(df, block=64)
    got = out.collect()
    assert len(got) == len(rows) and out.columns.count("size") == 1
    size = {i: len((t or "").split()) for i, t, _, _ in rows}
    sizes = {}
    for i, _, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size[i]
    want = level_targets(sizes, (1, 2, 3), 3)
    for s, target in want.items():
        rate = target / sizes[s] if sizes[s] else 0
        key = "mix-1|" + ("n" if s is None else "s" + s)
        u = int(hashlib.md5(key.encode()).hexdigest()[:8], 16) / 2 ** 32
        mine = sorted((r for r in rows if r[3] == s),
                      key=lambda r: (math.floor(math.log2(size[r[0]] + 1) * 8), r[0] // 64, r[0], size[r[0]]))
        copies = {r[0]: math.floor((k + 1) * rate + u) - math.floor(k * rate + u) for k, r in enumerate(mine)}
        own = [r for r in got if r.source == s]
        assert {r.doc_id: r.copies for r in own} == copies
        assert all(r.taken == r.copies * r.size <= 3 * r.size and r.size == size[r.doc_id] for r in own)
        taken = sum(r.taken for r in own)
        assert abs(taken - target) <= max([0, *(size[r[0]] for r in mine)]) + 0.02 * target
    again = mix_sources(df.repartition(5), block=64).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    emitted = emit_copies(out)
    assert emitted.count() == sum(r.copies for r in got)


def test_mix_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mix_sources(empty).count() == 0
    only = mix_sources(documents(spark, [(1, None), (2, ""), (2, ""), (None, "\n")])).collect()
    assert [(r.size, r.copies, r.taken, r.target) for r in only] == [(0, 0, 0, 0.0)] * 4
    same = mix_sources(documents(spark, [(1, "a b", "en", "s")] * 10 + [(None, "c", "en", "t")])).collect()
    assert sum(r.copies for r in same if r.source == "s") in (9, 10) and all(r.taken <= 3 * r.size for r in same)
