"""Histories, touched partitions, bitmaps and one-pass funnels against plain Python."""

import datetime as dt
import os
import random
import time

import pytest

from helpers import plan_text
from souk.operators import bitmaps, funnels
from souk.operators import history as H
from souk.operators import incremental as I
from souk.session import scratch_path
from pyspark.sql import functions as F

LOG = "k int, v string, version int, op string"


def test_history_at_every_version_and_late_changes(spark):
    rnd = random.Random(5)
    log = [(rnd.choice([None, 1, 1, 1, 2, 3, 4]), f"v{i}", i // 2, rnd.choice("IUUD")) for i in range(120)]
    root = scratch_path(spark, "history")
    cuts = [0, 15, 40, 60]
    for b, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
        batch = [r for r in log if lo <= r[2] < hi]
        if b == 2:
            batch += [(1, "late", 1, "U"), (2, "none", None, "U")]
        df = spark.createDataFrame(batch, LOG)
        H.extend_history(df, root, ["k"], "version", b)
        if b == 1:
            H.extend_history(df, root, ["k"], "version", b)      # a retry replaces itself
    whole = spark.createDataFrame(log, LOG)
    for v in (0, 7, 14, 15, 39, 59):
        got = {(r.k, r.v) for r in H.history_as_of(spark, root, v, 2).collect()}
        want = {(r.k, r.v) for r in I.snapshot_as_of(whole, ["k"], "version", v, op="op").collect()}
        assert got == want, v
    assert {r.v for r in spark.read.parquet(f"{root}/late").collect()} == {"late", "none"}
    early = {(r.k, r.v) for r in H.history_as_of(spark, root, 14, 0).collect()}
    assert early == {(r.k, r.v) for r in H.history_as_of(spark, root, 14, 2).collect()}


def test_history_without_changes_and_pushed_range(spark):
    root = scratch_path(spark, "history")
    H.extend_history(spark.createDataFrame([], LOG), root, ["k"], "version", 0)
    assert H.history_as_of(spark, root, 5, 0).count() == 0
    H.extend_history(spark.createDataFrame([(1, "a", 3, "I")], LOG), root, ["k"], "version", 1)
    assert H.history_as_of(spark, root, 5, 1).collect()[0].v == "a"
    text = plan_text(H.history_as_of(spark, root, 5, 1))
    assert text.count("LessThanOrEqual(valid_from,5)") == 2 and "GreaterThan(valid_to,5)" in text


def test_only_touched_partitions_are_rewritten(spark):
    root = scratch_path(spark, "by-part")
    rows = [(i, f"p {i % 5}/x" if i % 7 else None, i * 10) for i in range(60)]
    spark.createDataFrame(rows, "k int, p string, v int").write.partitionBy("p").parquet(root)
    files = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
                     for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}
    before = files()
    time.sleep(0.01)
    gone = [k for k, p, _ in rows if p == "p 1/x"]
    changes = [(gone[0], "p 2/x", -1, 1, "U"), (7, None, -2, 1, "U"), (1000, "new", -3, 1, "I")] + [(k, None, None, 2, "D") for k in gone[1:]]
    done = H.rewrite_touched(spark, root, spark.createDataFrame(changes, "k int, p string, v int, version int, op string"), ["k"], ["p", "v"], ["p"])
    assert {r.p for r in done.collect()} == {"p 1/x", "p 2/x", None, "new"}
    state = {k: (p, v) for k, p, v in rows if k not in gone} | {gone[0]: ("p 2/x", -1), 7: (None, -2), 1000: ("new", -3)}
    schema = "k int, v int, p string"
    assert {r.k: (r.p, r.v) for r in spark.read.schema(schema).parquet(root).collect()} == state
    after = files()
    for part in ("p 0", "p 3", "p 4"):
        mine = {f for f in before if part in f}
        assert mine and all(after.get(f) == before[f] for f in mine)
    assert not any(f in after for f in before if "p 1" in f)


def test_retention_and_rollup_of_sparse_users(spark):
    rnd = random.Random(2)
    months = [dt.date(2024, m, 1) for m in range(1, 7)]
    seen = [(rnd.choice([3, 40_000, 40_001, 5_000_000, rnd.randrange(300)]), rnd.choice(months)) for _ in range(400)] + [(None, months[0])]
    df = spark.createDataFrame(seen, "u bigint, m date")
    maps = bitmaps.user_bitmaps(df, [F.col("m")], "u")
    facts = {(u, m) for u, m in seen if u is not None}
    assert {r.m: r.users for r in bitmaps.distinct_users(maps, ["m"]).collect()} == {m: len({u for u, x in facts if x == m}) for m in months}
    first = {}
    for u, m in sorted(facts, key=lambda x: x[1]):
        first.setdefault(u, m)
    want = {}
    for u, m in facts:
        key = (first[u], m.month - first[u].month)
        want[key] = want.get(key, 0) + 1
    got = {(r.cohort_month, r.period): r.active_users for r in bitmaps.retention_from_bitmaps(maps, "m").collect()}
    assert got == want


@pytest.mark.parametrize("steps", [["a", "b", "c"], ["a", "a", "b"], ["b"]])
def test_funnel_of_a_hot_user_in_small_chunks(spark, steps):
    rnd = random.Random(9)
    ev = [(rnd.choice([1] * 6 + [2, 3, None]), rnd.choice([None, *range(40)]), rnd.choice("abcd"), i) for i in range(900)]
    ev += [(u, rnd.randrange(40), rnd.choice("abcd"), 1000 + 10 * u + j) for u in range(10, 60) for j in range(4)]
    df = spark.createDataFrame(ev, "u int, t int, kind string, id int")
    want = {}
    for u, t, kind, i in sorted(ev, key=lambda e: (e[1] is not None, e[1] or 0, e[3])):
        times = want.setdefault(u, [])
        if len(times) < len(steps) and kind == steps[len(times)]:
            times.append(t)
    got = {r.u: list(r.times) for r in funnels.funnel_times(df, "u", "t", "kind", "id", steps, chunk=3).collect()}
    assert got == {u: t for u, t in want.items() if t}
