"""Custom operators against brute-force Python on small random fixtures."""

import random

import pytest

from pyspark.sql import functions as F

from souk.operators import joins as J
from souk.operators import series as N
from souk.operators.aggregates import purchase_funnel


def test_interval_join_matches_nested_loop(spark):
    rnd = random.Random(7)
    ranges = []
    for i in range(40):
        lo = rnd.randrange(0, 5000)
        ranges.append((i, lo, lo + rnd.randrange(0, 900)))      # overlapping ranges allowed
    points = [(j, rnd.randrange(0, 6000)) for j in range(300)]
    rdf = spark.createDataFrame(ranges, "rid int, lo long, hi long")
    pdf = spark.createDataFrame(points, "pid int, v long")
    got = sorted((r.pid, r.rid) for r in J.interval_join(pdf, rdf, [], "v", "lo", "hi", 128, "inner").collect())
    want = sorted((p, i) for p, v in points for i, lo, hi in ranges if lo <= v <= hi)
    assert got == want
    left = J.interval_join(pdf, rdf, [], "v", "lo", "hi", 128, "left")
    unmatched = {p for p, v in points if not any(lo <= v <= hi for _, lo, hi in ranges)}
    assert {r.pid for r in left.where("rid IS NULL").collect()} == unmatched


def test_asof_join_matches_brute_force(spark):
    import datetime as dt
    rnd = random.Random(11)
    base = dt.date(2020, 1, 1)
    changes, facts = [], []
    for key in range(6):
        days = sorted(rnd.sample(range(0, 900), rnd.randrange(1, 8)))
        changes += [(key, base + dt.timedelta(days=d), float(d)) for d in days]
        facts += [(key, i, base + dt.timedelta(days=rnd.randrange(-50, 1000))) for i in range(30)]
    c = spark.createDataFrame(changes, "k int, eff date, price double")
    f = spark.createDataFrame(facts, "k int, i int, t date")
    got = {(r.k, r.i): r.price for r in J.asof_join(f, c, "k", "t", "eff", ["price"], 61).collect()}
    want = {}
    for k, i, t in facts:
        cands = [(e, p) for kk, e, p in changes if kk == k and e <= t]
        want[(k, i)] = max(cands)[1] if cands else None
    assert got == want


def test_counter_increase_handles_resets(spark):
    rows = [("m", i, v) for i, v in enumerate([0, 5, 9, 2, 7, 7, 1])]
    df = spark.createDataFrame(rows, "metric string, i int, value long").withColumn(
        "ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("i") * 60).cast("timestamp_ntz"))
    got = N.counter_increase(df, ["metric"], "ts", "value", "day").collect()
    # deltas: 5, 4, reset -> 2, 5, 0, reset -> 1  => 17
    assert sum(r.increase for r in got) == 17


def test_histogram_quantile_interpolates(spark):
    hist = spark.createDataFrame([("a", 10.0, 20), ("a", 25.0, 60), ("a", float("inf"), 100),
                                  ("b", 10.0, 0), ("b", float("inf"), 4)], "m string, le double, cum long")
    got = {(r.m, r.q): r.value for r in N.histogram_quantile(hist, ["m"], [0.5, 0.95]).collect()}
    assert got[("a", 0.5)] == 10.0 + (25.0 - 10.0) * (50 - 20) / (60 - 20)
    assert got[("a", 0.95)] == 25.0          # in the +Inf bucket: largest finite bound
    assert got[("b", 0.5)] == 10.0


def test_funnel_requires_order(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    ev = [(1, 1, t0, "view"), (1, 2, t0 + dt.timedelta(minutes=1), "click"),
          (1, 3, t0 + dt.timedelta(minutes=2), "purchase"),
          (2, 4, t0, "click"), (2, 5, t0 + dt.timedelta(minutes=1), "view"),      # click before view
          (2, 6, t0 + dt.timedelta(minutes=2), "purchase"),
          (3, 7, t0, "view"), (3, 8, t0, "click")]                                   # same time: tie by id
    df = spark.createDataFrame(ev, "u int, id int, ts timestamp_ntz, kind string")
    got = {r.name: r.users for r in purchase_funnel(df, "u", "ts", "kind", "id", ["view", "click", "purchase"]).collect()}
    assert got == {"view": 3, "click": 2, "purchase": 1}


def test_alert_sustained_islands(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    hours = [0, 1, 2, 4, 5, 7]            # hour 3 and 6 missing -> islands [0-2], [4-5], [7]
    df = spark.createDataFrame([("m", t0 + dt.timedelta(hours=h), 9) for h in hours], "metric string, ts timestamp_ntz, n int")
    got = sorted((r.hours, r.start.hour) for r in N.alert_sustained(df, ["metric"], "ts", F.col("n") > 5, 2).collect())
    assert got == [(2, 4), (3, 0)]


def test_rank_in_groups_matches_window(spark):
    """Heavy ties, one value that most of a group shares, NULLs, NaN, NULL
    groups, whatever the number of ranges."""
    from pyspark.sql import Window

    from souk.operators.windows import rank_in_groups
    rnd = random.Random(5)
    odd = [None, None, float("nan"), 3.0, 3.0, 3.0, 3.0]
    rows = [(g, i, rnd.choice(odd) if rnd.random() < 0.6 else float(rnd.randrange(12)))
            for g, n in (("hot", 300), ("cold", 20), (None, 60)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, v double")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            for fn in ("row_number", "rank"):
                tie = ["i"] if fn == "row_number" else []
                got = rank_in_groups(df, ["g"], "v", tie, "r", fn=fn).collect()
                w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last(), *tie)
                ref = df.withColumn("r", (F.row_number() if fn == "row_number" else F.rank()).over(w).cast("bigint")).collect()
                assert sorted((str(r.g), r.i, r.r) for r in got) == sorted((str(r.g), r.i, r.r) for r in ref)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_limit_fraction_matches_sort(spark):
    from souk.functions.scalar import limit_fraction
    rnd = random.Random(6)
    rows = [(rnd.choice([None, 1, 2, 2, 2, 3]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, i int")
    for fraction in (0.0, 0.13, 0.5, 1.0):
        got = limit_fraction(df, [F.col("a").desc_nulls_last(), F.col("i")], fraction).collect()
        ref = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))[:int(200 * fraction)]
        assert sorted(map(tuple, got), key=str) == sorted(ref, key=str)
    assert limit_fraction(df.limit(0), [F.col("i")], 0.5).count() == 0


def test_broadcast_guard_checks_the_plans_size(spark, tmp_path):
    from helpers import plan_text
    from souk.operators.joins import join_dim
    spark.createDataFrame([(i, "x" * 100) for i in range(50)], "k int, s string").write.parquet(f"{tmp_path}/dim")
    dim = spark.read.parquet(f"{tmp_path}/dim")
    fact = spark.range(200).select((F.col("id") % 60).cast("int").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pytest.warns(UserWarning, match="not broadcast"):
            big = join_dim(fact, dim, "k", "left", "broadcast", max_broadcast_bytes=10)
        small = join_dim(fact, dim, "k", "left", "broadcast")
        assert "SortMergeJoin" in plan_text(big, "simple") and "BroadcastHashJoin" in plan_text(small, "simple")
        assert big.count() == small.count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_asof_join_by_the_second(spark):
    """Changes and facts of one day, equal times, ties, NULLs and facts before
    the first change, against a loop over all changes."""
    import datetime as dt

    from souk.operators.joins import asof_join
    rnd = random.Random(7)
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    facts = [(n, rnd.choice(["a", "b", None]), at(rnd.randrange(0, 200000, 900)) if n % 20 else None) for n in range(200)]
    changes = [(rnd.choice(["a", "a", "b", None]), at(rnd.randrange(50000, 200000, 900)) if n % 15 else None, n, rnd.choice([None, 1.0, 2.0]))
               for n in range(120)]
    f = spark.createDataFrame(facts, "id int, k string, t timestamp")
    c = spark.createDataFrame(changes, "k string, eff timestamp, seq int, price double")
    for days in (1, 366):
        got = {r.id: (r.eff, r.seq, r.price) for r in
               asof_join(f, c.repartition(5), "k", "t", "eff", ["seq", "price"], tie=["seq"], bucket_days=days).collect()}
        assert len(got) == len(facts)
        for n, k, t in facts:
            fit = [(e, s, p) for ck, e, s, p in changes if k is not None and ck == k and t and e and e <= t]
            assert got[n] == max(fit, key=lambda x: x[:2], default=(None, None, None))


def test_interval_join_with_wide_ranges(spark):
    """One range as wide as everything among narrow ones: found on its own
    level, points without a range stay once."""
    from souk.operators.joins import interval_join
    rnd = random.Random(8)
    ranges = [(k, lo, lo + rnd.choice([0, 3, 40, 900])) for k, lo in enumerate(rnd.sample(range(5000), 60))] + [(99, 100, 4_000_000), (98, 5, 4)]
    points = [(i, rnd.choice([None, rnd.randrange(6000)])) for i in range(300)] + [(1000, 5_000_000), (1000, 5_000_000)]
    got = interval_join(spark.createDataFrame(points, "i int, x long"), spark.createDataFrame(ranges, "r int, lo long, hi long"),
                        [], "x", "lo", "hi", 10).collect()
    want = []
    for i, x in points:
        hits = [r for r, lo, hi in ranges if x is not None and lo <= x <= hi]
        want += [(i, r) for r in hits] or [(i, None)]
    assert sorted(((r.i, r.r) for r in got), key=str) == sorted(want, key=str)


def test_latest_by_key_is_stable(spark):
    from souk.operators.incremental import latest_by_key
    rows = [(k, 1, v) for k in range(5) for v in ("a", "c", "b")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = latest_by_key(spark.createDataFrame(rows, "k int, version int, v string").repartition(4), ["k"], "version").collect()
        assert sorted(map(tuple, got)) == [(k, 1, "c") for k in range(5)]


def test_knuth_hash_no_overflow_for_large_keys(spark):
    from souk.functions.scalar import KNUTH, knuth_bucket, knuth_mod_2_32
    keys = [0, 1, 3_500_000_000, 15_000_000_000, 9_000_000_000_000_000_000, 2**62 + 12345]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = df.select("k", knuth_bucket(F.col("k"), 10000).alias("b"), knuth_bucket(F.col("k"), 24).alias("p"),
                    knuth_mod_2_32(F.col("k")).alias("ip")).collect()
    for r in got:
        assert r.b == (r.k * KNUTH) % 10000
        assert r.p == (r.k * KNUTH) % 24
        assert r.ip == (r.k * KNUTH) % 2**32


def test_rank_in_groups_keeps_null_group(spark):
    from souk.operators.windows import rank_in_groups
    df = spark.createDataFrame([(None, i, float(i)) for i in range(30)] + [("a", i, float(i)) for i in range(5)],
                               "g string, i int, v double")
    got = rank_in_groups(df, ["g"], "v", ["i"], "r").collect()
    assert len(got) == 35
    assert sorted(r.r for r in got if r.g is None) == list(range(1, 31))


def test_multi_window_skew_safe_keeps_null_group(spark):
    from souk.operators.windows import multi_window, multi_window_skew_safe
    df = spark.createDataFrame([(None, i, float(i % 7)) for i in range(40)] + [("a", i, 1.0) for i in range(5)],
                               "g string, i int, v double")
    a = multi_window_skew_safe(df, ["g"], "v", ["i"])
    b = multi_window(df, ["g"], "v", [F.col("v").desc(), F.col("i")])
    key = lambda r: (str(r.g), r.i)
    assert sorted(((str(r.g), r.i, r.rn, r.group_total) for r in a.collect())) == \
        sorted(((str(r.g), r.i, r.rn, r.group_total) for r in b.collect()))
