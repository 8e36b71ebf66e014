"""Scans, quantiles and differences over ranges of equal size, against plain Python."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helpers import plan_text
from souk.operators import windows as W


@pytest.fixture
def no_coalescing(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def sessions(rows, gap):
    """{tie: session} by walking each user's events in order."""
    out, state = {}, {}
    for u, t, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or dt.datetime.min, r[2])):
        last, no = state.get(u, ("none", 0))
        new = last in ("none", None) or t is None or (t - last).total_seconds() > gap
        state[u] = (t, no + new)
        out[i] = no + new
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_of_a_burst(spark, no_coalescing, seed):
    rng = random.Random(seed)
    day = dt.datetime(2024, 1, 1)
    rows = [(7, day + dt.timedelta(milliseconds=rng.randrange(4_000_000)), i) for i in range(1500)]
    rows += [(rng.choice([1, 2, None]), rng.choice([None, day + dt.timedelta(seconds=rng.randrange(50_000))]), i) for i in range(1500, 1900)]
    df = spark.createDataFrame(rows, "u int, t timestamp_ntz, i long")
    got = {r.i: r.session_no for r in W.sessionize(df, "u", "t", "i", 3).collect()}
    assert got == sessions(rows, 3)
    # the burst of one user in one day is dealt over many ranges
    ranges = W.in_order(df.withColumn("_gk", F.struct("u")), ["_gk", "t", "i"]).where("u = 7").groupBy("_blk").count().collect()
    assert len(ranges) >= 5 and max(r["count"] for r in ranges) < 600


def test_sessions_never_partition_by_user_alone(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    text = plan_text(W.sessionize(ev, "user_id", "ts", "event_id"))
    assert text.count("hashpartitioning(_gk") >= 1 and "hashpartitioning(user_id" not in text


@pytest.mark.parametrize("bins, rounds", [(1024, 2), (4, 1), (3, 0), (2, 3)])
def test_quantiles_by_selection(spark, bins, rounds):
    rng = np.random.default_rng(3)
    groups = {"even": rng.uniform(0, 1, 700), "skew": np.exp(rng.normal(0, 12, 700)), "ties": rng.integers(0, 3, 700).astype(float),
              "one": np.array([5.0]), "wide": np.array([-1.7e308, 0.0, 1.0, 1.7e308]), None: np.array([2.0, 4.0])}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("even", None), ("even", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = {"lo": 0.25, "mid": 0.5, "hi": 0.95, "least": 0.0, "most": 1.0}
    got = {r["g"]: r for r in W.group_quantiles(df, ["g"], "x", probs, bins, rounds).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        if g == "wide":     # the interpolation itself is within the doubles' range
            xs = np.sort(xs)
            assert got[g]["least"] == xs[0] and got[g]["most"] == xs[-1] and got[g]["mid"] == 0.5
            continue
        for o, p in probs.items():
            assert got[g][o] == pytest.approx(np.quantile(xs, p), rel=1e-12)
    whole = W.group_quantiles(df, [], "x", {"mid": 0.5}).collect()
    assert whole[0]["mid"] == np.median([x for _, x in rows if x is not None and x == x])
    assert W.group_quantiles(df.limit(0), ["g"], "x", probs).collect() == []


def test_quantiles_hold_no_group_in_one_task(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("x"))
    text = plan_text(W.group_quantiles(df, ["g"], "x", {"q": 0.25}))
    assert "percentile" not in text and "ObjectHashAggregate" not in text


def test_row_difference_with_multiplicity(spark):
    rng = random.Random(4)
    row = lambda: (rng.choice([1, 2, 3, None]), rng.choice(["a", None]), rng.choice([1.5, None]))
    left, right = [row() for _ in range(60)], [row() for _ in range(60)]
    schema = "k int, s string, x double"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    la, lb = Counter(left), Counter(right)
    want = {r: (la[r], lb[r]) for r in la | lb if la[r] != lb[r]}
    got = {(r.k, r.s, r.x): (r.left_rows, r.right_rows) for r in W.row_difference(a, b, ["k"]).collect()}
    assert got == want
    assert W.row_difference(a, a.orderBy(F.rand(1)), ["k"]).collect() == []
    only = W.row_difference(a, a.limit(0), ["k"], ["s"], buckets=1)
    assert only.columns == ["s", "k", "left_rows", "right_rows"] and {r.right_rows for r in only.collect()} == {0}


def test_only_buckets_that_differ_are_compared(spark):
    a = spark.range(3000).select("id", (F.col("id") * 2).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 17, -1).otherwise(F.col("v")))
    rows = W.row_difference(a, b, ["id"], buckets=512)
    assert sorted((r.id, r.v, r.left_rows, r.right_rows) for r in rows.collect()) == [(17, -1, 0, 1), (17, 34, 1, 0)]
