"""What a step costs must not depend on one task, one file or the number of
its readers: the steps behind queries that grew faster than their input."""

import datetime as dt
import glob
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from souk.operators import joins as J
from souk.operators import score as M
from souk.operators import sessions as SL
from souk.operators import windows as W
from souk.plans import streams as S
from souk.session import FREE
from souk.sources import io
from souk.streaming import streams as K


def test_formats_are_written_from_one_computation(spark, tmp_path):
    once = F.udf(lambda: os.urandom(8).hex(), "string").asNondeterministic()
    df = spark.range(40).select("id", once().alias("u"))
    paths = io.write_formats(df, str(tmp_path), ["orc", "csv", "parquet", "json"])
    assert list(paths) == ["orc", "csv", "parquet", "json"]
    got = {f: sorted((int(r["id"]), r["u"]) for r in io.read_table(spark, p, f, "id string, u string" if f in io.TEXT_FORMATS else None).collect())
           for f, p in paths.items()}
    assert len(got["parquet"]) == 40 and all(v == got["parquet"] for v in got.values())


def test_adding_formats_adds_the_source_only(spark, tmp_path):
    for lo in (0, 10):
        paths = io.write_formats(spark.range(lo, lo + 10), str(tmp_path), ["parquet", "json"], mode="append")
    for f, p in paths.items():
        assert sorted(int(r["id"]) for r in io.read_table(spark, p, f, "id long").collect()) == list(range(20))


def test_asof_tasks_grow_with_rows(spark):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    facts = spark.createDataFrame([(k, day(n), n) for k in range(30) for n in range(5, 9)], "k int, t timestamp, n int")
    changes = spark.createDataFrame([(k, day(n), k * 100 + n) for k in range(0, 30, 2) for n in (1, 6)], "k int, eff timestamp, v int")
    few, many = (J.asof_join(facts, changes, "k", "t", "eff", ["v"], rows_per_task=r) for r in (10_000, 10))
    assert few.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() == 15
    for got in (few, many):
        for r in got.collect():
            assert r["v"] == (None if r["k"] % 2 else r["k"] * 100 + (6 if r["n"] >= 6 else 1))


def test_asof_tie_may_be_a_value(spark):
    at = dt.datetime(2024, 1, 1)
    facts = spark.createDataFrame([(1, at)], "k int, t timestamp")
    changes = spark.createDataFrame([(1, at, 5, 1), (1, at, 4, 2)], "k int, eff timestamp, v int, i int")
    got = J.asof_join(facts, changes, "k", "t", "eff", ["v", "i"], tie=["i"])
    assert got.columns == ["k", "t", "v", "i", "eff"]
    assert [tuple(r) for r in got.collect()] == [(1, at, 4, 2, at)]


@pytest.mark.parametrize("collected", [0, 4, 4096])
def test_quantiles_of_small_and_large_groups(spark, collected):
    import numpy as np

    rows = [(g, float((i * 7919) % 101) / 4) for g in range(6) for i in range(g * 3)] + [(None, 2.0), (1, None), (9, None), (9, float("nan"))]
    got = W.group_quantiles(spark.createDataFrame(rows, "g int, x double"), ["g"], "x", {"a": 0.25, "b": 0.75}, collected=collected)
    got = {r["g"]: (r["a"], r["b"]) for r in got.collect()}
    assert set(got) == {None, 1, 2, 3, 4, 5}
    for g, ab in got.items():
        x = [v for k, v in rows if k == g and v is not None]
        assert ab == pytest.approx((np.quantile(x, 0.25), np.quantile(x, 0.75)))


def test_small_groups_are_not_written_as_intervals(spark, monkeypatch):
    names, put = [], W.written
    monkeypatch.setattr(W, "written", lambda df, name: (names.append(name), put(df, name))[1])
    rows = [(i % 50, float(i)) for i in range(200)]
    assert W.group_quantiles(spark.createDataFrame(rows, "g int, x double"), ["g"], "x", {"m": 0.5}).count() == 50
    assert names == ["quantile-values", "quantile-groups"]


def test_ranking_computes_its_rows_once(spark):
    once = F.udf(lambda: float(os.urandom(1)[0]), "double").asNondeterministic()
    df = spark.range(200).select("id", (F.col("id") % 3).alias("d"), F.lit(1.0).alias("s"), (once() / 255).alias("share"))
    assert M.score_ranking(df, ["d"], "s", "share", 0.5, ["id"]).count() == 200


def test_sessions_are_dealt_to_all_tasks(spark, tmp_path):
    lines = spark.createDataFrame([(f"s{s}", n, f"{s} LAW_{n}") for s in range(40) for n in (1, 2, 3)], "session string, lineno int, line string")
    SL.write_session_files(lines, str(tmp_path / "logs"))
    files = glob.glob(f"{tmp_path}/logs/session=*/part-*")
    assert len(files) == 40 and len({os.path.basename(f)[:10] for f in files}) > 1
    assert not glob.glob(f"{tmp_path}/logs/_temporary")
    for f in files:
        s = f.split("session=s")[1].split("/")[0]
        assert open(f).read().split("\n") == [f"{s} LAW_1", f"{s} LAW_2", f"{s} LAW_3", ""]


def test_session_folders_are_listed_in_few_tasks_and_read_once(spark, tmp_path, monkeypatch):
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, names, put = spark.conf.get(key), [], SL.written
    monkeypatch.setattr(SL, "written", lambda df, name: (names.append(name), put(df, name))[1])
    with SL.few_listing_tasks(spark):
        assert int(spark.conf.get(key)) <= SL.LISTING_TASKS * spark.sparkContext.defaultParallelism
    assert spark.conf.get(key) == before
    (tmp_path / "a.txt").write_text("x\n\n y \r\nz")
    got = SL.read_session_lines(spark, str(tmp_path))
    assert sorted((r["lineno"], r["line"]) for r in got.collect()) == [(1, "x"), (3, "y"), (4, "z")]
    assert names == ["raw-lines"] and spark.conf.get(key) == before


def test_staged_chunks_have_files_by_their_rows(spark, tmp_path):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    df = spark.createDataFrame([(i, day(i % 6)) for i in range(240)], "id int, t timestamp")
    assert K.files_per_chunk(df, "t", 3, rows=1000) == 1
    assert K.files_per_chunk(df, "t", 3, rows=20) == 4
    # an empty chunk has one file only, so all have one
    assert K.files_per_chunk(df.where("t < '2024-01-03' OR t >= '2024-01-06'"), "t", 3, rows=20) == 1
    path = K.stage_stream_input(df, str(tmp_path / "in"), "t", 3, 4)
    assert len(glob.glob(f"{path}/part-*.parquet")) == 12
    seen = []

    def sink(batch, n):
        seen.append(sorted({r["t"].day for r in batch.collect()}))
    K.run_to_end(K.start_available_now(K.file_stream(spark, path, df.schema, 4), str(tmp_path / "ck"), sink=sink))
    assert seen == [[1, 2], [3, 4], [5, 6]]


def test_responses_are_written_once_and_sorted_after_the_shuffle(spark, monkeypatch):
    names, put = [], W.written
    plans = []
    for module in (M, W):
        monkeypatch.setattr(module, "written", lambda df, name: (names.append(name), plans.append(df), put(df, name))[2])
    # two students respond twice (the least order counts, NULL first), one value is missing
    rows = [("a", 1, 5.0, 2), ("a", 1, 9.0, 1), ("a", 2, 7.0, 1), ("a", 3, None, 1), ("a", 4, 99.0, 1), ("b", 1, 3.0, None), ("b", 1, 60.0, 4)]
    df = spark.createDataFrame(rows, "g string, student int, x double, at int")
    got = {r["g"]: r for r in M.valid_responses(df, ["g"], "student", "x", ["at"], 1, 50).collect()}
    assert (got["a"]["responses"], got["a"]["valid"]) == (4, 2)
    assert (got["b"]["responses"], got["b"]["valid"]) == (1, 1)
    assert names == ["responses", "quantile-groups"]
    assert "WindowGroupLimit" not in plans[0]._jdf.queryExecution().executedPlan().toString()


def test_valid_responses_shuffle_what_they_need_once(spark, tmp_path):
    """Columns ordered after the value are not read, and the verdict needs no
    shuffle after the quartiles' window."""
    from helpers import plan_text
    rng = random.Random(11)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(40), rng.randrange(3), rng.choice([1.0, 5.0, 7.0, 90.0, None, float("nan")]), i)
            for i in range(600)] + [("c", i, 0, None, i) for i in range(9)]
    spark.createDataFrame(rows, "g string, student int, at int, x double, later int").write.parquet(f"{tmp_path}/r")
    out = M.valid_responses(spark.read.parquet(f"{tmp_path}/r"), ["g"], "student", "x", ["at", "x", "later"], 1, 50)
    plan = plan_text(out, "formatted")
    assert plan.count("hashpartitioning") == 1 and "later" not in plan
    first = {}
    for g, s, at, x, _ in rows:
        key = (at, (0,) if x is None else (2,) if x != x else (1, x))
        first[g, s] = min(first.get((g, s), (key, x)), (key, x), key=lambda t: t[0])
    want = {}
    for g in ("a", "b"):
        xs = [x for (k, _), (_, x) in first.items() if k == g]
        told = sorted(x for x in xs if x is not None and x == x)
        q = [told[int(p)] * (1 - p % 1) + told[min(int(p) + 1, len(told) - 1)] * (p % 1) for p in ((len(told) - 1) * f for f in (0.25, 0.75))]
        fits = [x for x in told if 1 <= x <= 50 and q[0] - 1.5 * (q[1] - q[0]) <= x <= q[1] + 1.5 * (q[1] - q[0])]
        want[g] = (len(xs), len(fits))
    assert {r.g: (r.responses, r.valid) for r in out.collect()} == want


def test_quantiles_beside_large_and_small_groups(spark, tmp_path):
    rng = random.Random(12)
    rows = [(g, rng.choice([None, float(rng.randrange(50))])) for g, n in (("large", 300), ("small", 7), ("one", 1), (None, 5)) for _ in range(n)]
    rows = [(g, 3.0 if g == "one" else x) for g, x in rows] + [("none", None)]
    spark.createDataFrame(rows, "g string, x double").write.parquet(f"{tmp_path}/q")
    df, probs = spark.read.parquet(f"{tmp_path}/q"), {"lo": 0.25, "hi": 0.9}
    want = {r.g: (r.lo, r.hi) for r in W.group_quantiles(df, ["g"], "x", probs, stored=True).where("g IS NOT NULL").collect()}
    for collected in (50, 4096):
        got = W.beside_quantiles(df, ["g"], "x", probs, collected).collect()
        assert sorted((r.g, str(r.x)) for r in got) == sorted((g, str(x)) for g, x in rows if g in want)
        assert all((r.lo, r.hi) == want[r.g] for r in got) and set(want) == {"large", "small", "one"}


def test_lifecycle_state_is_on_disk_and_batches_do_not_grow(spark, tmp_path, monkeypatch):
    """By default Spark keeps all state in the executors' heap."""
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    rng = random.Random(3)
    orders = [(k, day(rng.randrange(700))) for k in range(1, 300)]
    lines = [(k, n, t + dt.timedelta(days=rng.randrange(90)), "F", rng.choice("RN")) for k, t in orders for n in range(rng.randrange(4))]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz, l_linestatus string, l_returnflag string").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    started = []
    start = K.start_available_now
    monkeypatch.setattr(K.chunks_by_rows, "__defaults__", (60,))
    monkeypatch.setattr(K.files_per_chunk, "__defaults__", (8,))
    monkeypatch.setattr(K, "start_available_now", lambda df, ckpt, **k: started.append(ckpt) or start(df, ckpt, **k))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        got = {r["order_id"]: r for r in S.stream_order_lifecycle(spark, str(tmp_path)).collect()}
        assert "HDFSBacked" in spark.conf.get(provider)
    finally:
        spark.conf.set(provider, before)
    offsets = [open(f).read() for f in glob.glob(f"{started[0]}/offsets/[0-9]*")]
    assert all("RocksDBStateStoreProvider" in x for x in offsets) and len(offsets) >= -(-len(orders) // 60)
    assert len(got) == len(orders)
    for k, t in orders:
        near = [x for x in lines if x[0] == k and k % 5 and x[2] <= t + dt.timedelta(days=60)]
        back = [x for x in near if x[4] == "R"]
        r = got[k]
        assert (r["delivered_lines"], r["refund_lines"]) == (len(near), len(back))
        assert (r["last_delivery_ts"], r["first_refund_ts"]) == (max([x[2] for x in near], default=None), min([x[2] for x in back], default=None))


def test_shuffle_files_go_before_the_formats_are_written_from_parquet(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {f for i in range(files.size()) if (f := files.apply(i).getName()).startswith("shuffle_")}

    before = shuffles()
    paths = io.write_formats(spark.range(1000).repartition(3, "id"), str(tmp_path), ["parquet", "json"])
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before and spark.conf.get(FREE, None) is None
    assert all(io.read_table(spark, p, f, "id long").count() == 1000 for f, p in paths.items())
