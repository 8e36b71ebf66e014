"""Quality gate, late data and independent stream consumers."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from souk.operators import quality as Q
from souk.session import scratch_path
from souk.sources import io
from souk.streaming import streams as K


def test_gate_raises_in_strict_mode(spark):
    rep = spark.createDataFrame([("c", "i", 1.0, 0.0, False)], "check_name string, item string, "
                                "value double, threshold double, passed boolean")
    with pytest.raises(Q.QualityGateFailed):
        Q.dq_gate(rep, fail_on_error=True)
    assert Q.dq_gate(rep, fail_on_error=False)[1] == "failed"
    ok = rep.withColumn("passed", F.lit(True))
    assert Q.dq_gate(ok)[1] == "passed"


def _events_with_late_rows(spark, path):
    """events split into ordered day files; rows with event_id % 50 = 0 are
    moved two files later (late data), the last ones into trailing files."""
    ev = io.load(spark, SF001, "events").withColumn("day", F.col("ts").cast("date"))
    days = sorted(r[0] for r in ev.select("day").distinct().collect())
    late = F.pmod("event_id", F.lit(50)) == 0
    for i in range(len(days) + 2):
        parts = []
        if i < len(days):
            parts.append(ev.where((F.col("day") == days[i]) & ~late))
        if i >= 2:
            parts.append(ev.where(late & (F.col("day") == days[i - 2])))
        batch = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        batch.drop("day").coalesce(1).write.mode("append").parquet(path)
    return ev.drop("day"), ev.where(late).count()


def test_late_rows_are_quarantined(spark):
    path = scratch_path(spark, "late-in")
    ev, n_late = _events_with_late_rows(spark, path)
    stream = K.file_stream(spark, path, ev.schema, 1)
    root = scratch_path(spark, "late-out")
    K.stream_ingest_late_policy(stream, "ts", 3600, f"{root}/out", f"{root}/hwm", f"{root}/_ckpt")
    out = spark.read.parquet(f"{root}/out")
    bronze, late = out.where("status = 'on_time'"), out.where("status = 'late'")
    assert late.count() == n_late
    assert late.where(F.pmod("event_id", F.lit(50)) != 0).count() == 0
    assert bronze.count() + late.count() == ev.count()


def test_heartbeat_closes_append_windows(spark):
    ev = io.load(spark, SF001, "events")
    path = K.stage_stream_input(ev, scratch_path(spark, "hb-in"), "ts", 4)
    last = ev.agg(F.max("ts")).first()[0]
    K.close_stream_input(spark, path, ev.schema, "ts", "user_id", -1, str(last))
    m = K.stream_metrics(K.file_stream(spark, path, ev.schema, 1), "ts", [], "1 day")
    root = scratch_path(spark, "hb-out")
    K.run_to_end(K.start_available_now(m, f"{root}/_ckpt", path=f"{root}/d"))
    out = spark.read.parquet(f"{root}/d").where(F.col("window_start") <= F.lit(last))
    assert out.agg(F.sum("n")).first()[0] == ev.count()
    assert out.count() == ev.select(F.col("ts").cast("date")).distinct().count()


def test_independent_consumers(spark):
    ev = io.load(spark, SF001, "events")
    path = K.stage_stream_input(ev, scratch_path(spark, "shared-in"), "ts", 3)
    outs = []
    for name in ("a", "b"):
        root = scratch_path(spark, f"consumer-{name}")
        s = K.file_stream(spark, path, ev.schema, 1).select("event_id")
        K.run_to_end(K.start_available_now(s, f"{root}/_ckpt", path=f"{root}/d"))
        outs.append(spark.read.parquet(f"{root}/d").count())
    assert outs == [ev.count(), ev.count()]


def test_topic_routing_is_deterministic(spark):
    ev = io.load(spark, SF001, "events")
    from souk.plans.streams import TOPIC_DEFAULT, TOPIC_RULES
    r = K.route_topics(ev, TOPIC_RULES, "event_type", TOPIC_DEFAULT)
    assert r.where(F.col("key").isNull() | F.col("topic").isNull()).count() == 0
    assert r.where("topic = 'orders' AND key <> event_id").count() == 0


def test_versioned_sink_compaction(spark):
    ev = io.load(spark, SF001, "events")
    path = K.stage_stream_input(ev, scratch_path(spark, "cmp-in"), "ts", 5)
    m = K.stream_metrics(K.file_stream(spark, path, ev.schema, 1), "ts", ["event_type"], "1 day")
    root = scratch_path(spark, "cmp-out")
    K.run_to_end(K.start_available_now(m, f"{root}/_ckpt", sink=K.versioned_batch_sink(f"{root}/d"),
                                       mode="update"))
    keys = ["window_start", "event_type"]
    before = sorted(tuple(r) for r in K.read_latest(spark, f"{root}/d", keys).collect())
    K.compact_versioned_sink(spark, f"{root}/d", keys, 2)
    K.compact_versioned_sink(spark, f"{root}/d", keys, 3)
    after = sorted(tuple(r) for r in K.read_latest(spark, f"{root}/d", keys).collect())
    assert after == before
    assert sum(r[3] for r in after) == ev.count()


def test_canonical_events_quarantine_bad_raw_values(spark):
    raw = spark.createDataFrame([("1", "2024-01-01 10:00:00", "7", "view", '{"k": 1}'),
                                 ("2", "not a time", "8", "view", '{"k": 2}'),
                                 ("3", "2024-01-01 11:00:00", "x9", "click", '{"k": 3}'),
                                 ("4", "2024-01-01 12:00:00", "9", "click", '{"k"')],
                                "event_id string, ts string, user_id string, event_type string, props string")
    clean, bad = Q.silver_clean(Q.canonical_events(raw))
    assert [r.event_id for r in clean.collect()] == ["1"]
    assert sorted((r.event_id, r.reason) for r in bad.collect()) == [
        ("2", "missing_ts"), ("3", "missing_user"), ("4", "malformed_payload")]
