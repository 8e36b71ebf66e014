"""Nothing is lost without a trace: quarantine, lineage, late rows, session warnings."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helpers import plan_text
from souk.operators import quality as Q
from souk.operators.score import normalise_components
from souk.pipeline import nightly
from souk.plans import QUERIES
from souk.session import scratch_path
from souk.streaming import streams as K

RAW = "event_id string, event_type string, ts string, user_id string, props string, value double"


def day(spark, d, ids, undated):
    rows = [(i, "view", f"{d} 10:00:00", "5", '{"k": 1}', 2.0) for i in ids] + [(i, "view", t, "5", '{"k": 1}', 1.0) for i, t in undated]
    return spark.createDataFrame(rows, RAW)


def test_undated_rows_of_every_run_are_kept(spark):
    root = scratch_path(spark, "two-days")
    first, second = day(spark, "2024-01-01", ["a", "b"], [("bad1", None)]), day(spark, "2024-01-02", ["c"], [("bad2", "garbage"), ("bad3", "")])
    for df, d in ((first, "2024-01-01"), (second, "2024-01-02"), (first, "2024-01-01")):
        Q.build_silver(spark, df, f"{root}/silver", d)
    kept = {r.event_id for r in spark.read.parquet(f"{root}/silver").collect()}
    gone = {r.event_id for r in spark.read.parquet(f"{root}/silver_quarantine").collect()}
    assert kept == {"a", "b", "c"} and gone == {"bad1", "bad2", "bad3"}


def test_a_day_that_became_empty_clears_its_gold_and_every_run_writes_lineage(spark):
    root = scratch_path(spark, "empty-day")
    full = day(spark, "2024-01-01", ["a", "b", "b"], [("bad1", None)])
    run = lambda df, d: nightly(spark, df, f"{root}/silver", f"{root}/gold", d)["status"]
    assert run(full, "2024-01-01") == "passed"
    assert run(day(spark, "2024-01-02", ["c"], []), "2024-01-02") == "passed"
    lineage = lambda: {(r["run"].isoformat(), r.dataset): r.rows for r in spark.read.parquet(f"{root}/silver_lineage").collect()}
    assert {k: v for k, v in lineage().items() if k[0] == "2024-01-01"} == {
        ("2024-01-01", "raw"): 4, ("2024-01-01", "silver"): 2, ("2024-01-01", "quarantine"): 0, ("2024-01-01", "undated"): 1}
    assert spark.read.parquet(f"{root}/gold").where("dt = '2024-01-01'").count() > 0
    assert run(full.limit(0), "2024-01-01") == "empty"
    gold = spark.read.parquet(f"{root}/gold")
    assert gold.where("dt = '2024-01-01'").count() == 0 and gold.where("dt = '2024-01-02'").count() > 0
    assert lineage()["2024-01-01", "raw"] == 0


def test_dedup_counts_what_it_drops(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    schema = "id int, ts timestamp"
    inp = scratch_path(spark, "in-counted")
    for rows in ([(1, at(0)), (1, at(0)), (2, at(50_000))], [(3, at(50_001))], [(4, at(1)), (5, at(60_000)), (5, at(60_000))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inp)
    root = scratch_path(spark, "counted")
    stream = K.file_stream(spark, inp, spark.read.parquet(inp).schema, 1)
    ledger = K.stream_dedup_counted(stream, ["id"], "ts", "1 hour", root, f"{root}/_ckpt", state_partitions=2)
    rows = [(r.rows_in, r.late, r.duplicates, r.rows_out) for r in ledger.where("rows_in > 0").orderBy("batch_id").collect()]
    assert rows == [(3, 0, 1, 2), (1, 0, 0, 1), (3, 1, 1, 1)]


def test_a_short_ledger_is_an_error(spark):
    class Query:
        recentProgress = [{"batchId": 1, "numInputRows": 3, "stateOperators": []}]  # noqa: RUF012
    with pytest.raises(RuntimeError, match="progress"):
        K.stream_ledger(Query())


def test_session_job_writes_diagnostics_and_all_warnings(spark, tmp_path):
    from souk.operators.sessions import session_job
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "s1").write_bytes("?? что-то\nQS 02.03.2021_10:00:00 {кофе}\n77 LAW_1 ACC_2\nDOC_OPEN  77 LAW_1\n".encode("cp1251"))
    out = session_job(spark, str(logs), str(tmp_path / "out"), single_file=True)
    [line] = [json.loads(x) for p in (tmp_path / "out" / "diagnostics").glob("*.json") for x in p.read_text().splitlines()]
    assert line["sessions"] == 1 and line["warnings"] == spark.read.json(out["warnings"]).count() > 0
    assert len(list((tmp_path / "out" / "metric2").glob("*.csv"))) == 1


def test_peer_statistics_are_one_aggregate_however_many_columns(spark):
    df = spark.range(50).select((F.col("id") % 3).alias("g"), *[(F.col("id") * i).cast("double").alias(f"c{i}") for i in range(1, 5)])
    plans = [plan_text(normalise_components(df, {f"z{i}": f"c{i}" for i in range(1, n + 1)}, ["g"])).count("Range (") for n in (1, 4)]
    assert plans[0] == plans[1]


@pytest.mark.parametrize("name", ["score_ranking", "score_explain", "score_normalised"])
def test_score_plans_stay_small(spark, name):
    text = plan_text(QUERIES[name](spark, SF001), "simple")
    assert text.count("Exchange hashpartitioning") <= 8, text
