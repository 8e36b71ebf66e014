"""Nightly medallion run: idempotent backfill, gate blocks gold in strict mode."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from souk.operators.quality import QualityGateFailed
from souk.pipeline import nightly
from souk.plans.quality import raw_events
from souk.session import scratch_path
from souk.sources import io


def test_nightly_backfill_is_idempotent(spark):
    raw = io.load(spark, SF001, "events")
    root = scratch_path(spark, "nightly")
    for d in ("2024-01-03", "2024-01-04", "2024-01-03"):
        out = nightly(spark, raw, f"{root}/silver", f"{root}/gold", d)
        assert out["status"] == "passed"
    silver = spark.read.parquet(f"{root}/silver")
    expect = raw.where(F.col("ts").cast("date").isin("2024-01-03", "2024-01-04")).count()
    assert silver.count() == expect
    gold = spark.read.parquet(f"{root}/gold")
    assert gold.agg(F.sum("lines")).first()[0] == expect


def test_gate_blocks_gold(spark):
    raw = raw_events(spark, SF001)              # cut payloads -> quarantined, completeness stays high
    bad = raw.withColumn("props", F.lit('{"x": 1}'))  # no k at all: completeness of k fails
    root = scratch_path(spark, "nightly-bad")
    with pytest.raises(QualityGateFailed):
        nightly(spark, bad, f"{root}/silver", f"{root}/gold", "2024-01-03")
    out = nightly(spark, bad, f"{root}/silver", f"{root}/gold", "2024-01-03", fail_on_error=False)
    assert out["status"] == "failed"
    assert any(r["item"] == "k" and not r["passed"] for r in out["report"])
    import os
    assert not os.path.exists(f"{root}/gold")


def test_cli_entry_points(spark, tmp_path, capsys):
    from souk.pipeline import main
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "s1").write_bytes("QS 01.07.2020_13:42:01 {налог}\n155 ACC_45616\n"
                              "DOC_OPEN 01.07.2020_13:43:21 155 ACC_45616\n".encode("cp1251"))
    main(["sessions", "--input", str(logs), "--out", str(tmp_path / "out")])
    m2 = spark.read.option("header", "true").csv(str(tmp_path / "out" / "metric2")).collect()
    assert [tuple(r) for r in m2] == [("2020-07-01", "ACC_45616", "1")]
    main(["nightly", "--raw", f"{SF001}/events.parquet", "--silver", str(tmp_path / "silver"),
          "--gold", str(tmp_path / "gold"), "--date", "2024-01-03"])
    assert capsys.readouterr().out.strip().endswith("passed")
