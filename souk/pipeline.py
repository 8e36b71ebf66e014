"""Parametrised jobs: the nightly medallion run and the session-log job.

``nightly``: raw events of one day -> silver (clean, deduplicated) and
quarantine -> quality gate -> gold mart of sales by category, seller and hour.
Every layer is written by day, so a rerun for a date (backfill) replaces
exactly that day, also when the day has become empty. In strict mode a failed
gate raises before gold is touched, so the last good gold partition stays
published.

usage:
  python -m souk.pipeline nightly --raw DIR --silver DIR --gold DIR --date YYYY-MM-DD [--soft]
  python -m souk.pipeline sessions --input DIR --out DIR [--doc ACC_45616]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.scalar import payload_field
from souk.operators import quality as Q
from souk.operators.aggregates import sales_mart


def sales_measures(silver: DataFrame, amount: str = "value") -> DataFrame:
    """The mart's columns of a silver event: category (the kind of event),
    seller and quantity from the payload (a missing quantity is one piece),
    and the amount as an exact decimal."""
    return silver.select("ts", F.col("event_type").alias("category"),
                         payload_field(F.col("payload"), "$.seller", "bigint").alias("seller"),
                         F.col(amount).try_cast("decimal(12,2)").alias("amount"),
                         F.coalesce(payload_field(F.col("payload"), "$.qty", "int"), F.lit(1)).alias("qty"))


def nightly(spark: SparkSession, raw: DataFrame, silver_path: str, gold_path: str, event_date: str,
            fail_on_error: bool = True, min_completeness: float = 0.99, amount: str = "value") -> dict:
    """Run one day; returns the gate status and the quality report rows.
    ``amount`` is the raw column that holds a sale's money. The rows read and
    written are kept in ``<silver_path>_lineage`` under the run's day. A day without silver rows has nothing
    to check: its status is 'empty' and its gold is cleared."""
    counts: dict[str, int] = {}
    silver = Q.build_silver(spark, raw, silver_path, event_date, measures=[amount], counts=counts)
    Q.append_lineage(spark, f"{silver_path.rstrip('/')}_lineage", "nightly", event_date,
                     {"raw": ("input", counts["raw"]), "silver": ("output", counts["silver"]),
                      "quarantine": ("output", counts["quarantine"]), "undated": ("output", counts["undated"])})
    day = silver.where(F.col("dt") == F.lit(event_date).cast("date"))
    if day.isEmpty():
        _publish(day, amount, gold_path, event_date)
        return {"status": "empty", "report": []}
    report = Q.check_completeness(day.withColumn("k", F.get_json_object("payload", "$.k")),
                                  ["event_id", "ts", "user_id", "k"], min_completeness)
    report = report.unionByName(Q.check_uniqueness(day, ["event_id"], "silver"))
    report = Q.with_gate_status(report).persist()
    try:
        _, status = Q.dq_gate(report.drop("gate"), fail_on_error=fail_on_error)
        rows = [r.asDict() for r in report.collect()]        # one row per check: small
    finally:
        report.unpersist()
    if status == "passed":
        _publish(day, amount, gold_path, event_date)
    return {"status": status, "report": rows}


def _publish(day: DataFrame, amount: str, gold_path: str, event_date: str) -> None:
    gold = sales_mart(sales_measures(day, amount), F.col("ts"), "hour", ["category", "seller"], "amount", "qty")
    gold.write.mode("overwrite").parquet(f"{gold_path}/dt={event_date}")


def main(argv: list[str] | None = None) -> None:
    from souk.operators.sessions import session_job
    from souk.session import get_spark

    ap = argparse.ArgumentParser(prog="souk.pipeline")
    sub = ap.add_subparsers(dest="job", required=True)
    n = sub.add_parser("nightly")
    n.add_argument("--raw", required=True)
    n.add_argument("--silver", required=True)
    n.add_argument("--gold", required=True)
    n.add_argument("--date", required=True)
    n.add_argument("--soft", action="store_true", help="report a failed gate instead of raising")
    s = sub.add_parser("sessions")
    s.add_argument("--input", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--doc", default="ACC_45616")
    args = ap.parse_args(argv)
    spark = get_spark(app=f"souk-{args.job}")
    if args.job == "nightly":
        out = nightly(spark, spark.read.parquet(args.raw), args.silver, args.gold, args.date,
                      fail_on_error=not args.soft)
        print(out["status"])
    else:
        print(session_job(spark, args.input, args.out, args.doc))


if __name__ == "__main__":
    main()
