"""Medallion layers and data-quality checks.

Every check returns a small DataFrame with one row per checked item, so
checks can be unioned into one report; :func:`dq_gate` turns a report into
a pass/fail status (and raises in strict mode).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk.functions.scalar import dedup_by_key

class QualityGateFailed(RuntimeError):
    pass


# ------------------------------------------------------------ medallion

def canonical_events(raw: DataFrame, measures: Sequence[str] = ()) -> DataFrame:
    """Six canonical fields + payload (+ ``measures``, raw columns kept as
    they are). Types by ``try_cast`` (bad values become NULL, never an
    error); ``ts`` is interpreted as UTC."""
    ts = F.col("ts").try_cast("timestamp_ntz")
    return raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.lower(F.trim(F.col("event_type"))).alias("event_type"),
        ts.alias("ts"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format(ts, "yyyyMMdd")).alias("session_id"),
        F.col("props").alias("payload"), *[F.col(m) for m in measures])


def silver_clean(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine): rows lacking id / time / user or with a
    malformed payload go to quarantine with a reason; nothing is dropped."""
    reason = (F.when(F.col("event_id").isNull(), "missing_event_id")
               .when(F.col("ts").isNull(), "missing_ts")
               .when(F.col("user_id").isNull(), "missing_user")
               .when(F.try_parse_json("payload").isNull(), "malformed_payload"))
    tagged = df.withColumn("reason", reason)
    return tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(F.col("reason").isNotNull())


def dedup_events(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Deterministic survivor per key (smallest ``order`` values)."""
    return dedup_by_key(df, keys, [F.col(c) for c in order])


def dedup_colocated(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """Exact dedup by ``key`` with one Exchange on the key.

    The aggregation's map-side partial step is the bounded-memory
    "pre-dedup inside partitions"; the final step after the shuffle makes
    it exact across partitions. A hot key crosses the shuffle as at most one
    row per map partition. The survivor is the smallest row (deterministic),
    and the output is hash-partitioned by ``key``, so later work keyed on it
    reuses the partitioning.
    """
    others = [c for c in df.columns if c != key]
    row = F.struct(*[F.col(c) for c in others])
    g = df.groupBy(key) if n is None else df.repartition(n, key).groupBy(key)
    return g.agg(F.min(row).alias("_r")).select(key, *[F.col("_r")[c].alias(c) for c in others])


#: the folder of rows that belong to no day, as Spark names a NULL partition
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def build_silver(spark: SparkSession, raw: DataFrame, silver_path: str, event_date: str,
                 quarantine_path: str | None = None, measures: Sequence[str] = (),
                 counts: dict[str, int] | None = None) -> DataFrame:
    """raw -> silver for one day: ``silver_path/dt=<day>``, one row per event.

    Rows are made canonical first (no bad value can stop the job) and then
    dealt out: clean rows of the day are deduplicated into silver, the day's
    other rows go to ``quarantine_path/dt=<day>/run=<day>`` with a reason, and
    rows whose time is missing or unreadable, which belong to no day, to the
    quarantine's own folder for those, below the day of the run that met
    them: the undated rows of one day's input never replace another's.
    ``quarantine_path`` defaults to ``<silver_path>_quarantine``. Each folder
    is overwritten as a whole, so a rerun (backfill) replaces exactly what
    that day's run wrote, also when it has become empty. ``counts`` is filled
    with the rows read (``raw``) and written (``silver``, ``quarantine``,
    ``undated``): counts without columns, which Parquet answers from its footers.
    """
    quarantine_path = quarantine_path or f"{silver_path.rstrip('/')}_quarantine"
    spark = raw.sparkSession
    events = canonical_events(raw, measures).withColumn("dt", F.col("ts").cast("date"))
    clean, bad = silver_clean(events)
    today = F.col("dt") == F.lit(event_date).cast("date")
    silver = dedup_events(clean.where(today), ["event_id"], ["ts", "payload"])
    parts = {"silver": (silver, f"{silver_path}/dt={event_date}"),
             "quarantine": (bad.where(today), f"{quarantine_path}/dt={event_date}/run={event_date}"),
             "undated": (bad.where(F.col("dt").isNull()), f"{quarantine_path}/dt={NO_DAY}/run={event_date}")}
    for df, path in parts.values():
        df.drop("dt").write.mode("overwrite").parquet(path)
    if counts is not None:
        counts["raw"] = raw.count()
        counts.update({n: spark.read.schema(df.drop("dt").schema).parquet(path).count() for n, (df, path) in parts.items()})
    # the partition column is given, so that a table whose days are all empty reads too
    return spark.read.schema(silver.schema).parquet(silver_path)


# --------------------------------------------------------------- checks

def _report(df: DataFrame, name: str, item: Column, value: Column, threshold: float,
            passed: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), item.cast("string").alias("item"),
                     value.cast("double").alias("value"), F.lit(threshold).cast("double").alias("threshold"),
                     passed.alias("passed"))


def check_completeness(df: DataFrame, cols: Sequence[str], min_share: float = 0.99) -> DataFrame:
    """Share of non-NULL, non-empty values per column, one aggregate pass."""
    aggs = [F.count("*").alias("_n")]
    for c in cols:
        ok = F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
        aggs.append(F.count(F.when(ok, 1)).alias(c))
    row = df.agg(*aggs)
    stacked = row.select("_n", F.explode(F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).alias("ok"))
                                                   for c in cols])).alias("s"))
    share = F.when(F.col("_n") > 0, F.col("s.ok") / F.col("_n"))
    return _report(stacked, "completeness", F.col("s.item"), share, min_share, share >= min_share)


def check_integrity(df: DataFrame, dim: DataFrame, fk: str, pk: str, name: str) -> DataFrame:
    """Rows whose foreign key has no partner (left anti join); passes at 0."""
    bad = df.join(dim, df[fk] == dim[pk], "left_anti").agg(F.count("*").alias("v"))
    return _report(bad, "integrity", F.lit(name), F.col("v"), 0.0, F.col("v") == 0)


def check_uniqueness(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Duplicate keys and surplus rows (rows beyond one per key)."""
    per = df.groupBy(*keys).agg(F.count("*").alias("c"))
    s = per.agg(F.count(F.when(F.col("c") > 1, 1)).alias("dup_keys"),
                F.sum(F.col("c") - 1).alias("surplus"))
    # both rows of the report come from the one aggregate
    both = F.array(F.struct(F.lit(f"{name}.duplicate_keys").alias("item"), F.col("dup_keys").alias("v")),
                   F.struct(F.lit(f"{name}.surplus_rows").alias("item"), F.col("surplus").alias("v")))
    s = s.select(F.explode(both).alias("x"))
    return _report(s, "uniqueness", F.col("x.item"), F.col("x.v"), 0.0, F.col("x.v") == 0)


def check_validity(df: DataFrame, rules: dict[str, Column], group: str | None = None,
                   min_share: float = 0.8) -> DataFrame:
    """Share of rows satisfying each rule (NULL counts as invalid), per
    group when given; a group below ``min_share`` fails."""
    by = [group] if group else []
    aggs = [F.count("*").alias("_n")] + [F.count(F.when(r, 1)).alias(n) for n, r in rules.items()]
    row = df.groupBy(*by).agg(*aggs)
    stacked = row.select(*by, "_n", F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("ok"))
                                                        for n in rules])).alias("s"))
    item = F.concat_ws(":", F.col("s.rule"), *(F.col(group).cast("string") for group in by))
    share = F.when(F.col("_n") > 0, F.col("s.ok") / F.col("_n"))
    return _report(stacked, "validity", item, share, min_share, share >= min_share)


def check_corridor(daily: DataFrame, day: str, metric: str, lookback: int = 7, k: float = 3.0) -> DataFrame:
    """Is each day's metric inside mean +- k * stddev of the ``lookback``
    preceding days? Window over the (small) daily series."""
    w = Window.orderBy(day).rowsBetween(-lookback, -1)
    m, sd = F.avg(metric).over(w), F.stddev_samp(metric).over(w)
    out = daily.select(day, metric, m.alias("mean_prev"), sd.alias("sd_prev"))
    inside = F.when(F.col("sd_prev").isNull(), True).otherwise(
        F.abs(F.col(metric) - F.col("mean_prev")) <= F.lit(k) * F.col("sd_prev"))
    return out.withColumn("in_corridor", inside)


def calendar_gaps(df: DataFrame, t: str, unit: str = "day") -> DataFrame:
    """Expected periods between the first and last event with their row
    counts (0 = a missing window). The calendar is generated from the
    min/max only, so its size is the length of the time range."""
    trunc = F.date_trunc(unit, F.col(t)).cast("timestamp_ntz")
    counts = df.groupBy(trunc.alias("period")).agg(F.count("*").alias("rows"))
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    cal = (df.agg(F.min(trunc).alias("lo"), F.max(trunc).alias("hi"))
             .select(F.explode(F.sequence("lo", "hi", step)).alias("period")))
    return cal.join(counts, "period", "left").select("period", F.coalesce("rows", F.lit(0)).alias("rows"))


def dq_gate(report: DataFrame, fail_on_error: bool = True) -> tuple[DataFrame, str]:
    """('passed' | 'failed') from a report; strict mode raises on failure.

    The status is one aggregate over the (small) report."""
    failed = report.where(~F.coalesce(F.col("passed"), F.lit(False))).limit(1).count() > 0
    status = "failed" if failed else "passed"
    if failed and fail_on_error:
        raise QualityGateFailed("data quality gate failed")
    return report, status


def with_gate_status(report: DataFrame) -> DataFrame:
    """The report with the gate outcome on every row ('passed' when all
    checks passed). A window over the report itself - one row per check,
    small by construction - so no extra job is needed."""
    ok = F.min(F.coalesce(F.col("passed"), F.lit(False)).cast("int")).over(Window.partitionBy())
    return report.withColumn("gate", F.when(ok == 1, "passed").otherwise("failed"))


def append_lineage(spark: SparkSession, path: str, job: str, run: str, datasets: dict[str, tuple[str, int]]) -> None:
    """Write ``{dataset: (role, rows)}`` of one run of a job as its lineage
    rows; a rerun replaces them, so the folder is the log of all runs."""
    rows = [(d, role, n) for d, (role, n) in datasets.items()]   # one row per dataset: small
    spark.createDataFrame(rows, "dataset string, role string, rows bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/job={job}/run={run}")


def lineage_rows(job: str, inputs: dict[str, DataFrame], outputs: dict[str, DataFrame],
                 version: str) -> DataFrame:
    """One row per (job run, dataset): role, name and row count. The counts
    are scalar subqueries evaluated by Spark jobs, not driver loops."""
    frames = []
    for role, items in (("input", inputs), ("output", outputs)):
        for name, df in items.items():
            frames.append(df.agg(F.count("*").alias("rows")).select(
                F.lit(job).alias("job"), F.lit(version).alias("version"), F.lit(role).alias("role"),
                F.lit(name).alias("dataset"), "rows"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
