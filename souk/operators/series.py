"""Metric-series rules as table operators.

A series is ``(metric, labels..., ts, value)``. Windows are partitioned by
the series labels; after the hourly/daily aggregation a series has one row
per time bucket, so its size is bounded by the time range, not the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hour_index(ts: Column) -> Column:
    """Whole hours since the epoch (UTC)."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / 3600).cast("bigint")


def counter_series(df: DataFrame, metric: str, t: str, reset_days: int = 7) -> DataFrame:
    """Cumulative event count per metric and hour, reset to 0 every
    ``reset_days`` days. Each metric's hourly calendar is generated from its
    own first/last hour (no cross join), so empty hours are samples too."""
    hour = F.date_trunc("hour", F.col(t)).cast("timestamp_ntz")
    counts = df.groupBy(F.col(metric).alias("metric"), hour.alias("ts")).agg(F.count("*").alias("n"))
    cal = (counts.groupBy("metric").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
                 .select("metric", "lo", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("ts")))
    s = cal.join(counts, ["metric", "ts"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    epoch = F.floor(F.datediff(F.col("ts").cast("date"), F.col("lo").cast("date")) / reset_days)
    w = Window.partitionBy("metric", "_epoch").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return (s.withColumn("_epoch", epoch).withColumn("value", F.sum("n").over(w))
             .select("metric", "ts", F.col("value").cast("bigint").alias("value")))


def counter_increase(series: DataFrame, labels: Sequence[str], t: str, value: str,
                     bucket: str = "day") -> DataFrame:
    """Growth per bucket: sum of positive deltas; after a reset (value
    drops) the new value counts. The first sample of a series adds 0. No
    extrapolation."""
    w = Window.partitionBy(*labels).orderBy(t)
    prev = F.lag(value).over(w)
    inc = (F.when(prev.isNull(), F.lit(0)).when(F.col(value) >= prev, F.col(value) - prev)
            .otherwise(F.col(value)))
    return (series.withColumn("_inc", inc)
                  .groupBy(*labels, F.date_trunc(bucket, F.col(t)).cast("timestamp_ntz").alias("bucket"))
                  .agg(F.sum("_inc").cast("bigint").alias("increase")))


def counter_rate(series: DataFrame, labels: Sequence[str], t: str, value: str,
                 bucket: str = "day", seconds: int = 86400) -> DataFrame:
    """Increase per second over the bucket."""
    inc = counter_increase(series, labels, t, value, bucket)
    return inc.withColumn("rate_per_s", F.col("increase") / F.lit(float(seconds)))


def histogram_buckets(df: DataFrame, labels: Sequence[str], value: str,
                      bounds: Sequence[float]) -> DataFrame:
    """Cumulative ``le`` buckets (the last bound is +Inf) in one aggregate."""
    aggs = [F.count(F.when(F.col(value) <= b, 1)).alias(f"_b{i}") for i, b in enumerate(bounds)]
    row = df.groupBy(*labels).agg(*aggs)
    items = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("cum"))
                      for i, b in enumerate(bounds)])
    return row.select(*labels, F.explode(items).alias("b")).select(*labels, "b.le", "b.cum")


def histogram_quantile(hist: DataFrame, labels: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """Linear interpolation inside the first bucket whose cumulative count
    reaches ``q * total`` (lower edge 0 for the first bucket); a quantile in
    the +Inf bucket returns the largest finite bound."""
    w = Window.partitionBy(*labels).orderBy("le")
    h = (hist.withColumn("prev_le", F.coalesce(F.lag("le").over(w), F.lit(0.0)))
             .withColumn("prev_cum", F.coalesce(F.lag("cum").over(w), F.lit(0)))
             .withColumn("total", F.max("cum").over(Window.partitionBy(*labels))))
    hq = (h.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
           .withColumn("rank", F.col("q") * F.col("total"))
           .where((F.col("cum") >= F.col("rank")) & (F.col("total") > 0)))
    first = hq.groupBy(*labels, "q").agg(F.min_by(F.struct("le", "prev_le", "cum", "prev_cum", "rank"), "le").alias("b"))
    b = lambda c: F.col(f"b.{c}")
    val = F.when(b("le") == float("inf"), b("prev_le")).otherwise(
        b("prev_le") + (b("le") - b("prev_le")) * (b("rank") - b("prev_cum")) / (b("cum") - b("prev_cum")))
    return first.select(*labels, "q", val.alias("value"))


def error_ratio(df: DataFrame, by: Sequence[Column], bad: Column) -> DataFrame:
    """Share of bad rows and availability (1 - share) per group."""
    g = df.groupBy(*by).agg(F.count(F.when(bad, 1)).alias("errors"), F.count("*").alias("total"))
    ratio = F.when(F.col("total") > 0, F.col("errors") / F.col("total"))
    return g.withColumn("error_ratio", ratio).withColumn("availability", F.lit(1.0) - F.col("error_ratio"))


def alert_sustained(series: DataFrame, labels: Sequence[str], t: str, cond: Column,
                    hold_hours: int) -> DataFrame:
    """Alerts whose condition held in consecutive hourly samples for at
    least ``hold_hours`` (gaps-and-islands: hour index minus row number is
    constant inside an island; a missing or false hour breaks it)."""
    on = series.where(cond).withColumn("_h", hour_index(F.col(t)))
    w = Window.partitionBy(*labels).orderBy("_h")
    isl = on.withColumn("_grp", F.col("_h") - F.row_number().over(w))
    return (isl.groupBy(*labels, "_grp")
               .agg(F.min(t).alias("start"), F.max(t).alias("_last"), F.count("*").alias("hours"))
               .where(F.col("hours") >= hold_hours)
               .select(*labels, "start", (F.col("_last") + F.expr("INTERVAL 1 HOUR")).alias("end"), "hours"))


def stale_layers(df: DataFrame, layer: str, t: str, now: Column, limit_s: int = 3600) -> DataFrame:
    """Layers whose newest row is older than ``limit_s`` at evaluation time."""
    g = df.groupBy(F.col(layer).alias("layer")).agg(F.max(t).alias("last_ts"))
    lag_us = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_ts").cast("timestamp"))
    return (g.withColumn("lag_seconds", lag_us / F.lit(1e6))
             .withColumn("stale", lag_us > F.lit(limit_s * 1_000_000)))


def consumer_lag(ends: DataFrame, commits: DataFrame, by: Sequence[str], k: int = 3) -> DataFrame:
    """lag = end offset - committed offset per consumer group and topic,
    with the top-``k`` lagging topics per group marked."""
    j = ends.join(commits, list(by), "left").withColumn("committed", F.coalesce("committed", F.lit(0)))
    j = j.withColumn("lag", F.col("end_offset") - F.col("committed"))
    w = Window.partitionBy("group_id").orderBy(F.col("lag").desc(), *[F.col(c) for c in by if c != "group_id"])
    return j.withColumn("lag_rank", F.row_number().over(w).cast("bigint")).withColumn("top_k", F.col("lag_rank") <= k)
