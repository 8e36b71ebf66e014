"""Metric-series queries on series derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.operators import series as N
from souk.plans.registry import query
from souk.sources import io

COUNTER_SQL = """
counts AS (SELECT event_type AS metric, date_trunc('hour', ts) AS ts, COUNT(*) AS n FROM events GROUP BY 1, 2),
rng AS (SELECT metric, MIN(ts) AS lo, MAX(ts) AS hi FROM counts GROUP BY metric),
cal AS (SELECT metric, lo, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM rng),
s AS (SELECT cal.metric, cal.ts, cal.lo, COALESCE(counts.n, 0) AS n FROM cal LEFT JOIN counts USING (metric, ts)),
series AS (
  SELECT metric, ts, CAST(SUM(n) OVER (PARTITION BY metric, floor(date_diff('day', CAST(lo AS DATE), CAST(ts AS DATE)) / 7)
                                       ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value
  FROM s)"""

INCREASE_SQL = COUNTER_SQL + """,
inc AS (
  SELECT metric, CAST(date_trunc('day', ts) AS TIMESTAMP) AS bucket, CAST(SUM(d) AS BIGINT) AS increase FROM (
    SELECT *, CASE WHEN LAG(value) OVER w IS NULL THEN 0 WHEN value >= LAG(value) OVER w THEN value - LAG(value) OVER w
                   ELSE value END AS d
    FROM series WINDOW w AS (PARTITION BY metric ORDER BY ts)) GROUP BY 1, 2)"""


def counter(spark: SparkSession, sf: str) -> DataFrame:
    return N.counter_series(io.load(spark, sf, "events"), "event_type", "ts", 7)


@query("counter_series", f"WITH {COUNTER_SQL}\nSELECT * FROM series")
def counter_series(spark: SparkSession, sf: str) -> DataFrame:
    return counter(spark, sf)


@query("counter_increase", f"WITH {INCREASE_SQL}\nSELECT * FROM inc")
def counter_increase(spark: SparkSession, sf: str) -> DataFrame:
    return N.counter_increase(counter(spark, sf), ["metric"], "ts", "value", "day")


@query("counter_rate", f"WITH {INCREASE_SQL}\nSELECT *, CAST(increase AS DOUBLE) / CAST(86400 AS DOUBLE) AS rate_per_s FROM inc")
def counter_rate(spark: SparkSession, sf: str) -> DataFrame:
    return N.counter_rate(counter(spark, sf), ["metric"], "ts", "value", "day", 86400)


# Histogram bucket bounds (le) and the quantiles asked for.
BUCKETS = [10.0, 25.0, 50.0, 100.0, 250.0, float("inf")]
QUANTILES = [0.5, 0.9, 0.99]


def _dbl(x: float) -> str:
    return "CAST('inf' AS DOUBLE)" if x == float("inf") else f"CAST({x} AS DOUBLE)"


HIST_SQL = f"""
hist AS (SELECT e.event_type, b.le, COUNT(*) FILTER (WHERE e.value <= b.le) AS cum
         FROM events e, (VALUES {', '.join(f'({_dbl(b)})' for b in BUCKETS)}) b(le) GROUP BY 1, 2)"""


@query("histogram_quantile", f"""WITH {HIST_SQL},
h AS (SELECT *, COALESCE(LAG(le) OVER w, CAST(0 AS DOUBLE)) AS prev_le, COALESCE(LAG(cum) OVER w, 0) AS prev_cum,
             MAX(cum) OVER (PARTITION BY event_type) AS total
      FROM hist WINDOW w AS (PARTITION BY event_type ORDER BY le)),
hq AS (SELECT h.*, q.q, q.q * h.total AS rank FROM h, (VALUES {', '.join(f'({_dbl(q)})' for q in QUANTILES)}) q(q)),
f AS (SELECT event_type, q, arg_min(struct_pack(le := le, prev_le := prev_le, cum := cum, prev_cum := prev_cum, rank := rank), le) AS b
      FROM hq WHERE cum >= rank AND total > 0 GROUP BY 1, 2)
SELECT event_type, q, CASE WHEN b.le = CAST('inf' AS DOUBLE) THEN b.prev_le
                           ELSE b.prev_le + (b.le - b.prev_le) * (b.rank - b.prev_cum) / (b.cum - b.prev_cum) END AS value
FROM f""")
def histogram_quantile(spark: SparkSession, sf: str) -> DataFrame:
    hist = N.histogram_buckets(io.load(spark, sf, "events"), ["event_type"], "value", BUCKETS)
    return N.histogram_quantile(hist, ["event_type"], QUANTILES)


@query("error_ratio", """
SELECT CAST(ts AS DATE) AS day, COUNT(*) FILTER (WHERE event_type = 'error') AS errors, COUNT(*) AS total,
       CAST(COUNT(*) FILTER (WHERE event_type = 'error') AS DOUBLE) / COUNT(*) AS error_ratio,
       1.0 - CAST(COUNT(*) FILTER (WHERE event_type = 'error') AS DOUBLE) / COUNT(*) AS availability
FROM events GROUP BY 1
""")
def error_ratio(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events")
    return N.error_ratio(ev, [F.col("ts").cast("date").alias("day")], F.col("event_type") == "error")


# Alert condition (events of one kind per hour) and hold time.
ALERT_MIN_EVENTS, ALERT_HOLD_HOURS = 4, 2


@query("alert_sustained", f"""
WITH c AS (SELECT event_type AS metric, date_trunc('hour', ts) AS ts, COUNT(*) AS n FROM events GROUP BY 1, 2),
o AS (SELECT *, date_diff('hour', TIMESTAMP '1970-01-01 00:00:00', ts) AS h FROM c WHERE n >= {ALERT_MIN_EVENTS}),
i AS (SELECT *, h - ROW_NUMBER() OVER (PARTITION BY metric ORDER BY h) AS grp FROM o)
SELECT metric, MIN(ts) AS start, MAX(ts) + INTERVAL 1 HOUR AS "end", COUNT(*) AS hours
FROM i GROUP BY metric, grp HAVING COUNT(*) >= {ALERT_HOLD_HOURS}
""")
def alert_sustained(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events")
    hourly = (ev.groupBy(F.col("event_type").alias("metric"),
                         F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
                .agg(F.count("*").alias("n")))
    return N.alert_sustained(hourly, ["metric"], "ts", F.col("n") >= ALERT_MIN_EVENTS, ALERT_HOLD_HOURS)


# Fixed value: a layer is stale when its newest row is older than this (s).
STALE_AFTER_S = 3600


@query("stale_layers", f"""
SELECT event_type AS layer, MAX(ts) AS last_ts,
       CAST(epoch_us((SELECT MAX(ts) FROM events)) - epoch_us(MAX(ts)) AS DOUBLE) / 1e6 AS lag_seconds,
       epoch_us((SELECT MAX(ts) FROM events)) - epoch_us(MAX(ts)) > {STALE_AFTER_S * 1_000_000} AS stale
FROM events GROUP BY 1
""")
def stale_layers(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events")
    now = ev.agg(F.max("ts")).scalar()
    return N.stale_layers(ev, "event_type", "ts", now, STALE_AFTER_S)


# Consumer groups and how many days each is behind.
CONSUMER_GROUPS = [("analytics", 5), ("billing", 2)]
TOPIC_PARTS = 4


@query("consumer_lag", f"""
WITH ends AS (SELECT event_type AS topic, user_id % {TOPIC_PARTS} AS part, COUNT(*) AS end_offset FROM events GROUP BY 1, 2),
commits AS (
  SELECT g.group_id, event_type AS topic, user_id % {TOPIC_PARTS} AS part,
         COUNT(*) FILTER (WHERE ts < (SELECT MAX(ts) FROM events) - g.behind * INTERVAL 1 DAY) AS committed
  FROM events, (VALUES {', '.join(f"('{g}', {d})" for g, d in CONSUMER_GROUPS)}) g(group_id, behind)
  GROUP BY 1, 2, 3),
j AS (SELECT c.group_id, e.topic, e.part, e.end_offset, c.committed, e.end_offset - c.committed AS lag
      FROM ends e JOIN commits c USING (topic, part))
SELECT *, ROW_NUMBER() OVER (PARTITION BY group_id ORDER BY lag DESC, topic, part) AS lag_rank,
       ROW_NUMBER() OVER (PARTITION BY group_id ORDER BY lag DESC, topic, part) <= 3 AS top_k
FROM j
""")
def consumer_lag(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events").withColumn("part", F.pmod("user_id", F.lit(TOPIC_PARTS)))
    now = ev.agg(F.max("ts")).scalar()
    ends = ev.groupBy(F.col("event_type").alias("topic"), "part").agg(F.count("*").alias("end_offset"))
    groups = F.array(*[F.struct(F.lit(g).alias("group_id"), F.lit(d).alias("behind")) for g, d in CONSUMER_GROUPS])
    ex = ev.select("event_type", "part", "ts", F.explode(groups).alias("g"))
    cutoff = now - F.make_dt_interval(days=F.col("g.behind"))
    commits = (ex.groupBy(F.col("g.group_id").alias("group_id"), F.col("event_type").alias("topic"), "part")
                 .agg(F.count(F.when(F.col("ts") < cutoff, 1)).alias("committed")))
    return N.consumer_lag(ends, commits, ["topic", "part"], 3).select(
        "group_id", "topic", "part", "end_offset", "committed", "lag", "lag_rank", "top_k")
