"""Medallion and data-quality queries. Raw input = events with
cut payloads (every 37th) plus re-delivered copies (every 11th), FIXTURES 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.scalar import payload_field
from souk.operators import quality as Q
from souk.operators import windows as W
from souk.plans.sources import BROKEN_PROPS, broken_events
from souk.plans.registry import query
from souk.session import scratch_path
from souk.sources import io

RAW_SQL = f"""
WITH b AS (SELECT event_id, ts, user_id, event_type, value, {BROKEN_PROPS} AS props FROM events),
raw AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE event_id % 11 = 0)
"""
CANON_SQL = RAW_SQL + """,
canon AS (SELECT CAST(event_id AS VARCHAR) AS event_id, lower(trim(event_type)) AS event_type, ts,
                 TRY_CAST(user_id AS BIGINT) AS user_id,
                 CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id, props AS payload
          FROM raw),
clean AS (SELECT * FROM canon WHERE event_id IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL
                                AND json_valid(payload))
"""


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    b = broken_events(spark, sf)
    return b.unionByName(b.where(F.pmod("event_id", F.lit(11)) == 0))


@query("canonical_events", CANON_SQL + "SELECT * FROM canon")
def canonical_events(spark: SparkSession, sf: str) -> DataFrame:
    return Q.canonical_events(raw_events(spark, sf))


@query("silver_clean", CANON_SQL + """
SELECT 'silver' AS layer, NULL AS reason, COUNT(*) AS n_rows FROM clean
UNION ALL
SELECT 'quarantine', 'malformed_payload', COUNT(*) FROM canon WHERE NOT json_valid(payload)
""")
def silver_clean(spark: SparkSession, sf: str) -> DataFrame:
    clean, bad = Q.silver_clean(Q.canonical_events(raw_events(spark, sf)))
    a = clean.agg(F.count("*").alias("n_rows")).select(F.lit("silver").alias("layer"),
                                                       F.lit(None).cast("string").alias("reason"), "n_rows")
    b = bad.groupBy("reason").agg(F.count("*").alias("n_rows")).select(F.lit("quarantine").alias("layer"),
                                                                       "reason", "n_rows")
    return a.unionByName(b)


DEDUP_OUT = "SELECT event_id, ts, user_id, event_type FROM"


@query("dedup_event_id", CANON_SQL + f"""
{DEDUP_OUT} (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts, payload) AS rn FROM clean) WHERE rn = 1
""")
def dedup_event_id(spark: SparkSession, sf: str) -> DataFrame:
    clean, _ = Q.silver_clean(Q.canonical_events(raw_events(spark, sf)))
    return Q.dedup_events(clean, ["event_id"], ["ts", "payload"]).select("event_id", "ts", "user_id", "event_type")


@query("dedup_composite", CANON_SQL + f"""
{DEDUP_OUT} (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, ts, event_type ORDER BY event_id, payload) AS rn
             FROM clean) WHERE rn = 1
""")
def dedup_composite(spark: SparkSession, sf: str) -> DataFrame:
    clean, _ = Q.silver_clean(Q.canonical_events(raw_events(spark, sf)))
    return (Q.dedup_events(clean, ["user_id", "ts", "event_type"], ["event_id", "payload"])
              .select("event_id", "ts", "user_id", "event_type"))


@query("dedup_colocated", CANON_SQL + f"""
{DEDUP_OUT} (SELECT DISTINCT * FROM canon)
""")
def dedup_colocated(spark: SparkSession, sf: str) -> DataFrame:
    canon = Q.canonical_events(raw_events(spark, sf))
    return Q.dedup_colocated(canon, "event_id").select("event_id", "ts", "user_id", "event_type")


SILVER_DAYS = ["2024-01-05", "2024-01-06"]


@query("silver_day", CANON_SQL + """
SELECT CAST(ts AS DATE) AS dt, COUNT(*) AS n_rows, COUNT(DISTINCT user_id) AS users FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ts, payload) AS rn FROM clean
  WHERE CAST(ts AS DATE) IN (DATE '2024-01-05', DATE '2024-01-06')) WHERE rn = 1
GROUP BY 1
""")
def silver_day(spark: SparkSession, sf: str) -> DataFrame:
    """Build two days, then rerun the first (backfill): the rerun replaces
    only its own partition, so the result equals one clean run."""
    raw = raw_events(spark, sf)
    path = scratch_path(spark, "silver")
    for d in SILVER_DAYS + SILVER_DAYS[:1]:
        Q.build_silver(spark, raw, path, d)
    s = spark.read.parquet(path)
    return s.groupBy("dt").agg(F.count("*").alias("n_rows"), F.count_distinct("user_id").alias("users"))


# Bad input fixture: times that are missing or no times, cut payloads, missing
# users, and every 11th row delivered twice.
BAD_RAW_SQL = f"""
b AS (SELECT event_id, event_type, value, {BROKEN_PROPS} AS props,
             CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN 'garbage'
                  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts,
             CASE WHEN event_id % 47 = 0 THEN NULL ELSE user_id END AS user_id FROM events),
raw AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE event_id % 11 = 0)
"""


def bad_raw_events(spark: SparkSession, sf: str) -> DataFrame:
    b = broken_events(spark, sf)
    at = lambda n: F.pmod("event_id", F.lit(n)) == 0
    b = (b.withColumn("ts", F.when(at(41), F.lit(None)).when(at(43), "garbage")
                      .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")))
          .withColumn("user_id", F.when(~at(47), F.col("user_id"))))
    return b.unionByName(b.where(at(11)))


@query("silver_and_quarantine", f"""
WITH {BAD_RAW_SQL},
t AS (SELECT *, TRY_CAST(ts AS TIMESTAMP) AS event_ts FROM raw),
r AS (SELECT *, CAST(event_ts AS DATE) AS day,
             CASE WHEN event_id IS NULL THEN 'missing_event_id' WHEN event_ts IS NULL THEN 'missing_ts'
                  WHEN user_id IS NULL THEN 'missing_user' WHEN NOT json_valid(props) THEN 'malformed_payload' END AS reason FROM t)
SELECT 'silver' AS layer, CAST(day AS VARCHAR) AS dt, NULL AS reason, COUNT(DISTINCT event_id) AS n_rows, CAST(SUM(v) AS DECIMAL(22,2)) AS total
FROM (SELECT day, event_id, MIN(CAST(value AS DECIMAL(12,2))) AS v FROM r
      WHERE reason IS NULL AND day IN (DATE '2024-01-05', DATE '2024-01-06') GROUP BY ALL) GROUP BY ALL
UNION ALL
SELECT 'quarantine', CAST(day AS VARCHAR), reason, COUNT(*), CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DECIMAL(22,2)) FROM r
WHERE reason IS NOT NULL AND (day IS NULL OR day IN (DATE '2024-01-05', DATE '2024-01-06')) GROUP BY ALL
""")
def silver_and_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Two daily inputs of bad events built, the first one twice: what is not
    in silver is in quarantine with its reason. Rows without a readable time
    come with either day's input (even event ids with the first) and are kept
    for both."""
    path = scratch_path(spark, "silver-bad")
    raw = bad_raw_events(spark, sf)
    day = F.col("ts").try_cast("timestamp_ntz").cast("date")
    for d in SILVER_DAYS + SILVER_DAYS[:1]:
        undated = day.isNull() & (F.pmod("event_id", F.lit(len(SILVER_DAYS))) == SILVER_DAYS.index(d))
        Q.build_silver(spark, raw.where((day == F.lit(d).cast("date")) | undated), path, d, measures=["value"])
    money = F.sum(F.col("value").cast("decimal(12,2)")).cast("decimal(22,2)").alias("total")
    s = spark.read.parquet(path).groupBy("dt").agg(F.count("*").alias("n_rows"), money)
    q = spark.read.parquet(f"{path}_quarantine").groupBy("dt", "reason").agg(F.count("*").alias("n_rows"), money)
    return (s.select(F.lit("silver").alias("layer"), F.col("dt").cast("string").alias("dt"), F.lit(None).cast("string").alias("reason"), "n_rows", "total")
             .unionByName(q.select(F.lit("quarantine").alias("layer"), F.col("dt").cast("string").alias("dt"), "reason", "n_rows", "total")))


def _completeness_sql(cols):
    parts = []
    for c in cols:
        parts.append(f"""SELECT 'completeness' AS check_name, '{c}' AS item,
  CAST(COUNT(*) FILTER (WHERE {c} IS NOT NULL AND trim(CAST({c} AS VARCHAR)) <> '') AS DOUBLE) / COUNT(*) AS value,
  CAST(0.99 AS DOUBLE) AS threshold,
  CAST(COUNT(*) FILTER (WHERE {c} IS NOT NULL AND trim(CAST({c} AS VARCHAR)) <> '') AS DOUBLE) / COUNT(*) >= 0.99 AS passed
FROM cc""")
    return "\nUNION ALL\n".join(parts)


COMPLETENESS_COLS = ["event_id", "ts", "user_id", "payload_k"]
COMPLETENESS_SQL = CANON_SQL + """,
cc AS (SELECT *, CASE WHEN json_valid(payload) THEN TRY_CAST(json_extract(payload, '$.k') AS INTEGER) END AS payload_k
       FROM canon)
""" + _completeness_sql(COMPLETENESS_COLS)


def completeness(spark, sf):
    canon = Q.canonical_events(raw_events(spark, sf)).withColumn(
        "payload_k", payload_field(F.col("payload"), "$.k", "int"))
    return Q.check_completeness(canon, COMPLETENESS_COLS)


query("dq_completeness", COMPLETENESS_SQL)(completeness)

INTEGRITY = [("lineitem.l_partkey", "lineitem", "l_partkey", "part", "p_partkey"),
             ("lineitem.l_suppkey", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
             ("orders.o_custkey", "orders", "o_custkey", "customer", "c_custkey"),
             ("events.user_id", "events", "user_id", "customer", "c_custkey")]
INTEGRITY_SQL = "\nUNION ALL\n".join(
    f"SELECT 'integrity' AS check_name, '{n}' AS item, CAST(COUNT(*) AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS threshold,"
    f" COUNT(*) = 0 AS passed FROM {t} WHERE {fk} NOT IN (SELECT {pk} FROM {d})"
    for n, t, fk, d, pk in INTEGRITY)


def integrity(spark, sf):
    frames = [Q.check_integrity(io.load(spark, sf, t), io.load(spark, sf, d), fk, pk, n)
              for n, t, fk, d, pk in INTEGRITY]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


query("dq_integrity", INTEGRITY_SQL)(integrity)

UNIQUENESS = [("lineitem", ["l_orderkey", "l_linenumber"]), ("orders", ["o_orderkey"])]
UNIQUENESS_SQL = "\nUNION ALL\n".join(
    f"""SELECT 'uniqueness' AS check_name, '{t}.' || m AS item, v AS value, CAST(0 AS DOUBLE) AS threshold, v = 0 AS passed
FROM (SELECT CAST(COUNT(*) FILTER (WHERE c > 1) AS DOUBLE) AS duplicate_keys, CAST(SUM(c - 1) AS DOUBLE) AS surplus_rows
      FROM (SELECT COUNT(*) AS c FROM {t} GROUP BY {', '.join(k)}))
UNPIVOT (v FOR m IN (duplicate_keys, surplus_rows))""" for t, k in UNIQUENESS)


def uniqueness(spark, sf):
    a = Q.check_uniqueness(io.load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")
    return a.unionByName(Q.check_uniqueness(io.load(spark, sf, "orders"), ["o_orderkey"], "orders"))


query("dq_uniqueness", UNIQUENESS_SQL)(uniqueness)

# Validity rules of line items (range / enumeration).
VALIDITY_RULES_SQL = {
    "qty_range": "l_quantity BETWEEN 1 AND 50",
    "discount_range": "l_discount BETWEEN 0 AND 0.1",
    "tax_range": "l_tax BETWEEN 0 AND 0.06",
    "flag_enum": "l_returnflag IN ('A', 'N', 'R')",
    "recent_ship": "l_shipdate >= TIMESTAMP '1997-01-01 00:00:00'",
}
VALIDITY_SQL = "\nUNION ALL\n".join(
    f"""SELECT 'validity' AS check_name, '{n}:' || l_linestatus AS item,
  CAST(COUNT(*) FILTER (WHERE {r}) AS DOUBLE) / COUNT(*) AS value, CAST(0.8 AS DOUBLE) AS threshold,
  CAST(COUNT(*) FILTER (WHERE {r}) AS DOUBLE) / COUNT(*) >= 0.8 AS passed
FROM lineitem GROUP BY l_linestatus""" for n, r in VALIDITY_RULES_SQL.items())


def validity(spark, sf):
    rules = {n: F.coalesce(F.expr(r), F.lit(False)) for n, r in VALIDITY_RULES_SQL.items()}
    return Q.check_validity(io.load(spark, sf, "lineitem"), rules, "l_linestatus", 0.8)


query("dq_validity", VALIDITY_SQL)(validity)


@query("dq_corridor", """
SELECT day, n,
       ROUND(AVG(n) OVER w, 6) AS mean_prev, ROUND(STDDEV_SAMP(n) OVER w, 6) AS sd_prev,
       CASE WHEN STDDEV_SAMP(n) OVER w IS NULL THEN true
            ELSE abs(n - AVG(n) OVER w) <= 3 * STDDEV_SAMP(n) OVER w END AS in_corridor
FROM (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1)
WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
""")
def dq_corridor(spark: SparkSession, sf: str) -> DataFrame:
    """Daily event count against mean +- 3 sd of the 7 preceding days. The
    window runs over the daily aggregate (one row per day), not raw rows."""
    daily = io.load(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    out = Q.check_corridor(daily, "day", "n", 7, 3.0)
    return out.select("day", "n", F.round("mean_prev", 6).alias("mean_prev"), F.round("sd_prev", 6).alias("sd_prev"),
                      "in_corridor")


@query("dq_freshness", """
WITH c AS (SELECT date_trunc('hour', ts) AS period, COUNT(*) AS n_rows FROM events GROUP BY 1),
cal AS (SELECT unnest(generate_series((SELECT MIN(period) FROM c), (SELECT MAX(period) FROM c), INTERVAL 1 HOUR)) AS period)
SELECT cal.period, COALESCE(c.n_rows, 0) AS n_rows FROM cal LEFT JOIN c USING (period)
""")
def dq_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Every expected hour between first and last event with its row count;
    0 marks a missing window."""
    return Q.calendar_gaps(io.load(spark, sf, "events"), "ts", "hour").withColumnRenamed("rows", "n_rows")


# Fixed value: delivery lag SLA (days) of the freshness lag check.
LAG_SLA_DAYS = 120


@query("freshness_lag_p95", f"""
SELECT order_month, lag_p95_days, lag_max_days, lag_p95_days <= {LAG_SLA_DAYS} AS sla_met FROM (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
         ROUND(quantile_cont(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)), 0.95), 6) AS lag_p95_days,
         CAST(MAX(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS BIGINT) AS lag_max_days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
""")
def freshness_lag_p95(spark: SparkSession, sf: str) -> DataFrame:
    """p95 of ship lag per order month against the SLA (exact percentile,
    rounded to 6 decimals: interpolation differs in the last bits between
    engines; the SLA flag is taken from the rounded value)."""
    li, o = io.load(spark, sf, "lineitem"), io.load(spark, sf, "orders")
    lag = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    d = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
           .select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("order_month"), lag.alias("lag")))
    # a month of any size is counted, not gathered: see group_quantiles
    p95 = W.group_quantiles(d, ["order_month"], "lag", {"p95": 0.95})
    g = (d.groupBy("order_month").agg(F.max("lag").cast("bigint").alias("lag_max_days")).join(p95, "order_month")
          .select("order_month", F.round("p95", 6).alias("lag_p95_days"), "lag_max_days"))
    return g.withColumn("sla_met", F.col("lag_p95_days") <= LAG_SLA_DAYS)


@query("dq_report", f"""
WITH r AS (
  SELECT * FROM ({COMPLETENESS_SQL})
  UNION ALL SELECT * FROM ({INTEGRITY_SQL})
  UNION ALL SELECT * FROM ({UNIQUENESS_SQL})
  UNION ALL SELECT * FROM ({VALIDITY_SQL}))
SELECT *, CASE WHEN bool_and(passed) OVER () THEN 'passed' ELSE 'failed' END AS gate FROM r
""")
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """All checks in one report plus the gate status (soft mode: reported,
    not raised)."""
    report = (completeness(spark, sf).unionByName(integrity(spark, sf))
              .unionByName(uniqueness(spark, sf)).unionByName(validity(spark, sf)))
    return Q.with_gate_status(report)


@query("lineage_rows", CANON_SQL + """
SELECT 'build_silver' AS job, 'v1' AS version, 'input' AS role, 'raw_events' AS dataset, COUNT(*) AS rows FROM raw
UNION ALL SELECT 'build_silver', 'v1', 'output', 'silver', COUNT(*) FROM clean
UNION ALL SELECT 'build_silver', 'v1', 'output', 'quarantine', COUNT(*) FROM canon WHERE NOT json_valid(payload)
""")
def lineage_rows(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_events(spark, sf)
    clean, bad = Q.silver_clean(Q.canonical_events(raw))
    return Q.lineage_rows("build_silver", {"raw_events": raw}, {"silver": clean, "quarantine": bad}, "v1")
