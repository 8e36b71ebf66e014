"""Aggregation queries: one-pass, skew, nested, marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions import scalar as S
from souk.operators import aggregates as A
from souk.operators import bitmaps, funnels
from souk.plans.registry import query
from souk.plans.tables import (DEC, NESTED_ORDERS_SQL, SALES_SQL, SKEWED_ORDERS_SQL, nested_orders, sales,
                               skewed_orders, with_views)
from souk.session import written
from souk.sources import io


MULTI_AGG_SQL = with_views("""
SELECT user_id, CAST(SUM(amount) AS DECIMAL(22,2)) AS total,
       MIN(amount) AS min_value, MAX(amount) AS max_value, COUNT(qty) AS n_counted,
       CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_value
FROM sales GROUP BY user_id
""", sales=SALES_SQL)


def _fix_multi(df: DataFrame) -> DataFrame:
    return df.withColumn("total", F.col("total").cast(DEC))


query("multi_agg", MULTI_AGG_SQL)(
    lambda spark, sf: _fix_multi(A.multi_agg(sales(spark, sf), ["user_id"], "amount", "qty")))
query("multi_agg_split", MULTI_AGG_SQL)(
    lambda spark, sf: _fix_multi(A.multi_agg_split(sales(spark, sf), ["user_id"], "amount", "qty")))


@query("multi_agg_sql", MULTI_AGG_SQL)
def multi_agg_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The same aggregate as SQL text over a temp view (same optimised plan)."""
    sales(spark, sf).createOrReplaceTempView("souk_sales")
    return spark.sql("""
        SELECT user_id, CAST(SUM(amount) AS DECIMAL(22,2)) AS total,
               MIN(amount) AS min_value, MAX(amount) AS max_value, COUNT(qty) AS n_counted,
               try_divide(CAST(SUM(amount) AS DOUBLE), COUNT(amount)) AS avg_value
        FROM souk_sales GROUP BY user_id""")


# Versioned fact: orders x versions 1..3; versions 2 and 3 exist only where
# (o_orderkey * 7 + v) % 5 < 2 (FIXTURES 4); amount grows 10 % per version.
VERSIONED_SQL = """
SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS dt, o_orderpriority AS category,
       o_custkey AS seller_id, v AS version,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) * (1 + 0.1 * (v - 1)) AS DECIMAL(14,2)) AS amount
FROM orders, (VALUES (1), (2), (3)) t(v)
WHERE v = 1 OR (o_orderkey * 7 + v) % 5 < 2
"""


def versioned_fact(spark: SparkSession, sf: str) -> DataFrame:
    o = io.load(spark, sf, "orders")
    v = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("version")
    rows = o.select("*", v).where((F.col("version") == 1)
                                  | (F.pmod(F.col("o_orderkey") * 7 + F.col("version"), F.lit(5)) < 2))
    amt = F.col("o_totalprice").cast("decimal(12,2)") * (F.lit(1) + F.lit(0.1).cast("decimal(2,1)") * (F.col("version") - 1))
    return rows.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("dt"),
                       F.col("o_orderpriority").alias("category"), F.col("o_custkey").alias("seller_id"),
                       F.col("version").cast("int").alias("version"), amt.cast("decimal(14,2)").alias("amount"))


@query("amount_per_category", with_views("""
SELECT category, CAST(SUM(amount) AS DECIMAL(22,2)) AS amount, COUNT(*) AS n_ids
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM vf) WHERE rn = 1
GROUP BY category
""", vf=VERSIONED_SQL))
def amount_per_category(spark: SparkSession, sf: str) -> DataFrame:
    """sum(amount) per category over the latest version of every id."""
    latest = S.dedup_by_key(versioned_fact(spark, sf), ["id"], [F.col("version").desc()])
    return latest.groupBy("category").agg(F.sum("amount").cast(DEC).alias("amount"),
                                          F.count("*").alias("n_ids"))


@query("daily_revenue_by_category", with_views("""
SELECT category_name, CAST(SUM(amount) AS DECIMAL(22,2)) AS revenue, COUNT(*) AS n_lines
FROM sales WHERE dt = DATE '1996-11-01' GROUP BY category_name ORDER BY revenue DESC
""", sales=SALES_SQL))
def daily_revenue_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return (sales(spark, sf).where(F.col("dt") == F.lit("1996-11-01").cast("date"))
              .groupBy("category_name").agg(F.sum("amount").cast(DEC).alias("revenue"),
                                            F.count("*").alias("n_lines"))
              .orderBy(F.col("revenue").desc()))


@query("daily_kpis", with_views("""
SELECT order_dt, COUNT(*) AS orders, COUNT(DISTINCT user_id) AS users,
       CAST(SUM(amount) AS DECIMAL(22,2)) AS revenue, CAST(SUM(qty) AS BIGINT) AS qty,
       CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_amount,
       CAST(SUM(qty) AS DOUBLE) / COUNT(qty) AS avg_qty
FROM sales GROUP BY order_dt ORDER BY order_dt
""", sales=SALES_SQL))
def daily_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return (A.daily_kpis(sales(spark, sf), "order_dt", "user_id", "amount", "qty")
              .withColumn("revenue", F.col("revenue").cast(DEC))
              .withColumn("qty", F.col("qty").cast("bigint")).orderBy("order_dt"))


SKEW_AGG_SQL = with_views("""
SELECT seller_id, CAST(SUM(amount) AS DECIMAL(22,2)) AS total, COUNT(amount) AS n,
       MIN(amount) AS min_value, MAX(amount) AS max_value
FROM so GROUP BY seller_id
""", so=SKEWED_ORDERS_SQL)


@query("salted_agg", SKEW_AGG_SQL)
def salted_agg(spark: SparkSession, sf: str) -> DataFrame:
    out = A.salted_agg(skewed_orders(spark, sf), ["seller_id"], ["order_id", "line_no", "category_id"],
                       "amount", salts=16)
    return out.withColumn("total", F.col("total").cast(DEC))


@query("skew_agg_naive", SKEW_AGG_SQL)
def skew_agg_naive(spark: SparkSession, sf: str) -> DataFrame:
    out = A.plain_agg(skewed_orders(spark, sf), ["seller_id"], "amount")
    return out.withColumn("total", F.col("total").cast(DEC))


@query("nested_total", with_views("""
SELECT user_id, CAST(SUM(it.unit_cents * it.qty) AS BIGINT) AS total_cents
FROM (SELECT user_id, unnest(items) AS it FROM nested) GROUP BY user_id
""", nested=NESTED_ORDERS_SQL))
def nested_total(spark: SparkSession, sf: str) -> DataFrame:
    """explode semantics: users whose orders have no lines disappear."""
    return A.nested_total(nested_orders(spark, sf), ["user_id"], "items", "unit_cents", "qty",
                          out="total_cents")


@query("nested_total_hof", with_views("""
SELECT user_id, CAST(COALESCE(SUM(t), 0) AS BIGINT) AS total_cents
FROM (SELECT user_id, (SELECT COALESCE(SUM(x.unit_cents * x.qty), 0) FROM (SELECT unnest(COALESCE(items, [])) AS x)) AS t
      FROM nested) GROUP BY user_id
""", nested=NESTED_ORDERS_SQL))
def nested_total_hof(spark: SparkSession, sf: str) -> DataFrame:
    """aggregate() fold: every user kept, empty arrays give 0."""
    return A.nested_total_hof(nested_orders(spark, sf), ["user_id"], "items", "unit_cents", "qty",
                              out="total_cents")


@query("sales_mart_hourly", """
SELECT date_trunc('hour', ts) AS period, event_type, COUNT(*) AS lines,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS revenue,
       COUNT(DISTINCT user_id) AS users
FROM events GROUP BY ALL
""")
def sales_mart_hourly(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events").withColumn("amount", F.col("value").cast("decimal(12,2)"))
    return (ev.withColumn("period", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
              .groupBy("period", "event_type")
              .agg(F.count("*").alias("lines"), F.sum("amount").cast(DEC).alias("revenue"),
                   F.count_distinct("user_id").alias("users")))


@query("sales_mart_by_seller_hour", """
SELECT CAST(date_trunc('hour', l_shipdate) AS TIMESTAMP) AS period, p_type AS category_name, l_suppkey AS seller_id, COUNT(*) AS lines,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS revenue, CAST(SUM(CAST(l_quantity AS INT)) AS BIGINT) AS qty
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
""")
def sales_mart_by_seller_hour(spark: SparkSession, sf: str) -> DataFrame:
    """The sales mart by category, seller and hour."""
    li = io.load(spark, sf, "lineitem").withColumn("amount", F.col("l_extendedprice").cast("decimal(12,2)"))
    p = io.load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category_name"))
    d = li.join(p, "l_partkey").withColumn("qty", F.col("l_quantity").cast("int")).withColumnRenamed("l_suppkey", "seller_id")
    out = A.sales_mart(d, F.col("l_shipdate"), "hour", ["category_name", "seller_id"], "amount", "qty")
    return out.withColumn("period", F.col("period").cast("timestamp_ntz")).withColumn("revenue", F.col("revenue").cast(DEC))


# The funnel steps (event kinds of the events table).
FUNNEL_STEPS = ["view", "click", "purchase"]


FUNNEL_SQL = """
WITH s1 AS (
  SELECT user_id, arg_min(struct_pack(ts := ts, id := event_id), struct_pack(ts := ts, id := event_id)) AS at
  FROM events WHERE event_type = 'view' GROUP BY user_id),
s2 AS (
  SELECT e.user_id, arg_min(struct_pack(ts := e.ts, id := e.event_id), struct_pack(ts := e.ts, id := e.event_id)) AS at
  FROM events e JOIN s1 ON e.user_id = s1.user_id
  WHERE e.event_type = 'click' AND (e.ts > s1.at.ts OR (e.ts = s1.at.ts AND e.event_id > s1.at.id))
  GROUP BY e.user_id),
s3 AS (
  SELECT e.user_id
  FROM events e JOIN s2 ON e.user_id = s2.user_id
  WHERE e.event_type = 'purchase' AND (e.ts > s2.at.ts OR (e.ts = s2.at.ts AND e.event_id > s2.at.id))
  GROUP BY e.user_id),
c AS (
SELECT 1 AS step, 'view' AS name, (SELECT COUNT(*) FROM s1) AS users
UNION ALL SELECT 2, 'click', (SELECT COUNT(*) FROM s2)
UNION ALL SELECT 3, 'purchase', (SELECT COUNT(*) FROM s3))
SELECT step, name, users,
       CASE WHEN LAG(users) OVER w > 0 THEN CAST(users AS DOUBLE) / LAG(users) OVER w END AS conv_from_prev,
       CASE WHEN FIRST_VALUE(users) OVER w > 0 THEN CAST(users AS DOUBLE) / FIRST_VALUE(users) OVER w END AS conv_from_first
FROM c WINDOW w AS (ORDER BY step)
"""


@query("purchase_funnel", FUNNEL_SQL)
def purchase_funnel(spark: SparkSession, sf: str) -> DataFrame:
    out = A.purchase_funnel(io.load(spark, sf, "events"), "user_id", "ts", "event_type", "event_id",
                            FUNNEL_STEPS)
    return out.withColumn("step", F.col("step").cast("int"))


@query("funnel_one_pass", FUNNEL_SQL)
def funnel_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    times = funnels.funnel_times(io.load(spark, sf, "events"), "user_id", "ts", "event_type", "event_id", FUNNEL_STEPS)
    return funnels.funnel_counts(times, FUNNEL_STEPS)


@query("ltv_by_cohort", with_views("""
SELECT cohort_month, period, cohort_users, revenue,
       CAST(SUM(revenue) OVER (PARTITION BY cohort_month ORDER BY period) AS DECIMAL(22,2)) AS cum_revenue,
       CAST(SUM(revenue) OVER (PARTITION BY cohort_month ORDER BY period) AS DOUBLE) / cohort_users AS ltv_per_user
FROM (
  SELECT c.cohort_month, CAST(date_diff('month', c.cohort_month, date_trunc('month', s.order_dt)) AS INTEGER) AS period,
         CAST(SUM(s.amount) AS DECIMAL(22,2)) AS revenue, ANY_VALUE(c.cohort_users) AS cohort_users
  FROM sales s JOIN (
      SELECT user_id, cohort_month, COUNT(*) OVER (PARTITION BY cohort_month) AS cohort_users
      FROM (SELECT user_id, CAST(date_trunc('month', MIN(order_dt)) AS DATE) AS cohort_month FROM sales GROUP BY user_id)
  ) c ON s.user_id = c.user_id
  GROUP BY 1, 2)
""", sales=SALES_SQL))
def ltv_by_cohort(spark: SparkSession, sf: str) -> DataFrame:
    from souk.operators.marts import ltv_by_cohort as ltv
    return ltv(sales(spark, sf), "user_id", "order_dt", "amount")


RETENTION_SQL = """
WITH act AS (SELECT DISTINCT o_custkey AS user_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders),
coh AS (SELECT user_id, MIN(m) AS cohort_month FROM act GROUP BY user_id),
size AS (SELECT cohort_month, COUNT(*) AS cohort_size FROM coh GROUP BY cohort_month)
SELECT coh.cohort_month, CAST(date_diff('month', coh.cohort_month, act.m) AS INTEGER) AS period,
       COUNT(*) AS active_users, ANY_VALUE(size.cohort_size) AS cohort_size,
       CAST(COUNT(*) AS DOUBLE) / ANY_VALUE(size.cohort_size) AS retention
FROM act JOIN coh USING (user_id) JOIN size USING (cohort_month)
GROUP BY 1, 2
"""


@query("cohort_retention", RETENTION_SQL)
def cohort_retention(spark: SparkSession, sf: str) -> DataFrame:
    from souk.operators.marts import cohort_retention as ret
    o = io.load(spark, sf, "orders")
    return ret(o, "o_custkey", "o_orderdate")


def _stored_days(spark: SparkSession, sf: str) -> DataFrame:
    """Each day's customers as bitmaps, written once."""
    o = io.load(spark, sf, "orders")
    return written(bitmaps.user_bitmaps(o, [F.col("o_orderdate").cast("date").alias("day")], "o_custkey"), "user-days")


@query("distinct_users_rollup", """
SELECT grain, CAST(date_trunc(grain, day) AS DATE) AS period, COUNT(DISTINCT o_custkey) AS users
FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders), (SELECT unnest(['day', 'week', 'month', 'year']) AS grain)
GROUP BY 1, 2
""")
def distinct_users_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct customers by day, week, month and year from the stored days."""
    level = _stored_days(spark, sf)
    out = bitmaps.distinct_users(level, ["day"]).select(F.lit("day").alias("grain"), F.col("day").alias("period"), "users")
    # a year's bitmaps come from its months'; weeks lie across months
    for grain in ("week", "month", "year"):
        got = bitmaps.roll_up(level, [F.trunc(F.col("day"), grain).alias("day")])
        if grain == "month":
            level = got = written(got, "user-months")
        out = out.unionByName(bitmaps.distinct_users(got, ["day"]).select(F.lit(grain).alias("grain"), F.col("day").alias("period"), "users"))
    return out


@query("retention_bitmaps", RETENTION_SQL)
def retention_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    months = bitmaps.roll_up(_stored_days(spark, sf), [F.trunc(F.col("day"), "month").alias("month")])
    return bitmaps.retention_from_bitmaps(written(months, "user-months"), "month")


@query("seller_scorecard", """
SELECT l_suppkey AS seller_id, s_nationkey AS nationkey,
       COUNT(DISTINCT l_orderkey) AS orders, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS revenue,
       CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / COUNT(*) AS return_share,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*) AS mean_price,
       CAST(RANK() OVER (PARTITION BY s_nationkey ORDER BY SUM(CAST(l_extendedprice AS DECIMAL(12,2))) DESC) AS BIGINT) AS rank_in_nation
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
GROUP BY l_suppkey, s_nationkey
""")
def seller_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    from souk.operators.marts import seller_scorecard as sc
    li = io.load(spark, sf, "lineitem")
    s = io.load(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"),
                                             F.col("s_nationkey").alias("nationkey"))
    return sc(li.join(s, "l_suppkey"), "l_suppkey", "nationkey", "l_orderkey", "l_extendedprice",
              F.col("l_returnflag") == "R", "rank_in_nation")


@query("metrics_agg", """
SELECT event_type || ':' || strftime(ts, '%Y-%m-%d') AS metric_key, COUNT(*) AS n,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total,
       MAX(value) AS max_value
FROM events GROUP BY 1
""")
def metrics_agg(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events")
    key = F.concat(F.col("event_type"), F.lit(":"), F.date_format("ts", "yyyy-MM-dd"))
    return (ev.groupBy(key.alias("metric_key"))
              .agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(12,2)")).cast(DEC).alias("total"),
                   F.max("value").alias("max_value")))
