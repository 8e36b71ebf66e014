"""Window, top-k and set-operation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions import scalar as S
from souk.operators import windows as W
from souk.plans.registry import query
from souk.plans.scalar import LINE_ORDER, LINE_ORDER_SQL
from souk.plans.tables import DEC, SALES_SQL, sales, with_views
from souk.sources import io


def sales_order():
    return [F.col("amount").desc(), F.col("order_id"), F.col("line_no"), F.col("seller_id"),
            F.col("qty"), F.col("dt"), F.col("category_name"), F.col("brand")]
SALES_ORDER_SQL = "amount DESC, order_id, line_no, seller_id, qty, dt, category_name, brand"


@query("topn_per_user", with_views(f"""
SELECT user_id, order_id, line_no, amount, rn FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {SALES_ORDER_SQL}) AS rn FROM sales)
WHERE rn <= 3
""", sales=SALES_SQL))
def topn_per_user(spark: SparkSession, sf: str) -> DataFrame:
    return (W.topn_per_group(sales(spark, sf), ["user_id"], sales_order(), 3)
              .select("user_id", "order_id", "line_no", "amount", "rn"))


MULTI_WINDOW_SQL = """
SELECT event_id, user_id, value,
       ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id) AS DECIMAL(22,2)) AS group_total,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id) AS DOUBLE)
         / COUNT(value) OVER (PARTITION BY user_id) AS group_avg
FROM events
"""


@query("multi_window", MULTI_WINDOW_SQL)
def multi_window(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events").select("event_id", "user_id", "value",
                                            F.col("value").cast("decimal(12,2)").alias("v"))
    out = W.multi_window(ev, ["user_id"], "v", [F.col("value").desc(), F.col("event_id")])
    return out.withColumn("group_total", F.col("group_total").cast(DEC)).drop("v")


@query("multi_window_skew_safe", MULTI_WINDOW_SQL)
def multi_window_skew_safe(spark: SparkSession, sf: str) -> DataFrame:
    """Same result as ``multi_window``; users are ranked over value ranges."""
    ev = io.load(spark, sf, "events").select("event_id", "user_id", "value",
                                            F.col("value").cast("decimal(12,2)").alias("v"))
    out = W.multi_window_skew_safe(ev, ["user_id"], "v", ["event_id"])
    return out.select("event_id", "user_id", "value", "rn", F.col("group_total").cast(DEC).alias("group_total"),
                      "group_avg")


@query("multi_window_sql", MULTI_WINDOW_SQL)
def multi_window_sql(spark: SparkSession, sf: str) -> DataFrame:
    io.load(spark, sf, "events").createOrReplaceTempView("souk_events")
    return spark.sql("""
        SELECT event_id, user_id, value,
               CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS BIGINT) AS rn,
               CAST(SUM(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id) AS DECIMAL(22,2)) AS group_total,
               try_divide(CAST(SUM(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id) AS DOUBLE),
                          COUNT(value) OVER (PARTITION BY user_id)) AS group_avg
        FROM souk_events""")


@query("topn_sellers_per_category", with_views("""
SELECT category_name, seller_id, total, rn FROM (
  SELECT category_name, seller_id, CAST(SUM(amount) AS DECIMAL(22,2)) AS total,
         ROW_NUMBER() OVER (PARTITION BY category_name ORDER BY SUM(amount) DESC, seller_id) AS rn
  FROM sales GROUP BY category_name, seller_id)
WHERE rn <= 5
""", sales=SALES_SQL))
def topn_sellers_per_category(spark: SparkSession, sf: str) -> DataFrame:
    out = W.topn_groups(sales(spark, sf), ["category_name"], ["seller_id"], "amount", 5)
    return out.withColumn("total", F.col("total").cast(DEC))


SESSIONIZE_SQL = """
SELECT event_id, user_id, ts,
       CAST(SUM(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no
FROM (SELECT *, CASE WHEN LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                       OR ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 30 MINUTE
                     THEN 1 ELSE 0 END AS new FROM events)
"""


@query("sessionize", SESSIONIZE_SQL)
def sessionize(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events")
    return (W.sessionize(ev, "user_id", "ts", "event_id", 1800)
              .select("event_id", "user_id", "ts", F.col("session_no").cast("bigint")))


BURST_SQL = SESSIONIZE_SQL.replace("FROM events", "FROM burst")


@query("sessionize_burst", with_views(BURST_SQL.replace("30 MINUTE", "2 SECOND"), burst="""
SELECT event_id, 1 AS user_id, TIMESTAMP '2024-01-01' + (ts - date_trunc('day', ts)) AS ts FROM events
"""))
def sessionize_burst(spark: SparkSession, sf: str) -> DataFrame:
    """All events as those of one user within one day: the ranges of equal
    row count that the scan works on do not depend on users or days."""
    ev = io.load(spark, sf, "events")
    since = F.col("ts") - F.date_trunc("day", "ts").cast("timestamp_ntz")
    ev = ev.select("event_id", F.lit(1).alias("user_id"), (F.lit("2024-01-01").cast("timestamp_ntz") + since).alias("ts"))
    return W.sessionize(ev, "user_id", "ts", "event_id", 2).select("event_id", "user_id", "ts", F.col("session_no").cast("bigint"))


@query("session_window_agg", f"""
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end, COUNT(*) AS events
FROM ({SESSIONIZE_SQL}) GROUP BY user_id, session_no
""")
def session_window_agg(spark: SparkSession, sf: str) -> DataFrame:
    """Built-in session_window: same sessions as the lag + running-sum form."""
    ev = io.load(spark, sf, "events")
    g = ev.groupBy("user_id", F.session_window("ts", "30 minutes").alias("s")).agg(F.count("*").alias("events"))
    return g.select("user_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("s.end").cast("timestamp_ntz").alias("session_end"), "events")


@query("topk_sellers", with_views("""
SELECT seller_id, CAST(SUM(amount) AS DECIMAL(22,2)) AS revenue FROM sales
GROUP BY seller_id ORDER BY revenue DESC, seller_id LIMIT 5
""", sales=SALES_SQL))
def topk_sellers(spark: SparkSession, sf: str) -> DataFrame:
    agg = sales(spark, sf).groupBy("seller_id").agg(F.sum("amount").cast(DEC).alias("revenue"))
    return W.topk(agg, [F.col("revenue").desc(), F.col("seller_id")], 5)


@query("reconcile", f"""
WITH a AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, COUNT(*) AS actual_rows,
                  CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS actual_sum
           FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn
                 FROM lineitem) WHERE rn = 1 GROUP BY 1),
c AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, COUNT(*) AS control_rows,
             CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS control_sum
      FROM lineitem GROUP BY 1)
SELECT COALESCE(a.ship_year, c.ship_year) AS ship_year, actual_rows, actual_sum, control_rows, control_sum,
       CASE WHEN actual_rows IS NULL THEN 'missing' WHEN control_rows IS NULL THEN 'extra'
            WHEN actual_rows <> control_rows
              OR CAST(abs(COALESCE(actual_sum, 0) - COALESCE(control_sum, 0)) AS DOUBLE) / abs(CAST(control_sum AS DOUBLE)) > 0.001
            THEN 'mismatch' ELSE 'ok' END AS status
FROM a FULL OUTER JOIN c ON a.ship_year = c.ship_year
""")
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicated (silver) lines against the raw control, per ship year."""
    li = io.load(spark, sf, "lineitem")
    order = [F.col(LINE_ORDER[0]).desc()] + [F.col(c) for c in LINE_ORDER[1:]]
    silver = S.dedup_by_key(li, ["l_orderkey", "l_linenumber"], order)
    prep = lambda d: d.select(F.year("l_shipdate").alias("ship_year"),
                              F.col("l_extendedprice").cast("decimal(12,2)").alias("m"))
    out = W.reconcile(prep(silver), prep(li), ["ship_year"], "m")
    return out.select("ship_year", "actual_rows", F.col("actual_sum").cast(DEC).alias("actual_sum"),
                      "control_rows", F.col("control_sum").cast(DEC).alias("control_sum"), "status")


# The control side of the row-level difference: rows lost, rows delivered
# twice, rows with another quantity.
CONTROL_SQL = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 97 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_returnflag
FROM lineitem WHERE l_orderkey % 89 <> 0
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE l_orderkey % 83 = 0
"""


@query("row_difference", with_views("""
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag,
       CAST(SUM(a) AS BIGINT) AS left_rows, CAST(SUM(b) AS BIGINT) AS right_rows FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, 1 AS a, 0 AS b FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, 0, 1 FROM control)
GROUP BY 1, 2, 3, 4 HAVING SUM(a) <> SUM(b)
""", control=CONTROL_SQL))
def row_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Lines against a control copy that lost, doubled and changed some."""
    li = io.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    at = lambda n: F.pmod("l_orderkey", F.lit(n)) == 0
    control = (li.where(~at(89)).withColumn("l_quantity", F.when(at(97), F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
                 .unionByName(li.where(at(83))))
    return W.row_difference(li, control, ["l_orderkey"])
