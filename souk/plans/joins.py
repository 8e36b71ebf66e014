"""Join queries: strategies, star enrichment, as-of, range, anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions import scalar as S
from souk.operators import joins as J
from souk.plans.registry import query
from souk.plans.tables import DEC, SALES_SQL, sales, with_views
from souk.session import scratch_path
from souk.sources import io


JOIN_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_type, p_brand
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
"""


def _join(strategy: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        li = io.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        p = io.load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
        return J.join_dim(li, p, "l_partkey", "left", strategy)
    return run


query("join_sort_merge", JOIN_SQL)(_join("merge"))
query("join_broadcast", JOIN_SQL)(_join("broadcast"))
query("join_adaptive", JOIN_SQL)(_join("adaptive"))


@query("revenue_by_category", with_views("""
SELECT category_name, CAST(SUM(amount) AS DECIMAL(22,2)) AS revenue, COUNT(*) AS n_lines
FROM sales GROUP BY category_name ORDER BY revenue DESC
""", sales=SALES_SQL))
def revenue_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return (sales(spark, sf).groupBy("category_name")
              .agg(F.sum("amount").cast(DEC).alias("revenue"), F.count("*").alias("n_lines"))
              .orderBy(F.col("revenue").desc()))


@query("enrich_star", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_type, s_name, n_name, o_custkey
FROM lineitem
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN orders ON l_orderkey = o_orderkey
""")
def enrich_star(spark: SparkSession, sf: str) -> DataFrame:
    li = io.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = io.load(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey")
    supp = (io.load(spark, sf, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
              .join(io.load(spark, sf, "nation").withColumnRenamed("n_nationkey", "s_nationkey"),
                    "s_nationkey", "left"))
    orders = io.load(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return J.enrich_star(li, [(part, "l_partkey", ["p_type"]),
                              (supp, "l_suppkey", ["s_name", "n_name"]),
                              (orders, "l_orderkey", ["o_custkey"])])


# As-of price fixture: each part changes price every 30 + partkey % 60 days
# from 1992-01-01 until the end of 2002 (FIXTURES 4); change n adds n % 10.
PRICE_CHANGES_SQL = """
SELECT p_partkey AS partkey,
       CAST(DATE '1992-01-01' + CAST(n * (30 + p_partkey % 60) AS INTEGER) AS DATE) AS eff_dt,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) + n % 10 AS DECIMAL(12,2)) AS price
FROM part, LATERAL (SELECT unnest(range(0, CAST(floor(4017 / (30 + p_partkey % 60)) AS BIGINT) + 1)) AS n)
"""


def price_changes(spark: SparkSession, sf: str) -> DataFrame:
    p = io.load(spark, sf, "part")
    period = F.lit(30) + F.pmod("p_partkey", F.lit(60))
    n = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.lit(4017) / period)))
    return (p.select("p_partkey", "p_retailprice", period.alias("_per"), n.alias("n"))
             .select(F.col("p_partkey").alias("partkey"),
                     F.date_add(F.lit("1992-01-01").cast("date"), (F.col("n") * F.col("_per")).cast("int")).alias("eff_dt"),
                     (F.col("p_retailprice").cast("decimal(12,2)") + F.col("n") % 10)
                      .cast("decimal(12,2)").alias("price")))


@query("asof_price", with_views("""
SELECT l.order_id, l.line_no, l.partkey, l.order_dt, c.eff_dt, c.price
FROM lines l ASOF LEFT JOIN changes c ON l.partkey = c.partkey AND l.order_dt >= c.eff_dt
""", changes=PRICE_CHANGES_SQL, lines="""
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS partkey, CAST(o_orderdate AS DATE) AS order_dt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""))
def asof_price(spark: SparkSession, sf: str) -> DataFrame:
    li = io.load(spark, sf, "lineitem")
    o = io.load(spark, sf, "orders")
    lines = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
               .select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                       F.col("l_partkey").alias("partkey"), F.col("o_orderdate").cast("date").alias("order_dt")))
    return (J.asof_join(lines, price_changes(spark, sf), "partkey", "order_dt", "eff_dt", ["price"])
              .select("order_id", "line_no", "partkey", "order_dt", "eff_dt", "price"))


# Intraday fixture: every event looks up its user's last click by the hour;
# both times are cut to hours, so equal times and ties are common.
@query("asof_last_click", """
SELECT event_id, user_id, event_ts, CAST(last_c.h AS TIMESTAMP) AS click_hour, last_c.v AS click_value, last_c.i AS click_id FROM (
  SELECT *, LAST_VALUE(c IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_ts, fact, event_id
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_c
  FROM (SELECT event_id, user_id, ts AS event_ts, 1 AS fact, NULL AS c FROM events
        UNION ALL
        SELECT event_id, user_id, date_trunc('hour', ts), 0,
               struct_pack(h := date_trunc('hour', ts), v := value, i := event_id)
        FROM events WHERE event_type = 'click'))
WHERE fact = 1
""")
def asof_last_click(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events")
    clicks = ev.where(F.col("event_type") == "click").select(
        "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("click_hour"),
        F.col("value").alias("click_value"), F.col("event_id").alias("click_id"))
    return J.asof_join(ev.select("event_id", "user_id", F.col("ts").alias("event_ts")), clicks, "user_id", "event_ts",
                       "click_hour", ["click_value", "click_id"], tie=["click_id"])


# IP fixture (FIXTURES 4): every nation owns three consecutive blocks of
# 2^25 addresses (range id = nationkey * 3 + j), each only partly used (gaps);
# customer ip = (custkey * 2654435761) % 2^32.
IP_RANGES_SQL = """
SELECT idx AS range_id, n_nationkey AS nationkey,
       CAST(idx * 33554432 AS BIGINT) AS lo,
       CAST(idx * 33554432 + 16777216 + (idx * 1000003) % 8388608 AS BIGINT) AS hi
FROM (SELECT n_nationkey, CAST(n_nationkey AS BIGINT) * 3 + j AS idx FROM nation, range(0, 3) t(j))
"""


def ip_ranges(spark: SparkSession, sf: str) -> DataFrame:
    n = io.load(spark, sf, "nation")
    idx = (F.col("n_nationkey").cast("bigint") * 3 + F.col("j")).alias("idx")
    r = (n.select("n_nationkey", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(2).cast("bigint"))).alias("j"))
          .select("n_nationkey", idx))
    i = F.col("idx")
    return r.select(i.alias("range_id"), F.col("n_nationkey").alias("nationkey"), (i * 33554432).alias("lo"),
                    (i * 33554432 + 16777216 + (i * 1000003) % 8388608).alias("hi"))


@query("ip_range_join", with_views("""
SELECT c_custkey, ip, range_id, nationkey
FROM (SELECT c_custkey, (c_custkey * 2654435761) % 4294967296 AS ip FROM customer) c
LEFT JOIN ranges ON ip BETWEEN lo AND hi
""", ranges=IP_RANGES_SQL))
def ip_range_join(spark: SparkSession, sf: str) -> DataFrame:
    c = io.load(spark, sf, "customer").select("c_custkey", S.knuth_mod_2_32(F.col("c_custkey")).alias("ip"))
    out = J.interval_join(c, ip_ranges(spark, sf), [], "ip", "lo", "hi", 1 << 22, "left")
    return out.select("c_custkey", "ip", "range_id", "nationkey")


@query("fk_violations", """
SELECT 'lineitem.l_partkey' AS check_name, COUNT(*) AS violations FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'lineitem.l_orderkey', COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'orders.o_custkey', COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'orders.without_lines', COUNT(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def fk_violations(spark: SparkSession, sf: str) -> DataFrame:
    li, o = io.load(spark, sf, "lineitem"), io.load(spark, sf, "orders")
    p, c = io.load(spark, sf, "part"), io.load(spark, sf, "customer")
    checks = [
        ("lineitem.l_partkey", J.fk_violations(li, p, F.col("l_partkey") == F.col("p_partkey"))),
        ("lineitem.l_orderkey", J.fk_violations(li, o, F.col("l_orderkey") == F.col("o_orderkey"))),
        ("orders.o_custkey", J.fk_violations(o, c, F.col("o_custkey") == F.col("c_custkey"))),
        ("orders.without_lines", J.fk_violations(o, li, F.col("o_orderkey") == F.col("l_orderkey"))),
    ]
    frames = [df.agg(F.count("*").alias("violations")).select(F.lit(n).alias("check_name"), "violations")
              for n, df in checks]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("order_lifecycle", """
SELECT o_orderkey AS order_id, o_orderdate AS purchase_ts, o_totalprice,
       r.first_refund_ts, COALESCE(r.refund_lines, 0) AS refund_lines,
       d.last_delivery_ts, d.last_delivery_status
FROM orders
LEFT JOIN (SELECT l_orderkey, MIN(l_shipdate) AS first_refund_ts, COUNT(*) AS refund_lines
           FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) r ON r.l_orderkey = o_orderkey
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_delivery_ts,
                  max(l_linestatus) FILTER (WHERE l_shipdate = mx) AS last_delivery_status
           FROM (SELECT *, max(l_shipdate) OVER (PARTITION BY l_orderkey) AS mx FROM lineitem)
           GROUP BY l_orderkey) d ON d.l_orderkey = o_orderkey
""")
def order_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    o = io.load(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"),
                                           F.col("o_orderdate").alias("purchase_ts"), "o_totalprice")
    li = io.load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"),
                                              F.col("l_shipdate").alias("ts"),
                                              F.col("l_linestatus").alias("status"), "l_returnflag")
    out = J.order_lifecycle(o, li.where(F.col("l_returnflag") == "R"), li, "order_id", "ts")
    return out.withColumn("refund_lines", F.coalesce("refund_lines", F.lit(0).cast("bigint")))


# Bucket count of the co-located tables (both sides must use the same).
JOIN_BUCKETS = 16


@query("bucketed_join", """
SELECT o_orderpriority, COUNT(*) AS n_lines,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_orderpriority
""")
def bucketed_join(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem and orders written bucketed by order key into the same
    number of buckets; their join needs no shuffle of either side."""
    import uuid
    tag = uuid.uuid4().hex[:8]
    li = io.load(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    o = io.load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    lb = io.write_bucketed(li, f"souk_lineitem_{tag}", ["l_orderkey"], JOIN_BUCKETS,
                           scratch_path(spark, "bucketed-lineitem"))
    ob = io.write_bucketed(o, f"souk_orders_{tag}", ["o_orderkey"], JOIN_BUCKETS,
                           scratch_path(spark, "bucketed-orders"))
    # sort-merge join on the buckets (what two large tables get): no
    # Exchange below the join on either side
    return (lb.join(ob.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
              .groupBy("o_orderpriority")
              .agg(F.count("*").alias("n_lines"),
                   F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast(DEC).alias("revenue")))
