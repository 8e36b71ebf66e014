"""Projection, filter and scalar-expression queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions import scalar as S
from souk.plans.registry import ORACLES, query
from souk.plans.sources import BROKEN_PROPS, broken_events
from souk.plans.tables import DEC, NESTED_ORDERS_SQL, SALES_SQL, nested_orders, sales, with_views
from souk.sources import io


@query("filter_select", """
SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'
""")
def filter_select(spark: SparkSession, sf: str) -> DataFrame:
    return (io.load(spark, sf, "events").where(F.col("event_type") == "purchase")
              .select("event_id", "user_id", "ts", "value"))


@query("filter_by_day", with_views("""
SELECT order_id, line_no, category_name, seller_id, amount FROM sales WHERE dt = DATE '1998-08-23'
""", sales=SALES_SQL))
def filter_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return (sales(spark, sf).where(F.col("dt") == F.lit("1998-08-23").cast("date"))
              .select("order_id", "line_no", "category_name", "seller_id", "amount"))


# Value bands and device labels of the bucketing example.
VALUE_BANDS = [(10.0, "low"), (50.0, "mid"), (200.0, "high")]
DEVICES = ["mobile", "web", "tablet"]


@query("conditional_bucket", """
SELECT CASE WHEN value < 10.0 THEN 'low' WHEN value < 50.0 THEN 'mid'
            WHEN value < 200.0 THEN 'high' ELSE 'premium' END AS band,
       CASE WHEN user_id % 3 = 0 THEN 'mobile' WHEN user_id % 3 = 1 THEN 'web' ELSE 'tablet' END AS device,
       COUNT(*) AS n_events
FROM events GROUP BY ALL
""")
def conditional_bucket(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events")
    m = F.pmod(F.col("user_id"), F.lit(3))
    device = F.when(m == 0, DEVICES[0]).when(m == 1, DEVICES[1]).otherwise(DEVICES[2])
    return (ev.select(S.bucket(F.col("value"), VALUE_BANDS, "premium").alias("band"),
                      device.alias("device"))
              .groupBy("band", "device").agg(F.count("*").alias("n_events")))


@query("conditional_agg_vs_union", """
SELECT CAST(ts AS DATE) AS day,
       COUNT(*) FILTER (WHERE event_type = 'view') AS views,
       COUNT(*) FILTER (WHERE event_type = 'click') AS clicks,
       COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchases,
       CAST(SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) ELSE 0 END) AS DECIMAL(22,2)) AS purchase_value
FROM events GROUP BY 1
""")
def conditional_agg_vs_union(spark: SparkSession, sf: str) -> DataFrame:
    """One conditional pass (one Exchange) instead of three filters + union."""
    ev = io.load(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    is_ = lambda t: F.col("event_type") == t
    return ev.groupBy("day").agg(
        F.count(F.when(is_("view"), 1)).alias("views"),
        F.count(F.when(is_("click"), 1)).alias("clicks"),
        F.count(F.when(is_("purchase"), 1)).alias("purchases"),
        F.sum(F.when(is_("purchase"), F.col("value").cast("decimal(12,2)")).otherwise(0))
         .cast(DEC).alias("purchase_value"))


@query("union_of_filters", ORACLES["conditional_agg_vs_union"])
def union_of_filters(spark: SparkSession, sf: str) -> DataFrame:
    """The union twin of the conditional pass: one filtered aggregate per kind
    of event, put together again by day."""
    ev = io.load(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    zero, parts = F.lit(0).cast("bigint"), []
    for kind, name in (("view", "views"), ("click", "clicks"), ("purchase", "purchases"), (None, None)):
        rows = ev.where(F.col("event_type") == kind) if kind else ev
        money = F.sum(F.col("value").cast("decimal(12,2)")) if kind == "purchase" else F.lit(0).cast("decimal(22,2)")
        n = F.count("*") if kind else zero
        parts.append(rows.groupBy("day").agg(*[(n if c == name else zero).alias(c) for c in ("views", "clicks", "purchases")],
                                             money.cast(DEC).alias("purchase_value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("day").agg(F.sum("views").alias("views"), F.sum("clicks").alias("clicks"),
                                  F.sum("purchases").alias("purchases"), F.sum("purchase_value").cast(DEC).alias("purchase_value"))


@query("string_key_ops", """
SELECT event_id, 'evt-' || CAST(event_id AS VARCHAR) AS event_key,
       concat_ws('_', CAST(user_id AS VARCHAR), CAST(event_id % 10 AS VARCHAR)) AS salted_key,
       split_part(concat_ws('_', CAST(user_id AS VARCHAR), CAST(event_id % 10 AS VARCHAR)), '_', 1) AS user_part,
       upper(event_type) || ':' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS label
FROM events
""")
def string_key_ops(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events")
    salted = F.concat_ws("_", F.col("user_id").cast("string"), F.pmod("event_id", F.lit(10)).cast("string"))
    return ev.select("event_id",
                     F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("event_key"),
                     salted.alias("salted_key"),
                     F.split(salted, "_")[0].alias("user_part"),
                     F.concat(F.upper("event_type"), F.lit(":"),
                              F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("label"))


@query("math_scalar", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(22,4)) AS net_price,
       CAST(ceil(l_quantity / 7) AS BIGINT) AS packs,
       CAST(floor(l_tax * 100 + 0.5) AS BIGINT) AS tax_pct,
       ROUND(exp(l_discount), 6) AS growth,
       l_orderkey % 7 AS mod7
FROM lineitem
""")
def math_scalar(spark: SparkSession, sf: str) -> DataFrame:
    li = io.load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     (F.col("l_extendedprice").cast("decimal(12,2)")
                      * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(22,4)").alias("net_price"),
                     F.ceil(F.col("l_quantity") / 7).cast("bigint").alias("packs"),
                     F.floor(F.col("l_tax") * 100 + 0.5).cast("bigint").alias("tax_pct"),
                     F.round(F.exp("l_discount"), 6).alias("growth"),
                     (F.col("l_orderkey") % 7).alias("mod7"))


@query("date_scalar", """
SELECT event_id,
       CAST(ts AS DATE) AS day,
       strftime(ts, '%d.%m.%Y_%H:%M:%S') AS log_stamp,
       regexp_replace(strftime(ts, '%d.%m.%Y_%H:%M:%S'), '^(\\d{2})\\.(\\d{2})\\.(\\d{4})_.*$', '\\3-\\2-\\1') AS iso_day,
       CAST(strptime(strftime(ts, '%d.%m.%Y_%H:%M:%S'), '%d.%m.%Y_%H:%M:%S') AS TIMESTAMP) AS parsed_ts,
       CAST(ts AS DATE) + INTERVAL 7 DAY AS week_later,
       date_trunc('hour', ts) AS hour_start,
       CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day_index
FROM events
""")
def date_scalar(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events")
    stamp = F.date_format("ts", "dd.MM.yyyy_HH:mm:ss")
    return ev.select("event_id",
                     F.col("ts").cast("date").alias("day"),
                     stamp.alias("log_stamp"),
                     F.regexp_replace(stamp, r"^(\d{2})\.(\d{2})\.(\d{4})_.*$", "$3-$2-$1").alias("iso_day"),
                     F.to_timestamp_ntz(stamp, F.lit("dd.MM.yyyy_HH:mm:ss")).alias("parsed_ts"),
                     F.date_add(F.col("ts").cast("date"), 7).cast("timestamp_ntz").alias("week_later"),
                     F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start"),
                     F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).alias("day_index"))


@query("nested_build_slice", with_views("""
SELECT order_id, user_id, it.line AS line, it.unit_cents AS unit_cents, it.qty AS qty,
       len(items) AS n_items
FROM (SELECT order_id, user_id, items, unnest(items[1:2]) AS it FROM nested)
""", nested=NESTED_ORDERS_SQL))
def nested_build_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Build the nested orders, cut each array to two items, explode, read fields."""
    n = nested_orders(spark, sf)
    return (n.select("order_id", "user_id", F.size("items").cast("bigint").alias("n_items"),
                     F.explode(F.slice("items", 1, 2)).alias("it"))
              .select("order_id", "user_id", F.col("it.line").alias("line"),
                      F.col("it.unit_cents").alias("unit_cents"), F.col("it.qty").alias("qty"),
                      "n_items"))


@query("json_payload_by_type", f"""
SELECT event_type,
       COUNT(*) AS n_events,
       COUNT(k) AS n_with_k,
       CAST(SUM(k) AS BIGINT) AS sum_k,
       COUNT(*) FILTER (WHERE event_type = 'purchase' AND k >= 50) AS big_purchases
FROM (SELECT event_type,
             CASE WHEN json_valid(p) THEN TRY_CAST(json_extract(p, '$.k') AS INTEGER) END AS k
      FROM (SELECT event_type, {BROKEN_PROPS} AS p FROM events))
GROUP BY event_type
""")
def json_payload_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """Typed payload fields via VARIANT; malformed payloads give NULL fields."""
    ev = broken_events(spark, sf).withColumn("k", S.payload_field(F.col("props"), "$.k", "int"))
    return ev.groupBy("event_type").agg(
        F.count("*").alias("n_events"), F.count("k").alias("n_with_k"),
        F.sum("k").cast("bigint").alias("sum_k"),
        F.count(F.when((F.col("event_type") == "purchase") & (F.col("k") >= 50), 1)).alias("big_purchases"))


@query("hash_sample", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE (c_custkey * 2654435761) % 10000 < 1000
""")
def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    c = io.load(spark, sf, "customer")
    return S.hash_sample(c, "c_custkey", 0.10).select("c_custkey", "c_name", "c_mktsegment")


@query("limit_fraction", """
SELECT c_custkey, c_name FROM customer ORDER BY c_custkey
LIMIT CAST(floor((SELECT COUNT(*) FROM customer) * 0.1) AS BIGINT)
""")
def limit_fraction(spark: SparkSession, sf: str) -> DataFrame:
    c = io.load(spark, sf, "customer").select("c_custkey", "c_name")
    return S.limit_fraction(c, [F.col("c_custkey")], 0.1)


LINE_ORDER = ["l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_ORDER_SQL = ("l_extendedprice DESC, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, "
                  "l_returnflag, l_linestatus, l_shipdate")


@query("dedup_by_key", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn
      FROM lineitem) WHERE rn = 1
""")
def dedup_by_key(spark: SparkSession, sf: str) -> DataFrame:
    li = io.load(spark, sf, "lineitem")
    order = [F.col(LINE_ORDER[0]).desc()] + [F.col(c) for c in LINE_ORDER[1:]]
    return (S.dedup_by_key(li, ["l_orderkey", "l_linenumber"], order)
              .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))


# Fixed value: salt of the pseudonymisation examples.
PII_SALT = "souk-salt"


@query("pseudonymise", f"""
SELECT sha256('{PII_SALT}' || CAST(c_custkey AS VARCHAR)) AS cust_token,
       regexp_replace(c_name, '[0-9]', '*', 'g') AS masked_name,
       c_nationkey, c_mktsegment
FROM customer
""")
def pseudonymise(spark: SparkSession, sf: str) -> DataFrame:
    c = io.load(spark, sf, "customer")
    return c.select(S.pseudonymise(F.col("c_custkey"), PII_SALT).alias("cust_token"),
                    S.mask_digits(F.col("c_name")).alias("masked_name"),
                    "c_nationkey", "c_mktsegment")


# What each role may see of the customer table.
ROLE_POLICY = {
    "analyst": (["c_nationkey", "c_mktsegment", "c_acctbal"], "c_acctbal >= 0"),
    "bi": (["c_nationkey", "c_mktsegment"], "true"),
}


def role_view(df: DataFrame, role: str, policy: dict, token_col: str, salt: str) -> DataFrame:
    """Column list + row predicate per role; identifiers only as tokens."""
    cols, pred = policy[role]
    return df.where(F.expr(pred)).select(S.pseudonymise(F.col(token_col), salt).alias("cust_token"), *cols)


@query("role_view", f"""
SELECT sha256('{PII_SALT}' || CAST(c_custkey AS VARCHAR)) AS cust_token, c_nationkey, c_mktsegment, c_acctbal
FROM customer WHERE c_acctbal >= 0
""")
def role_view_q(spark: SparkSession, sf: str) -> DataFrame:
    return role_view(io.load(spark, sf, "customer"), "analyst", ROLE_POLICY, "c_custkey", PII_SALT)
