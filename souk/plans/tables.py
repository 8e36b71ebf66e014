"""Stand-in views over the driver tables (FIXTURES.md section 4).

Each view exists twice: as a DataFrame builder (what the Spark jobs read)
and as SQL text that the DuckDB oracles inline as a CTE. The two are kept
next to each other so they cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.sources.io import load

# money results are exact decimals with this type in Spark and in the oracles
DEC = "decimal(22,2)"

# ---------------------------------------------------------------- sales
SALES_SQL = """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, CAST(l_shipdate AS DATE) AS dt,
       p_type AS category_name, p_brand AS brand, l_suppkey AS seller_id, o_custkey AS user_id,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS amount, CAST(l_quantity AS INT) AS qty,
       CAST(o_orderdate AS DATE) AS order_dt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""


def sales(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders")
    p = load(spark, sf, "part")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(p, F.col("l_partkey") == F.col("p_partkey"))
              .select(F.col("l_orderkey").alias("order_id"),
                      F.col("l_linenumber").alias("line_no"),
                      F.col("l_shipdate").cast("date").alias("dt"),
                      F.col("p_type").alias("category_name"),
                      F.col("p_brand").alias("brand"),
                      F.col("l_suppkey").alias("seller_id"),
                      F.col("o_custkey").alias("user_id"),
                      F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
                      F.col("l_quantity").cast("int").alias("qty"),
                      F.col("o_orderdate").cast("date").alias("order_dt")))


# ------------------------------------------------------- skewed orders
# Sellers 1/2/3 receive 30/20/15 % of the rows (hot keys).
SKEWED_SELLER_SQL = """CASE WHEN l_orderkey % 20 < 6 THEN 1 WHEN l_orderkey % 20 < 10 THEN 2
     WHEN l_orderkey % 20 < 13 THEN 3 ELSE l_suppkey END"""

SKEWED_ORDERS_SQL = f"""
SELECT l_orderkey AS order_id, l_linenumber AS line_no, o_custkey AS user_id,
       CAST({SKEWED_SELLER_SQL} AS BIGINT) AS seller_id,
       l_partkey AS category_id,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS amount, CAST(l_quantity AS INT) AS qty,
       l_shipdate AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def skewed_orders(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders")
    bucket = F.col("l_orderkey") % 20
    seller = (F.when(bucket < 6, 1).when(bucket < 10, 2).when(bucket < 13, 3)
              .otherwise(F.col("l_suppkey"))).cast("bigint")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
              .select(F.col("l_orderkey").alias("order_id"),
                      F.col("l_linenumber").alias("line_no"),
                      F.col("o_custkey").alias("user_id"),
                      seller.alias("seller_id"),
                      F.col("l_partkey").alias("category_id"),
                      F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
                      F.col("l_quantity").cast("int").alias("qty"),
                      F.col("l_shipdate").alias("ts")))


# --------------------------------------------------------- nested orders
# Items carry integer cents so totals are exact in every engine:
# unit_cents = cents(l_extendedprice) div qty.
NESTED_ORDERS_SQL = """
SELECT o_orderkey AS order_id, o_custkey AS user_id,
       list({'line': l_linenumber,
             'unit_cents': CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) // CAST(l_quantity AS BIGINT),
             'qty': CAST(l_quantity AS INT)}
            ORDER BY l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) // CAST(l_quantity AS BIGINT),
                     CAST(l_quantity AS INT))
         FILTER (WHERE l_orderkey IS NOT NULL) AS items
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_orderkey, o_custkey
"""


def nested_orders(spark: SparkSession, sf: str) -> DataFrame:
    """orders with their lines as array<struct<line,unit_cents,qty>>.

    Lines are grouped by order first (one shuffle on the order key; an
    order has a bounded number of lines) and left-joined to orders, so
    orders without lines get an empty array.
    """
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders")
    unit_cents = F.expr("CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)"
                        " div CAST(l_quantity AS BIGINT)")
    item = F.struct(F.col("l_linenumber").alias("line"),
                    unit_cents.alias("unit_cents"),
                    F.col("l_quantity").cast("int").alias("qty"))
    per_order = (li.groupBy("l_orderkey")
                   .agg(F.array_sort(F.collect_list(item)).alias("items")))
    empty = F.array().cast(per_order.schema["items"].dataType)
    return (o.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
              .select(F.col("o_orderkey").alias("order_id"),
                      F.col("o_custkey").alias("user_id"),
                      F.coalesce("items", empty).alias("items")))


def with_views(sql: str, **views: str) -> str:
    """Prefix ``sql`` with ``WITH name AS (view_sql), ...``."""
    if not views:
        return sql
    ctes = ",\n".join(f"{name} AS ({body.strip()})" for name, body in views.items())
    return f"WITH {ctes}\n{sql.strip()}"
