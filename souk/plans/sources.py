"""Source, sink and format queries with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.plans.registry import query
from souk.plans.tables import DEC, SALES_SQL, SKEWED_ORDERS_SQL, sales, skewed_orders, with_views
from souk.session import scratch_path
from souk.sources import io


@query("scan_count", """
SELECT 'lineitem' AS table_name, COUNT(*) AS n_rows FROM lineitem
UNION ALL SELECT 'orders', COUNT(*) FROM orders
UNION ALL SELECT 'part', COUNT(*) FROM part
UNION ALL SELECT 'events', COUNT(*) FROM events
""")
def scan_count(spark: SparkSession, sf: str) -> DataFrame:
    frames = [io.load(spark, sf, t).agg(F.count("*").alias("n_rows"))
              .select(F.lit(t).alias("table_name"), "n_rows")
              for t in ("lineitem", "orders", "part", "events")]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


SALES_COLS_SCHEMA = T.StructType([
    T.StructField("category_name", T.StringType()),
    T.StructField("seller_id", T.LongType()),
    T.StructField("amount", T.DecimalType(12, 2)),
    T.StructField("qty", T.IntegerType()),
])

ROUNDTRIP_SQL = with_views("""
SELECT category_name, CAST(COALESCE(SUM(amount * qty), 0) AS DECIMAL(22,2)) AS revenue,
       COUNT(*) AS n_lines
FROM sales GROUP BY category_name
""", sales=SALES_SQL)


def _roundtrip(spark: SparkSession, sf: str, fmt: str) -> DataFrame:
    """sales -> ``fmt`` files -> typed read -> revenue per category."""
    src = sales(spark, sf).select([f.name for f in SALES_COLS_SCHEMA.fields])
    out = scratch_path(spark, f"roundtrip-{fmt}")
    path = io.write_formats(src, out, [fmt])[fmt]
    if fmt in io.TEXT_FORMATS:
        # text formats carry no types: read as strings, then cast (normalise)
        raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in SALES_COLS_SCHEMA])
        back = io.normalise_types(io.read_table(spark, path, fmt, raw_schema), SALES_COLS_SCHEMA)
    else:
        back = io.read_table(spark, path, fmt)
    return revenue_per_category_of(back, "amount", "qty")


def revenue_per_category_of(df: DataFrame, price: str, qty: str) -> DataFrame:
    """coalesce(sum(price * qty), 0) per category (D1)."""
    return (df.groupBy("category_name")
              .agg(F.coalesce(F.sum(F.col(price) * F.col(qty)), F.lit(0)).cast(DEC).alias("revenue"),
                   F.count("*").alias("n_lines")))


query("csv_roundtrip_agg", ROUNDTRIP_SQL)(lambda spark, sf: _roundtrip(spark, sf, "csv"))
query("json_roundtrip_agg", ROUNDTRIP_SQL)(lambda spark, sf: _roundtrip(spark, sf, "json"))
query("orc_roundtrip_agg", ROUNDTRIP_SQL)(lambda spark, sf: _roundtrip(spark, sf, "orc"))
query("revenue_per_category", ROUNDTRIP_SQL)(
    lambda spark, sf: revenue_per_category_of(sales(spark, sf), "amount", "qty"))


@query("format_inventory")
def format_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Write sales to every available format, then bytes/files per format."""
    src = sales(spark, sf)
    out = scratch_path(spark, "formats")
    written = io.write_formats(src, out, ["parquet", "orc", "csv", "json", "avro"])
    return io.storage_inventory(spark, written)


@query("partitioned_read_filter", with_views("""
SELECT brand, COUNT(*) AS n_lines, CAST(SUM(amount) AS DECIMAL(22,2)) AS revenue
FROM sales WHERE category_name = 'ECONOMY' AND dt >= DATE '1998-01-01'
GROUP BY brand
""", sales=SALES_SQL))
def partitioned_read_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Write sales partitioned by category, read back with a partition filter
    (PartitionFilters prunes directories) and a pushed data filter."""
    path = scratch_path(spark, "sales-by-category")
    io.write_partitioned(sales(spark, sf), path, ["category_name"])
    back = spark.read.parquet(path)
    return (back.where((F.col("category_name") == "ECONOMY") & (F.col("dt") >= F.lit("1998-01-01").cast("date")))
                .groupBy("brand").agg(F.count("*").alias("n_lines"),
                                      F.sum("amount").cast(DEC).alias("revenue")))


@query("append_two_writers", """
SELECT version, COUNT(*) AS n_rows, COUNT(DISTINCT o_orderkey) AS n_keys,
       CAST(SUM(amount) AS DECIMAL(22,2)) AS total
FROM (SELECT o_orderkey, v AS version,
             CAST(CAST(o_totalprice AS DECIMAL(12,2)) * (1 + 0.1 * v) AS DECIMAL(14,2)) AS amount
      FROM orders, (VALUES (0), (1), (2)) t(v))
GROUP BY version
""")
def append_two_writers(spark: SparkSession, sf: str) -> DataFrame:
    """Seed with overwrite, then two writers append to the same directory;
    every batch survives (append never replaces)."""
    o = io.load(spark, sf, "orders")
    path = scratch_path(spark, "appends")

    def batch(v: int) -> DataFrame:
        amt = (F.col("o_totalprice").cast("decimal(12,2)") * F.lit(1 + 0.1 * v).cast("decimal(3,1)"))
        return o.select("o_orderkey", F.lit(v).alias("version"), amt.cast("decimal(14,2)").alias("amount"))

    batch(0).write.mode("overwrite").parquet(path)
    batch(1).write.mode("append").parquet(path)
    batch(2).write.mode("append").parquet(path)
    back = spark.read.parquet(path)
    return (back.groupBy("version")
                .agg(F.count("*").alias("n_rows"), F.count_distinct("o_orderkey").alias("n_keys"),
                     F.sum("amount").cast(DEC).alias("total")))


@query("append_overlapping_writers", """
SELECT o_orderkey, COUNT(*) AS n_rows, COUNT(DISTINCT version) AS n_writers, CAST(MAX(amount) AS DECIMAL(14,2)) AS highest
FROM (SELECT o_orderkey, 1 AS version, CAST(o_totalprice AS DECIMAL(14,2)) AS amount FROM orders WHERE o_orderkey % 3 <> 0
      UNION ALL SELECT o_orderkey, 1, CAST(o_totalprice AS DECIMAL(14,2)) FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 = 0
      UNION ALL SELECT o_orderkey, 2, CAST(CAST(o_totalprice AS DECIMAL(14,2)) + 1 AS DECIMAL(14,2)) FROM orders WHERE o_orderkey % 3 <> 1)
GROUP BY o_orderkey
""")
def append_overlapping_writers(spark: SparkSession, sf: str) -> DataFrame:
    """Two writers with overlapping keys, one of them with duplicates in its
    batch: appends keep every row; the reader sees who wrote a key how often."""
    o = io.load(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(14,2)").alias("amount"))
    third, path = F.pmod("o_orderkey", F.lit(3)), scratch_path(spark, "overlapping-appends")
    one = o.where(third != 0).withColumn("version", F.lit(1))
    one.unionByName(one.where(F.pmod("o_orderkey", F.lit(5)) == 0)).write.mode("append").parquet(path)
    two = o.where(third != 1).select("o_orderkey", (F.col("amount") + 1).cast("decimal(14,2)").alias("amount"), F.lit(2).alias("version"))
    two.write.mode("append").parquet(path)
    return (spark.read.parquet(path).groupBy("o_orderkey")
                 .agg(F.count("*").alias("n_rows"), F.count_distinct("version").alias("n_writers"), F.max("amount").alias("highest")))


@query("format_row_counts", with_views("""
SELECT f AS format, COUNT(*) AS n_rows, CAST(SUM(amount) AS DECIMAL(22,2)) AS revenue
FROM sales, (VALUES ('parquet'), ('orc'), ('csv'), ('json')) t(f) GROUP BY f
""", sales=SALES_SQL))
def format_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What is found again in each format after writing sales to all of them."""
    src = sales(spark, sf).select([f.name for f in SALES_COLS_SCHEMA.fields])
    written = io.write_formats(src, scratch_path(spark, "counted-formats"), ["parquet", "orc", "csv", "json"])
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in SALES_COLS_SCHEMA])
    out = None
    for fmt, path in written.items():
        back = io.normalise_types(io.read_table(spark, path, fmt, text if fmt in io.TEXT_FORMATS else None), SALES_COLS_SCHEMA)
        n = back.agg(F.count("*").alias("n_rows"), F.sum("amount").cast(DEC).alias("revenue")).select(
            F.lit(fmt).alias("format"), "n_rows", "revenue")
        out = n if out is None else out.unionByName(n)
    return out


@query("key_skew_profile", with_views("""
SELECT seller_id, n_rows, ROUND(CAST(n_rows AS DOUBLE) * 100.0 / (SELECT COUNT(*) FROM so), 2) AS share_pct
FROM (SELECT seller_id, COUNT(*) AS n_rows FROM so GROUP BY seller_id)
ORDER BY n_rows DESC, seller_id LIMIT 5
""", so=SKEWED_ORDERS_SQL))
def key_skew_profile(spark: SparkSession, sf: str) -> DataFrame:
    return io.key_skew_profile(skewed_orders(spark, sf), "seller_id", 5).withColumnRenamed("rows", "n_rows")


# fixture for broken input (FIXTURES 4): every 37th payload is cut short
BROKEN_PROPS = "CASE WHEN event_id % 37 = 0 THEN substr(props, 1, 4) ELSE props END"


def broken_events(spark: SparkSession, sf: str) -> DataFrame:
    ev = io.load(spark, sf, "events")
    return ev.withColumn("props", F.expr(BROKEN_PROPS))


@query("quarantine_split", f"""
SELECT CASE WHEN json_valid(props) THEN 'ok' ELSE 'quarantine' END AS status,
       CASE WHEN json_valid(props) THEN NULL ELSE 'malformed_json' END AS reason,
       COUNT(*) AS n_rows
FROM (SELECT event_id, {BROKEN_PROPS} AS props FROM events)
GROUP BY ALL
""")
def quarantine_split(spark: SparkSession, sf: str) -> DataFrame:
    ev = broken_events(spark, sf)
    good, bad = io.split_quarantine(ev, F.try_parse_json("props").isNotNull(),
                                    F.lit("malformed_json"))
    g = good.groupBy().agg(F.count("*").alias("n_rows")).select(
        F.lit("ok").alias("status"), F.lit(None).cast("string").alias("reason"), "n_rows")
    b = bad.groupBy("reason").agg(F.count("*").alias("n_rows")).select(
        F.lit("quarantine").alias("status"), "reason", "n_rows")
    return g.unionByName(b).where(F.col("n_rows") > 0)
