"""Exact distinct users that roll up.

A day's users are stored once as bitmaps, a row per (day, bucket of 32,768
ids). Weeks, months, any range of days and cohorts are unions of stored
bitmaps; the events are not read again. Ids have to be numbers, and dense for
small bitmaps: a bucket with any user is 4 KB.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def user_bitmaps(df: DataFrame, by: Sequence[Column], user: str) -> DataFrame:
    """``by..., bucket, users`` (a bitmap): who occurs in each group. NULL
    users are nobody. Repeated rows set a bit again; an aggregate with a state
    of 4 KB per (group, bucket), combined before the shuffle."""
    u = F.col(user).cast("bigint")
    return (df.where(u.isNotNull()).groupBy(*by, F.bitmap_bucket_number(u).alias("bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(u)).alias("users")))


def roll_up(bitmaps: DataFrame, by: Sequence[Column]) -> DataFrame:
    """Stored bitmaps united by coarser groups, e.g. days to months."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def distinct_users(bitmaps: DataFrame, by: Sequence[str], out: str = "users") -> DataFrame:
    """The exact number of different users per group."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("users")).cast("bigint").alias(out))


def retention_from_bitmaps(months: DataFrame, month: str) -> DataFrame:
    """``cohort_month, period, active_users, cohort_size, retention`` from a
    bitmap per (month, bucket): of the users first seen in a month those
    active in a later one.

    With S(c) the users seen up to month c and A(p) those active in p, the
    cohort's active users are |A(p) and S(c)| - |A(p) and S(c before)|. Users
    first seen in c are active in c, so only a bucket's own months begin
    cohorts. A bucket has one row per month, and the work per bucket goes with
    the square of the months, whatever the number of events.
    """
    m = months.select(F.col(month).alias("p"), "bucket", F.col("users").alias("a"))
    w = Window.partitionBy("bucket").orderBy("c")
    seen = m.select("bucket", F.col("p").alias("c"), F.bitmap_or_agg("a").over(
        Window.partitionBy("bucket").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    seen = seen.withColumn("before", F.coalesce(F.lag("s").over(w), F.lit(bytearray(4096))))
    sides = F.array(F.struct(F.lit(1).alias("sign"), F.col("s").alias("map")), F.struct(F.lit(-1).alias("sign"), F.col("before").alias("map")))
    pairs = (seen.join(m, "bucket").where(F.col("p") >= F.col("c"))
                 .select("bucket", "c", "p", "a", F.explode(sides).alias("side"))
                 .select("bucket", "c", "p", "side.sign", F.explode(F.array("a", "side.map")).alias("map")))
    both = pairs.groupBy("bucket", "c", "p", "sign").agg(F.bitmap_and_agg("map").alias("both"))
    n = both.groupBy(F.col("c").alias("cohort_month"), "p").agg(F.sum(F.col("sign") * F.bitmap_count("both")).alias("active_users"))
    size = seen.groupBy(F.col("c").alias("cohort_month")).agg(F.sum(F.bitmap_count("s") - F.bitmap_count("before")).alias("cohort_size"))
    period = (F.year("p") - F.year("cohort_month")) * 12 + F.month("p") - F.month("cohort_month")
    return (n.join(size, "cohort_month").where("active_users > 0")
             .select("cohort_month", period.cast("int").alias("period"), F.col("active_users").cast("bigint"),
                     F.col("cohort_size").cast("bigint"),
                     (F.col("active_users").cast("double") / F.col("cohort_size")).alias("retention")))
