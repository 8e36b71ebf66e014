"""Business marts: cohorts, lifetime value, retention,
seller scorecard. Per-user reductions first, then small per-cohort frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.operators.windows import rank_in_groups

DEC = "decimal(22,2)"


def _months_between(a, b):
    """Whole calendar months from date ``a`` to date ``b`` (both month starts)."""
    return ((F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)).cast("int")


def user_cohorts(df: DataFrame, user: str, day: str) -> DataFrame:
    """First activity month per user, with the size of that cohort.

    The cohort size comes from a grouped count joined back (one row per
    cohort month), not from a window over all users.
    """
    first = df.groupBy(user).agg(F.trunc(F.min(day).cast("date"), "month").alias("cohort_month"))
    sizes = first.groupBy("cohort_month").agg(F.count("*").alias("cohort_users"))
    return first.join(sizes, "cohort_month")


def ltv_by_cohort(df: DataFrame, user: str, day: str, amount: str) -> DataFrame:
    """Revenue per (cohort month, months since cohort) and its running sum,
    also per cohort user. The running window is over one cohort's periods
    (a few hundred rows at most), after all heavy work is aggregated."""
    coh = user_cohorts(df, user, day)
    per = (df.join(coh, user)
             .withColumn("period", _months_between(F.col("cohort_month"), F.trunc(F.col(day).cast("date"), "month")))
             .groupBy("cohort_month", "period")
             .agg(F.sum(amount).cast(DEC).alias("revenue"), F.first("cohort_users").alias("cohort_users")))
    w = Window.partitionBy("cohort_month").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    cum = F.sum("revenue").over(w)
    return per.select("cohort_month", "period", "cohort_users", "revenue",
                      cum.cast(DEC).alias("cum_revenue"),
                      (cum.cast("double") / F.col("cohort_users")).alias("ltv_per_user"))


def cohort_retention(df: DataFrame, user: str, t: str) -> DataFrame:
    """Active users per (cohort month, period) over the cohort size.

    Activity is first reduced to distinct (user, month) pairs, so the
    distinct count is a plain count after one dedup shuffle."""
    act = df.select(F.col(user).alias("user_id"), F.trunc(F.col(t).cast("date"), "month").alias("m")).distinct()
    coh = user_cohorts(act.withColumnRenamed("m", "_m"), "user_id", "_m")
    return (act.join(coh, "user_id")
               .withColumn("period", _months_between(F.col("cohort_month"), F.col("m")))
               .groupBy("cohort_month", "period")
               .agg(F.count("*").alias("active_users"), F.first("cohort_users").alias("cohort_size"))
               .withColumn("retention", F.col("active_users").cast("double") / F.col("cohort_size")))


def seller_scorecard(lines: DataFrame, seller: str, peers: str, order: str, price: str, returned: Column,
                     rank: str = "rank_in_peers") -> DataFrame:
    """Orders, revenue, return share, mean price and rank by revenue among the
    peers (column ``peers``) per seller. ``returned`` says whether a line came
    back. The mean is over the lines that have a price."""
    p = F.col(price).cast("decimal(12,2)")
    agg = (lines.groupBy(F.col(seller).alias("seller_id"), peers)
                .agg(F.count_distinct(order).alias("orders"),
                     F.sum(p).cast(DEC).alias("revenue"),
                     (F.count(F.when(returned, 1)).cast("double") / F.count("*")).alias("return_share"),
                     F.when(F.count(p) > 0, F.sum(p).cast("double") / F.count(p)).alias("mean_price")))
    # one row per seller; very many sellers of one peer group are ranked over
    # revenue ranges instead of one sorted window (see rank_in_groups)
    return rank_in_groups(agg, [peers], "revenue", [], rank, fn="rank")
