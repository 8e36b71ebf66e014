"""Aggregation operators.

All are single ``groupBy().agg()`` passes (partial aggregation map-side,
one Exchange) unless stated; hot keys are handled by partial aggregation,
optional salting (:func:`salted_agg`) and AQE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _avg(total: Column, n: Column) -> Column:
    """sum / count as double; NULL for an empty (all-NULL) group instead of a
    division-by-zero error under ANSI."""
    return F.when(n > 0, total.cast("double") / n)


def multi_agg(df: DataFrame, by: Sequence[str], value: str, counted: str) -> DataFrame:
    """sum / avg / min / max of ``value`` and ``count(counted)`` (NULLs skipped)
    per group in one pass. ``avg`` is sum/count so it is exact for decimals."""
    return (df.groupBy(*by)
              .agg(F.sum(value).alias("total"),
                   F.count(value).alias("_n"),
                   F.min(value).alias("min_value"),
                   F.max(value).alias("max_value"),
                   F.count(counted).alias("n_counted"))
              .withColumn("avg_value", _avg(F.col("total"), F.col("_n")))
              .drop("_n"))


def multi_agg_split(df: DataFrame, by: Sequence[str], value: str, counted: str) -> DataFrame:
    """The anti-pattern twin of :func:`multi_agg`: two groupings joined back.
    Kept only to prove equality and to show the extra Exchanges."""
    a = (df.groupBy(*by).agg(F.sum(value).alias("total"), F.count(value).alias("_n"),
                             F.count(counted).alias("n_counted"))
           .withColumn("avg_value", _avg(F.col("total"), F.col("_n"))).drop("_n"))
    b = df.groupBy(*by).agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))
    return a.join(b, list(by))


def salted_agg(df: DataFrame, by: Sequence[str], row_id: Sequence[str], value: str,
               salts: int = 16) -> DataFrame:
    """Sum / count / min / max per key through ``(key, salt)`` partials.

    The salt is ``pmod(xxhash64(row id), salts)``: deterministic (retries and
    reruns agree) and spreads a hot key over ``salts`` reducers in the first
    stage. The key keeps its type (the salt is a separate column).
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in row_id]), F.lit(salts))
    partial = (df.withColumn("_salt", salt)
                 .groupBy(*by, "_salt")
                 .agg(F.sum(value).alias("_s"), F.count(value).alias("_c"),
                      F.min(value).alias("_mn"), F.max(value).alias("_mx")))
    return (partial.groupBy(*by)
                   .agg(F.sum("_s").alias("total"), F.sum("_c").alias("n"),
                        F.min("_mn").alias("min_value"), F.max("_mx").alias("max_value")))


def plain_agg(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Naive twin of :func:`salted_agg` (the oracle for it)."""
    return (df.groupBy(*by)
              .agg(F.sum(value).alias("total"), F.count(value).alias("n"),
                   F.min(value).alias("min_value"), F.max(value).alias("max_value")))


def nested_total(df: DataFrame, by: Sequence[str], items: str, price: str = "unit_price",
                 qty: str = "qty", keep_empty: bool = False, out: str = "total",
                 acc_type: str = "bigint") -> DataFrame:
    """sum(price * qty) over exploded nested items per group.

    ``keep_empty`` uses ``explode_outer`` so groups whose arrays are all
    empty/NULL survive with total 0 (the RDD twin's semantics)."""
    ex = F.explode_outer(items) if keep_empty else F.explode(items)
    rows = df.select(*by, ex.alias("_it"))
    line = (F.col("_it")[price] * F.col("_it")[qty]).cast("decimal(38,0)" if acc_type == "bigint" else acc_type)
    # summed in DECIMAL(38,0): only a final total beyond the output type could fail
    return (rows.groupBy(*by)
                .agg(F.coalesce(F.sum(line), F.lit(0)).cast(acc_type).alias(out)))


def nested_total_hof(df: DataFrame, by: Sequence[str], items: str, price: str = "unit_price",
                     qty: str = "qty", out: str = "total", acc_type: str = "bigint") -> DataFrame:
    """Same as :func:`nested_total` (keep_empty) without exploding: each
    array is folded in place by ``aggregate()``, so no row multiplication
    reaches the shuffle."""
    zero = F.lit(0).cast(acc_type)
    fold = F.aggregate(F.coalesce(F.col(items), F.array()), zero,
                       lambda acc, it: (acc + it[price] * it[qty]).cast(acc_type))
    wide = "decimal(38,0)" if acc_type == "bigint" else acc_type
    return (df.select(*by, fold.alias("_t"))
              .groupBy(*by).agg(F.sum(F.col("_t").cast(wide)).cast(acc_type).alias(out)))


def daily_kpis(df: DataFrame, day: str, user: str, amount: str, qty: str,
               exact: bool = True) -> DataFrame:
    """count(*), distinct users, sums and averages per day. ``exact=False`` swaps
    the distinct count for HyperLogLog (no Expand, bounded state)."""
    users = F.count_distinct(user) if exact else F.approx_count_distinct(user)
    return (df.groupBy(day)
              .agg(F.count("*").alias("orders"), users.alias("users"),
                   F.sum(amount).alias("revenue"), F.sum(qty).alias("qty"),
                   _avg(F.sum(amount), F.count(amount)).alias("avg_amount"),
                   _avg(F.sum(qty), F.count(qty)).alias("avg_qty")))


def sales_mart(df: DataFrame, t: Column, grain: str, by: Sequence[str], amount: str,
               qty: str) -> DataFrame:
    """Sales per ``grain`` (``date_trunc`` unit) and dimension columns."""
    return (df.withColumn("period", F.date_trunc(grain, t))
              .groupBy("period", *by)
              .agg(F.count("*").alias("lines"), F.sum(amount).alias("revenue"),
                   F.sum(qty).alias("qty")))


def purchase_funnel(df: DataFrame, user: str, t: str, kind: str, tie: str,
                    steps: Sequence[str]) -> DataFrame:
    """Ordered funnel: per user the first time of step 1, then the first time
    of step k strictly after (by ``(t, tie)``) the reached step k-1.

    Per-user reductions only (``min`` of structs over the user's events
    after the previous step), chained by left joins into one row per user
    with the time of every step reached; all steps are then counted in one
    aggregate. No window over a whole user history.
    Result: one row per step with users reaching it and the conversion
    from the previous step and from step 1.
    """
    ev = df.select(F.col(user).alias("_u"), F.struct(F.col(t), F.col(tie)).alias("_k"),
                   F.col(kind).alias("_kind"))
    chain = (ev.where(F.col("_kind") == steps[0]).groupBy("_u")
               .agg(F.min("_k").alias("_at1")))
    for i, s in enumerate(steps[1:], start=2):
        after = ev.where(F.col("_kind") == s).select("_u", F.col("_k").alias("_next"))
        chain = (chain.join(after, (chain["_u"] == after["_u"]) & (F.col("_next") > F.col(f"_at{i - 1}")), "left")
                      .groupBy(chain["_u"]).agg(*[F.min(f"_at{j}").alias(f"_at{j}") for j in range(1, i)],
                                                F.min("_next").alias(f"_at{i}")))
    reached = [F.struct(F.lit(i).alias("step"), F.lit(s).alias("name"), F.col(f"_n{i}").alias("users"))
               for i, s in enumerate(steps, start=1)]
    out = (chain.agg(*[F.count(f"_at{i}").alias(f"_n{i}") for i in range(1, len(steps) + 1)])
                .select(F.explode(F.array(*reached)).alias("r")).select("r.*"))
    # conversion on the per-step counts (one row per step: a tiny frame)
    from pyspark.sql import Window
    w = Window.orderBy("step")
    prev, first = F.lag("users").over(w), F.first("users").over(w)
    return (out.withColumn("conv_from_prev", F.when(prev > 0, F.col("users") / prev))
               .withColumn("conv_from_first", F.when(first > 0, F.col("users") / first)))
