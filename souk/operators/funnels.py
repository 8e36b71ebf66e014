"""Ordered funnels in one pass over the events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.operators.windows import in_order

#: events that one row of a first summary covers
CHUNK = 4096


def _start(k: int, time: str) -> Column:
    """The summary of no event: from each start nothing is reached."""
    return F.array_repeat(F.array().cast(f"array<{time}>"), k)


def _then(k: int):
    """Composition: from start i the first part reaches ``i + size(a[i])``,
    from where the second part goes on."""
    def compose(a: Column, b: Column) -> Column:
        def one(times: Column, i: Column) -> Column:
            at = i + F.size(times)
            return F.when(at < k, F.concat(times, F.element_at(b, F.least(at, F.lit(k - 1)) + 1))).otherwise(times)
        return F.transform(a, one)
    return compose


def funnel_times(df: DataFrame, user: str, t: str, kind: str, tie: str, steps: Sequence[str],
                 chunk: int = CHUNK) -> DataFrame:
    """``user, times``: when each user first reached step 1, then step 2
    strictly after it (by ``(t, tie)``), and so on, as far as they came.
    Users that never reach step 1 have no row; a NULL user is one user;
    events without a time come first.

    A part of a user's events is summed up by what it does from each start:
    element i of the summary holds the times of the steps that a user who
    enters with i steps done reaches inside the part. Summaries compose in
    order, and composing is associative, so the events are read once and
    dealt out by ranges of (user, t, tie): chunks of ``chunk`` events, then
    the chunks of a range, then the ranges of a user. No step holds more than
    one of these, however many events a user has.
    """
    k, time = len(steps), df.schema[t].dataType.simpleString()
    ev = df.where(F.col(kind).isin(*set(steps))).select(
        F.struct(F.col(user).alias("user")).alias("_gk"), F.struct(F.col(t).alias("t"), F.col(tie).alias("tie")).alias("_at"),
        F.col(kind).alias("_kind"))
    d = in_order(ev, ["_gk", "_at"])
    no = F.row_number().over(Window.partitionBy("_gk", "_blk").orderBy("_at"))
    d = d.withColumn("_chunk", F.floor((no - 1) / chunk))
    names = F.array(*[F.lit(s) for s in steps])

    def event(state: Column, x: Column) -> Column:
        def one(times: Column, i: Column) -> Column:
            at = i + F.size(times)
            hit = (at < k) & (F.element_at(names, F.least(at, F.lit(k - 1)) + 1) == x["_kind"])
            return F.when(hit, F.concat(times, F.array(x["_at"]["t"]))).otherwise(times)
        return F.transform(state, one)

    fold = lambda items, step: F.aggregate(items, _start(k, time), step)
    in_turn = lambda pos, value: F.array_sort(F.collect_list(F.struct(F.col(pos).alias("_pos"), F.col(value).alias("_sum"))))
    compose = _then(k)
    part = d.groupBy("_gk", "_blk", "_chunk").agg(F.array_sort(F.collect_list(F.struct("_at", "_kind"))).alias("_ev"))
    part = part.select("_gk", "_blk", "_chunk", fold(F.col("_ev"), event).alias("_s"))
    part = part.groupBy("_gk", "_blk").agg(in_turn("_chunk", "_s").alias("_p"))
    part = part.select("_gk", "_blk", fold(F.col("_p"), lambda a, b: compose(a, b["_sum"])).alias("_s"))
    whole = part.groupBy("_gk").agg(in_turn("_blk", "_s").alias("_p"))
    times = F.element_at(fold(F.col("_p"), lambda a, b: compose(a, b["_sum"])), 1)
    return whole.select(F.col("_gk.user").alias(user), times.alias("times")).where(F.size("times") > 0)


def funnel_counts(times: DataFrame, steps: Sequence[str]) -> DataFrame:
    """``step, name, users, conv_from_prev, conv_from_first`` of
    :func:`funnel_times`: one aggregate, one row per step."""
    n = [F.count(F.when(F.size("times") >= i, 1)).alias(f"n{i}") for i in range(1, len(steps) + 1)]
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b))
    rows = [F.struct(F.lit(i).alias("step"), F.lit(s).alias("name"), F.col(f"n{i}").alias("users"),
                     (share(f"n{i}", f"n{i - 1}") if i > 1 else F.lit(None).cast("double")).alias("conv_from_prev"),
                     share(f"n{i}", "n1").alias("conv_from_first")) for i, s in enumerate(steps, start=1)]
    return times.agg(*n).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
