"""Join operators.

Strategy is Catalyst's to choose unless asked otherwise; an explicit
broadcast is only issued behind a check of the plan's size estimate.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.scalar import dedup_by_key
from souk.operators.windows import prefix_scan
from souk.session import written

# Largest dimension we broadcast on request, by the plan's own size estimate.
MAX_BROADCAST_BYTES = 256 << 20


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan (no job is run)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def join_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column,
             how: str = "left", strategy: str = "adaptive",
             max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join a fact to a dimension.

    * ``merge``     - force a shuffled sort-merge join (hint ``merge``);
    * ``broadcast`` - broadcast ``dim`` if the plan's size estimate is at most
      ``max_broadcast_bytes``; a larger one is joined by the adaptive plan,
      with a warning;
    * ``adaptive``  - no hint: static size threshold plus AQE's runtime
      conversion to broadcast / skew splitting decide.
    """
    if strategy not in {"merge", "broadcast", "adaptive", "auto"}:
        raise ValueError(f"unknown join strategy {strategy}")
    if strategy == "merge":
        return fact.join(dim.hint("merge"), on, how)
    if strategy == "broadcast":
        size = plan_bytes(dim)
        if size <= max_broadcast_bytes:
            return fact.join(F.broadcast(dim), on, how)
        warnings.warn(f"dimension of about {size} bytes is not broadcast (limit {max_broadcast_bytes})", stacklevel=2)
    return fact.join(dim, on, how)


def enrich_star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, Sequence[str]]],
                strategy: str = "adaptive") -> DataFrame:
    """Chain of left joins fact -> dims. Each dimension is reduced to one
    row per key first (deterministic survivor: smallest values), so the
    enrichment never multiplies fact rows."""
    out = fact
    for dim, key, cols in dims:
        one = dedup_by_key(dim.select(key, *cols), [key], [F.col(c).asc_nulls_last() for c in cols])
        out = join_dim(out, one, key, "left", strategy)
    return out


# A range is spread over at most SPREAD + 1 buckets of its level; the buckets
# of a level are SPREAD times as wide as those of the level below.
SPREAD = 16


def interval_join(points: DataFrame, ranges: DataFrame, point_key: Sequence[str],
                  value: str, lo: str, hi: str, bucket_width: int,
                  how: str = "left", hi_inclusive: bool = True) -> DataFrame:
    """Exact range join ``lo <= value <= hi`` (or ``< hi``) as an equi-join.

    Every range gets the lowest level whose buckets (``bucket_width * 16^level``
    wide) cover it with at most 17, and is exploded into those; every point is
    looked up once per level up to the highest in use (a scalar subquery over
    the ranges). The two are equi-joined on ``(point_key..., level, bucket)``
    and the range predicate is applied after. Exact for any overlap pattern;
    no cross product, a wide range is not multiplied without bound, and a hot
    key is spread over its buckets (AQE splits what remains skewed). A left
    join keeps each point without a range once.
    """
    b = F.lit(bucket_width)
    count = F.floor(F.col(hi) / b) - F.floor(F.col(lo) / b) + 1
    level = F.greatest(F.lit(0), F.ceil(F.log(float(SPREAD), F.greatest(count, F.lit(1)).cast("double")) - F.lit(1.0 + 1e-9))).cast("int")
    r = ranges.where(F.col(lo).isNotNull() & F.col(hi).isNotNull() & (F.col(lo) <= F.col(hi))).withColumn("_l", level)
    top = r.agg(F.max("_l")).first()[0] or 0
    wide = lambda n: F.pow(F.lit(float(SPREAD)), n).cast("bigint") * b
    r = r.withColumn("_b", F.explode(F.sequence(F.floor(F.col(lo) / wide(F.col("_l"))), F.floor(F.col(hi) / wide(F.col("_l"))))))
    p = points.withColumn("_l", F.explode(F.sequence(F.lit(0), F.lit(top)))) if top else points.withColumn("_l", F.lit(0))
    p = p.withColumn("_b", F.floor(F.col(value) / wide(F.col("_l"))))
    cond = [p[k] == r[k] for k in point_key] + [p["_l"] == r["_l"], p["_b"] == r["_b"]]
    upper = (p[value] <= r[hi]) if hi_inclusive else (p[value] < r[hi])
    cond += [p[value] >= r[lo], upper]
    own = [c for c in ranges.columns if c not in point_key]
    joined = p.join(r, cond, how if top == 0 else "inner").select(*[p[c] for c in points.columns], *[r[c] for c in own])
    if top == 0 or how != "left":
        return joined
    # with several levels a point has several rows, most without a partner: the
    # points without any are those whose key and value never matched
    key = F.struct(*[F.col(c) for c in [*point_key, value]])
    seen = joined.select(key.alias("_seen")).distinct()
    alone = points.join(seen, key.eqNullSafe(F.col("_seen")), "left_anti")
    return joined.unionByName(alone, allowMissingColumns=True)


#: rows of facts and changes that one task puts in order
ASOF_ROWS = 500_000


def asof_join(facts: DataFrame, changes: DataFrame, key: str, t: str, eff: str,
              values: Sequence[str], bucket_days: int = 366, tie: Sequence[str] = (),
              rows_per_task: int = ASOF_ROWS) -> DataFrame:
    """Values of ``changes`` in effect at each fact's time: of the same key the
    change with the greatest ``eff <= t``, to the microsecond (left semantics:
    NULL if none). Of changes at the same time the one with the greatest
    ``tie`` columns, then the greatest values, counts, so reruns agree.

    Facts and changes are put into one sequence per key, by time, changes
    first, and the last change before each fact is carried forward by a
    blocked prefix scan: no interval table, no explode, facts are read once
    and a hot key is spread over its time blocks. The sequence is written and
    counted first, and dealt to as many tasks as it has ``rows_per_task``, so
    that a task's memory does not grow with the tables. NULL keys and times
    match nothing. Returns the fact's columns, ``values`` and ``eff``.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    # fields by number: a column may be wanted twice, names need not differ
    numbered = lambda names: F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    fact, got, order = numbered(facts.columns), numbered([*values, eff]), numbered([*tie, *values])
    c = changes.where(F.col(key).isNotNull() & F.col(eff).isNotNull()).select(
        F.col(key).alias("_k"), micros(eff).alias("_t"), F.lit(0).alias("_fact"), order.alias("_tie"), got.alias("_got"))
    f = facts.select(F.col(key).alias("_k"), micros(t).alias("_t"), F.lit(1).alias("_fact"), fact.alias("_row"))
    both = written(c.unionByName(f, allowMissingColumns=True), "asof-rows")
    parts = max(1, -(-both.count() // rows_per_task))
    scanned = prefix_scan(both, ["_k"], F.floor(F.col("_t") / (bucket_days * 86_400_000_000)), ["_t", "_fact", "_tie"],
                          lasts={"_now": F.col("_got")}, partitions=parts)
    return scanned.where("_fact = 1").select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(facts.columns)],
                                             *[F.col(f"_now.c{i}").alias(c) for i, c in enumerate([*values, eff])])


def fk_violations(df: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Rows of ``df`` whose key has no partner in ``dim`` (left anti join)."""
    return df.join(dim, on, "left_anti")


def order_lifecycle(purchases: DataFrame, refunds: DataFrame, deliveries: DataFrame,
                    key: str, t: str) -> DataFrame:
    """One row per purchased order: purchase fields, the first refund time,
    the last delivery time and its status. Each side is reduced to one row
    per key before the join (partial aggregation map-side), so the joins are
    1:1 and cannot multiply rows."""
    first_refund = refunds.groupBy(key).agg(F.min(t).alias("first_refund_ts"),
                                            F.count("*").alias("refund_lines"))
    last_delivery = (deliveries.groupBy(key)
                     .agg(F.max_by(F.struct(F.col(t), F.col("status")),
                                   F.struct(F.col(t), F.col("status"))).alias("_d"))
                     .select(key, F.col("_d")[t].alias("last_delivery_ts"),
                             F.col("_d")["status"].alias("last_delivery_status")))
    return (purchases.join(first_refund, key, "left")
                     .join(last_delivery, key, "left"))
