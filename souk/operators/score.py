"""Transparent composite score.

Components are normalised inside their peer group (z-score over a window
partitioned by the peer columns), combined with fixed weights, optionally
renormalised when a component is missing, explained per component and
tracked over semesters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.operators.windows import beside_quantiles, rank_in_groups
from souk.session import written


def normalise_components(df: DataFrame, cols: dict[str, str], peers: Sequence[str], method: str = "z",
                         digits: int = 6) -> DataFrame:
    """z-scores (or min-max) inside the peer group, ``cols`` being ``{new
    column: raw column}``; NULL when the spread is 0 or undefined.

    The peers' statistics of all columns are one aggregate (combined before
    the shuffle) and one join, however many columns there are: a peer group
    of any size is never gathered in one task."""
    key = F.struct(*[F.col(p) for p in peers])      # NULL peers are one group
    aggs = []
    for o, c in cols.items():
        aggs += ([F.avg(c).alias(f"_a_{o}"), F.stddev_samp(c).alias(f"_b_{o}")] if method == "z"
                 else [F.min(c).alias(f"_a_{o}"), F.max(c).alias(f"_b_{o}")])
    stats = df.groupBy(key.alias("_peers")).agg(*aggs)

    def val(o: str, c: str) -> Column:
        x, a, b = F.col(c), F.col(f"_a_{o}"), F.col(f"_b_{o}")
        return F.when(b > 0, (x - a) / b) if method == "z" else F.when(b > a, (x - a) / (b - a))

    names = [c for c in df.columns if c not in cols]
    return (df.withColumn("_peers", key).join(stats, "_peers")
              .select(*names, *[F.round(val(o, c), digits).alias(o) for o, c in cols.items()]))


def normalise_component(df: DataFrame, col: str, peers: Sequence[str], out: str | None = None,
                        method: str = "z", digits: int = 6) -> DataFrame:
    """:func:`normalise_components` of one column."""
    return normalise_components(df, {out or f"z_{col}": col}, peers, method, digits)


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def composite_score(df: DataFrame, weights: dict[str, float], partial: bool = False,
                    out: str = "score", digits: int | None = None) -> DataFrame:
    """``sum(w * x)``; with ``partial`` missing components are left out and
    the remaining weights renormalised (``is_complete`` flags the row).
    Not rounded by default: weighted sums of rounded components land on
    exact half-way digits, where rounding modes of engines disagree."""
    if not partial:
        expr = None
        for c, w in weights.items():
            term = F.lit(w) * F.col(c)
            expr = term if expr is None else expr + term
        return df.withColumn(out, _round(expr, digits))
    num = den = None
    for c, w in weights.items():
        t = F.coalesce(F.lit(w) * F.col(c), F.lit(0.0))
        d = F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(F.lit(0.0))
        num, den = (t, d) if num is None else (num + t, den + d)
    complete = F.lit(True)
    for c in weights:
        complete = complete & F.col(c).isNotNull()
    return (df.withColumn(out, _round(F.when(den > 0, num / den), digits))
              .withColumn("is_complete", complete))


def valid_responses(df: DataFrame, group: Sequence[str], student: str, value: str,
                    order: Sequence[str], lo: float, hi: float) -> DataFrame:
    """Per group: responses after one-per-student dedup, valid ones (inside
    ``[lo, hi]`` and inside quartiles +- 1.5 IQR of the group) and the share.
    Quartiles are exact and found by :func:`beside_quantiles`, so a group of
    any size is counted, not gathered. The responses are written once: they
    are read for the groups' sizes and again for the verdict. Groups with a
    NULL key or without a value have no row."""
    order = list(order)
    if value in order:      # what comes after the value decides between equal values only, and is not read
        order = order[:order.index(value) + 1]
    # sorted by student first, who tells most rows apart
    w = Window.partitionBy(student, *group).orderBy(*order)
    # the first is the one without a row before it: a limit on a row number
    # would sort all rows before the shuffle too, and most students respond once
    one = df.withColumn("_before", F.lag(F.lit(True)).over(w)).where("_before IS NULL").select(*group, value)
    one = beside_quantiles(written(one, "responses"), group, value, {"_q1": 0.25, "_q3": 0.75})
    iqr = F.col("_q3") - F.col("_q1")
    ok = (F.col(value).between(lo, hi) & (F.col(value) >= F.col("_q1") - 1.5 * iqr)
          & (F.col(value) <= F.col("_q3") + 1.5 * iqr))
    return (one.groupBy(*group)
               .agg(F.count("*").alias("responses"), F.count(F.when(ok, 1)).alias("valid"))
               .withColumn("share_valid", F.col("valid") / F.col("responses")))


def score_ranking(df: DataFrame, peers: Sequence[str], score: str, share: str,
                  min_share: float = 0.8, tie: Sequence[str] = ()) -> DataFrame:
    """Rank by score inside the peer group; rows with too few valid
    responses are flagged and get no rank. The rows are written once: the
    ranked and the flagged ones are read from there."""
    df = written(df, "scored")
    flagged = F.col(share) < min_share
    eligible = df.where(~flagged)
    ranked = rank_in_groups(eligible, peers, score, tie, "rank", fn="rank").withColumn("flagged", F.lit(False))
    rest = (df.where(flagged).withColumn("rank", F.lit(None).cast("bigint"))
              .withColumn("flagged", F.lit(True)))
    return ranked.unionByName(rest)


def score_explain(df: DataFrame, keys: Sequence[str], weights: dict[str, float],
                  raw: dict[str, str], peers: Sequence[str], digits: int = 6) -> DataFrame:
    """One row per component: weight, normalised value, contribution and the
    raw gap to the peer-group mean (unpivot via explode of a struct array)."""
    key = F.struct(*[F.col(p) for p in peers])
    means = df.groupBy(key.alias("_peers")).agg(*[F.avg(rcol).alias(f"_m_{comp}") for comp, rcol in raw.items()])
    withmeans = df.withColumn("_peers", key).join(means, "_peers")
    items = F.array(*[F.struct(F.lit(comp).alias("component"), F.lit(wt).alias("weight"),
                               F.col(comp).alias("value"), F.col(raw[comp]).alias("raw"),
                               F.col(f"_m_{comp}").alias("peer_mean"))
                      for comp, wt in weights.items()])
    e = withmeans.select(*keys, F.explode(items).alias("c"))
    return e.select(*keys, "c.component", "c.weight", "c.value",
                    (F.col("c.weight") * F.col("c.value")).alias("contribution"),
                    F.round(F.col("c.raw") - F.col("c.peer_mean"), digits).alias("gap_to_peers"))


def score_history(df: DataFrame, entity: Sequence[str], period: str, score: str,
                  digits: int | None = None) -> DataFrame:
    """Score per period with the change against the entity's previous period."""
    w = Window.partitionBy(*entity).orderBy(period)
    return df.withColumn("change", _round(F.col(score) - F.lag(score).over(w), digits))

