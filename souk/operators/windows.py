"""Window, top-k and set operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.session import written


def topn_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int,
                   rank_col: str = "rn") -> DataFrame:
    """First ``n`` rows per group by ``order`` (must end in a unique tie-break).

    Written as ``row_number() <= n`` so Catalyst inserts a WindowGroupLimit
    before the Exchange: at most ``n`` rows per group and map partition are
    shuffled, whatever the group size.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
              .where(F.col(rank_col) <= n))


def topn_groups(df: DataFrame, outer: Sequence[str], inner: Sequence[str], value: str,
                n: int) -> DataFrame:
    """Top ``n`` inner groups by ``sum(value)`` inside each outer group:
    aggregate first (partial aggregation shrinks the data), then rank."""
    agg = df.groupBy(*outer, *inner).agg(F.sum(value).alias("total"))
    order = [F.col("total").desc()] + [F.col(c) for c in inner]
    return topn_per_group(agg, outer, order, n)


def multi_window(df: DataFrame, by: Sequence[str], value: str, order: Sequence[Column]) -> DataFrame:
    """Row number within the group plus group total and average, all over the
    same partitioning: one Exchange, two Window nodes (ordered + unordered)."""
    w_ord = Window.partitionBy(*by).orderBy(*order)
    w_all = Window.partitionBy(*by)
    return df.select("*",
                     F.row_number().over(w_ord).cast("bigint").alias("rn"),
                     F.sum(value).over(w_all).alias("group_total"),
                     F.when(F.count(value).over(w_all) > 0,
                            F.sum(value).over(w_all).cast("double") / F.count(value).over(w_all))
                      .alias("group_avg"))


def prefix_scan(df: DataFrame, keys: Sequence[str], block: Column, order: Sequence[str],
                sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None,
                inclusive: bool = False, partitions: int | None = None) -> DataFrame:
    """Running sums and last non-NULL values per key in ``order``, computed
    in bounded blocks so that no task has to sort a whole (possibly hot) key.

    ``block`` must be monotone in ``order`` (e.g. ``lineno div 100000`` or an
    hour bucket of the time). Three steps:

    1. the scan inside every ``(key, block)`` window (bounded groups);
    2. one summary row per block (block sum, block's last non-NULL value)
       and a carry per block: the scan over the summaries of the earlier
       blocks of the key (one row per block, small);
    3. the carry joined back on ``(key, block)`` - the same columns the
       in-block window is partitioned by, so the big side is not reshuffled.

    ``inclusive`` includes the current row. Sums over no row are 0.
    ``partitions`` deals the blocks to so many tasks, whatever the session's
    number of shuffle partitions.
    """
    sums, lasts = sums or {}, lasts or {}
    b, gk = "_blk", "_gk"
    # the key as one struct column: struct equality treats NULL fields as
    # equal, so a NULL key is one group in the window, the summaries and the
    # join alike, and all three use the same (struct, block) partitioning
    d = df.withColumn(gk, F.struct(*[F.col(k) for k in keys])).withColumn(b, block)
    if partitions:
        d = d.repartition(partitions, gk, b)
    w = Window.partitionBy(gk, b).orderBy(*order).rowsBetween(Window.unboundedPreceding,
                                                               0 if inclusive else -1)
    for o, c in sums.items():
        d = d.withColumn(f"_v_{o}", c).withColumn(f"_s_{o}", F.sum(f"_v_{o}").over(w))
    for o, c in lasts.items():
        d = d.withColumn(f"_v_{o}", c).withColumn(f"_l_{o}", F.last(f"_v_{o}", ignorenulls=True).over(w))
    pos = F.struct(*[F.col(c) for c in order])
    summary = d.groupBy(gk, b).agg(
        *[F.sum(f"_v_{o}").alias(f"_bs_{o}") for o in sums],
        *[F.max_by(F.col(f"_v_{o}"), F.when(F.col(f"_v_{o}").isNotNull(), pos)).alias(f"_bl_{o}") for o in lasts])
    wb = Window.partitionBy(gk).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(gk, b,
                           *[F.sum(f"_bs_{o}").over(wb).alias(f"_cs_{o}") for o in sums],
                           *[F.last(f"_bl_{o}", ignorenulls=True).over(wb).alias(f"_cl_{o}") for o in lasts])
    j = d.join(carry, [gk, b], "left")
    outs = ([(F.coalesce(F.col(f"_s_{o}"), F.lit(0)) + F.coalesce(F.col(f"_cs_{o}"), F.lit(0))).alias(o)
             for o in sums]
            + [F.coalesce(F.col(f"_l_{o}"), F.col(f"_cl_{o}")).alias(o) for o in lasts])
    helper = [c for c in j.columns if c.startswith(("_v_", "_s_", "_l_", "_cs_", "_cl_")) or c in (b, gk)]
    return j.select(*[c for c in j.columns if c not in helper], *outs)


def in_order(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` dealt out by ranges of ``order`` and written, with ``_blk``: the
    range's number. Every range is a bounded part of the rows, whatever its
    keys; only rows equal in all of ``order`` must stay together."""
    return written(df.repartitionByRange(*order).withColumn("_blk", F.spark_partition_id()), "in-order")


def rank_in_groups(df: DataFrame, keys: Sequence[str], value: str, tie: Sequence[str],
                   out: str = "rn", fn: str = "row_number") -> DataFrame:
    """``row_number`` / ``rank`` by ``value`` descending, NULLs last (then
    ``tie``) per group, NULL keys being one group, without sorting a hot group
    in one task.

    The rows are dealt out by ranges of (group, value, tie), so a large group,
    a value that most of its rows share, or its NULLs lie in several ranges;
    the window runs per group and range and adds the rows of the group's
    earlier ranges. The same path is taken at every size. ``rank`` is the
    least row number of the rows with the same value and ties.
    """
    names = df.columns
    d = df.withColumn("_gk", F.struct(*[F.col(k) for k in keys]))
    order = [F.col(value).desc_nulls_last(), *[F.col(c) for c in tie]]
    # a rank's ties are split by the row's hash, so that they need not fit one range
    spread = [F.xxhash64(*[F.col(c) for c in names])] if fn == "rank" else []
    d = in_order(d, ["_gk", *order, *spread])
    w = Window.partitionBy("_gk", "_blk").orderBy(*order, *spread)
    sizes = d.groupBy("_gk", "_blk").agg(F.count("*").alias("_size"))
    wb = Window.partitionBy("_gk").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = sizes.select("_gk", "_blk", F.coalesce(F.sum("_size").over(wb), F.lit(0)).alias("_carry"))
    numbered = (d.withColumn("_local", F.row_number().over(w)).join(carry, ["_gk", "_blk"])
                 .withColumn("_no", (F.col("_local") + F.col("_carry")).cast("bigint")))
    if fn == "row_number":
        return numbered.select(*names, F.col("_no").alias(out))
    same = F.struct("_gk", *[F.col(c) for c in [value, *tie]])
    first = numbered.groupBy(same.alias("_same")).agg(F.min("_no").alias(out))
    return numbered.withColumn("_same", same).join(first, "_same").select(*names, out)


def multi_window_skew_safe(df: DataFrame, by: Sequence[str], value: str, tie: Sequence[str]) -> DataFrame:
    """:func:`multi_window` for groups of any size: the group total and
    average come from an aggregate joined back (partial aggregation, AQE
    splits a hot group on the join) and the row number from
    :func:`rank_in_groups`."""
    gk = F.struct(*[F.col(k) for k in by]).alias("_tk")     # NULL-safe group key
    totals = df.groupBy(gk).agg(F.sum(value).alias("group_total"), F.count(value).alias("_cnt"))
    ranked = rank_in_groups(df, by, value, tie, "rn").withColumn(
        "_tk", F.struct(*[F.col(k) for k in by]))
    return (ranked.join(totals, "_tk").drop("_tk")
                  .withColumn("group_avg", F.when(F.col("_cnt") > 0,
                                                  F.col("group_total").cast("double") / F.col("_cnt")))
                  .drop("_cnt"))


def time_block(t: str, seconds: int = 3600) -> Column:
    """Monotone block id from a timestamp: whole ``seconds`` since the epoch."""
    return F.floor(F.unix_seconds(F.col(t).cast("timestamp")) / seconds).cast("bigint")


def sessionize(df: DataFrame, user: str, t: str, tie: str, gap_seconds: int = 1800) -> DataFrame:
    """Session number per user: a new session starts when the silence since
    the previous event exceeds ``gap_seconds`` (exactly the gap stays in) or
    is unknown because one of the two times is NULL.

    A segmented scan over ranges of equal row count: the rows are dealt out
    by ranges of (user, time, tie), so that a user with a third of all rows,
    or a burst of them within one second, lies in many ranges. Each (user,
    range) is numbered by itself and summed up in one row: its first and last
    time and the sessions that begin inside it. Two such summaries compose
    (does the gap between them begin a session, and how many sessions came
    before), so a scan over a user's summaries gives every range its carry.
    """
    names = df.columns
    d = in_order(df.withColumn("_gk", F.struct(F.col(user))), ["_gk", F.col(t), F.col(tie)])
    w = Window.partitionBy("_gk", "_blk").orderBy(t, tie)
    at = F.unix_micros(F.col(t).cast("timestamp"))
    far = lambda a, b: F.coalesce(F.col(b) - F.col(a) > F.lit(gap_seconds * 1_000_000), F.lit(True))
    d = d.withColumn("_t", at).withColumn("_i", F.row_number().over(w)).withColumn("_p", F.lag("_t").over(w))
    begins = F.when((F.col("_i") > 1) & far("_p", "_t"), 1).otherwise(0)
    d = d.withColumn("_inner", F.sum(begins).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # the summaries come from the numbered rows: first and last row of a range
    ends = d.groupBy("_gk", "_blk").agg(
        F.max(F.when(F.col("_i") == 1, F.col("_t"))).alias("_first"), F.max_by("_t", "_i").alias("_last"),
        F.max("_inner").alias("_starts"))
    wb = Window.partitionBy("_gk").orderBy("_blk")
    ends = ends.withColumn("_before", F.lag("_last").over(wb))
    ends = ends.withColumn("_head", F.when(far("_before", "_first"), 1).otherwise(0))
    carry = ends.select("_gk", "_blk", (F.sum(F.col("_head") + F.col("_starts")).over(wb) - F.col("_starts")).alias("_carry"))
    return d.join(carry, ["_gk", "_blk"]).select(*names, (F.col("_inner") + F.col("_carry")).alias("session_no"))


#: values of a group that a window puts in order; larger groups are
#: counted: bins of a histogram per open interval, and histograms before what
#: is left of the intervals is put in order
QUANTILE_VALUES, QUANTILE_BINS, QUANTILE_ROUNDS = 4096, 1024, 2


def beside_quantiles(df: DataFrame, group: Sequence[str], value: str, probs: dict[str, float],
                     collected: int = QUANTILE_VALUES) -> DataFrame:
    """``df``, which is stored, with its group's exact quantiles (those of
    :func:`group_quantiles`) in each row. Rows with a NULL key and groups
    without a value are left out.

    The rows of groups of at most ``collected`` rows are shuffled and sorted
    once, by a window that also has the quantiles; what is then grouped by
    ``group`` needs no further shuffle. The other groups are joined with
    :func:`group_quantiles`."""
    x = F.col(value).cast("double")
    d = df.dropna(subset=list(group))
    many = d.groupBy(*group).agg(F.count("*").alias("_n")).where(F.col("_n") > collected).select(*group)
    many = written(many, "quantile-groups")
    none = many.isEmpty()
    w = Window.partitionBy(*group)
    few = d if none else d.join(many, list(group), "left_anti")
    few = few.withColumn("_x", F.when(~F.isnan(x), x))
    few = few.withColumn("_i", F.row_number().over(w.orderBy(F.col("_x").asc_nulls_last())) - 1).withColumn("_n", F.count("_x").over(w))
    place = {o: F.lit(float(p)) * (F.col("_n") - 1) for o, p in probs.items()}
    value_at = lambda c: F.max(F.when(F.col("_i") == c, F.col("_x"))).over(w)
    few = few.where("_n > 0").select(*df.columns, *[value_at(f(c)).alias(f"{k}_{o}") for o, c in place.items() for k, f in (("_lo", F.floor), ("_hi", F.ceil))], "_n")
    part = {o: c - F.floor(c) for o, c in place.items()}
    few = few.select(*df.columns, *[(F.col(f"_lo_{o}") * (1 - part[o]) + F.col(f"_hi_{o}") * part[o]).alias(o) for o in probs])
    if none:
        return few
    large = d.join(many, list(group), "left_semi")
    return few.unionByName(large.join(group_quantiles(large, group, value, probs), list(group)).select(few.columns))


def group_quantiles(df: DataFrame, group: Sequence[str], value: str, probs: dict[str, float],
                    bins: int = QUANTILE_BINS, rounds: int = QUANTILE_ROUNDS, collected: int = QUANTILE_VALUES,
                    stored: bool = False) -> DataFrame:
    """Exact interpolated quantiles per group, ``probs`` being ``{column: p}``,
    by distributed selection: no group's values have to fit one task.

    Groups of at most ``collected`` values are sorted by a window; the
    others, which are few for their rows, are selected from.

    The order statistics that a group's quantiles lie between are found by
    rank. Each round counts the values of the interval that still holds a
    rank in ``bins`` equal bins (combined before the shuffle, so a group
    sends at most ``bins`` rows per task and interval) and keeps the one bin
    with the rank; values outside it are not looked at again. An interval of
    one value is decided. What is left after ``rounds`` (values of very
    uneven spread) is counted by value and put in order by ranges, at any
    size. NULL and NaN values count as missing; a group without a value has
    no row; groups with NULL keys are groups. ``df`` is written first, as it is
    read several times, unless it is ``stored`` already.
    """
    gk = F.struct(*[F.col(g) for g in group]) if group else F.struct(F.lit(1).alias("all"))
    x = F.col(value).cast("double")
    d = df.select(gk.alias("_gk"), x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    d = d if stored else written(d, "quantile-values")
    stats = d.groupBy("_gk").agg(F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    stats = written(stats.where(F.col("_n") > collected), "quantile-groups")
    names = [F.col(f"_gk.{g}").alias(g) for g in group]
    # positions in groups of bounded size, so the window's buffer is bounded too
    few = d.join(stats.select("_gk"), "_gk", "left_anti")
    few = (few.withColumn("_i", F.row_number().over(Window.partitionBy("_gk").orderBy("_x")) - 1)
              .withColumn("_n", F.count("*").over(Window.partitionBy("_gk"))))
    place = {o: F.lit(float(p)) * (F.col("_n") - 1) for o, p in probs.items()}
    value_at = lambda c: F.max(F.when(F.col("_i") == c, F.col("_x")))
    few = few.groupBy("_gk", "_n").agg(*[value_at(f(c)).alias(f"{k}_{o}") for o, c in place.items() for k, f in (("_lo", F.floor), ("_hi", F.ceil))])
    part = {o: c - F.floor(c) for o, c in place.items()}
    few = few.select(*names, *[(F.col(f"_lo_{o}") * (1 - part[o]) + F.col(f"_hi_{o}") * part[o]).alias(o) for o in probs])
    if stats.isEmpty():
        return few
    d = d.join(stats.select("_gk"), "_gk", "left_semi")
    at = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs.values()]
    ranks = F.array_distinct(F.array(*[f(c).cast("bigint") for c in at for f in (F.floor, F.ceil)]))
    zero = F.lit(0).cast("bigint")
    open_ = stats.select("_gk", F.explode(ranks).alias("_r"), "_lo", "_hi", zero.alias("_base"))
    open_, found = written(open_, "quantile-ranks"), None
    iv = ["_gk", "_lo", "_hi"]

    def within(targets: DataFrame) -> DataFrame:
        """The values of the open intervals; an interval is listed once."""
        return d.join(targets.select(*iv).distinct(), "_gk").where("_x between _lo and _hi")

    def settle(targets: DataFrame) -> DataFrame:
        done = targets.where("_lo = _hi").select("_gk", "_r", F.col("_lo").alias("_v"))
        return done if found is None else found.unionByName(done)

    def after(targets: DataFrame, counted: DataFrame, lo: str, hi: str) -> DataFrame:
        """Each rank's place among consecutive counts ``_c`` that end at ``_sum``."""
        rank = F.col("_r") - F.col("_base")
        hit = targets.join(counted, iv).where((rank < F.col("_sum")) & (rank >= F.col("_sum") - F.col("_c")))
        return hit.select("_gk", "_r", F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), (F.col("_base") + F.col("_sum") - F.col("_c")).alias("_base"))

    for _ in range(rounds):
        found, open_ = settle(open_), open_.where("_lo < _hi")
        if open_.isEmpty():
            break
        part = (F.col("_x") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)   # halves cannot overflow
        bin_ = F.least(F.floor(part * bins), F.lit(bins - 1))
        hist = within(open_).groupBy(*iv, bin_.alias("_bin")).agg(F.count("*").alias("_c"), F.min("_x").alias("_least"), F.max("_x").alias("_most"))
        hist = hist.withColumn("_sum", F.sum("_c").over(Window.partitionBy(*iv).orderBy("_bin")))
        open_ = written(after(open_, hist, "_least", "_most"), "quantile-ranks")
    else:
        found, open_ = settle(open_), open_.where("_lo < _hi")
        if not open_.isEmpty():
            counted = within(open_).groupBy(*iv, "_x").agg(F.count("*").alias("_c"))
            found = settle(after(open_, running_total(counted, iv, "_x", "_c", "_sum"), "_x", "_x"))
    v = stats.select("_gk", "_n", F.explode(F.array(*[F.struct(F.lit(o).alias("o"), c.alias("at")) for o, c in zip(probs, at, strict=True)])).alias("q"))
    lo, hi = F.floor("q.at").cast("bigint"), F.ceil("q.at").cast("bigint")
    v = v.select("_gk", "q.o", (F.col("q.at") - lo).alias("part"), lo.alias("lo"), hi.alias("hi"))
    low, high = found.toDF("_gk", "lo", "v_lo"), found.toDF("_gk", "hi", "v_hi")
    v = v.join(low, ["_gk", "lo"]).join(high, ["_gk", "hi"])
    mid = F.col("v_lo") * (1 - F.col("part")) + F.col("v_hi") * F.col("part")
    out = v.groupBy("_gk").agg(*[F.max(F.when(F.col("o") == o, mid)).alias(o) for o in probs])
    return few.unionByName(out.select(*names, *probs))


def running_total(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """``df`` with the running sum of ``value`` per group in ``order``, its
    own row included, over ranges as in :func:`rank_in_groups`."""
    d = in_order(df.withColumn("_rk", F.struct(*[F.col(k) for k in keys])), ["_rk", F.col(order)])
    w = Window.partitionBy("_rk", "_blk").orderBy(order)
    wb = Window.partitionBy("_rk").orderBy("_blk")
    sums = d.groupBy("_rk", "_blk").agg(F.sum(value).alias("_all"))
    carry = sums.select("_rk", "_blk", (F.sum("_all").over(wb) - F.col("_all")).alias("_carry"))
    d = d.withColumn("_local", F.sum(value).over(w)).join(carry, ["_rk", "_blk"])
    return d.select(*df.columns, (F.col("_local") + F.col("_carry")).alias(out))


def topk(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k (TakeOrderedAndProject: k rows per partition, then merge)."""
    return df.orderBy(*order).limit(k)


def reconcile(actual: DataFrame, control: DataFrame, keys: Sequence[str], measure: str,
              tolerance: float = 0.001) -> DataFrame:
    """Compare per-key counts and sums of ``measure`` against a control summary.

    Full outer join of the two aggregates: keys missing on either side and
    relative differences above ``tolerance`` are flagged.
    """
    a = actual.groupBy(*keys).agg(F.count("*").alias("actual_rows"),
                                  F.sum(measure).alias("actual_sum"))
    c = control.groupBy(*keys).agg(F.count("*").alias("control_rows"),
                                   F.sum(measure).alias("control_sum"))
    j = a.join(c, list(keys), "full_outer")
    diff = F.abs(F.coalesce("actual_sum", F.lit(0)) - F.coalesce("control_sum", F.lit(0)))
    rel = F.when(F.coalesce("control_sum", F.lit(0)) != 0,
                 diff.cast("double") / F.abs(F.col("control_sum")).cast("double"))
    status = (F.when(F.col("actual_rows").isNull(), "missing")
               .when(F.col("control_rows").isNull(), "extra")
               .when((F.col("actual_rows") != F.col("control_rows"))
                     | (F.coalesce(rel, F.lit(0.0)) > tolerance), "mismatch")
               .otherwise("ok"))
    return j.withColumn("status", status)


#: key buckets whose digests are compared before any row is
DIFFERENCE_BUCKETS = 4096


def row_difference(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                   buckets: int = DIFFERENCE_BUCKETS) -> DataFrame:
    """Rows that the two sides do not hold equally often, with ``left_rows``
    and ``right_rows``: ``exceptAll`` both ways in one frame.

    Each side is reduced to a digest per bucket of keys that does not depend
    on the order of rows: their number and the sums of two independent hashes
    of each row. Only buckets whose digests differ are read again and
    compared, row values being counted on both sides with one aggregation, so
    two tables that agree but for a few keys cost two scans and a shuffle of
    those keys' buckets. NULLs equal NULLs. ``columns`` (default: all of
    ``left``) must be of types that can be grouped; the others are not
    compared. Two buckets of different rows have equal digests with a
    probability of about 2^-128.
    """
    names = list(columns or left.columns)
    names += [k for k in keys if k not in names]
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).alias("_bucket")
    cols = [F.col(f"`{c}`") for c in names]

    def rows(df: DataFrame) -> DataFrame:
        return df.select(bucket, *cols)

    def digest(df: DataFrame, side: str) -> DataFrame:
        h = [F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(20, 0)")).alias(f"_{side}{seed}") for seed in (1, 2)]
        return rows(df).groupBy("_bucket").agg(F.count("*").alias(f"_{side}0"), *h)

    both = digest(left, "l").join(digest(right, "r"), "_bucket", "full_outer")
    same = F.lit(True)
    for i in range(3):
        same = same & F.col(f"_l{i}").eqNullSafe(F.col(f"_r{i}"))
    # at most one row per bucket: a table of fixed size
    differ = F.broadcast(written(both.where(~same).select("_bucket"), "differing-buckets"))
    sides = [rows(d).join(differ, "_bucket", "left_semi").select(*cols, F.lit(a).alias("_l"), F.lit(1 - a).alias("_r")) for d, a in ((left, 1), (right, 0))]
    counted = sides[0].unionByName(sides[1]).groupBy(*cols).agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))
    return counted.where("left_rows <> right_rows")
