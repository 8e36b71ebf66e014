"""Incremental tables over plain Parquet layers.

A table is a base layer plus a change layer ``(keys..., values..., version,
op)`` with ``op`` in I / U / D. "Latest per key" is always an aggregate (the
greatest ``(version, ...)``), so a hot key crosses the shuffle as one row per
map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OP_INSERT, OP_UPDATE, OP_DELETE = "I", "U", "D"


def latest_by_key(df: DataFrame, keys: Sequence[str], version: str,
                  tie: Sequence[str] = ()) -> DataFrame:
    """One row per key: the row with the greatest ``(version, *tie)``. Of rows
    equal in these the one with the greatest other columns (in their order),
    so the result is the same on every run."""
    others = [c for c in df.columns if c not in keys]
    order = [version, *tie, *[c for c in others if c != version and c not in tie]]
    return (df.groupBy(*keys)
              .agg(F.max(F.struct(*[F.col(c) for c in order])).alias("_r"))
              .select(*keys, *[F.col("_r")[c].alias(c) for c in others]))


def merge_on_read(base: DataFrame, changes: DataFrame, keys: Sequence[str],
                  cols: Sequence[str], version: str = "version", op: str = "op") -> DataFrame:
    """Current state = base with the latest change per key applied.

    Latest-wins per key (duplicate change keys cannot multiply rows), a
    matched flag instead of ``coalesce`` (an update may set NULL), inserts
    for keys missing in the base, deletes drop the key. Updates and deletes
    are a left join of the base with the changes; inserts are the changes
    whose keys the base does not have. In both the changes are the side that
    can be broadcast (by Spark's size statistics or adaptive execution), so
    while the change layer is small the base is never shuffled.
    """
    last = latest_by_key(changes.select(*keys, *cols, version, op), keys, version)
    new = last.select(*keys, *[F.col(c).alias(f"_c_{c}") for c in cols],
                      F.col(op).alias("_op"), F.lit(True).alias("_m"))
    j = base.select(*keys, *cols).join(new, list(keys), "left")
    matched = F.coalesce(F.col("_m"), F.lit(False))
    kept = j.where(F.coalesce(F.col("_op"), F.lit("")) != OP_DELETE).select(
        *keys, *[F.when(matched, F.col(f"_c_{c}")).otherwise(F.col(c)).alias(c) for c in cols])
    known = base.select(*keys).join(last.select(*keys), list(keys), "left_semi")
    inserts = last.where(F.coalesce(F.col(op), F.lit("")) != OP_DELETE).join(known, list(keys), "left_anti")
    return kept.unionByName(inserts.select(*keys, *cols))


def full_rewrite(base: DataFrame, changes: DataFrame, keys: Sequence[str], cols: Sequence[str],
                 path: str, partition_by: Sequence[str] = (), version: str = "version",
                 op: str = "op") -> DataFrame:
    """Write the merged table to a *new* path (never the input path) and
    return it read back."""
    from souk.sources.io import write_partitioned
    merged = merge_on_read(base, changes, keys, cols, version, op)
    if partition_by:
        write_partitioned(merged, path, list(partition_by))
    else:
        merged.write.mode("overwrite").parquet(path)
    return merged.sparkSession.read.parquet(path)


def write_changes(changes: DataFrame, path: str) -> None:
    """Append a batch of changes to the change layer."""
    changes.write.mode("append").parquet(path)


def compact(merged: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Materialise the merged state as the new base; the content is unchanged,
    only the layout. Adaptive execution sizes the files by bytes
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``); ``files`` asks for
    a fixed number instead."""
    out = merged.hint("rebalance") if files is None else merged.repartition(files)
    out.write.mode("overwrite").parquet(path)
    return merged.sparkSession.read.parquet(path)


def upsert_latest(base: DataFrame, changes: DataFrame, keys: Sequence[str],
                  version: str) -> DataFrame:
    """Union of base and changes, greatest ``version`` per key wins
    (inserts included): the record-key + pre-combine-field upsert."""
    return latest_by_key(base.unionByName(changes), keys, version)


def snapshot_as_of(log: DataFrame, keys: Sequence[str], version: str, v: int,
                   op: str | None = None) -> DataFrame:
    """State as of version ``v``: changes up to ``v``, latest per key (of equal
    versions as in :func:`latest_by_key`), deletes dropped."""
    upto = log.where(F.col(version) <= v)
    last = latest_by_key(upto, keys, version)
    return last.where(F.col(op) != OP_DELETE).drop(op) if op else last


def changes_between(old: DataFrame, new: DataFrame, keys: Sequence[str],
                    cols: Sequence[str]) -> DataFrame:
    """Keys that changed between two snapshots with kind I / U / D.

    A full outer join on the keys; values are compared themselves, NULL being
    equal to NULL only, so no update can hide behind a hash. Values come from
    the new side.
    """
    values = F.struct(*[F.col(c) for c in cols])
    o = old.select(*keys, values.alias("_old"), F.lit(True).alias("_in_old"))
    n = new.select(*keys, values.alias("_new"), F.lit(True).alias("_in_new"))
    j = o.join(n, list(keys), "full_outer")
    kind = (F.when(F.col("_in_old").isNull(), OP_INSERT)
             .when(F.col("_in_new").isNull(), OP_DELETE)
             .when(~F.col("_old").eqNullSafe(F.col("_new")), OP_UPDATE))
    return (j.withColumn("change", kind).where(F.col("change").isNotNull())
             .select(*keys, "change", *[F.col(f"_new.{c}").alias(c) for c in cols]))


def cdc_apply(log: DataFrame, keys: Sequence[str], lsn: str, op: str,
              delete_ops: Sequence[str] = ("d", "D")) -> DataFrame:
    """Ordered row changes -> current state: last change per key by ``lsn``
    (log compaction), keys whose last change is a delete are dropped."""
    last = latest_by_key(log, keys, lsn)
    return last.where(~F.col(op).isin(*delete_ops)).drop(op)
