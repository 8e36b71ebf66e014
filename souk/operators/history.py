"""State as of any version or date, and rewrites of touched partitions only
(SURVEY 2.J1, 2.J7).

A history is a folder of validity intervals ``[valid_from, valid_to)``, built
batch by batch from a change log. ``closed/batch=n`` holds the intervals that
batch n has closed and is never written again; ``open/batch=n`` holds the
last row of every key after batch n, deletes too. A lookup filters both by
range, which Parquet answers from its statistics; the log is not read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.operators.incremental import OP_DELETE, latest_by_key, merge_on_read
from souk.operators.windows import in_order
from souk.session import written


def _with_next(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with ``valid_to``: the ``valid_from`` of the key's next row.

    The rows are dealt out by ranges of (key, valid_from), so a key with a
    third of all changes lies in many ranges; the last row of a (key, range)
    takes the first ``valid_from`` of the key's next range.
    """
    names = rows.columns
    others = [c for c in names if c not in keys and c != "valid_from"]
    d = rows.withColumn("_gk", F.struct(*keys)).withColumn("_at", F.struct("valid_from", *others))
    d = in_order(d, ["_gk", "_at"])
    heads = d.groupBy("_gk", "_blk").agg(F.min("valid_from").alias("_head"))
    later = F.lead("_head").over(Window.partitionBy("_gk").orderBy("_blk"))
    heads = heads.select("_gk", "_blk", later.alias("_later"))
    near = F.lead("valid_from").over(Window.partitionBy("_gk", "_blk").orderBy("_at"))
    d = d.withColumn("_near", near).join(heads, ["_gk", "_blk"])
    return d.select(*names, F.coalesce("_near", "_later").alias("valid_to"))


def extend_history(changes: DataFrame, path: str, keys: Sequence[str], version: str, batch: int,
                   op: str = "op") -> None:
    """Add a batch of changes ``(keys..., values..., version, op)`` to the
    history at ``path``. Batches are numbered from 0 in the order of their
    versions; a batch that is run again replaces itself.

    Only the open rows of changed keys meet the changes; all other open rows
    are carried over. Of equal versions of a key the row with the greatest
    other columns counts, as in :func:`latest_by_key`; the others are valid
    for no time and are not kept. A delete closes an interval and opens none.
    Changes without a version or older than what is known of their key are
    applied to nothing and kept in ``late/batch=<n>``. A NULL key is a key.
    """
    spark = changes.sparkSession
    values = [c for c in changes.columns if c not in (*keys, version, op)]
    new = changes.select(*keys, *values, op, F.col(version).alias("valid_from"))
    gk = F.struct(*[F.col(k) for k in keys])
    if batch:
        known = spark.read.schema(new.schema).parquet(f"{path}/open/batch={batch - 1}").withColumn("_gk", gk)
        last = known.select("_gk", F.col("valid_from").alias("_known"))
    else:
        known = new.limit(0).withColumn("_gk", gk)
        last = known.select("_gk", F.col("valid_from").alias("_known")).limit(0)
    # one open row per key: the join multiplies nothing
    new = written(new.withColumn("_gk", gk).join(last, "_gk", "left"), "changes")
    late = F.col("valid_from").isNull() | F.coalesce(F.col("valid_from") < F.col("_known"), F.lit(False))
    new.where(late).drop("_gk", "_known").write.mode("overwrite").parquet(f"{path}/late/batch={batch}")
    new = new.where(~late).drop("_known")
    changed = new.select("_gk").distinct()
    seq = known.join(changed, "_gk", "left_semi").unionByName(new).drop("_gk")
    spans = written(_with_next(seq, keys), "spans")
    closed = spans.where((F.col("valid_to") > F.col("valid_from")) & ~F.col(op).eqNullSafe(F.lit(OP_DELETE)))
    (closed.repartitionByRange("valid_to", "valid_from").sortWithinPartitions("valid_to", "valid_from")
           .write.mode("overwrite").parquet(f"{path}/closed/batch={batch}"))
    same = known.join(changed, "_gk", "left_anti").drop("_gk")
    # written last: a batch counts once its open rows are there
    same.unionByName(spans.where("valid_to IS NULL").drop("valid_to")).write.mode("overwrite").parquet(f"{path}/open/batch={batch}")


def read_history(spark: SparkSession, path: str, batch: int, op: str = "op") -> DataFrame:
    """All intervals after batch ``batch``; ``valid_to`` is NULL while open."""
    open_ = spark.read.parquet(f"{path}/open/batch={batch}")
    end = open_.schema["valid_from"].dataType
    schema = T.StructType([*open_.schema.fields, T.StructField("valid_to", end), T.StructField("batch", T.IntegerType())])
    closed = spark.read.schema(schema).parquet(f"{path}/closed").where(F.col("batch") <= batch).drop("batch")
    live = open_.where(~F.col(op).eqNullSafe(F.lit(OP_DELETE))).withColumn("valid_to", F.lit(None).cast(end))
    return closed.unionByName(live)


def history_as_of(spark: SparkSession, path: str, at, batch: int, op: str = "op") -> DataFrame:
    """The rows valid at ``at`` (a version, date or time) by what was known
    after batch ``batch``. The range filter reaches both scans."""
    spans = read_history(spark, path, batch, op)
    valid = (F.col("valid_from") <= F.lit(at)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(at)))
    return spans.where(valid).drop("valid_from", "valid_to", op)


def rewrite_touched(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], cols: Sequence[str],
                    by: Sequence[str], version: str = "version", op: str = "op") -> DataFrame:
    """Apply a change layer to the table at ``path``, partitioned by ``by``
    (which are among ``cols``), rewriting the touched partitions only; returns
    these: ``by..., folder`` (NULL for a partition that is new).

    Touched are the partitions that hold a changed key now (found by a scan
    of the keys alone) and those that changed rows belong to. They are read by
    dynamic partition pruning, merged, written to the shared checkpoint folder
    and then exchanged with ``partitionOverwriteMode=dynamic``, so a row whose
    partition changes leaves its old one, and a run that fails can be run
    again. A partition that has lost all its rows is written as an empty one.
    """
    names = spark.read.parquet(path).schema
    typed = T.StructType([changes.schema[f.name] if f.name in by else f for f in names])
    base = spark.read.schema(typed).parquet(path)
    last = written(latest_by_key(changes.select(*keys, *cols, version, op), keys, version), "last-changes")
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    hit = base.select(*keys, *by, folder.alias("folder")).join(last.select(*keys), list(keys), "left_semi")
    new = last.where(~F.col(op).eqNullSafe(F.lit(OP_DELETE))).select(*by, F.lit(None).cast("string").alias("folder"))
    touched = written(hit.select(*by, "folder").unionByName(new).groupBy(*by)
                      .agg(F.max("folder").alias("folder"), F.count("*").alias("rows")), "touched-partitions")
    # equal values prune by partition; NULL is a partition of its own
    some_null = F.lit(False)
    for c in by:
        some_null = some_null | F.col(c).isNull()
    part = base.join(touched.where("rows > 0").select(*by), list(by), "left_semi")
    null_part = base.where(some_null).withColumn("_p", F.struct(*by))
    null_part = null_part.join(touched.where(some_null).select(F.struct(*by).alias("_p")), "_p", "left_semi").drop("_p")
    merged = written(merge_on_read(part.unionByName(null_part), last, keys, cols, version, op), "merged-partitions")
    (merged.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*by).parquet(path))
    left = merged.select(F.struct(*by).alias("_p")).distinct()
    emptied = (touched.where("folder IS NOT NULL").withColumn("_p", F.struct(*by))
                      .join(left, "_p", "left_anti").select("folder"))
    empty = merged.drop(*by).limit(0)
    for row in emptied.collect():                    # at most one row per touched partition
        empty.write.mode("overwrite").parquet(unquote(row["folder"]))
    return touched.select(*by, "folder")
