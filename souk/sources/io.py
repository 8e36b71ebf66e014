"""Readers, writers and storage inventory.

All functions take and return DataFrames; nothing is collected to the
driver. Formats that need a jar that is not on the classpath (Avro, Kafka)
are feature-detected by :func:`format_available`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.session import shuffles_freed

TEXT_FORMATS = {"csv", "json"}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver tables (Parquet, schema from the footers)."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None,
               options: dict | None = None) -> DataFrame:
    """Read ``path`` in ``fmt``; text formats get ``schema`` so nothing is inferred.

    CSV is read with a header and a tab separator (the layout the writers
    below produce); JSON is line-delimited.
    """
    r = spark.read.format(fmt)
    opts = dict(options or {})
    if fmt == "csv":
        opts.setdefault("header", "true")
        opts.setdefault("sep", "\t")
    if schema is not None:
        r = r.schema(schema)
    return r.options(**opts).load(path)


def normalise_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every column named in ``schema`` to its type (after CSV/JSON reads).

    ``try_cast``: a malformed value becomes NULL (for the completeness /
    validity checks to report) instead of failing the whole job under ANSI.
    """
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def format_available(spark: SparkSession, fmt: str) -> bool:
    """True when a data source for ``fmt`` resolves on this classpath.

    Probes by reading a path that does not exist: a missing source fails with
    DATA_SOURCE_NOT_FOUND, a present one with a missing-path error.
    """
    if fmt in {"parquet", "orc", "csv", "json", "text", "noop", "binaryFile"}:
        return True
    try:
        spark.read.format(fmt).load("/souk-format-probe-does-not-exist")
    except Exception as e:  # noqa: BLE001 - classification by message
        msg = str(e)
        return not ("DATA_SOURCE_NOT_FOUND" in msg or "Failed to find data source" in msg)
    return True


def write_formats(df: DataFrame, outdir: str, formats: list[str], files: int | None = None,
                  mode: str = "overwrite") -> dict[str, str]:
    """Write one source into several formats.

    By default every task writes its own file, so the write is as parallel as
    its input; ``files`` narrows it to so many (a choice for small tables: the
    upstream work of a ``coalesce`` runs in as many tasks). Parquet/ORC use
    snappy, CSV is tab-separated with a header. Unavailable formats are skipped.
    The source is computed once: with Parquet among several formats, that is
    written first, its shuffle files go, and the others are written from its
    files (not when adding to a folder, whose older rows are not the source's).
    Returns ``{format: path}`` of what was written.
    """
    spark = df.sparkSession
    able = [fmt for fmt in formats if format_available(spark, fmt)]
    once = len(able) > 1 and "parquet" in able and mode == "overwrite"
    schema, written = df.schema, {}
    for fmt in sorted(able, key=lambda f: f != "parquet") if once else able:
        path = f"{outdir.rstrip('/')}/{fmt}"
        w = (df if files is None else df.coalesce(files)).write.mode(mode).format(fmt)
        if fmt in {"parquet", "orc"}:
            w = w.option("compression", "snappy")
        if fmt == "csv":
            w = w.option("header", "true").option("sep", "\t")
        # what follows reads the Parquet files only
        with shuffles_freed(spark, once and fmt == "parquet"):
            w.save(path)
        written[fmt] = path
        if once and fmt == "parquet":
            df = spark.read.schema(schema).parquet(path)
    return {fmt: written[fmt] for fmt in able}


def storage_inventory(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Bytes and data files per named directory, computed by a file listing job.

    Uses the ``binaryFile`` source without reading ``content`` (only the
    metadata columns are projected, so file bodies are never loaded).
    """
    frames = []
    for name, path in paths.items():
        listing = (spark.read.format("binaryFile")
                   .option("recursiveFileLookup", "true")
                   .load(path)
                   .select("path", "length")
                   .where(~F.regexp_like(F.col("path"), F.lit(r"(^|/)[._][^/]*$"))))
        frames.append(listing.select(F.lit(name).alias("format"), "length"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return (out.groupBy("format")
            .agg(F.count("*").alias("files"), F.sum("length").alias("bytes")))


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite",
                      fmt: str = "parquet", writers_per_value: int = 8) -> None:
    """Partitioned write, rows clustered by the partition columns first so
    each partition directory gets few files. A deterministic salt (hash of
    the row, so a retried task writes the same rows) spreads every partition
    value over up to ``writers_per_value`` tasks: a hot value is not written
    by one task."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(writers_per_value))
    (df.repartition(*[F.col(c) for c in by], salt)
       .write.mode(mode).format(fmt).partitionBy(*by).save(path))


def write_bucketed(df: DataFrame, name: str, by: list[str], buckets: int, path: str) -> DataFrame:
    """Write ``df`` as an external table bucketed (and sorted) by ``by``.

    Two tables bucketed by the same keys into the same number of buckets are
    joined / aggregated on those keys without an Exchange on either side
    (co-located). The files live at ``path`` (a shared folder); the session
    catalog only holds the bucket spec. Returns the table.
    """
    (df.write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by)
       .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def split_quarantine(df: DataFrame, ok: Column, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, quarantined); bad rows keep a reason, none dropped.

    ``ok`` NULL counts as bad. The two frames share one lineage; persist the
    input when both are written.
    """
    flag = F.coalesce(ok, F.lit(False))
    good = df.where(flag)
    bad = df.where(~flag).withColumn("reason", reason)
    return good, bad


def key_skew_profile(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """Top-``k`` keys by row count with their share of all rows.

    Counts are one partial/final aggregate; the total is a scalar subquery
    (its own small job), so no window spans the whole table.
    """
    total = df.agg(F.count("*")).scalar()
    counts = df.groupBy(key).agg(F.count("*").alias("rows"))
    return (counts.orderBy(F.col("rows").desc(), F.col(key)).limit(k)
            .select(key, "rows",
                    F.round(F.col("rows") * 100.0 / total, 2).alias("share_pct")))
