"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.session import scratch_path, shuffles_freed

#: ASCII white space: space, tab, line feed, vertical tab, form feed, return.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame`` with its DuckDB SQL, if any."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, compression: str = "snappy", free: bool = False) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back, so
    that later steps neither recompute it nor depend on any one executor.
    With ``free`` the shuffle files of the write go when it has ended."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark, free):
        df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*written: DataFrame) -> None:
    """Delete tables of :func:`materialise` that nothing reads any more: all
    that was derived from them must have been written."""
    for df in written:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where its folder is visible to
    them (local mode, a shared mount); elsewhere ship it with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def row_struct(df: DataFrame, columns: Sequence[str] | None = None, alias: str = "_row") -> Column:
    """All (or the named) columns as one struct, so that an operator's own
    columns can never clash with the caller's."""
    names = df.columns if columns is None else columns
    return F.struct(*[F.col(f"`{c}`") for c in names]).alias(alias)


def unpack(df: DataFrame, added: Sequence[str], alias: str = "_row") -> DataFrame:
    """The caller's columns again, then ``added``; an added column replaces a
    caller's column of the same name."""
    taken = {a.lower() for a in added}
    names = [f.name for f in df.schema[alias].dataType.fields if f.name.lower() not in taken]
    return df.select(*[F.col(f"{alias}.`{c}`").alias(c) for c in names], *[F.col(a) for a in added])


_HELD: dict[object, object] = {}


def held(key, make):
    """What ``make`` builds for ``key``, kept by a Python worker between tasks:
    one thing at a time, so that what an earlier operator needed is not kept
    beside what the next one does."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Let go of what :func:`held` keeps, in operators that need nothing of it."""
    _HELD.clear()


#: characters of text that one slice of a batch holds at most (or one text)
SLICE_CHARS = 4_000_000


def map_texts(df: DataFrame, text_col: str, fields, make, keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with columns that Python computes
    from whole texts, in slices.

    ``make()`` is called once per task and returns ``texts -> arrow arrays``,
    one per field of ``fields``. Only a slice of texts is in Python at a time;
    a text is never cut. NULL texts arrive as empty texts.
    """
    importable(df.sparkSession)
    added = T.StructType(fields)
    names = {f.name.lower() for f in added}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    d = df.select(*[F.col(f"`{c}`") for c in kept], text_or_empty(f"`{text_col}`").alias("_text_in"))

    def run(batches):
        fn = make()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            sizes = pc.binary_length(texts).to_pylist()
            start, held = 0, 0
            for i, n in enumerate(sizes):
                if held and held + n > SLICE_CHARS:
                    yield from part(fn, batch, start, i)
                    start, held = i, 0
                held += n
            if start < len(sizes):
                yield from part(fn, batch, start, len(sizes))

    def part(fn, batch, start, end):
        b = batch.slice(start, end - start)
        arrays = fn(b.column(b.num_columns - 1).to_pylist())
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], *arrays], names=[*kept, *[f.name for f in added]])

    schema = T.StructType([*[df.schema[c] for c in kept], *added])
    return d.mapInArrow(run, schema)
