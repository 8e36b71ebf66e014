"""Session construction and shared-folder helpers.

Every job in the library takes a ``SparkSession``; this module only builds
one for tests / the bench and resolves the shared scratch folder that jobs
use for written intermediates (never a machine-local folder on a cluster).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Session settings every job relies on (UTC wall clock, adaptive execution).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partitions sized to fit executor memory: scans split at 128 MB, AQE
    # coalesces / splits shuffle partitions towards 128 MB
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # cp1251 session logs are decoded with decode(..., 'windows-1251').
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, app: str = "souk",
              shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's base settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def sizing_conf(total_cores: int, shuffle_bytes: int, target_bytes: int = 128 << 20) -> dict:
    """Initial shuffle partitions for a cluster: enough for ~``target_bytes``
    per partition of the largest shuffle and at least two waves of tasks.
    AQE then coalesces small partitions and splits skewed ones at runtime.

    >>> sizing_conf(4000, 100 << 40)["spark.sql.shuffle.partitions"]
    '819200'
    """
    parts = max(2 * total_cores, -(-shuffle_bytes // target_bytes))
    return {"spark.sql.shuffle.partitions": str(parts),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts)}


# Session key remembering the fallback folder of local runs. Spark refuses
# runtime changes of ``spark.checkpoint.dir`` itself, so it is only read.
_SCRATCH_KEY = "souk.scratch.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is only read here.
    When it is unset in a ``local`` session (tests) a private folder is
    created once, remembered in the session under ``souk.scratch.dir`` and
    registered as the checkpoint folder of the context; on a cluster a
    missing setting is an error, since executors share no local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_SCRATCH_KEY, None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="souk-ckpt-")
        spark.conf.set(_SCRATCH_KEY, d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "souk-work", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back: later
    steps share one result and no executor's loss costs more than its tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's setting that removes a query's shuffle files once it has ended
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession, free: bool = True) -> Iterator[None]:
    """What is written here has its shuffle files removed once it is written;
    else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(FREE, None)
    if free:
        spark.conf.set(FREE, "true")
    try:
        yield
    finally:
        if free and before is None:
            spark.conf.unset(FREE)
        elif free:
            spark.conf.set(FREE, before)
