"""Structured Streaming operators.

Sources are file streams (a directory per topic; Kafka when its connector is
present - see :func:`kafka_available`). Event time is cast to ``timestamp``
(watermarks reject TIMESTAMP_NTZ); the session time zone is UTC.

Sinks are idempotent: :func:`versioned_batch_sink` writes every micro-batch
to its own ``batch_id=<n>`` directory with overwrite, so a retried batch
replaces its own output; readers take the latest version per key
(:func:`read_latest`). That makes update-mode results (windows still open
at the end, sessions that grow) exact without waiting for the watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from souk.operators.incremental import latest_by_key
from souk.session import scratch_path


def kafka_available(spark: SparkSession) -> bool:
    from souk.sources.io import format_available
    return format_available(spark, "kafka")


# ------------------------------------------------------------------ input

def topic_stream(spark: SparkSession, topic: str, schema, bootstrap: str | None = None,
                 root: str | None = None, files_per_trigger: int = 1) -> DataFrame:
    """Read a topic as a stream of typed rows.

    With a bootstrap server and the Kafka connector on the classpath the
    topic is read from Kafka and the JSON value parsed with ``schema``;
    otherwise the topic is the directory ``root/topic`` of Parquet files."""
    if bootstrap and kafka_available(spark):
        raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
               .option("subscribe", topic).option("startingOffsets", "earliest").load())
        return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("v")).select("v.*")
    return file_stream(spark, f"{root.rstrip('/')}/{topic}", schema, files_per_trigger)


def write_topic(df: DataFrame, topic: str, key: str, ckpt: str, bootstrap: str | None = None,
                root: str | None = None) -> StreamingQuery:
    """Write a stream to a topic (Kafka JSON values keyed by ``key`` when
    available, else Parquet files under ``root/topic``)."""
    if bootstrap and kafka_available(df.sparkSession):
        out = df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
        w = (out.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
             .option("topic", topic).option("checkpointLocation", ckpt).trigger(availableNow=True))
        return run_to_end(w.start())
    return run_to_end(start_available_now(df, ckpt, path=f"{root.rstrip('/')}/{topic}"))


def stage_chunks(df: DataFrame, path: str, chunk: Column, chunks: int, files: int = 1) -> str:
    """Write ``df`` as ordered appends, rows of ``chunk`` 0 first (NULL counts
    as 0, so no row is lost), for a file stream to replay with
    ``maxFilesPerTrigger = files``. The table is read once and written by
    chunk; each append then reads its own chunk's folder only and is written
    by ``files`` tasks, dealt round robin."""
    parts = scratch_path(df.sparkSession, "stream-chunks")
    df.withColumn("_chunk", F.coalesce(chunk, F.lit(0)).cast("int")).write.partitionBy("_chunk").parquet(parts)
    staged = df.sparkSession.read.parquet(parts)
    for i in range(chunks):
        staged.where(F.col("_chunk") == i).select(*df.columns).repartition(files).write.mode("append").parquet(path)
    return path


def stage_stream_input(df: DataFrame, path: str, t: str, chunks: int, files: int = 1) -> str:
    """:func:`stage_chunks` by time: ``chunks`` equal spans of days, rows
    without a time in the first."""
    return stage_chunks(df, path, time_chunk(df, t, chunks), chunks, files)


def time_chunk(df: DataFrame, t: str, chunks: int) -> Column:
    """The number of the span of days, of ``chunks`` equal ones, that a row is in."""
    day = F.col(t).cast("date")
    lo, hi = df.agg(F.min(day), F.max(day)).first()
    span = (hi - lo).days + 1 if lo else 1
    return F.floor(F.datediff(day, F.lit(lo).cast("date")) * chunks / span)


#: rows that one file of a staged chunk has at least
FILE_ROWS = 250_000


def files_per_chunk(df: DataFrame, t: str, chunks: int, rows: int = FILE_ROWS) -> int:
    """Files, and so tasks, for each chunk of :func:`stage_stream_input`: as
    many as the smallest chunk has ``rows``, at least 1. A stream that takes
    so many files per trigger gets one chunk a batch, for every file has rows."""
    sizes = df.groupBy(F.coalesce(time_chunk(df, t, chunks), F.lit(0)).alias("_chunk")).agg(F.count(F.lit(1)).alias("n"))
    n, least = sizes.agg(F.count(F.lit(1)), F.min("n")).first()
    return max(1, least // rows) if n == chunks else 1


#: rows of its largest table that a batch of a stream with much state gets about
BATCH_ROWS = 4_000_000


def chunks_by_rows(dfs: Sequence[DataFrame], least: int, rows: int = BATCH_ROWS) -> int:
    """Chunks, alike for all ``dfs``, of about ``rows`` of the largest one,
    at least ``least``: the state has the rows of a batch beside those that
    the watermark has not passed, so batches must not grow with the tables."""
    return max(least, *[-(-df.count() // rows) for df in dfs])


def close_stream_input(spark: SparkSession, path: str, schema, t: str, key: str, key_value,
                       after: str, steps: int = 2, also: dict | None = None, files: int = 1) -> None:
    """Append ``steps`` heartbeat rows (key ``key_value``) far after the data,
    each once in ``files`` files, so that a stream that takes so many per
    trigger gets one step a batch.

    In append mode a window or session is emitted only once the watermark
    has passed it, and the watermark is set from the previous batch; two
    heartbeat batches move it beyond every real event so all results are
    final. Readers drop the heartbeat key. ``also`` gives values of further
    columns, which are NULL else: a join's key columns need one, since Spark
    filters rows with a NULL key before it looks at their time."""
    also = also or {}
    for i in range(1, steps + 1):
        row = (spark.range(1) if files == 1 else spark.range(0, files, numPartitions=files)).select(*[
            (F.lit(key_value) if f.name == key
             else (F.lit(after).cast(f.dataType) + F.expr(f"INTERVAL {i * 30} DAYS")) if f.name == t
             else F.lit(also.get(f.name))).cast(f.dataType).alias(f.name) for f in schema.fields])
        row.write.mode("append").parquet(path)


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def with_event_time(df: DataFrame, t: str = "ts", out: str = "event_time",
                    delay: str = "1 hour") -> DataFrame:
    return df.withColumn(out, F.col(t).cast("timestamp")).withWatermark(out, delay)


# ------------------------------------------------------------------ sinks

def versioned_batch_sink(path: str, transform: Callable[[DataFrame], DataFrame] | None = None):
    """foreachBatch function: ``path/batch_id=<id>`` overwritten per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, None if nothing was written there yet; any other
    failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _snapshots(spark: SparkSession, path: str) -> DataFrame | None:
    return _read_if_there(spark, f"{path}_snapshots")


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Final state of a versioned sink: latest batch per key. With a
    compacted snapshot (:func:`compact_versioned_sink`) only the newest
    snapshot and the batches after it are read."""
    batches = spark.read.parquet(path)
    snaps = _snapshots(spark, path)
    if snaps is not None:
        upto = snaps.agg(F.max("upto")).scalar()
        newest = snaps.where(F.col("upto") == upto).drop("upto")
        batches = newest.unionByName(batches.where(F.col("batch_id") > upto))
    return latest_by_key(batches, keys, "batch_id").drop("batch_id")


def compact_versioned_sink(spark: SparkSession, path: str, keys: Sequence[str], upto: int) -> None:
    """Fold batches ``<= upto`` (and the previous snapshot) into a new
    snapshot folder ``<path>_snapshots/upto=<upto>``; later readers skip the
    folded batches. Written to a new folder, so a failed compaction leaves
    the previous state readable."""
    batches = spark.read.parquet(path)
    snaps = _snapshots(spark, path)
    src = batches.where(F.col("batch_id") <= upto)
    if snaps is not None:
        last = snaps.agg(F.max("upto")).scalar()
        src = (snaps.where(F.col("upto") == last).drop("upto")
                    .unionByName(batches.where((F.col("batch_id") > last) & (F.col("batch_id") <= upto))))
    latest_by_key(src, keys, "batch_id").write.mode("overwrite").parquet(f"{path}_snapshots/upto={upto}")


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Block until an ``availableNow`` query has drained its input."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def default_state_partitions(spark: SparkSession) -> int:
    """State-store partitions for a new stateful query: the cluster's total
    cores (every task slot holds one state partition)."""
    return max(2, spark.sparkContext.defaultParallelism)


#: state on the executors' disks, within one bound of memory for all stores of an
#: executor; without it Spark keeps all state in their heap
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a count of rows that nothing here reads costs a lookup per write
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def start_available_now(df: DataFrame, ckpt: str, sink=None, mode: str = "append",
                        path: str | None = None, fmt: str = "parquet",
                        partition_by: Sequence[str] = (),
                        state_partitions: int | None = None, state: dict[str, str] | None = None) -> StreamingQuery:
    """Start a query that drains the available input and stops.

    ``state_partitions`` fixes the number of state-store partitions of a new
    stateful query (it is recorded in the checkpoint at the first start);
    ``state`` are settings of its state stores, such as :data:`DISK_STATE`.
    The stream runs on a clone of the session taken at ``start()``, so the
    settings are applied only around the start and restored afterwards.
    """
    spark = df.sparkSession
    settings = dict(state or {})
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        w = df.writeStream.option("checkpointLocation", ckpt).outputMode(mode).trigger(availableNow=True)
        if sink is not None:
            return w.foreachBatch(sink).start()
        if partition_by:
            w = w.partitionBy(*partition_by)
        return w.format(fmt).start(path)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# -------------------------------------------------------------- operators

def stream_ingest(stream: DataFrame, ok: Column, reason: Column, bronze: str, bad: str,
                  ckpt: str) -> StreamingQuery:
    """stream -> bronze; rows failing ``ok`` -> quarantine with a reason.
    One foreachBatch, two writes from the persisted batch, both idempotent
    per batch id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn("_ok", F.coalesce(ok, F.lit(False))).persist()
        try:
            b.where("_ok").drop("_ok").write.mode("overwrite").parquet(f"{bronze}/batch_id={batch_id}")
            (b.where("NOT _ok").drop("_ok").withColumn("reason", reason)
              .write.mode("overwrite").parquet(f"{bad}/batch_id={batch_id}"))
        finally:
            b.unpersist()
    return run_to_end(start_available_now(stream, ckpt, sink=write))


def stream_ingest_late_policy(stream: DataFrame, t: str, delay_seconds: int, out: str,
                              hwm: str, ckpt: str) -> StreamingQuery:
    """Explicit late-data policy: a row is late when its event time is more
    than ``delay_seconds`` behind the high-water mark (max event time of all
    earlier batches). Every batch is written once to
    ``out/batch_id=<n>/status=on_time|late`` (late rows are quarantined,
    never silently lost). The high-water mark is one cumulative row per
    batch in ``hwm``; everything is keyed by batch id, so a retried batch
    reproduces the same split."""
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        marks = _read_if_there(spark, hwm)
        prev = marks.where(F.col("batch_id") < batch_id).agg(F.max("max_ts")).first()[0] if marks else None
        if prev is None:
            is_late = F.lit(False)
        else:
            cutoff = F.lit(prev).cast("timestamp") - F.make_dt_interval(secs=F.lit(delay_seconds))
            is_late = F.col(t).cast("timestamp") < cutoff
        b = batch.persist()
        try:
            (b.withColumn("status", F.when(is_late, "late").otherwise("on_time"))
              .write.mode("overwrite").partitionBy("status").parquet(f"{out}/batch_id={batch_id}"))
            cur = b.agg(F.max(F.col(t).cast("timestamp"))).first()[0]
            top = max([x for x in (prev, cur) if x is not None], default=None)
            (spark.range(1).select(F.lit(top).cast("timestamp").alias("max_ts"))
                  .write.mode("overwrite").parquet(f"{hwm}/batch_id={batch_id}"))
        finally:
            b.unpersist()
    return run_to_end(start_available_now(stream, ckpt, sink=write))


def route_topics(df: DataFrame, rules: dict[str, tuple[str, str]], kind: str,
                 default: tuple[str, str]) -> DataFrame:
    """Event kind -> (topic, key column). Adds ``topic`` and ``key``; which
    partition of the topic a key goes to is the broker's business."""
    topic = key = None
    for k, (tp, kc) in rules.items():
        cond = F.col(kind) == k
        topic = F.when(cond, tp) if topic is None else topic.when(cond, tp)
        key = F.when(cond, F.col(kc)) if key is None else key.when(cond, F.col(kc))
    topic, key = topic.otherwise(default[0]), key.otherwise(F.col(default[1]))
    return df.withColumn("topic", topic).withColumn("key", key.try_cast("bigint"))


def stream_dedup(stream: DataFrame, keys: Sequence[str], t: str, delay: str) -> DataFrame:
    """At-least-once input -> one row per key, state kept for ``delay``."""
    return with_event_time(stream, t, "event_time", delay).dropDuplicatesWithinWatermark(list(keys))


def stream_sessions(stream: DataFrame, user: str, t: str, gap: str, delay: str) -> DataFrame:
    """Session windows (gap-based) per user with event counts."""
    s = with_event_time(stream, t, "event_time", delay)
    return (s.groupBy(F.col(user), F.session_window("event_time", gap).alias("s"))
             .agg(F.count("*").alias("events"))
             .select(user, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                     "events"))


def stream_metrics(stream: DataFrame, t: str, by: Sequence[str], window: str,
                   slide: str | None = None, delay: str = "1 hour",
                   value: str | None = None) -> DataFrame:
    """Counts (and sums) per tumbling (or sliding) window and key."""
    s = with_event_time(stream, t, "event_time", delay)
    w = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    aggs = [F.count("*").alias("n")]
    if value:
        aggs.append(F.sum(F.col(value).cast("decimal(12,2)")).cast("decimal(22,2)").alias("total"))
    return (s.groupBy(w.alias("w"), *by).agg(*aggs)
             .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                     *[a for a in ("n", "total") if a == "n" or value]))


def stream_order_join(left: DataFrame, right: DataFrame, key: str, lt: str, rt: str,
                      within_days: int, delay: str) -> DataFrame:
    """Stream-stream inner join by key with ``lt <= rt <= lt + within``;
    both sides watermarked so join state is bounded by the time bound."""
    l = with_event_time(left, lt, "l_time", delay)
    r = with_event_time(right.withColumnRenamed(key, "_rkey"), rt, "r_time", delay)
    cond = ((F.col(key) == F.col("_rkey")) & (F.col("r_time") >= F.col("l_time"))
            & (F.col("r_time") <= F.col("l_time") + F.expr(f"INTERVAL {within_days} DAYS")))
    return l.join(r, cond, "inner").drop("_rkey")


def stream_lifecycle(purchases: DataFrame, deliveries: DataFrame, refunds: DataFrame, key: str, line: str,
                     t: tuple[str, str, str], within_days: int, delay: str) -> DataFrame:
    """Purchases with their delivered lines and each line's refund, as two
    chained left outer stream-stream joins: purchase -> delivery on ``key``,
    then -> refund on ``(key, line)``, each within ``within_days`` after the
    purchase (``t``: the three streams' time columns).

    A purchase without delivery and a delivered line without refund are held
    in state and given out once, with NULLs, when the watermark has passed
    the last time a partner could have; so the state of both joins is bounded
    by the time bound, and every purchase leaves the chain. A line is
    refunded at most once, so the joins do not multiply rows.
    """
    p = with_event_time(purchases, t[0], "p_time", delay)
    d = with_event_time(deliveries.select(F.col(key).alias("_dkey"), F.col(line), F.col(t[1]).alias("delivery_ts"), "status"), "delivery_ts", "d_time", delay)
    r = with_event_time(refunds.select(F.col(key).alias("_rkey"), F.col(line).alias("_rline"), F.col(t[2]).alias("refund_ts")), "refund_ts", "r_time", delay)
    bound = F.col("p_time") + F.expr(f"INTERVAL {within_days} DAYS")
    near = lambda x: (F.col(x) >= F.col("p_time")) & (F.col(x) <= bound)
    first = p.join(d, (F.col(key) == F.col("_dkey")) & near("d_time"), "left_outer").drop("_dkey", "d_time")
    both = first.join(r, (F.col(key) == F.col("_rkey")) & (F.col(line) == F.col("_rline")) & near("r_time"), "left_outer")
    return both.drop("_rkey", "_rline", "r_time", "p_time")


def stream_ledger(query: StreamingQuery, read: str = "rows_in") -> list[tuple]:
    """``(batch_id, rows_in, late, duplicates)`` of every batch of a drained
    query, from its progress: rows that were read (an observed metric named
    ``read`` if the stream has one, else what the sources report), rows that
    a stateful operator dropped behind the watermark, and duplicates dropped.

    Counts are rows only for operators that see rows (dedup, joins);
    aggregations combine rows before the state and report combined rows. The
    session keeps ``spark.sql.streaming.numRecentProgressUpdates`` batches; a
    query with more of them is an error here, not a short ledger.
    """
    progress = [p for p in query.recentProgress if p["numInputRows"] or p["stateOperators"]]
    out: dict[int, list[int]] = {}
    for p in progress:
        seen = (p.get("observedMetrics") or {}).get(read)
        row = out.setdefault(p["batchId"], [0, 0, 0])
        row[0] += seen[0] if seen is not None else p["numInputRows"]
        for op in p["stateOperators"]:
            row[1] += op["numRowsDroppedByWatermark"]
            row[2] += op["customMetrics"].get("numDroppedDuplicateRows", 0)
    last = max(out, default=-1)
    if len(out) != last + 1:
        raise RuntimeError(f"progress of {last + 1 - len(out)} batches is gone; raise spark.sql.streaming.numRecentProgressUpdates")
    return [(i, *out[i]) for i in sorted(out)]


def stream_dedup_counted(stream: DataFrame, keys: Sequence[str], t: str, delay: str, path: str, ckpt: str,
                         state_partitions: int | None = None) -> DataFrame:
    """:func:`stream_dedup` into ``path/data`` whose lost rows are counted:
    the ledger ``batch_id, rows_in, late, duplicates, rows_out`` is written to
    ``path/ledger`` and returned, and per run rows_in = rows_out + late +
    duplicates, or this raises. Rows out are counted from the data written."""
    spark = stream.sparkSession
    query = run_to_end(start_available_now(stream_dedup(stream, keys, t, delay), ckpt, sink=versioned_batch_sink(f"{path}/data"),
                                           state_partitions=state_partitions))
    schema = "batch_id bigint, rows_in bigint, late bigint, duplicates bigint"
    counted = spark.createDataFrame(stream_ledger(query), schema)   # one row per batch: small
    written = spark.read.parquet(f"{path}/data").groupBy(F.col("batch_id").cast("bigint").alias("batch_id")).agg(F.count("*").alias("rows_out"))
    ledger = counted.join(written, "batch_id", "left").withColumn("rows_out", F.coalesce("rows_out", F.lit(0).cast("bigint")))
    ledger.coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger")
    ledger = spark.read.parquet(f"{path}/ledger")
    off = ledger.where("rows_in <> rows_out + late + duplicates")
    if not off.isEmpty():
        raise RuntimeError(f"rows unaccounted for: {off.first()}")
    return ledger


def co_viewed_pairs(df: DataFrame, session: Sequence[str], item: str, t: str, tie: str,
                    block_seconds: int = 86400) -> DataFrame:
    """Products viewed one right after the other in the same session,
    counted as unordered pairs. Adjacent pairs only (the next view), so the
    output is bounded by the number of views - never all pairs of a group.
    The next view is a reversed blocked prefix scan (no per-session sort of
    a whole session in one task)."""
    from souk.operators.windows import prefix_scan
    micros = F.unix_micros(F.col(t).cast("timestamp"))
    rev = df.select(*session, F.col(item).alias("_a"), (-micros).alias("_nt"), (-F.col(tie)).alias("_ntie"))
    nxt = prefix_scan(rev, list(session), F.floor(F.col("_nt") / (block_seconds * 1_000_000)),
                      ["_nt", "_ntie"], lasts={"_b": F.col("_a")})
    pairs = nxt.where(F.col("_b").isNotNull() & (F.col("_a") != F.col("_b")))
    return (pairs.select(F.least("_a", "_b").alias("item_a"), F.greatest("_a", "_b").alias("item_b"))
                 .groupBy("item_a", "item_b").agg(F.count("*").alias("co_views")))


def burst_users(df: DataFrame, user: str, t: str, per: str, k: int) -> DataFrame:
    """Users with more than ``k`` events inside one ``per`` window (rate rule)."""
    return (df.groupBy(user, F.window(F.col(t).cast("timestamp"), per).alias("w"))
              .agg(F.count("*").alias("n"))
              .where(F.col("n") > k)
              .select(user, F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n"))
