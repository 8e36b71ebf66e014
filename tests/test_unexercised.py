"""Options that no registered query passes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from souk.functions.scalar import mask_digits, mask_email, safe_ratio
from souk.session import ensure_checkpoint_dir, scratch_path
from souk.streaming import streams as K


def test_masks_and_ratio(spark):
    df = spark.createDataFrame([("jane@example.com", 4.0, 2.0), ("no mail 12", 1.0, 0.0), (None, 1.0, None)], "s string, a double, b double")
    got = df.select(mask_email(F.col("s")).alias("m"), mask_digits(F.col("s")).alias("d"), safe_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [tuple(r) for r in got] == [("j***@example.com", "jane@example.com", 2.0), ("no mail 12", "no mail **", None), (None, None, None)]


def test_sliding_windows(spark, tmp_path):
    at = [dt.datetime(2024, 1, 1, 0, m) for m in (0, 14, 16, 45)]
    spark.createDataFrame([(t, "a") for t in at], "ts timestamp, k string").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = K.file_stream(spark, f"{tmp_path}/in", "ts timestamp, k string")
    m = K.stream_metrics(stream, "ts", ["k"], "30 minutes", slide="15 minutes")
    K.run_to_end(K.start_available_now(m, f"{tmp_path}/ckpt", sink=K.versioned_batch_sink(f"{tmp_path}/out"), mode="update"))
    got = {(r.window_start, r.n) for r in K.read_latest(spark, f"{tmp_path}/out", ["window_start", "k"]).collect()}
    want = {}
    for t in at:
        for back in (0, 15):
            start = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=t.minute // 15 * 15 - back)
            want[start] = want.get(start, 0) + 1
    assert got == set(want.items())


def test_rows_without_time_are_staged(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 1)), (2, None), (3, dt.datetime(2024, 1, 9))]
    df = spark.createDataFrame(rows, "id int, ts timestamp")
    K.stage_stream_input(df, f"{tmp_path}/in", "ts", 3)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/in").collect()) == [1, 2, 3]
    K.stage_stream_input(df.where("ts IS NULL"), f"{tmp_path}/none", "ts", 2)
    assert spark.read.parquet(f"{tmp_path}/none").count() == 1


def test_only_a_missing_path_counts_as_missing(spark, tmp_path):
    assert K._read_if_there(spark, f"{tmp_path}/nothing") is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark says of a broken file, it is said
        K._read_if_there(spark, f"{tmp_path}/broken").collect()


def test_shared_folder_is_required_on_a_cluster(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Cluster())
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_min_max_normalisation(spark):
    from souk.operators.score import normalise_component
    rows = [("a", 1, 1.0), ("a", 2, 3.0), ("a", 3, 2.0), ("b", 4, 5.0), ("b", 5, 5.0), (None, 6, 0.0), (None, 7, 4.0), ("a", 8, None)]
    df = spark.createDataFrame(rows, "g string, i int, x double")
    got = {r.i: r.n for r in normalise_component(df, "x", ["g"], "n", method="min-max").collect()}
    assert got == {1: 0.0, 2: 1.0, 3: 0.5, 4: None, 5: None, 6: 0.0, 7: 1.0, 8: None}


def test_nested_total_keeps_empty_groups(spark):
    from souk.operators.aggregates import nested_total
    df = spark.createDataFrame([(1, [(5, 2), (1, 1)]), (2, []), (3, None)], "k int, items array<struct<unit_price: bigint, qty: int>>")
    assert {r.k: r.total for r in nested_total(df, ["k"], "items", keep_empty=True).collect()} == {1: 11, 2: 0, 3: 0}
    assert {r.k: r.total for r in nested_total(df, ["k"], "items").collect()} == {1: 11}
