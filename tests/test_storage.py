from pyspark.sql import functions as F

from pitchside.sources import storage


def test_materialize_once_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(200).select(F.col("id").alias("v"), (F.col("id") % 2).alias("p"))

    old_scope = storage.BUILD_SCOPE
    storage.BUILD_SCOPE = f"test-{tmp_path.name}"
    try:
        inputs = [str(tmp_path / "input")]
        path = storage.materialize_once(spark, "t", inputs, build, partition_by=["p"])
        again = storage.materialize_once(spark, "t", inputs, build, partition_by=["p"])
    finally:
        storage.BUILD_SCOPE = old_scope
    assert path == again and len(calls) == 1
    assert spark.read.parquet(path).count() == 200


def test_bucket_count_follows_data_volume():
    from pitchside.sources.bronze import MAX_BUCKETS, MIN_BUCKETS, TARGET_BUCKET_BYTES, log_buckets
    assert log_buckets(0) == MIN_BUCKETS
    assert log_buckets(1000 * TARGET_BUCKET_BYTES) == 1024
    assert log_buckets(1024 * TARGET_BUCKET_BYTES) == 1024
    assert log_buckets(10 ** 15) == MAX_BUCKETS


def test_uncommitted_attempt_is_never_the_table(spark, tmp_path):
    old_scope = storage.BUILD_SCOPE
    storage.BUILD_SCOPE = f"left-{tmp_path.name}"
    try:
        inputs = [str(tmp_path / "input")]
        left = storage.table_path(spark, "t", inputs) + "/attempt-0"
        spark.range(5).write.parquet(left)
        p, fs = storage.fs_path(spark, left + "/_SUCCESS")
        fs.delete(p, False)
        assert storage.built_path(spark, "t", inputs) is None
        path = storage.materialize_once(spark, "t", inputs, lambda: spark.range(7))
    finally:
        storage.BUILD_SCOPE = old_scope
    assert path != left and spark.read.parquet(path).count() == 7
