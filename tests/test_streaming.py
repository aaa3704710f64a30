import datetime as dt
import os
import tempfile

from pitchside.sources.bronze import create_log, read_log
from pitchside.sources.schemas import LANDED
from pitchside.streaming import queue_from_outcome_log, run_landing_stream
from pitchside.streaming.landing_stream import read_outcome_log, write_micro_batch
from pitchside.plans.queue import mark
from tests.conftest import rows

T0 = dt.datetime(2022, 12, 1)
OK = '{"errors":[],"results":0,"response":[]}'
BAD = '{"errors":{"fixture":"no data"},"response":[]}'


def _log(spark, root):
    """A log table of its own for one test."""
    return create_log(spark, "stream_" + os.path.basename(root).replace("-", "_"), f"{root}/raw", 8)


def test_stream_drains_in_budgeted_batches_and_replays_nothing(spark):
    root = tempfile.mkdtemp(prefix="pitchside-stream-")
    src = os.path.join(root, "landed")
    landed = spark.createDataFrame(
        [("statistics", i, None, None, T0 + dt.timedelta(hours=i), OK if i % 3 else BAD)
         for i in range(1, 9)] + [("fixtures", None, 1, 2022, T0, OK)], LANDED)
    for i in range(3):   # three landing drops, one file each
        landed.filter(f"coalesce(fixture_id, 0) % 3 = {i}").coalesce(1).write.mode("append").parquet(src)
    log = _log(spark, root)
    args = (spark, src, log, f"{root}/outcomes", f"{root}/ckpt")
    batches = run_landing_stream(*args, max_files_per_trigger=1)
    assert batches == 3
    assert read_log(spark, log).count() == 7                                   # 6 good statistics + 1 fixtures
    assert run_landing_stream(*args, max_files_per_trigger=1) == 0   # nothing new
    assert read_log(spark, log).count() == 7
    outcomes = read_outcome_log(spark, f"{root}/outcomes")
    seeded = spark.createDataFrame([(i, "statistics", "pending", 0, None) for i in range(1, 9)],
                                   "fixture_id long, endpoint string, status string, attempts int, "
                                   "last_attempt_at timestamp")
    state = queue_from_outcome_log(seeded, outcomes)
    assert rows(state.select("fixture_id", "status", "attempts"), "fixture_id") == [
        (i, "done" if i % 3 else "failed", 1) for i in range(1, 9)]
    batch_outcomes = landed.filter("endpoint = 'statistics'").selectExpr(
        "fixture_id", "endpoint", "CASE WHEN fixture_id % 3 = 0 THEN 'failed' ELSE 'done' END AS status",
        "fetched_at AS at")
    assert rows(state) == rows(mark(seeded, batch_outcomes))


def test_replayed_micro_batch_is_written_once(spark):
    root = tempfile.mkdtemp(prefix="pitchside-replay-")
    batch = spark.createDataFrame(
        [("statistics", 1, None, None, T0, OK), ("players", 2, None, None, T0, BAD)], LANDED)
    log = _log(spark, root)
    for epoch in (0, 1, 1):          # epoch 1 is replayed after a failure
        write_micro_batch(batch, epoch, log, f"{root}/outcomes", "s1")
    assert read_log(spark, log).count() == 2          # one good row per epoch
    assert read_outcome_log(spark, f"{root}/outcomes").count() == 4


def test_two_checkpoints_share_one_log(spark):
    root = tempfile.mkdtemp(prefix="pitchside-two-")
    log = _log(spark, root)
    for name, fixture in (("a", 1), ("b", 2)):
        (spark.createDataFrame([("statistics", fixture, None, None, T0, OK)], LANDED)
         .write.parquet(f"{root}/{name}"))
        run_landing_stream(spark, f"{root}/{name}", log, f"{root}/outcomes",
                           f"{root}/ckpt-{name}")
    assert rows(read_log(spark, log).select("fixture_id")) == [(1,), (2,)]
    assert read_outcome_log(spark, f"{root}/outcomes").count() == 2
