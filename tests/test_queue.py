import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitchside.operators import duplicate_keys
from pitchside.plans import queue as Q
from pitchside.sources.schemas import INGESTION_CHECKPOINT, LANDED
from tests.conftest import rows
from tests.fixtures import T0, bronze, fixture, raw_row

AT = dt.datetime(2023, 1, 1)


def _q(spark, data):
    return spark.createDataFrame(data, INGESTION_CHECKPOINT)


def _ids(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "fixture_id long")


def test_finished_fixtures_from_latest_payload(spark):
    log = bronze(spark, [
        raw_row("fixtures", {"response": [fixture(1, 1, 2, 1, 0, short="FT"),
                                          fixture(2, 1, 2, 1, 1, short="PEN"),
                                          fixture(3, 1, 2, 2, 1, short="AET"),
                                          fixture(4, 1, 2, None, None, short="NS")]},
                T0 + dt.timedelta(hours=1), league_id=1, season=2022),
        raw_row("fixtures", {"response": [fixture(9, 1, 2, 0, 0)]}, T0, league_id=1, season=2022),
        raw_row("fixtures", {"errors": []}, T0, league_id=2, season=2022),   # no response: nothing
    ])
    assert rows(Q.finished_fixtures(log), "fixture_id") == [(1,), (2,), (3,)]


def test_seed_empty_twice_and_over_existing(spark):
    q = _q(spark, [(1, "statistics", "done", 1, T0), (1, "players", "failed", 2, T0)])
    assert rows(Q.seed(q, _ids(spark, []))) == rows(q)
    once = Q.seed(q, _ids(spark, [1, 2, 2]))
    twice = Q.seed(once, _ids(spark, [1, 2]))
    expected = [(1, "lineups", "pending", 0, None), (1, "players", "failed", 2, T0),
                (1, "statistics", "done", 1, T0), (2, "lineups", "pending", 0, None),
                (2, "players", "pending", 0, None), (2, "statistics", "pending", 0, None)]
    assert rows(once, "fixture_id", "endpoint") == expected
    assert rows(twice, "fixture_id", "endpoint") == expected
    assert duplicate_keys(twice, Q.KEYS).count() == 0
    assert Q.offered_pairs(_ids(spark, [1, 2, 2])).collect()[0][0] == 9


def test_claim_modes_and_budget(spark):
    q = _q(spark, [(5, "players", "pending", 0, None), (5, "lineups", "failed", 1, T0),
                   (3, "statistics", "done", 1, T0), (7, "players", "pending", 0, None),
                   (5, "statistics", "pending", 0, None)])
    assert [tuple(r) for r in Q.claim(q, 2).collect()] == [(5, "lineups", "failed"),
                                                          (5, "players", "pending")]
    assert [tuple(r) for r in Q.claim(q, 2, statuses=("pending",)).collect()] == [
        (5, "players", "pending"), (5, "statistics", "pending")]
    assert Q.budget(None) == 30 and Q.budget(4) == 4
    with pytest.raises(ValueError):
        Q.claim(q, 0)


def test_mark_and_requeue(spark):
    q = _q(spark, [(1, "players", "pending", 0, None), (2, "players", "failed", 1, T0)])
    out = spark.createDataFrame([(1, "players", "done", AT), (9, "players", "failed", AT)],
                                "fixture_id long, endpoint string, status string, at timestamp")
    marked = Q.mark(q, out)
    assert rows(marked, "fixture_id") == [(1, "players", "done", 1, AT), (2, "players", "failed", 1, T0),
                                          (9, "players", "failed", 1, AT)]
    again = Q.mark(marked, out.filter("fixture_id = 1"))
    assert rows(again.filter("fixture_id = 1")) == [(1, "players", "done", 2, AT)]
    requeued = Q.requeue(marked, spark.createDataFrame([(2, "players")], "fixture_id long, endpoint string"))
    assert rows(requeued.filter("fixture_id = 2")) == [(2, "players", "pending", 1, T0)]


def test_backfill_batch_outcomes(spark):
    q = _q(spark, [(1, "statistics", "pending", 0, None), (1, "players", "pending", 0, None),
                   (2, "statistics", "failed", 1, T0), (3, "statistics", "pending", 0, None)])
    landed = spark.createDataFrame([
        ("statistics", 1, None, None, T0, '{"errors":[],"results":0,"response":[]}'),
        ("players", 1, None, None, T0, '{"errors":{"fixture":"no data"},"response":[]}'),
        ("statistics", 3, None, None, T0, '{"errors":[],"results":0,"response":[]}'),
    ], LANDED)
    dry = Q.backfill_batch(q, landed, limit=3, dry_run=True)
    assert list(dry) == ["claimed"]
    batch = Q.backfill_batch(q, landed, limit=3, at=F.lit(AT).cast("timestamp"))
    assert tuple(batch["counts"].collect()[0]) == (1, 2, 3)   # 1 ok; 1 rejected, 1 absent
    assert rows(batch["appended"].select("endpoint", "fixture_id")) == [("statistics", 1)]
    assert rows(batch["queue"], "fixture_id", "endpoint") == [
        (1, "players", "failed", 1, AT), (1, "statistics", "done", 1, AT),
        (2, "statistics", "failed", 2, AT), (3, "statistics", "pending", 0, None)]


def test_queue_store_round_trip(spark):
    from pitchside.sources.queue_store import create_queue, read_queue, write_queue
    table = create_queue(spark, "queue_t.round_trip", 8)
    assert read_queue(spark, table).count() == 0
    write_queue(Q.seed(read_queue(spark, table), _ids(spark, [1, 2]), buckets=8), table, 8)
    outcomes = spark.createDataFrame([(1, "players", "done", AT)],
                                     "fixture_id long, endpoint string, status string, at timestamp")
    write_queue(Q.mark(read_queue(spark, table), outcomes, buckets=8), table, 8)
    current = read_queue(spark, table)
    assert current.count() == 6
    assert rows(current.filter("status = 'done'")) == [(1, "players", "done", 1, AT)]
    pair = spark.createDataFrame([(1, "players")], "fixture_id long, endpoint string")
    write_queue(Q.requeue(current, pair, buckets=8), table, 8)
    assert read_queue(spark, table).filter("status = 'pending'").count() == 6


def test_seed_mark_and_requeue_leave_the_queue_in_place(spark):
    from pitchside.sources.queue_store import read_queue, write_queue
    table = write_queue(_q(spark, [(i, e, "pending", 0, None) for i in range(40)
                                   for e in ("players", "lineups")]), "queue_t.in_place", 8)
    queue = read_queue(spark, table)
    outcomes = spark.createDataFrame([(1, "players", "done", AT), (99, "players", "failed", AT)],
                                     "fixture_id long, endpoint string, status string, at timestamp")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")        # more than the queue's buckets
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as with a large batch
        for changed in (Q.seed(queue, _ids(spark, [1, 77]), buckets=8),
                        Q.mark(queue, outcomes, buckets=8), Q.requeue(queue, outcomes, buckets=8)):
            plan = changed._jdf.queryExecution().executedPlan()
            for line, above in _scans_with_parents(plan.toString()):
                if "in_place" in line:
                    assert "Exchange" not in above, plan.toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _scans_with_parents(plan):
    """(scan line, the lines on its path to the root) of a printed plan."""
    path = []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*|")) if line.strip() else 0
        path = [(d, t) for d, t in path if d < depth] + [(depth, line)]
        if "FileScan" in line:
            yield line, "\n".join(t for _, t in path[:-1])


def test_insert_is_refused_under_the_key(spark):
    from pitchside.sources.queue_store import (DuplicateKeyError, insert_rows, read_queue,
                                               refused_keys, write_queue)
    table = write_queue(_q(spark, [(1, "players", "done", 1, T0)]), "queue_t.keyed", 8)
    before = rows(read_queue(spark, table))
    for bad in ([(2, "players", "pending", 0, None)] * 2, [(1, "players", "pending", 0, None)],
                [(None, "players", "pending", 0, None)], [(3, None, "pending", 0, None)]):
        batch = _q(spark, [*bad, (9, "lineups", "pending", 0, None)])
        with pytest.raises(DuplicateKeyError):
            insert_rows(batch, table, 8)
        assert rows(read_queue(spark, table)) == before              # as it was
        assert refused_keys(read_queue(spark, table), batch, 8).count() == 1
    insert_rows(_q(spark, [(9, "lineups", "failed", 2, T0)]), table, 8)
    assert rows(read_queue(spark, table)) == sorted(
        [*before, (9, "lineups", "failed", 2, T0)], key=repr)


def test_claim_skips_row_groups_of_finished_pairs(spark):
    """Rows are sorted by status in a bucket, so statistics exclude what a claim cannot take."""
    import pyarrow.parquet as pq

    from pitchside.sources.queue_store import read_queue, write_queue
    from pitchside.sources.tables import table_location
    data = _q(spark, [(i, "players", "pending" if i % 50 == 0 else "done", 1, T0)
                      for i in range(4000)]).repartition(3)
    old = spark.sparkContext._jsc.hadoopConfiguration().get("parquet.block.size")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "1024")
    try:
        table = write_queue(data, "queue_t.clustered", 8)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", old or "134217728")
    files = list(__import__("pathlib").Path(
        table_location(spark, table).removeprefix("file:")).glob("*.parquet"))
    groups = [pq.ParquetFile(f).metadata.row_group(i).column(2).statistics
              for f in files for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    needed = [g for g in groups if g.min <= "pending" <= g.max or g.min <= "failed" <= g.max]
    assert len(groups) >= 16 and len(needed) <= len(groups) // 2
    claimed = Q.claim(read_queue(spark, table), 5)
    assert [r.fixture_id for r in claimed.collect()] == [0, 50, 100, 150, 200]


def test_endpoint_path_and_payload_text(spark):
    from pitchside.functions.payload import endpoint_path, payload_text
    df = spark.createDataFrame([("players",), ("fixtures",)], "e string")
    assert [r[0] for r in df.select(endpoint_path("e")).collect()] == ["fixtures/players", None]
    s = spark.createDataFrame([(1, None)], "a int, b string").select(F.struct("a", "b").alias("p"))
    assert s.select(payload_text(F.col("p"), is_text=False)).collect()[0][0] == '{"a":1,"b":null}'


def test_failed_queue_write_blocks_nothing(spark):
    from pitchside.sources.queue_store import read_queue, write_queue
    table = write_queue(Q.seed(_q(spark, []), _ids(spark, [1])), "queue_t.failed_write", 8)
    broken = read_queue(spark, table).withColumn(
        "status", F.when(F.col("endpoint") == "players", F.raise_error(F.lit("lost")))
        .otherwise(F.col("status")))
    with pytest.raises(Exception, match="lost"):
        write_queue(broken, table, 8)
    assert read_queue(spark, table).count() == 3
    write_queue(Q.seed(read_queue(spark, table), _ids(spark, [2, 3])), table, 8)
    assert read_queue(spark, table).count() == 9


def test_live_batch_counts_only_new_bodies(spark):
    queue = spark.createDataFrame([(1, "statistics", "failed", 3, T0)],
                                  "fixture_id long, endpoint string, status string, attempts int, "
                                  "last_attempt_at timestamp")
    old = spark.createDataFrame([("statistics", 1, None, None, T0, '{"errors":[]}')], LANDED)
    assert Q.backfill_batch(queue, old, 1)["queue"].first()["status"] == "failed"
    new = spark.createDataFrame([("statistics", 1, None, None, T0 + dt.timedelta(hours=1),
                                  '{"errors":[]}')], LANDED)
    got = Q.backfill_batch(queue, new, 1)["queue"].first()
    assert (got["status"], got["attempts"]) == ("done", 4) and got["last_attempt_at"] > T0
