import json
import os
import tempfile
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from pitchside.sources import inputs, synth
from pitchside.sources.bronze import append_log, create_log, log_buckets, read_log
from pitchside.sources.landing import audit, tag
from pitchside.sources.schemas import FIXTURES, PLAYERS, STANDINGS, STATISTICS
from pitchside.sources.storage import path_size, table_path


@pytest.fixture(scope="module")
def orders_dir(spark):
    """420 orders in one file of one row group; some keys and customers are NULL, negative or repeated."""
    folder = tempfile.mkdtemp(prefix="pitchside-orders-")
    key = F.when(F.col("id") == 17, None).when(F.col("id") == 18, -41).otherwise(F.col("id") % 400)
    (spark.range(420).select(
        key.cast("bigint").alias("o_orderkey"),
        F.when(F.col("id") == 19, None).otherwise(F.col("id") % 37).cast("bigint").alias("o_custkey"),
        F.element_at(F.split(F.lit("O,F,P"), ","), (F.col("id") % 3 + 1).cast("int"))
        .alias("o_orderstatus"),
        F.expr("TIMESTAMP '1995-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id AS INT) % 900)")
        .alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
     .coalesce(1).write.parquet(os.path.join(folder, "orders.parquet")))
    return folder


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_payloads_are_made_in_many_tasks_and_not_stored(spark, orders_dir):
    """The narrow rows are dealt before text is made of them, though their file has one row group."""
    landed = inputs.landed(spark, orders_dir)
    details = landed.filter(F.col("endpoint") == PLAYERS)
    placed = details.select("fixture_id", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in placed}) == inputs.buckets(spark, orders_dir) == 8
    assert len({(r.fixture_id, r.task) for r in placed}) == len({r.fixture_id for r in placed})
    source = [os.path.join(orders_dir, "orders.parquet")]
    assert path_size(spark, table_path(spark, "landed", source)) == 0


def test_season_payloads_move_narrow_rows_once(spark, orders_dir):
    """Season payloads are gathered from narrow rows dealt by league-season: one exchange, no elements."""
    landed = synth.landed_from_orders(
        spark.read.parquet(os.path.join(orders_dir, "orders.parquet")), 8)
    for endpoint in (FIXTURES, STANDINGS):
        plan = _plan(landed.filter(F.col("endpoint") == endpoint)).split("== Initial Plan ==")[0]
        moved = [line for line in plan.splitlines() if "Exchange" in line]
        assert len(moved) == 1 and "REPARTITION_BY_NUM" in moved[0]


def test_fixtures_payloads_hold_every_fixture(spark, orders_dir):
    """Each league-season has its fixtures, repeated and NULL ids too, in order, with a copy whose goals
    are 99 and, where the rule says so, the fixture without an id."""
    facts = synth.fixture_facts(spark.read.parquet(os.path.join(orders_dir, "orders.parquet")))
    want = {}
    for r in facts.collect():
        want.setdefault((r.league_id, r.season), []).append(r)
    got = synth.fixtures_payloads(facts).collect()
    assert len(got) == 2 * len(want) and len({(r.league_id, r.season, r.fetched_at) for r in got}) == len(got)
    for row in got:
        rows = want[row.league_id, row.season]
        stale = row.fetched_at < max(r.played_at for r in rows) + timedelta(hours=24)
        body = json.loads(row.raw_payload)
        ids = [e["fixture"]["id"] for e in body["response"]]
        extra = row.league_id is not None and (row.league_id + row.season) % 7 == 0
        assert ids == sorted([r.fixture_id for r in rows] + [None] * extra,
                             key=lambda k: (k is not None, k or 0))
        assert body["results"] == len(ids)
        assert sum(e["fixture"]["status"]["short"] == "TBD" for e in body["response"]) == extra
        goals = [(99, 99)] * len(ids) if stale else sorted(
            [(r.home_goals, r.away_goals) for r in rows] + [(None, None)] * extra, key=str)
        found = [(e["goals"]["home"], e["goals"]["away"]) for e in body["response"]]
        assert (found if stale else sorted(found, key=str)) == goals


def test_audited_rows_are_parsed_once(spark, orders_dir):
    kept = tag(inputs.landed(spark, orders_dir)).filter(F.col("endpoint") == STATISTICS)
    assert _plan(kept).split("== Initial Plan ==")[0].count("from_json(") == 1


def test_placed_append_moves_no_text(spark, orders_dir):
    rows = tag(audit(synth.landed_from_orders(
        spark.read.parquet(os.path.join(orders_dir, "orders.parquet")), 8)))
    root, logs = tempfile.mkdtemp(prefix="pitchside-placed-"), {}
    for placed in (False, True):
        name = f"placed_log_{placed}".lower()
        append_log(rows, create_log(spark, name, f"{root}/{placed}", 8), "one", placed=placed)
        logs[placed] = read_log(spark, name)
    assert logs[True].exceptAll(logs[False]).isEmpty() and logs[False].exceptAll(logs[True]).isEmpty()
    files = [f for folder, _, names in os.walk(f"{root}/True/load_id=one/endpoint={PLAYERS}")
             for f in names if f.endswith(".parquet")]
    assert len(files) == 8 and all(".zstd." in f for f in files)   # one file per bucket
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_buckets_follow_orders(spark):
    assert log_buckets(162 << 20, inputs.ORDERS_BYTES_PER_BUCKET) == 256


def test_side_texts_equal_texts_made_row_by_row(spark, orders_dir):
    """A side's text looked up by its values is the text made from the row itself."""
    facts = synth.fixture_facts(spark.read.parquet(os.path.join(orders_dir, "orders.parquet")))
    rows = synth._with_side_bases(facts.filter("short != 'NS'")).withColumn(
        "stale", F.col("fixture_id") % 3 == 0)
    for names, text in ((synth._STATISTICS_KEYS, synth._statistics_block()),
                        (synth._PLAYERS_KEYS, synth._players_block())):
        looked_up = synth._with_side_texts(rows, names, text)
        for side in (0, 1):
            own = rows.select("*", *[c.alias(n) for n, c in synth._side_keys(side).items()
                                     if n in names and n not in rows.columns])
            known = [F.col(n).isNotNull() for n in names]
            own = own.filter(sum(k.cast("int") for k in known) == len(names)).select(
                "fixture_id", "t_1", "stale", text.alias("block"))
            got = looked_up.filter(F.col(f"block_{side}").isNotNull()).select(
                "fixture_id", "t_1", "stale", F.col(f"block_{side}").alias("block"))
            assert own.count() == got.count() > 0
            assert own.exceptAll(got).isEmpty() and got.exceptAll(own).isEmpty()
        assert looked_up.count() == rows.count()
