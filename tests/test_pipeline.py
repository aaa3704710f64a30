import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from pitchside.plans.incremental import Incremental
from pitchside.plans.intermediate import int_player_stats, int_team_match_stats
from pitchside.plans.marts import GOLD_ORDER, gold_ordered, team_tournament_profile
from pitchside.plans.pipeline import GOLD, Layers, build_models, log_rows
from pitchside.plans.staging import (fixture_rows, stg_fixtures, stg_match_statistics,
                                     stg_player_statistics)
from pitchside.plans.views import STAGING_VIEWS
from pitchside.sources.bronze import (append_log, create_bronze, create_log, publish_view, read_log,
                                      read_log_splits)
from pitchside.sources.tables import in_file_order, rebuild_table, table_location
from tests.conftest import rows
from tests.fixtures import T0, bronze, fixture, raw_row, stats

HOUR = dt.timedelta(hours=1)


def _entry(player, minutes):
    return {"player": {"id": player, "name": f"P{player}"},
            "statistics": [{"games": {"minutes": minutes, "captain": True}, "offsides": None}]}


def _players(*teams):
    return {"response": [{"team": {"id": t, "name": f"T{t}"}, "players": list(ps)} for t, ps in teams]}


LOG_ROWS = [
    raw_row("fixtures", {"response": [fixture(1, 10, 20, 2, 0), fixture(2, 20, 10, 1, 1, referee=None),
                                      fixture(None, 1, 2, 0, 0)]}, T0, league_id=1, season=2022),
    raw_row("statistics", {"response": [stats(10, **{"Ball Possession": "60%"}),
                                        stats(20, **{"Ball Possession": "40%"})]}, T0, fixture_id=1),
    raw_row("statistics", {"response": []}, T0, fixture_id=2),
    raw_row("players", _players((10, [_entry(7, 90), _entry(8, None)])), T0, fixture_id=1),
    raw_row("standings", {"response": [1]}, T0),
]
# Newer payloads of the same season and fixtures, and one that is older than what is there.
LATER_ROWS = [
    raw_row("fixtures", {"response": [fixture(1, 10, 20, 0, 3), fixture(3, 30, 10, 2, 2, cup="Cup B")]},
            T0 + HOUR, league_id=1, season=2022),
    raw_row("statistics", {"response": [stats(20, **{"Ball Possession": "45%"}),
                                        stats(10, **{"Ball Possession": "N/A"})]}, T0 + HOUR, fixture_id=2),
    raw_row("players", _players(), T0 + HOUR, fixture_id=1),          # nothing left of fixture 1
    raw_row("statistics", {"response": [stats(10, **{"Ball Possession": "1%"})]}, T0 - HOUR,
            fixture_id=1),
]
LAST_ROWS = [
    raw_row("fixtures", {"response": [fixture(9, 40, 50, 1, 0)]}, T0, league_id=2, season=2021),
    raw_row("statistics", {"response": [stats(40, **{"Ball Possession": "50%"}),
                                        stats(50, **{"Ball Possession": "50%"})]}, T0, fixture_id=9),
    raw_row("statistics", {"response": [stats(30, **{"Ball Possession": "33%"}),
                                        stats(10, **{"Ball Possession": "67%"})]}, T0, fixture_id=3),
    raw_row("players", _players((40, [_entry(5, 12)])), T0, fixture_id=9),
]


def _new_log(spark, name, *loads):
    log = create_log(spark, name, tempfile.mkdtemp(prefix="pitchside-log-") + "/log", 8)
    for i, load in enumerate(loads):
        append_log(bronze(spark, load), log, f"load-{i}")
    return log


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_create_bronze_and_build_models(spark):
    loc = tempfile.mkdtemp(prefix="pitchside-bronze-")
    tables = create_bronze(spark, "bronze_t", loc)
    assert tables == ["ingestion_checkpoint", "raw_api_responses"]
    assert create_bronze(spark, "bronze_t", loc) == tables          # idempotent
    append_log(bronze(spark, LOG_ROWS), "bronze_t.raw_api_responses", "first")
    layers = Layers(default="dev_t", staging=None, intermediate=" silver_t ", marts="gold_t")
    names = build_models(spark, "bronze_t.raw_api_responses", layers)
    assert names["stg_fixtures"] == "dev_t.stg_fixtures"
    assert names["int_team_match_stats"] == "silver_t.int_team_match_stats"
    assert names[GOLD] == f"gold_t.{GOLD}"
    gold = rows(spark.table(names[GOLD]).select("team_id", "points", "avg_ball_possession"), "team_id")
    assert gold == [(10, 3, 0.6), (20, 0, 0.4)]
    other = spark.newSession()                                       # views live in the catalog
    assert other.table("dev_t.stg_fixtures").count() == 2
    assert other.table("dev_t.stg_player_statistics").count() == 2
    append_log(bronze(spark, LATER_ROWS), "bronze_t.raw_api_responses", "second")
    assert {r.fixture_id for r in other.table("dev_t.stg_fixtures").collect()} == {1, 3}
    build_models(spark, "bronze_t.raw_api_responses", layers)       # rebuilt under its readers
    assert rows(spark.table(names[GOLD]).select("team_id", "points"), "team_id") == [(10, 0), (20, 3)]


def test_log_models_equal_the_models_of_plain_rows(spark):
    raw = read_log(spark, _new_log(spark, "log_models", LOG_ROWS, LATER_ROWS, LAST_ROWS))
    plain = bronze(spark, LOG_ROWS + LATER_ROWS + LAST_ROWS)
    for model in (stg_fixtures, stg_match_statistics, stg_player_statistics):
        assert rows(model(raw)) == rows(model(plain)), model.__name__


def test_equal_times_have_one_winner_in_every_layout(spark):
    tied = [raw_row("statistics", {"response": [stats(t, Fouls=t)]}, T0, fixture_id=1) for t in (5, 6, 7)]
    tied += [raw_row("fixtures", {"response": [fixture(t, 1, 2, 0, 0)]}, T0, league_id=1, season=1)
             for t in (5, 6, 7)]
    plain = bronze(spark, tied)
    one, other = (read_log(spark, _new_log(spark, n, *loads)) for n, loads in (
        ("tied_one", [tied]), ("tied_other", [tied[::-1][:2], tied[:4], tied[:1]])))
    for model in (stg_match_statistics, stg_fixtures):
        assert rows(model(one)) == rows(model(other)) == rows(model(plain))
        assert model(one).count() == 1


def test_appends_and_loads(spark):
    log = _new_log(spark, "log_loads", LOG_ROWS, LATER_ROWS)
    append_log(bronze(spark, LATER_ROWS), log, "load-1")            # a repeated load replaces itself
    raw = read_log(spark, log)
    assert raw.count() == len(LOG_ROWS) + len(LATER_ROWS)
    plan = _plan(int_team_match_stats(stg_match_statistics(raw)))
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    for bad in (raw_row("statistics", {}, T0), raw_row("weather", {}, T0, fixture_id=1),
                (T0, None, 1, "{}", None, None)):
        with pytest.raises(Exception, match="not a row of the log"):
            append_log(bronze(spark, [bad]), log, "bad")
    with pytest.raises(ValueError):
        append_log(bronze(spark, LOG_ROWS), log, "it's")
    assert read_log(spark, log).count() == raw.count()


def test_payload_text_meets_no_shuffle(spark):
    raw = read_log(spark, _new_log(spark, "log_late", LOG_ROWS, LATER_ROWS))
    from pitchside.plans.staging import latest_fixture_payloads, latest_fixtures_payloads
    spread = read_log_splits(spark, table_location(spark, "log_late"))
    for df in (latest_fixtures_payloads(raw), latest_fixture_payloads(raw, "statistics"),
               latest_fixture_payloads(spread, "statistics", spread=True)):
        nodes = df._jdf.queryExecution().executedPlan()
        todo, exchanges = [nodes], []
        while todo:
            node = todo.pop()
            name = node.nodeName()
            if name == "AdaptiveSparkPlan":
                todo.append(node.inputPlan())
            if "Exchange" in name:
                exchanges.append(node.output().mkString(","))
            todo += [node.children().apply(i) for i in range(node.children().size())]
        assert not any("raw_payload" in e for e in exchanges)
        assert df.count() > 0


def test_hot_fixture_is_read_in_splits(spark):
    hot = [raw_row("statistics", {"response": [stats(10, Fouls=i)] * 40}, T0 + i * HOUR, fixture_id=1)
           for i in range(60)]
    cold = [raw_row("statistics", {"response": [stats(10, Fouls=1)]}, T0, fixture_id=i) for i in range(2, 90)]
    log = _new_log(spark, "log_hot", hot + cold)
    raw, spread = log_rows(spark, log)
    assert spread
    got = stg_match_statistics(raw, spread)
    assert "Bucketed: true" not in _plan(got) and "WindowGroupLimit" in _plan(got)
    assert rows(got) == rows(stg_match_statistics(read_log(spark, log)))
    assert log_rows(spark, _new_log(spark, "log_cold", cold))[1] is False


def test_fixtures_are_parsed_once_for_rows_and_counts(spark):
    counted = stg_fixtures(read_log(spark, _new_log(spark, "log_once", LOG_ROWS, LATER_ROWS)))
    counted.collect()
    final = _plan(counted).split("== Initial Plan ==")[0]
    assert final.count("from_json") == 1 and "ReusedExchange" in final


def test_long_season_payload_is_parsed_in_parts(spark):
    season = {"response": [fixture(i, i % 7, i % 5 + 10, 1, 0) for i in range(500)] + [None]}
    short = {"response": [fixture(900, 1, 2, 0, 0)]}
    loads = [raw_row("fixtures", season, T0, league_id=1, season=2022),
             raw_row("fixtures", short, T0, league_id=2, season=2022)]
    raw = read_log(spark, _new_log(spark, "log_long", loads))
    whole, parts = fixture_rows(raw), fixture_rows(raw, split_chars=10_000)
    assert rows(whole) == rows(parts) and whole.count() == 501
    assert "REPARTITION_BY_NUM" in _plan(parts) and "REPARTITION" not in _plan(whole)
    busy = parts.select(F.spark_partition_id()).distinct().count()
    assert busy >= 2
    for bad in ('{"response":{"a":1}}', '{"response":[{"fixture":{"id":"x"}}]}', '{"response":[', "[" * 99):
        broken = read_log(spark, _new_log(spark, f"log_bad_{abs(hash(bad))}", [
            raw_row("fixtures", bad.ljust(50), T0, league_id=1, season=1)]))
        with pytest.raises(Exception, match="(?i)malformed"):
            fixture_rows(broken, split_chars=10).collect()


def test_rebuild_keeps_readers_and_survives_failure(spark):
    table = rebuild_table(spark.range(10).toDF("v"), "rebuild_t.numbers")
    planned = spark.table(table)
    broken = spark.range(20).select(F.when(F.col("id") == 19, F.raise_error(F.lit("half-way")))
                                    .otherwise(F.col("id")).cast("long").alias("v"))
    with pytest.raises(Exception, match="half-way"):
        rebuild_table(broken, table)
    assert spark.table(table).count() == 10                          # readable, as it was
    rebuild_table(spark.table(table).union(spark.table(table)), table)   # reads what it replaces
    assert spark.table(table).count() == 20
    assert planned.count() == 10                                     # an old plan still has its files
    rebuild_table(spark.range(3).selectExpr("id AS v", "'x' AS w"), table)   # other columns
    assert spark.table(table).columns == ["v", "w"]
    rebuild_table(spark.range(4).toDF("v"), table, bucket_by=(4, ["v"]))
    assert "Exchange" not in _plan(spark.table(table).groupBy("v").count())
    assert [t.name for t in spark.catalog.listTables("rebuild_t")] == ["numbers"]


def test_gold_files_are_in_read_order(spark):
    from pitchside.plans.marts import in_gold_order
    raw = bronze(spark, [
        raw_row("fixtures", {"response": [fixture(i, i % 23, i % 19 + 30, i % 4, i % 3, cup=f"Cup {i % 5}")
                                          for i in range(400)]}, T0, league_id=1, season=2022),
        *[raw_row("statistics", {"response": [stats(i % 23, Fouls=1), stats(i % 19 + 30, Fouls=2)]}, T0,
                  fixture_id=i) for i in range(400)]])
    gold = team_tournament_profile(fixture_rows(raw), int_team_match_stats(stg_match_statistics(raw)))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # several files
    try:
        table = rebuild_table(in_gold_order(gold), "gold_order_t.gold")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    placed = in_file_order(spark, table)
    assert len(spark.table(table).inputFiles()) > 1
    got = [tuple(r)[:-1] for r in sorted(placed.collect(), key=lambda r: r.position)]
    assert got == [tuple(r) for r in gold_ordered(gold.select(*GOLD_ORDER)).collect()]
    assert sorted(r.position for r in placed.collect()) == list(range(1, len(got) + 1))


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 0, 2)])
def test_incremental_equals_the_full_rebuild(spark, order):
    name = "inc_" + "_".join(map(str, order))
    batches = [LOG_ROWS, LATER_ROWS, LAST_ROWS]
    root = tempfile.mkdtemp(prefix="pitchside-inc-")
    log = create_log(spark, f"{name}_log", f"{root}/log", 8)
    models = Incremental(spark, log, f"{name}_models", root, 8)
    for step, i in enumerate(order):
        append_log(bronze(spark, batches[i]), log, f"load-{i}")
        models.apply(f"load-{i}")
        if step == 1:
            models.apply(f"load-{i}")                               # again: nothing changes
        raw = read_log(spark, log)
        stats_ = int_team_match_stats(stg_match_statistics(raw))
        assert rows(models.fixtures()) == rows(fixture_rows(raw))
        assert rows(models.team_stats()) == rows(stats_)
        assert rows(models.player_stats()) == rows(int_player_stats(stg_player_statistics(raw)))
        assert rows(models.gold()) == rows(team_tournament_profile(fixture_rows(raw), stats_))


def test_view_text_equals_the_models(spark):
    log = _new_log(spark, "log_views", LOG_ROWS, LATER_ROWS, LAST_ROWS)
    raw = read_log(spark, log)
    for model in (stg_fixtures, stg_match_statistics, stg_player_statistics):
        view = publish_view(spark, STAGING_VIEWS[model.__name__](log), "silver_views_t",
                            model.__name__, "dev")
        assert view == f"silver_views_t.{model.__name__}"
        got = spark.newSession().table(view)
        assert got.columns == model(raw).columns and rows(got) == rows(model(raw))
    assert "Exchange" not in _plan(spark.table("silver_views_t.stg_match_statistics"))
