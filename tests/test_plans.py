"""Plan shapes the design relies on at scale (checked on the smallest driver tables)."""

import os

import pytest

from pitchside.catalog import QUERIES
from pitchside.plans.staging import latest_fixtures_payloads
from pitchside.sources import inputs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["stg_match_statistics", "int_team_match_stats",
                                  "stg_player_statistics", "int_player_stats",
                                  "latest_payload_by_fixture"])
def test_per_fixture_paths_do_not_shuffle_on_the_bucketed_log(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "Exchange" not in plan
    assert "PartitionFilters: [isnotnull(endpoint" in plan


def test_team_stats_aggregate_long_rows_by_hash(spark):
    plan = _plan(QUERIES["int_team_match_stats"](spark, SF))
    assert "HashAggregate" in plan


def test_gold_does_not_plan_the_referee_count(spark):
    plan = _plan(QUERIES["team_tournament_profile"](spark, SF))
    assert "LeftOuter" not in plan and "count(1)" not in plan


def test_fixture_dedupe_pushes_tag_filters_and_prunes_columns(spark):
    plan = _plan(latest_fixtures_payloads(inputs.bronze(spark, SF)))
    assert "PushedFilters: [IsNotNull(league_id), IsNotNull(season)]" in plan
    assert "WindowGroupLimit" in plan
    assert "lineups" not in plan.split("PartitionFilters")[1].split("]")[0]


def test_claim_is_a_top_k_not_a_sort(spark):
    plan = _plan(QUERIES["queue_claim"](spark, SF))
    assert "TakeOrderedAndProject" in plan
