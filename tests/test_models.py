import datetime as dt

from pyspark.sql import functions as F

from pitchside.plans.intermediate import int_player_stats, int_team_match_stats
from pitchside.plans.marts import match_results, team_tournament_profile
from pitchside.plans.staging import stg_fixtures, stg_match_statistics, stg_player_statistics
from tests.conftest import rows
from tests.fixtures import T0, bronze, fixture, raw_row, stats

H = dt.timedelta(hours=1)


def _fixtures_log(spark):
    fresh = {"response": [fixture(1, 10, 20, 2, 1), fixture(2, 20, 30, 1, 1, referee=None),
                          fixture(3, 30, 10, None, None, short="NS", referee=None),
                          fixture(None, 10, 30, 0, 0, referee="Ref A")]}   # NULL id: dropped
    stale = {"response": [fixture(1, 10, 20, 99, 99)]}
    other = {"response": [fixture(4, 10, 20, 0, 3, season=2023)]}
    return [raw_row("fixtures", fresh, T0 + 2 * H, league_id=1, season=2022),
            raw_row("fixtures", stale, T0 + H, league_id=1, season=2022),
            raw_row("fixtures", other, T0, league_id=1, season=2023),
            raw_row("fixtures", {"response": []}, T0 + 5 * H)]   # untagged: ignored


def test_stg_fixtures_latest_payload_and_referee_counts(spark):
    out = stg_fixtures(bronze(spark, _fixtures_log(spark)))
    got = rows(out.select("fixture_id", "referee", "referee_games", "home_goals"), "fixture_id")
    # The NULL-id fixture is filtered before counting: Ref A counts 2 (fixtures 1 and 4).
    assert got == [(1, "Ref A", 2, 2), (2, None, 2, 1), (3, None, 2, None), (4, "Ref A", 2, 0)]


def test_referee_strategies_agree(spark):
    log = bronze(spark, _fixtures_log(spark))
    assert rows(stg_fixtures(log, "aggregate")) == rows(stg_fixtures(log, "window"))


def _stats_log(spark):
    return [
        raw_row("statistics", {"response": [stats(10, **{"Yellow Cards": None, "Fouls": "N/A",
                                                          "Ball Possession": "61%", "Shots on Goal": 5}),
                                            stats(20, **{"Ball Possession": "39%", "Offsides": 2})]},
                T0 + 2 * H, fixture_id=1),
        raw_row("statistics", {"response": [stats(10, **{"Shots on Goal": 99})]}, T0, fixture_id=1),
        raw_row("statistics", {"response": []}, T0, fixture_id=2),
        raw_row("statistics", {"response": [stats(20, **{"Ball Possession": "50%"}),
                                            stats(30, **{"Ball Possession": "50%"})]}, T0, fixture_id=2),
        raw_row("statistics", {"response": [stats(10, **{"Passes %": "80%"})]}, T0, fixture_id=4),
    ]


def test_statistics_long_and_wide(spark):
    log = bronze(spark, _stats_log(spark))
    long = stg_match_statistics(log)
    # fixture 1: latest payload, 4 + 2 rows; fixture 2: two payloads tie on time, the tiebreak
    # (longest text) keeps the two-team one, 2 rows; fixture 4: 1 row.
    assert long.count() == 9
    assert rows(long.filter("fixture_id = 2").select("team_id"), "team_id") == [(20,), (30,)]
    wide = int_team_match_stats(long).filter(F.col("fixture_id") == 1)
    got = rows(wide.select("team_id", "shots_on_goal", "fouls", "yellow_cards", "offsides",
                           "ball_possession"), "team_id")
    # present-null yellow -> 0; absent offsides for team 10 -> NULL; 'N/A' fouls -> NULL
    assert got == [(10, 5, None, 0, None, 0.61), (20, None, None, None, 2, 0.39)]


def test_empty_statistics_response_keeps_one_null_row(spark):
    log = bronze(spark, [raw_row("statistics", {"response": []}, T0, fixture_id=7)])
    assert rows(stg_match_statistics(log)) == [(7, None, None, None, None)]
    assert rows(int_team_match_stats(stg_match_statistics(log)).select("fixture_id", "team_id")) == [(7, None)]


def test_gold_invariants_and_join_semantics(spark):
    log = bronze(spark, _fixtures_log(spark) + _stats_log(spark))
    fx = stg_fixtures(log)
    gold = team_tournament_profile(fx, int_team_match_stats(stg_match_statistics(log)))
    for r in gold.collect():
        assert r.total_wins + r.total_draws + r.total_losses == r.matches_played
        assert r.points == 3 * r.total_wins + r.total_draws
    got = {r.team_id: r for r in gold.collect()}
    # fixture 3 has no stats: dropped by the inner join; fixture 4 (season 2023) merges with 2022.
    assert got[10].matches_played == 2 and got[10].points == 3 and got[10].avg_ball_possession == 0.61
    # team 20 won fixture 4 but has no stats row there: that win counts nowhere.
    assert (got[20].matches_played, got[20].total_draws, got[20].total_losses) == (2, 1, 1)
    assert got[30].matches_played == 1 and got[30].points_pct == round(1 / 21 * 100, 2)
    assert rows(match_results(fx).filter("fixture_id = 3").select("result")) == [("D",), ("D",)]


def test_players_inner_explodes_and_casts(spark):
    entry = {"games": {"minutes": 90, "position": "G", "rating": "7.3", "captain": True,
                       "substitute": False}, "offsides": None, "shots": {"total": 2, "on": 1},
             "passes": {"total": 30, "key": 1, "accuracy": "80%"}}
    body = {"response": [
        {"team": {"id": 1, "name": "A"}, "players": [
            {"player": {"id": 11, "name": "p11"}, "statistics": [entry]},
            {"player": {"id": 12, "name": "p12"}, "statistics": []},
            {"player": {"id": 13, "name": "p13"}, "statistics": [{"games": {"minutes": None}}]}]},
        {"team": {"id": 2, "name": "B"}, "players": []}]}
    log = bronze(spark, [raw_row("players", body, T0, fixture_id=5)])
    stg = stg_player_statistics(log)
    assert len(stg.columns) == 37 and stg.count() == 2
    typed = int_player_stats(stg).collect()
    assert len(typed) == 1
    r = typed[0]
    assert (r.minutes, r.rating, r.captain, r.substitute, r.total_shots, r.passes_accuracy,
            r.offsides) == (90, 7.3, True, False, 2, None, None)
