"""Staging models: latest payload per key -> schema-on-read -> explode -> projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.operators import (explode_path, fetch_rows, latest_per_key, latest_pointers,
                                 parse_json_column, partition_count, project_paths)
from pitchside.sources import schemas as S
from pitchside.sources.bronze import endpoint_rows

# Output of the fixtures projection (fixed values): (path under the exploded element, name).
FIXTURE_COLUMNS = (
    ("r.fixture.id", "fixture_id"),
    ("r.fixture.date", "match_date"),
    ("r.fixture.referee", "referee"),
    ("r.fixture.status.long", "match_status"),
    ("r.fixture.venue.name", "venue_name"),
    ("r.fixture.venue.city", "venue_city"),
    ("r.league.name", "tournament_name"),
    ("r.league.season", "tournament_season"),
    ("r.league.round", "tournament_round"),
    ("r.teams.home.id", "home_team_id"),
    ("r.teams.home.name", "home_team_name"),
    ("r.teams.away.id", "away_team_id"),
    ("r.teams.away.name", "away_team_name"),
    ("r.goals.home", "home_goals"),
    ("r.goals.away", "away_goals"),
)

STG_FIXTURES_ORDER = ("fixture_id", "match_date", "referee", "referee_games", "match_status",
                      "venue_name", "venue_city", "tournament_name", "tournament_season",
                      "tournament_round", "home_team_id", "home_team_name", "away_team_id",
                      "away_team_name", "home_goals", "away_goals")


#: Characters above which a season's payload is parsed in parts, and of one part.
SPLIT_CHARS, PART_CHARS = 8 << 20, 4 << 20
_SEASON = ["league_id", "season"]
# Of payloads of one time the longest wins, then the greatest hash: the same one in every layout.
_ORDER = ["ingested_at", "payload_chars", "payload_hash"]


def _from_log(raw: DataFrame) -> bool:
    """Whether ``raw`` is a scan of the log, with the narrow columns that choose a payload."""
    return "payload_hash" in raw.columns


def _season_rows(raw: DataFrame) -> DataFrame:
    return endpoint_rows(raw, S.FIXTURES).filter(
        F.col("league_id").isNotNull() & F.col("season").isNotNull())


def _latest_in_one_pass(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The one-pass form, for rows that are no scan of the log: the same winners."""
    kept = rows.select(*keys, "ingested_at", "raw_payload",
                       F.length("raw_payload").alias("payload_chars"),
                       F.xxhash64("raw_payload").alias("payload_hash"))
    return latest_per_key(kept, keys, _ORDER, ["raw_payload"])


def _latest_seasons(raw: DataFrame, carry: Sequence[str] = ()) -> tuple[DataFrame, int, int]:
    """Latest fixtures payload per (league_id, season), with the length of the longest and the
    total length of those above ``SPLIT_CHARS`` (0 and 0 when unknown).

    On the log the winners are chosen on narrow columns, counted, and only their payload text is read:
    no payload meets a shuffle."""
    rows = _season_rows(raw)
    columns = list(dict.fromkeys([*_SEASON, "ingested_at", "raw_payload", *carry]))
    if not _from_log(raw):
        return _latest_in_one_pass(rows, _SEASON).select(*columns), 0, 0
    best = latest_pointers(rows, _SEASON, _ORDER)
    long = F.when(F.col("payload_chars") > SPLIT_CHARS, F.col("payload_chars").cast("long"))
    size = best.agg(F.count(F.lit(1)).alias("n"), F.max("payload_chars").alias("longest"),
                    F.sum(long).alias("long")).first()
    latest = fetch_rows(rows, best, _SEASON, _ORDER, columns, n_pointers=size["n"])
    return latest, size["longest"] or 0, size["long"] or 0


def latest_fixtures_payloads(raw: DataFrame) -> DataFrame:
    """Latest fixtures payload per (league_id, season); untagged rows are ignored."""
    return _latest_seasons(raw)[0]


def latest_fixture_payloads(raw: DataFrame, endpoint: str, spread: bool = False,
                            carry: Sequence[str] = ()) -> DataFrame:
    """Latest payload per fixture_id of one per-fixture endpoint (NULL ids form one group, of which
    the log has none).

    On the log the winners are chosen on narrow columns; then payloads are read once, bucket by
    bucket, with no shuffle or sort of their text. ``spread`` (for ``read_log_splits`` of a log in
    which one fixture fills a bucket) reads ordinary splits instead: a partial top-1 in every task
    precedes a narrow shuffle, and the winners' places are looked up in every split."""
    rows = endpoint_rows(raw, endpoint)
    columns = list(dict.fromkeys(["fixture_id", "ingested_at", "raw_payload", *carry]))
    if not _from_log(raw):
        return _latest_in_one_pass(rows, ["fixture_id"]).select(*columns)
    best = latest_pointers(rows, ["fixture_id"], _ORDER)
    return fetch_rows(rows, best, ["fixture_id"], _ORDER, columns,
                      n_pointers=best.count() if spread else None)


def _elements_in_parts(payloads: DataFrame, tasks: int, keep: Sequence[str]) -> DataFrame:
    """The elements ``r`` of long fixtures payloads: the list is cut into the elements' own texts,
    which are dealt to ``tasks`` tasks and typed there. FAILFAST in both steps. (An element that is a
    string holding an object counts as the object.)"""
    texts = parse_json_column(payloads, "raw_payload", "response ARRAY<STRING>", "j",
                              mode="FAILFAST", keep=keep)
    dealt = explode_path(texts, "j.response", "text", keep=keep).repartition(tasks)
    element = S.FIXTURES_DDL.split("ARRAY<", 1)[1][:-1]
    return dealt.select(*keep, F.from_json("text", element, {"mode": "FAILFAST"}).alias("r"))


def fixture_rows(raw: DataFrame, split_chars: int = SPLIT_CHARS,
                 carry: Sequence[str] = ()) -> DataFrame:
    """The fixtures model without ``referee_games``: what consumers that never read the count
    (match results, gold) should scan, so the count's extra aggregate and join are not planned.

    Parsed FAILFAST with the full schema: a malformed payload fails the query. Fixtures without an
    id are dropped. Payloads longer than ``split_chars``, where the log has any, are parsed in parts
    by many tasks; the others whole. ``carry`` adds columns of the payload's row."""
    latest, longest, long_chars = _latest_seasons(raw, carry)
    whole = latest if longest <= split_chars else latest.filter(
        F.length("raw_payload") <= split_chars)
    parsed = parse_json_column(whole, "raw_payload", S.FIXTURES_DDL, "j", mode="FAILFAST",
                               keep=carry)
    elements = explode_path(parsed, "j.response", "r", keep=carry)
    if longest > split_chars:
        tasks = min(10_000, max(2, -(-max(longest, long_chars) // PART_CHARS)))
        elements = elements.unionByName(_elements_in_parts(
            latest.filter(F.length("raw_payload") > split_chars), tasks, carry))
    return project_paths(elements.filter(F.col("r.fixture.id").isNotNull()), FIXTURE_COLUMNS,
                         keep=carry)


def stg_fixtures(raw: DataFrame, referee_strategy: str = "once") -> DataFrame:
    """One row per fixture of the latest fixtures payload of each league-season, with
    ``referee_games`` counted after fixtures without an id are dropped (NULL referees are one
    group). Payloads are parsed once for rows and counts."""
    counted = partition_count(fixture_rows(raw), ["referee"], "referee_games",
                              strategy=referee_strategy)
    return counted.select(*STG_FIXTURES_ORDER)


def stg_match_statistics(raw: DataFrame, spread: bool = False) -> DataFrame:
    """Long team statistics: one row per (fixture, team, stat). ``explode_outer`` at both levels,
    so an empty response or an empty statistics list still yields one row of NULLs."""
    return statistics_rows(latest_fixture_payloads(raw, S.STATISTICS, spread))


def statistics_rows(payloads: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The statistics model over chosen payloads, with columns of theirs carried along."""
    keep = ["fixture_id", *carry]
    parsed = parse_json_column(payloads, "raw_payload", S.STATISTICS_DDL, "j", keep=keep)
    teams = explode_path(parsed, "j.response", "f", outer=True, keep=keep)
    stats = explode_path(teams, "f.statistics", "stats", outer=True,
                         keep=[*keep, F.col("f.team.id").alias("team_id"),
                               F.col("f.team.name").alias("team_name")])
    return stats.select("fixture_id", "team_id", "team_name",
                        F.col("stats.type").alias("stats_type"),
                        F.col("stats.value").alias("stats_value"), *carry)


def stg_player_statistics(raw: DataFrame, spread: bool = False) -> DataFrame:
    """One row per (fixture, team, player, statistics entry); inner explodes drop empty lists."""
    return player_rows(latest_fixture_payloads(raw, S.PLAYERS, spread))


def player_rows(payloads: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The players model over chosen payloads, with columns of theirs carried along."""
    keep = ["fixture_id", *carry]
    parsed = parse_json_column(payloads, "raw_payload", S.PLAYERS_DDL, "j", keep=keep,
                               sent_ddl=S.PLAYERS_SENT_DDL)
    teams = explode_path(parsed, "j.response", "t", keep=keep)
    players = explode_path(teams, "t.players", "p",
                           keep=[*keep, F.col("t.team.id").alias("team_id"),
                                 F.col("t.team.name").alias("team_name")])
    entries = explode_path(players, "p.statistics", "s",
                           keep=[*keep, "team_id", "team_name",
                                 F.col("p.player.id").alias("player_id"),
                                 F.col("p.player.name").alias("player_name")])
    ids = ["fixture_id", "team_id", "team_name", "player_id", "player_name"]
    named = project_paths(entries, [(f"s.{path}", name) for path, name in S.PLAYER_STAT_COLUMNS],
                          keep=[*ids, *carry])
    return named.select(*ids, *[name for _, name in S.PLAYER_STAT_COLUMNS], *carry)
