"""Fixed schemas: bronze tables, landed payloads, and the schema-on-read DDL of each endpoint.

Everything here is a fixed value that must equal the source pipeline's contract (column names,
types, JSON field names including the API's own spellings ``on`` and ``commited``). Nothing is
inferred at runtime.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import types as T

# ---- bronze tables (fixed values) -------------------------------------------------------------

RAW_API_RESPONSES = T.StructType([
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("fixture_id", T.LongType()),
    T.StructField("raw_payload", T.StringType()),
    T.StructField("league_id", T.IntegerType()),
    T.StructField("season", T.IntegerType()),
])

INGESTION_CHECKPOINT = T.StructType([
    T.StructField("fixture_id", T.LongType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("last_attempt_at", T.TimestampType()),
])

CHECKPOINT_KEYS = ("fixture_id", "endpoint")

# What a fetcher leaves behind for one request: the endpoint, the request parameters and the body.
LANDED = T.StructType([
    T.StructField("endpoint", T.StringType()),
    T.StructField("fixture_id", T.LongType()),
    T.StructField("league_id", T.IntegerType()),
    T.StructField("season", T.IntegerType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("raw_payload", T.StringType()),
])

# Landed payloads with the envelope audit recorded once, at landing time.
LANDED_AUDITED = T.StructType(LANDED.fields + [
    T.StructField("is_ok", T.BooleanType()),
    T.StructField("error_text", T.StringType()),
    T.StructField("result_count", T.IntegerType()),
])

# ---- fixed values: endpoints, statuses, finished codes ----------------------------------------

FIXTURES = "fixtures"
STANDINGS = "standings"
STATISTICS = "statistics"
LINEUPS = "lineups"
PLAYERS = "players"

# What the work queue tracks for each finished fixture; the order is part of the contract.
CHECKPOINT_ENDPOINTS = ("statistics", "lineups", "players")

# Where each queued endpoint lives below the API root.
ENDPOINT_PATHS = {
    "statistics": "fixtures/statistics",
    "lineups": "fixtures/lineups",
    "players": "fixtures/players",
}

PENDING, DONE, FAILED = "pending", "done", "failed"
STATUSES = (PENDING, DONE, FAILED)

# A fixture in one of these states will not change any more.
FINISHED_STATUSES = ("FT", "PEN", "AET")

DEFAULT_DAILY_BUDGET = 30

# ---- schema-on-read DDL (fixed values) --------------------------------------------------------

FIXTURES_DDL = """response ARRAY<STRUCT<
    fixture: STRUCT<id: BIGINT, date: STRING, referee: STRING,
        status: STRUCT<short: STRING, long: STRING>,
        venue: STRUCT<name: STRING, city: STRING>>,
    league: STRUCT<name: STRING, season: INT, round: STRING>,
    teams: STRUCT<
        home: STRUCT<id: BIGINT, name: STRING, code: STRING>,
        away: STRUCT<id: BIGINT, name: STRING, code: STRING>>,
    goals: STRUCT<home: INT, away: INT>
>>"""

STATISTICS_DDL = """response ARRAY<STRUCT<
    team: STRUCT<id: INT, name: STRING>,
    statistics: ARRAY<STRUCT<type: STRING, value: STRING>>
>>"""

# Leaf groups of one player statistics entry, each leaf a STRING.
PLAYER_STAT_GROUPS = (
    ("games", ("minutes", "position", "rating", "captain", "substitute")),
    ("offsides", ()),
    ("shots", ("total", "on")),
    ("goals", ("total", "conceded", "assists", "saves")),
    ("passes", ("total", "key", "accuracy")),
    ("tackles", ("total", "blocks", "interceptions")),
    ("duels", ("total", "won")),
    ("dribbles", ("attempts", "success", "past")),
    ("fouls", ("drawn", "committed")),
    ("cards", ("yellow", "red")),
    ("penalty", ("won", "commited", "scored", "missed", "saved")),
)


# What the API sends for a leaf of a statistics entry, where it is not a whole number.
PLAYER_LEAF_KINDS = {"games.position": "STRING", "games.rating": "STRING",
                     "games.captain": "BOOLEAN", "games.substitute": "BOOLEAN",
                     "passes.accuracy": "STRING"}


def _players_ddl(kind: Callable[[str], str]) -> str:
    parts = []
    for group, leaves in PLAYER_STAT_GROUPS:
        if leaves:
            parts.append(f"{group}: STRUCT<" + ", ".join(
                f"{leaf}: {kind(f'{group}.{leaf}')}" for leaf in leaves) + ">")
        else:
            parts.append(f"{group}: {kind(group)}")
    return ("response ARRAY<STRUCT<team: STRUCT<id: INT, name: STRING>, "
            "players: ARRAY<STRUCT<player: STRUCT<id: INT, name: STRING>, "
            f"statistics: ARRAY<STRUCT<{', '.join(parts)}>>>>>>")


PLAYERS_DDL = _players_ddl(lambda path: "STRING")
# The same with the leaves typed as they are sent.
PLAYERS_SENT_DDL = _players_ddl(lambda path: PLAYER_LEAF_KINDS.get(path, "BIGINT"))

# Output columns of the player projection: (path inside one statistics entry, output name).
PLAYER_STAT_COLUMNS = (
    ("games.minutes", "minutes"),
    ("games.position", "position"),
    ("games.rating", "rating"),
    ("games.captain", "captain"),
    ("games.substitute", "substitute"),
    ("offsides", "offsides"),
    ("shots.total", "total_shots"),
    ("shots.on", "shots_on_target"),
    ("goals.total", "goals_total"),
    ("goals.conceded", "goals_conceded"),
    ("goals.assists", "assists"),
    ("goals.saves", "saves"),
    ("passes.total", "passes_total"),
    ("passes.key", "passes_key"),
    ("passes.accuracy", "passes_accuracy"),
    ("tackles.total", "tackles_total"),
    ("tackles.blocks", "tackles_blocks"),
    ("tackles.interceptions", "tackles_interceptions"),
    ("duels.total", "duels_total"),
    ("duels.won", "duels_won"),
    ("dribbles.attempts", "dribbles_attempts"),
    ("dribbles.success", "dribbles_success"),
    ("dribbles.past", "dribbles_past"),
    ("fouls.drawn", "fouls_drawn"),
    ("fouls.committed", "fouls_committed"),
    ("cards.yellow", "cards_yellow"),
    ("cards.red", "cards_red"),
    ("penalty.won", "penalty_won"),
    ("penalty.commited", "penalty_commited"),
    ("penalty.scored", "penalty_scored"),
    ("penalty.missed", "penalty_missed"),
    ("penalty.saved", "penalty_saved"),
)

# Target type of each player column after the intermediate cast; unlisted columns become INT.
PLAYER_CAST_OVERRIDES = {
    "position": None,          # stays STRING
    "rating": "double",
    "captain": "boolean",
    "substitute": "boolean",
}

# Long -> wide team statistics: (type label as sent by the API, output column, measure kind).
# kind: "int" = try_cast INT; "int0" = try_cast INT, NULL -> 0 when the row exists;
# "pct" = '61%' -> 0.61 DOUBLE.
TEAM_STAT_SPEC = (
    ("Shots on Goal", "shots_on_goal", "int"),
    ("Shots off Goal", "shots_off_goal", "int"),
    ("Blocked Shots", "blocked_shots", "int"),
    ("Total Shots", "total_shots", "int"),
    ("Shots insidebox", "shots_insidebox", "int"),
    ("Shots outsidebox", "shots_outsidebox", "int"),
    ("Fouls", "fouls", "int"),
    ("Yellow Cards", "yellow_cards", "int0"),
    ("Red Cards", "red_cards", "int0"),
    ("Corner Kicks", "corner_kicks", "int"),
    ("Offsides", "offsides", "int0"),
    ("Goalkeeper Saves", "goalkeeper_saves", "int0"),
    ("Ball Possession", "ball_possession", "pct"),
    ("Total passes", "total_passes", "int"),
    ("Passes accurate", "passes_accurate", "int"),
    ("Passes %", "passes_percentage", "pct"),
)
