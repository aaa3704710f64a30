"""Independent DuckDB SQL for every registered query.

The oracle recomputes each answer straight from the driver tables with the synthesis rules of
``sources.synth`` (integer arithmetic on ``orders``), without building or parsing any JSON, so it
checks the Spark path text -> parse -> explode -> pivot -> join -> aggregate end to end.

DuckDB differences handled here: sums are cast to BIGINT (DuckDB returns HUGEINT); rounding goes
through DECIMAL so ties round half-up like Spark; integer-looking text is checked with a regex
before TRY_CAST (DuckDB would round '12.5' where Spark yields NULL).
"""

from __future__ import annotations


# Parameters of the registered queries and, as fixed values, the labels, columns and casts of the
# models: stated here on their own, so that an error in the package's lists cannot hide.
BATCH_RUN_AT = "2002-01-01 00:00:00"
CLAIM_LIMIT = 30
TOP_OPEN_ORDERS = 20
TEAM_STATS = (
    ("Shots on Goal", "shots_on_goal", "int"), ("Shots off Goal", "shots_off_goal", "int"),
    ("Blocked Shots", "blocked_shots", "int"), ("Total Shots", "total_shots", "int"),
    ("Shots insidebox", "shots_insidebox", "int"), ("Shots outsidebox", "shots_outsidebox", "int"),
    ("Fouls", "fouls", "int"), ("Yellow Cards", "yellow_cards", "int0"),
    ("Red Cards", "red_cards", "int0"), ("Corner Kicks", "corner_kicks", "int"),
    ("Offsides", "offsides", "int0"), ("Goalkeeper Saves", "goalkeeper_saves", "int0"),
    ("Ball Possession", "ball_possession", "pct"), ("Total passes", "total_passes", "int"),
    ("Passes accurate", "passes_accurate", "int"), ("Passes %", "passes_percentage", "pct"))
PLAYER_STATS = (
    "minutes", "position", "rating", "captain", "substitute", "offsides", "total_shots",
    "shots_on_target", "goals_total", "goals_conceded", "assists", "saves", "passes_total",
    "passes_key", "passes_accuracy", "tackles_total", "tackles_blocks", "tackles_interceptions",
    "duels_total", "duels_won", "dribbles_attempts", "dribbles_success", "dribbles_past",
    "fouls_drawn", "fouls_committed", "cards_yellow", "cards_red", "penalty_won",
    "penalty_commited", "penalty_scored", "penalty_missed", "penalty_saved")
PLAYER_CASTS = {"position": None, "rating": "double", "captain": "boolean",
                "substitute": "boolean"}

_ENDPOINTS = "(VALUES ('statistics'), ('lineups'), ('players')) AS e(endpoint)"

_FX = """
fx AS (
    SELECT o_orderkey AS fixture_id,
           CAST(o_custkey // 10 AS INTEGER) AS league_id,
           CAST(year(o_orderdate) AS INTEGER) AS season,
           o_orderdate AS played_at,
           concat('Cup ', substr(o_orderpriority, 3)) AS tournament,
           concat('Round ', o_orderkey % 7) AS round,
           CASE o_orderstatus WHEN 'O' THEN 'NS' WHEN 'F' THEN 'FT'
                ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'PEN' ELSE 'AET' END END AS short,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS match_date,
           CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE concat('Ref ', o_custkey % 40) END AS referee,
           CAST(o_orderkey % 25 AS BIGINT) AS home_id,
           CAST((o_orderkey % 25 + 1 + o_custkey % 24) % 25 AS BIGINT) AS away_id,
           CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_custkey % 5 AS INTEGER) END AS home_goals,
           CASE WHEN o_orderstatus = 'O' THEN NULL
                ELSE CAST((o_orderkey + o_custkey) % 4 AS INTEGER) END AS away_goals
    FROM orders
),
fin AS (SELECT * FROM fx WHERE short <> 'NS')"""

_STG_FIXTURES = """
stg AS (
    SELECT fixture_id, match_date, referee,
           count(*) OVER (PARTITION BY referee) AS referee_games,
           concat('Long ', short) AS match_status,
           concat('V ', home_id) AS venue_name, concat('C ', home_id) AS venue_city,
           tournament AS tournament_name, season AS tournament_season, round AS tournament_round,
           home_id AS home_team_id, concat('Team ', home_id) AS home_team_name,
           away_id AS away_team_id, concat('Team ', away_id) AS away_team_name,
           home_goals, away_goals
    FROM fx
)"""

_LABELS = ", ".join(f"({k}, '{label}')" for k, (label, _, _) in enumerate(TEAM_STATS))

_STAT_LONG = f"""
sides AS (
    SELECT fixture_id, CAST(home_id AS INTEGER) AS t FROM fin WHERE fixture_id % 17 <> 0
    UNION ALL
    SELECT fixture_id, CAST(away_id AS INTEGER) AS t FROM fin WHERE fixture_id % 17 <> 0
),
labels AS (SELECT * FROM (VALUES {_LABELS}) AS l(k, label)),
cells AS (
    SELECT s.fixture_id, s.t, l.k, l.label, s.fixture_id * 31 + s.t * 17 + l.k * 7 AS h
    FROM sides s, labels l
    WHERE s.fixture_id % 50 <> 0 AND NOT (l.k = 10 AND s.fixture_id % 9 = 0)
),
stat_long AS (
    SELECT fixture_id, t AS team_id, concat('Team ', t) AS team_name, label AS stats_type,
           CASE WHEN k IN (12, 15) THEN concat(20 + h % 60, '%')
                WHEN k IN (7, 8, 10, 11) THEN
                    CASE WHEN (h % 20) % 4 = 0 THEN NULL ELSE CAST((h % 20) % 6 AS VARCHAR) END
                WHEN k = 6 AND fixture_id % 11 = 0 THEN 'N/A'
                ELSE CAST(h % 20 AS VARCHAR) END AS stats_value
    FROM cells
    UNION ALL
    SELECT fixture_id, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
           CAST(NULL AS VARCHAR)
    FROM fin WHERE fixture_id % 17 <> 0 AND fixture_id % 50 = 0
)"""


def _int(v: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({v}), '[+-]?[0-9]+') "
            f"THEN TRY_CAST(trim({v}) AS INTEGER) END")


def _pct(v: str) -> str:
    return f"TRY_CAST(replace({v}, '%', '') AS DOUBLE) / 100"


def _team_measures() -> str:
    cols = []
    for label, name, kind in TEAM_STATS:
        if kind == "int":
            e = _int("stats_value")
        elif kind == "int0":
            e = f"coalesce({_int('stats_value')}, 0)"
        else:
            e = _pct("stats_value")
        cols.append(f"max(CASE WHEN stats_type = '{label}' THEN {e} END) AS {name}")
    return ",\n           ".join(cols)


_TEAM_STATS = f"""
team_stats AS (
    SELECT fixture_id, team_id, max(team_name) AS team_name,
           {_team_measures()}
    FROM stat_long GROUP BY fixture_id, team_id
)"""

_MATCH_RESULTS = """
mr AS (
    SELECT fixture_id, match_date, tournament_name, tournament_round,
           home_team_id AS team_id, home_team_name AS team_name,
           home_goals AS goals_for, away_goals AS goals_against,
           CASE WHEN home_goals > away_goals THEN 'W' WHEN home_goals < away_goals THEN 'L'
                ELSE 'D' END AS result
    FROM stg
    UNION ALL
    SELECT fixture_id, match_date, tournament_name, tournament_round,
           away_team_id, away_team_name, away_goals, home_goals,
           CASE WHEN away_goals > home_goals THEN 'W' WHEN away_goals < home_goals THEN 'L'
                ELSE 'D' END
    FROM stg
)"""


def _round2(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(18, 8)), 2) AS DOUBLE)"


_GOLD = f"""
WITH {_FX}, {_STG_FIXTURES}, {_STAT_LONG}, {_TEAM_STATS}, {_MATCH_RESULTS}
SELECT mr.team_id, mr.tournament_name, max(mr.team_name) AS team_name,
       count(mr.fixture_id) AS matches_played,
       CAST(sum(CASE WHEN result = 'W' THEN 3 WHEN result = 'D' THEN 1 ELSE 0 END) AS BIGINT) AS points,
       CAST(sum(CASE WHEN result = 'W' THEN 1 ELSE 0 END) AS BIGINT) AS total_wins,
       CAST(sum(CASE WHEN result = 'D' THEN 1 ELSE 0 END) AS BIGINT) AS total_draws,
       CAST(sum(CASE WHEN result = 'L' THEN 1 ELSE 0 END) AS BIGINT) AS total_losses,
       CAST(sum(goals_for) AS BIGINT) AS total_goals,
       {_round2('avg(goals_for)')} AS avg_goals_for,
       CAST(sum(goals_against) AS BIGINT) AS total_goals_against,
       {_round2('avg(goals_against)')} AS avg_goals_against,
       {_round2('avg(CAST(s.ball_possession AS DECIMAL(10, 4)))')} AS avg_ball_possession,
       {_round2('avg(CAST(s.passes_percentage AS DECIMAL(10, 4)))')} AS avg_passes_percentage,
       {_round2("CAST(sum(CASE WHEN result = 'W' THEN 3 WHEN result = 'D' THEN 1 ELSE 0 END) AS BIGINT) / 21 * 100")} AS points_pct
FROM mr JOIN team_stats s ON mr.fixture_id = s.fixture_id AND mr.team_id = s.team_id
GROUP BY mr.tournament_name, mr.team_id
"""

# ---- players -------------------------------------------------------------------------------

def _player_leaves() -> list[tuple[str, str]]:
    """(output column, SQL text expression) for the 32 statistics columns, in output order."""
    special = {
        "minutes": "CASE WHEN n > 9 THEN NULL ELSE CAST(90 - n AS VARCHAR) END",
        "position": "CASE WHEN n = 1 THEN 'G' WHEN n <= 5 THEN 'D' WHEN n <= 9 THEN 'M' ELSE 'F' END",
        "rating": "concat(5 + n % 5, '.', fixture_id % 10)",
        "captain": "CASE WHEN n = 1 THEN 'true' ELSE 'false' END",
        "substitute": "CASE WHEN n > 8 THEN 'true' ELSE 'false' END",
        "passes_accuracy": "CASE WHEN n % 4 = 0 THEN concat(60 + n, '%') ELSE CAST(60 + n AS VARCHAR) END",
    }
    out, j = [], 0
    for name in PLAYER_STATS:
        if name in special:
            out.append((name, special[name]))
        else:
            j += 1
            v = f"(fixture_id + 3 * t + 5 * n + {j}) % 9"
            out.append((name, f"CASE WHEN {v} = 0 THEN NULL ELSE CAST({v} AS VARCHAR) END"))
    return out


_PLAYER_ROWS = """
psides AS (
    SELECT fixture_id, CAST(home_id AS INTEGER) AS t FROM fin WHERE fixture_id % 17 <> 0
    UNION ALL
    SELECT fixture_id, CAST(away_id AS INTEGER) FROM fin
    WHERE fixture_id % 17 <> 0 AND fixture_id % 13 <> 0
),
prow AS (
    SELECT p.fixture_id, p.t, CAST(g.n AS INTEGER) AS n
    FROM psides p, range(1, 12) AS g(n)
    WHERE NOT (g.n = 11 AND p.fixture_id % 7 = 0)
)"""


def _stg_players_sql() -> str:
    cols = ",\n       ".join(f"{e} AS {name}" for name, e in _player_leaves())
    return f"""
WITH {_FX}, {_PLAYER_ROWS}
SELECT fixture_id, t AS team_id, concat('Team ', t) AS team_name,
       CAST(t * 100 + n AS INTEGER) AS player_id, concat('Player ', t * 100 + n) AS player_name,
       {cols}
FROM prow
"""


def _int_players_sql() -> str:
    typed = []
    for name, e in _player_leaves():
        target = PLAYER_CASTS.get(name, "int")
        if target is None:
            typed.append(f"{e} AS {name}")
        elif target == "double":
            typed.append(f"TRY_CAST({e} AS DOUBLE) AS {name}")
        elif target == "boolean":
            typed.append(f"TRY_CAST({e} AS BOOLEAN) AS {name}")
        else:
            typed.append(f"{_int(e)} AS {name}")
    cols = ",\n       ".join(typed)
    return f"""
WITH {_FX}, {_PLAYER_ROWS}
SELECT fixture_id, t AS team_id, concat('Team ', t) AS team_name,
       CAST(t * 100 + n AS INTEGER) AS player_id, concat('Player ', t * 100 + n) AS player_name,
       {cols}
FROM prow WHERE n <= 9
"""


# ---- queue ---------------------------------------------------------------------------------

_QUEUE = f"""
prior AS (
    SELECT o_orderkey AS fixture_id, e.endpoint,
           CASE WHEN o_orderkey % 8 = 0 THEN 'done' ELSE 'failed' END AS status,
           CAST(1 AS INTEGER) AS attempts,
           o_orderdate + INTERVAL 48 HOUR AS last_attempt_at
    FROM orders, {_ENDPOINTS}
    WHERE o_orderkey % 4 = 0
),
seeded AS (
    SELECT * FROM prior
    UNION ALL
    SELECT f.fixture_id, e.endpoint, 'pending', CAST(0 AS INTEGER), CAST(NULL AS TIMESTAMP)
    FROM fin f, {_ENDPOINTS}
    WHERE NOT EXISTS (SELECT 1 FROM prior p
                      WHERE p.fixture_id = f.fixture_id AND p.endpoint = e.endpoint)
)"""

_OUTCOMES = f"""
outc AS (
    SELECT f.fixture_id, e.endpoint,
           CASE WHEN f.fixture_id % 17 = 0 THEN 'failed' ELSE 'done' END AS status,
           f.played_at + INTERVAL 24 HOUR AS att
    FROM fin f, {_ENDPOINTS}
    UNION ALL
    SELECT f.fixture_id, e.endpoint, 'done', f.played_at + INTERVAL 23 HOUR
    FROM fin f, (VALUES ('statistics'), ('players')) AS e(endpoint)
    WHERE f.fixture_id % 3 = 0 AND f.fixture_id % 17 <> 0
),
red AS (
    SELECT fixture_id, endpoint, count(*) AS n, arg_max(status, att) AS st, max(att) AS att
    FROM outc GROUP BY fixture_id, endpoint
),
marked AS (
    SELECT coalesce(q.fixture_id, r.fixture_id) AS fixture_id,
           coalesce(q.endpoint, r.endpoint) AS endpoint,
           CASE WHEN r.fixture_id IS NOT NULL THEN r.st ELSE q.status END AS status,
           CAST(CASE WHEN r.fixture_id IS NOT NULL AND q.fixture_id IS NOT NULL THEN q.attempts + r.n
                     WHEN r.fixture_id IS NOT NULL THEN r.n ELSE q.attempts END AS INTEGER) AS attempts,
           CASE WHEN r.fixture_id IS NOT NULL THEN r.att ELSE q.last_attempt_at END AS last_attempt_at
    FROM seeded q FULL OUTER JOIN red r ON q.fixture_id = r.fixture_id AND q.endpoint = r.endpoint
)"""

_BATCH = f"""
claimed AS (
    SELECT fixture_id, endpoint, status FROM seeded
    WHERE status IN ('pending', 'failed') ORDER BY fixture_id, endpoint LIMIT {CLAIM_LIMIT}
),
batch AS (
    SELECT c.fixture_id, c.endpoint,
           CASE WHEN f.fixture_id IS NOT NULL AND f.fixture_id % 17 <> 0 THEN 'done'
                ELSE 'failed' END AS status
    FROM claimed c LEFT JOIN fin f ON c.fixture_id = f.fixture_id
)"""

_LANDED = """
groups AS (
    SELECT league_id, season, max(played_at) AS last_played,
           max(CASE WHEN short <> 'NS' THEN played_at END) AS last_finished,
           count(*) + CASE WHEN (league_id + season) % 7 = 0 THEN 1 ELSE 0 END AS n_fixtures
    FROM fx GROUP BY league_id, season
)"""


def oracle_sql() -> dict[str, str]:
    w = f"WITH {_FX}"
    q = _queries(w)
    # The streaming landing job must leave the same log and queue as the batch path.
    q["stream_tagged_payloads"] = q["tagged_payloads"]
    q["stream_queue_mark"] = q["queue_mark"]
    q["one_log_gold"] = q["team_tournament_profile"]
    # So do models kept up to date load by load, and the views of a layer.
    q["incremental_gold"] = q["team_tournament_profile"]
    q["silver_view_fixtures"] = q["stg_fixtures"]
    q["silver_view_statistics"] = q["stg_match_statistics"]
    q["silver_view_players"] = q["stg_player_statistics"]
    q["gold_read_order"] = f"""
        WITH g AS ({q["team_tournament_profile"]})
        SELECT *, row_number() OVER (ORDER BY tournament_name, points_pct DESC, total_wins DESC,
                                     total_goals DESC, avg_ball_possession DESC NULLS LAST,
                                     team_id) AS position FROM g"""
    q["bronze_tables"] = f"""
        SELECT 'wc_project.bronze.raw_api_responses' AS qualified_name, count(*) AS n_rows
        FROM ({q["tagged_payloads"]})
        UNION ALL
        SELECT 'wc_project.bronze.ingestion_checkpoint', count(*) FROM ({q["queue_seed"]})"""
    # Bootstrapping from the landed payloads seeds exactly what seeding from the log does.
    q["bootstrap_queue"] = q["queue_seed"]
    return q


def _queries(w: str) -> dict[str, str]:
    return {
        "stg_fixtures": f"{w}, {_STG_FIXTURES} SELECT * FROM stg",
        "stg_match_statistics": f"{w}, {_STAT_LONG} SELECT * FROM stat_long",
        "int_team_match_stats": f"{w}, {_STAT_LONG}, {_TEAM_STATS} SELECT * FROM team_stats",
        "match_results": f"{w}, {_STG_FIXTURES}, {_MATCH_RESULTS} SELECT * FROM mr",
        "team_tournament_profile": _GOLD,
        "stg_player_statistics": _stg_players_sql(),
        "int_player_stats": _int_players_sql(),
        "latest_payload_by_season": f"""{w}
            SELECT league_id, season, max(played_at) + INTERVAL 24 HOUR AS ingested_at
            FROM fx GROUP BY league_id, season""",
        "latest_payload_by_fixture": f"""{w}
            SELECT fixture_id, played_at + INTERVAL 24 HOUR AS ingested_at
            FROM fin WHERE fixture_id % 17 <> 0""",
        "referee_games": f"{w}, {_STG_FIXTURES} SELECT fixture_id, referee, referee_games FROM stg",
        "finished_fixtures": f"{w} SELECT fixture_id FROM fin",
        "queue_seed": f"{w}, {_QUEUE} SELECT * FROM seeded",
        "queue_seed_offered": f"{w} SELECT count(*) * 3 AS pairs_offered FROM fin",
        "queue_claim": f"""{w}, {_QUEUE}
            SELECT fixture_id, endpoint, status FROM seeded WHERE status IN ('pending', 'failed')
            ORDER BY fixture_id, endpoint LIMIT {CLAIM_LIMIT}""",
        "queue_claim_pending_only": f"""{w}, {_QUEUE}
            SELECT fixture_id, endpoint, status FROM seeded WHERE status = 'pending'
            ORDER BY fixture_id, endpoint LIMIT {CLAIM_LIMIT}""",
        "queue_mark": f"{w}, {_QUEUE}, {_OUTCOMES} SELECT * FROM marked",
        "queue_requeue": f"""{w}, {_QUEUE}, {_OUTCOMES}
            SELECT fixture_id, endpoint,
                   CASE WHEN status = 'failed' AND endpoint = 'statistics' THEN 'pending'
                        ELSE status END AS status,
                   attempts, last_attempt_at
            FROM marked""",
        "queue_outcomes": f"""{w}, {_QUEUE}, {_BATCH}
            SELECT count(*) FILTER (WHERE status = 'done') AS done,
                   count(*) FILTER (WHERE status = 'failed') AS failed,
                   count(*) AS requested
            FROM batch""",
        "queue_after_backfill": f"""{w}, {_QUEUE}, {_BATCH}
            SELECT q.fixture_id, q.endpoint, coalesce(b.status, q.status) AS status,
                   CAST(q.attempts + CASE WHEN b.fixture_id IS NULL THEN 0 ELSE 1 END AS INTEGER)
                       AS attempts,
                   CASE WHEN b.fixture_id IS NULL THEN q.last_attempt_at
                        ELSE TIMESTAMP '{BATCH_RUN_AT}' END AS last_attempt_at
            FROM seeded q LEFT JOIN batch b
              ON q.fixture_id = b.fixture_id AND q.endpoint = b.endpoint""",
        "queue_dry_run": f"""{w}, {_QUEUE}
            SELECT fixture_id, endpoint, status FROM seeded WHERE status IN ('pending', 'failed')
            ORDER BY fixture_id, endpoint LIMIT 30""",      # the default budget
        "queue_live_backfill": f"""{w}, {_QUEUE}, {_BATCH},
            live AS (
                SELECT b.fixture_id, b.endpoint,
                       CASE WHEN q.last_attempt_at IS NULL THEN b.status ELSE 'failed' END AS status
                FROM batch b JOIN seeded q
                  ON q.fixture_id = b.fixture_id AND q.endpoint = b.endpoint)
            SELECT q.fixture_id, q.endpoint, coalesce(b.status, q.status) AS status,
                   CAST(q.attempts + CASE WHEN b.fixture_id IS NULL THEN 0 ELSE 1 END AS INTEGER)
                       AS attempts,
                   b.fixture_id IS NOT NULL OR q.last_attempt_at IS NOT NULL AS attempted
            FROM seeded q LEFT JOIN live b
              ON q.fixture_id = b.fixture_id AND q.endpoint = b.endpoint""",
        "queue_refused_keys": f"""{w}, {_QUEUE}
            SELECT fixture_id, endpoint, offered, tracked FROM (
                SELECT f.fixture_id, e.endpoint,
                       CAST(CASE WHEN f.short = 'NS' THEN 1 ELSE 2 END AS BIGINT) AS offered,
                       EXISTS (SELECT 1 FROM seeded q WHERE q.fixture_id = f.fixture_id
                               AND q.endpoint = e.endpoint) AS tracked
                FROM fx f, {_ENDPOINTS})
            WHERE offered > 1 OR tracked""",
        "queue_endpoint_paths": f"""{w}, {_QUEUE}
            SELECT fixture_id, endpoint, concat('fixtures/', endpoint) AS path FROM seeded""",
        "payload_texts": """
            SELECT o_orderkey, concat('{"id":', o_orderkey, ',"status":{"short":"', o_orderstatus,
                   '","long":null},"teams":[', o_custkey, ']}') AS raw_payload FROM orders""",
        "queue_duplicate_keys": """
            SELECT CAST(0 AS BIGINT) AS fixture_id, '' AS endpoint, CAST(0 AS BIGINT) AS n_rows
            WHERE false""",                     # the key of the queue: no pair twice
        "log_repeated_pairs": f"""{w}
            SELECT fixture_id, e.endpoint, CAST(2 AS BIGINT) AS n_payloads
            FROM fin, (VALUES ('statistics'), ('players')) AS e(endpoint)
            WHERE fixture_id % 3 = 0 AND fixture_id % 17 <> 0""",
        "payload_audit": f"""{w}, {_LANDED}
            SELECT 'fixtures' AS endpoint, 2 * count(*) AS n_landed, 2 * count(*) AS n_ok,
                   CAST(0 AS BIGINT) AS n_bad, CAST(2 * sum(n_fixtures) AS BIGINT) AS ok_results
            FROM groups
            UNION ALL
            SELECT 'standings', count(*), count(*), 0, CAST(count(*) AS BIGINT)
            FROM groups WHERE last_finished IS NOT NULL
            UNION ALL
            SELECT 'lineups', count(*), count(*) FILTER (WHERE fixture_id % 17 <> 0),
                   count(*) FILTER (WHERE fixture_id % 17 = 0),
                   CAST(2 * count(*) FILTER (WHERE fixture_id % 17 <> 0) AS BIGINT)
            FROM fin
            UNION ALL
            SELECT 'players', count(*) + count(*) FILTER (WHERE fixture_id % 3 = 0 AND fixture_id % 17 <> 0),
                   count(*) FILTER (WHERE fixture_id % 17 <> 0)
                     + count(*) FILTER (WHERE fixture_id % 3 = 0 AND fixture_id % 17 <> 0),
                   count(*) FILTER (WHERE fixture_id % 17 = 0),
                   CAST(2 * (count(*) FILTER (WHERE fixture_id % 17 <> 0)
                     + count(*) FILTER (WHERE fixture_id % 3 = 0 AND fixture_id % 17 <> 0)) AS BIGINT)
            FROM fin
            UNION ALL
            SELECT 'statistics', count(*) + count(*) FILTER (WHERE fixture_id % 3 = 0 AND fixture_id % 17 <> 0),
                   count(*) FILTER (WHERE fixture_id % 17 <> 0)
                     + count(*) FILTER (WHERE fixture_id % 3 = 0 AND fixture_id % 17 <> 0),
                   count(*) FILTER (WHERE fixture_id % 17 = 0),
                   CAST(2 * (count(*) FILTER (WHERE fixture_id % 17 <> 0 AND fixture_id % 50 <> 0)
                     + count(*) FILTER (WHERE fixture_id % 3 = 0 AND fixture_id % 17 <> 0
                                        AND fixture_id % 50 <> 0)) AS BIGINT)
            FROM fin""",
        "payload_quarantine": f"""{w}
            SELECT e.endpoint, fixture_id, CAST(NULL AS INTEGER) AS league_id,
                   CAST(NULL AS INTEGER) AS season, played_at + INTERVAL 24 HOUR AS fetched_at,
                   '{{"fixture":"no data"}}' AS error_text
            FROM fin, {_ENDPOINTS} WHERE fixture_id % 17 = 0""",
        "tagged_payloads": f"""{w}, {_LANDED}
            SELECT last_played + INTERVAL 24 HOUR AS ingested_at, 'fixtures' AS endpoint,
                   CAST(NULL AS BIGINT) AS fixture_id, league_id, season FROM groups
            UNION ALL
            SELECT last_played + INTERVAL 23 HOUR, 'fixtures', NULL, league_id, season FROM groups
            UNION ALL
            SELECT last_finished + INTERVAL 24 HOUR, 'standings', NULL, NULL, NULL
            FROM groups WHERE last_finished IS NOT NULL
            UNION ALL
            SELECT played_at + INTERVAL 24 HOUR, e.endpoint, fixture_id, NULL, NULL
            FROM fin, {_ENDPOINTS} WHERE fixture_id % 17 <> 0
            UNION ALL
            SELECT played_at + INTERVAL 23 HOUR, e.endpoint, fixture_id, NULL, NULL
            FROM fin, (VALUES ('statistics'), ('players')) AS e(endpoint)
            WHERE fixture_id % 3 = 0 AND fixture_id % 17 <> 0""",
        "latest_event_per_user": """
            SELECT * FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "parse_event_props": """
            SELECT event_id, user_id, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k
            FROM events""",
        "orders_pivot_by_status": """
            SELECT o_custkey, count(*) AS n_orders,
                   max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS max_price_f,
                   max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS max_price_o,
                   max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS max_price_p
            FROM orders GROUP BY o_custkey""",
        "top_open_orders": f"""
            SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
            WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT {TOP_OPEN_ORDERS}""",
    }
