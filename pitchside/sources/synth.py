"""Landed API payloads derived from the driver's ``orders`` table, built entirely on Spark.

One order is one fixture. Every field is integer arithmetic on the order's columns, so an
independent SQL engine can recompute each model's answer without touching JSON, while our pipeline
goes through the full text -> parse -> explode path. The rules:

fixture          fixture_id = o_orderkey; league_id = o_custkey div 10; season = year(o_orderdate)
                 (a league-season holds ~14 fixtures at any scale factor, so a fixtures payload
                 stays bounded); tournament 'Cup ' || substr(o_orderpriority, 3); round
                 'Round ' || key % 7; status O -> NS, F -> FT, P -> PEN (even key) / AET (odd);
                 referee NULL when custkey % 10 = 0 else 'Ref ' || custkey % 40; home team
                 h = key % 25, away (h + 1 + custkey % 24) % 25; goals NULL for NS, else
                 custkey % 5 and (key + custkey) % 4; venue 'V h' / 'C h'.
fixtures payload one per league-season at max(o_orderdate) + 24h, plus a stale copy at + 23h with
                 every goal 99; league-seasons with (league_id + season) % 7 = 0 also carry one
                 fixture with a NULL id (status TBD, referee 'Ref 1').
standings        one per league-season, untagged, never parsed downstream.
details          finished fixtures (status not NS) x (statistics, lineups, players) at
                 o_orderdate + 24h. key % 17 = 0: an error envelope instead (rejected by the audit).
                 Statistics and players also land a stale copy at + 23h when key % 3 = 0 (and the
                 key is not rejected), with every value 99.
statistics       per team t and stat index k, h = key*31 + t*17 + k*7: percentages '{20+h%60}%';
                 cards / offsides / saves JSON null when (h%20)%4 = 0 else (h%20)%6; Offsides
                 absent when key % 9 = 0; Fouls 'N/A' when key % 11 = 0; others h % 20;
                 key % 50 = 0 -> empty response.
players          per team t and n in 1..11: id t*100+n; minutes null when n > 9 else 90-n;
                 rating '{5+n%5}.{key%10}'; captain n = 1; substitute n > 8; position G/D/M/F;
                 passes.accuracy '{60+n}%' when n % 4 = 0 else 60+n; leaf j of the other 26
                 (in schema order) (key + 3t + 5n + j) % 9, JSON null when 0; no statistics for
                 n = 11 when key % 7 = 0; no players for the away team when key % 13 = 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.sources import schemas as S

JSON_OPTS = {"ignoreNullFields": "false"}

def _season_keys() -> list[Column]:
    return [(F.col("o_custkey").cast("bigint") / 10).cast("int").alias("league_id"),
            F.year("o_orderdate").cast("int").alias("season")]


def fixture_facts(orders: DataFrame) -> DataFrame:
    """One row per order with the flat fixture attributes."""
    if "league_id" not in orders.columns:
        orders = orders.select("*", *_season_keys())
    key = F.col("o_orderkey")
    cust = F.col("o_custkey")
    st = F.col("o_orderstatus")
    short = (F.when(st == "O", "NS").when(st == "F", "FT")
             .otherwise(F.when(key % 2 == 0, "PEN").otherwise("AET")))
    home = (key % 25).cast("bigint")
    away = ((key % 25 + 1 + cust % 24) % 25).cast("bigint")
    not_started = short == "NS"
    return orders.select(
        key.alias("fixture_id"),
        "league_id",
        "season",
        F.col("o_orderdate").alias("played_at"),
        F.concat(F.lit("Cup "), F.substring("o_orderpriority", 3, 100)).alias("tournament"),
        F.concat(F.lit("Round "), (key % 7).cast("string")).alias("round"),
        short.alias("short"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("match_date"),
        F.when(cust % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Ref "), (cust % 40).cast("string"))).alias("referee"),
        home.alias("home_id"),
        away.alias("away_id"),
        F.when(not_started, F.lit(None)).otherwise(cust % 5).cast("int").alias("home_goals"),
        F.when(not_started, F.lit(None)).otherwise((key + cust) % 4).cast("int").alias("away_goals"),
    )


def _team(id_col: Column) -> Column:
    return F.struct(id_col.alias("id"),
                    F.concat(F.lit("Team "), id_col.cast("string")).alias("name"),
                    F.concat(F.lit("T"), id_col.cast("string")).alias("code"))


def _fixture_element(r: Column, season: Column, stale: Column) -> Column:
    goal = lambda c: F.when(stale, F.lit(99)).otherwise(r[c]).cast("int")
    return F.struct(
        F.struct(
            r["fixture_id"].alias("id"),
            r["match_date"].alias("date"),
            r["referee"].alias("referee"),
            F.struct(r["short"].alias("short"),
                     F.concat(F.lit("Long "), r["short"]).alias("long")).alias("status"),
            F.struct(F.concat(F.lit("V "), r["home_id"].cast("string")).alias("name"),
                     F.concat(F.lit("C "), r["home_id"].cast("string")).alias("city")
                     ).alias("venue"),
        ).alias("fixture"),
        F.struct(r["tournament"].alias("name"), season.alias("season"),
                 r["round"].alias("round")).alias("league"),
        F.struct(_team(r["home_id"]).alias("home"),
                 _team(r["away_id"]).alias("away")).alias("teams"),
        F.struct(goal("home_goals").alias("home"), goal("away_goals").alias("away")).alias("goals"),
    )


def _envelope(get: str, params: Column, response: Column) -> Column:
    return F.to_json(F.struct(
        F.lit(get).alias("get"),
        params.alias("parameters"),
        F.array().cast("array<string>").alias("errors"),
        F.size(response).alias("results"),
        response.alias("response"),
    ), JSON_OPTS)


def _error_envelope(get: str, params: Column) -> Column:
    return F.to_json(F.struct(
        F.lit(get).alias("get"),
        params.alias("parameters"),
        F.struct(F.lit("no data").alias("fixture")).alias("errors"),
        F.lit(0).alias("results"),
        F.array().cast("array<string>").alias("response"),
    ), JSON_OPTS)


def _landed(endpoint: Column, fixture_id: Column, league_id: Column, season: Column,
            fetched_at: Column, payload: Column) -> list[Column]:
    return [endpoint.alias("endpoint"), fixture_id.cast("bigint").alias("fixture_id"),
            league_id.cast("int").alias("league_id"), season.cast("int").alias("season"),
            fetched_at.cast("timestamp").alias("fetched_at"), payload.alias("raw_payload")]


def _narrow(**fixed: Column) -> Column:
    """What an element of a fixtures payload is made of; ``fixed`` replaces columns of the row."""
    types = {"fixture_id": "bigint", "match_date": "string", "referee": "string", "short": "string",
             "home_id": "bigint", "away_id": "bigint", "tournament": "string", "round": "string",
             "home_goals": "int", "away_goals": "int"}
    return F.struct(*[fixed.get(c, F.col(c)).cast(t).alias(c) for c, t in types.items()])


def fixtures_payloads(facts: DataFrame) -> DataFrame:
    """One fixtures payload per league-season plus its stale copy (bounded group per payload). Groups
    are gathered from narrow rows; elements and copies are made of them afterwards."""
    nothing = F.lit(None)
    placeholder = _narrow(fixture_id=nothing, match_date=nothing, referee=F.lit("Ref 1"),
                          short=F.lit("TBD"), home_id=F.lit(0), away_id=F.lit(1),
                          tournament=F.col("first_cup"), round=F.lit("Round 0"),
                          home_goals=nothing, away_goals=nothing)
    grouped = (facts.groupBy("league_id", "season")
               .agg(F.collect_list(_narrow()).alias("rows"),
                    F.min("tournament").alias("first_cup"),
                    F.max("played_at").alias("last_played"))
               .withColumn("rows", F.when((F.col("league_id") + F.col("season")) % 7 == 0,
                                          F.concat("rows", F.array(placeholder)))
                           .otherwise(F.col("rows")))
               .select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("stale"))
               .withColumn("resp", F.sort_array(F.transform("rows", lambda r: _fixture_element(
                   r, F.col("season"), F.col("stale"))))))
    fetched = (F.col("last_played") + F.expr("INTERVAL 24 HOURS")
               - F.when(F.col("stale"), F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOURS")))
    params = F.struct(F.col("league_id").alias("league"), F.col("season").alias("season"))
    return grouped.select(*_landed(F.lit(S.FIXTURES), F.lit(None), F.col("league_id"),
                                   F.col("season"), fetched,
                                   _envelope("fixtures", params, F.col("resp"))))


def standings_payloads(facts: DataFrame) -> DataFrame:
    """One standings payload per league-season: teams with their points (stored only)."""
    played = facts.filter(F.col("short") != "NS")
    sides = played.select(
        "league_id", "season", "played_at",
        F.inline(F.array(
            F.struct(F.col("home_id").alias("team_id"),
                     F.when(F.col("home_goals") > F.col("away_goals"), 3)
                      .when(F.col("home_goals") == F.col("away_goals"), 1).otherwise(0).alias("pts")),
            F.struct(F.col("away_id").alias("team_id"),
                     F.when(F.col("away_goals") > F.col("home_goals"), 3)
                      .when(F.col("away_goals") == F.col("home_goals"), 1).otherwise(0).alias("pts")),
        )))
    per_team = (sides.groupBy("league_id", "season", "team_id")
                .agg(F.sum("pts").cast("int").alias("points"),
                     F.max("played_at").alias("last_played")))
    table = (per_team.groupBy("league_id", "season")
             .agg(F.sort_array(F.collect_list(F.struct(
                 F.col("team_id").alias("team_id"), F.col("points").alias("points")))).alias("rows"),
                  F.max("last_played").alias("last_played")))
    resp = F.array(F.struct(F.struct(
        F.col("league_id").alias("id"), F.col("season").alias("season"),
        F.array(F.transform(F.col("rows"), lambda r: F.struct(
            r["team_id"].alias("team_id"), r["points"].alias("points")))).alias("standings"),
    ).alias("league")))
    params = F.struct(F.col("league_id").alias("league"), F.col("season").alias("season"))
    return table.select(*_landed(F.lit(S.STANDINGS), F.lit(None), F.lit(None), F.lit(None),
                                 F.col("last_played") + F.expr("INTERVAL 24 HOURS"),
                                 _envelope("standings", params, resp)))


def _sides() -> list[tuple[Column, int]]:
    return [(F.col("t_0"), 0), (F.col("t_1"), 1)]


def _with_side_bases(finished: DataFrame) -> DataFrame:
    """Per-side INT residues that every generated value derives from, computed once per row so
    the unrolled value expressions stay small INT arithmetic (no per-value casts)."""
    key = F.col("fixture_id")
    cols = [F.col("home_id").cast("int").alias("t_0"), F.col("away_id").cast("int").alias("t_1"),
            (key % 10).cast("string").alias("r10")]
    for side, tid in ((0, "home_id"), (1, "away_id")):
        h = key * 31 + F.col(tid) * 17
        cols += [(h % 60).cast("int").alias(f"h60_{side}"), (h % 20).cast("int").alias(f"h20_{side}"),
                 ((key % 9 + F.col(tid) * 3) % 9).cast("int").alias(f"pb_{side}")]
    return finished.select("*", *cols)


#: What a side's text depends on beside its team: these residues of the fixture, by endpoint.
_STATISTICS_KEYS = ("team", "h60", "h20", "fouls_na", "no_offsides", "stale")
_PLAYERS_KEYS = ("team", "pb", "r10", "drops_last", "stale")


#: Tasks that make the sides' texts (some thousands of a few KB).
_TEXT_TASKS = 16


def _side_keys(side: int) -> dict[str, Column]:
    """The values a side's text is made of, by name (``stale`` is a column of the row)."""
    key = F.col("fixture_id")
    return {"team": F.col(f"t_{side}"), "h60": F.col(f"h60_{side}"), "h20": F.col(f"h20_{side}"),
            "pb": F.col(f"pb_{side}"), "r10": F.col("r10"), "fouls_na": key % 11 == 0,
            "no_offsides": key % 9 == 0, "drops_last": key % 7 == 0, "stale": F.col("stale")}


def _with_side_texts(rows: DataFrame, names: tuple[str, ...], text: Column) -> DataFrame:
    """``rows`` with ``block_0`` and ``block_1``, the text of each side. ``text`` is made once for each
    combination of its values (``names``) that occurs, all of them residues, so their number does not
    grow with the table, and looked up by them. A side with a NULL among them has no text."""
    sides = [rows.select(*[c.alias(n) for n, c in _side_keys(side).items() if n in names])
             for side in (0, 1)]
    blocks = (sides[0].unionByName(sides[1]).distinct().repartition(_TEXT_TASKS, *names)
              .select(*names, text.alias("block")))
    for side in (0, 1):
        keys = _side_keys(side)
        found = F.broadcast(blocks.select(*[F.col(n).alias(f"__{n}") for n in names],
                                          F.col("block").alias(f"block_{side}")))
        same = [keys[n] == F.col(f"__{n}") for n in names]
        rows = rows.join(found, same, "left").drop(*[f"__{n}" for n in names])
    return rows


def _statistics_block() -> Column:
    """One side of a statistics envelope as text, assembled with ``concat`` (the values mix JSON
    numbers, strings and nulls; plain string expressions keep the generated code small and fast).
    With h = key*31 + t*17 + k*7: h % 60 = (h60 + 7k % 60) % 60, h % 20 = (h20 + 7k % 20) % 20."""
    stale, t = F.col("stale"), F.col("team").cast("string")
    entries = []
    for k, (label, _, _) in enumerate(S.TEAM_STAT_SPEC):
        m60 = (F.col("h60") + (7 * k) % 60) % 60
        m20 = (F.col("h20") + (7 * k) % 20) % 20
        if label in ("Ball Possession", "Passes %"):
            value = F.concat(F.lit('"'), (m60 + 20).cast("string"), F.lit('%"'))
        elif label in ("Yellow Cards", "Red Cards", "Offsides", "Goalkeeper Saves"):
            value = F.when(m20 % 4 != 0, (m20 % 6).cast("string")).otherwise(F.lit("null"))
        elif label == "Fouls":
            value = F.when(F.col("fouls_na"), F.lit('"N/A"')).otherwise(m20.cast("string"))
        else:
            value = m20.cast("string")
        value = F.when(stale, F.lit('"99"')).otherwise(value)
        entry = F.concat(F.lit(f'{{"type":"{label}","value":'), value, F.lit("}"))
        if label == "Offsides":
            entry = F.when(~F.col("no_offsides"), entry)   # absent entry; concat_ws skips NULL
        entries.append(entry)
    return F.concat(F.lit('{"team":{"id":'), t, F.lit(',"name":"Team '), t,
                    F.lit('"},"statistics":['), F.concat_ws(",", *entries), F.lit("]}"))


def _statistics_body(key: Column) -> Column:
    """The statistics envelope as text, around the texts of the sides."""
    empty = key % 50 == 0
    response = F.when(empty, F.lit("")).otherwise(
        F.concat(F.col("block_0"), F.lit(","), F.col("block_1")))
    return F.concat(
        F.lit('{"get":"fixtures/statistics","parameters":{"fixture":'), key.cast("string"),
        F.lit('},"errors":[],"results":'), F.when(empty, F.lit("0")).otherwise(F.lit("2")),
        F.lit(',"response":['), response, F.lit("]}"))


def _player_text(drops_last: Column, t: Column, base: Column, n: Column, stale: Column) -> Column:
    """One player entry of team ``t`` (``n`` in 1..11) as JSON text. Leaf j of the generic rule is
    (key + 3t + 5n + j) % 9, computed as (base + 5n + j) % 9 with base = (key % 9 + 3t) % 9."""
    def quoted(c: Column) -> Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    special = {
        ("games", "minutes"): F.when(n <= 9, F.when(stale, F.lit("99"))
                                     .otherwise((F.lit(90) - n).cast("string"))).otherwise("null"),
        ("games", "position"): quoted(F.when(n == 1, "G").when(n <= 5, "D").when(n <= 9, "M")
                                      .otherwise("F")),
        ("games", "rating"): quoted(F.concat((F.lit(5) + n % 5).cast("string"), F.lit("."),
                                             F.col("r10"))),
        ("games", "captain"): F.when(n == 1, "true").otherwise("false"),
        ("games", "substitute"): F.when(n > 8, "true").otherwise("false"),
        ("passes", "accuracy"): (F.when(stale, F.lit("99"))
                                 .when(n % 4 == 0, quoted(F.concat((F.lit(60) + n).cast("string"),
                                                                   F.lit("%"))))
                                 .otherwise((F.lit(60) + n).cast("string"))),
    }
    parts: list[Column] = [F.lit('{"player":{"id":'), (t * 100 + n).cast("string"),
                           F.lit(',"name":"Player '), (t * 100 + n).cast("string"),
                           F.lit('"},"statistics":[')]
    stat: list[Column] = []
    j = 0
    for gi, (group, leaves) in enumerate(S.PLAYER_STAT_GROUPS):
        stat.append(F.lit(("," if gi else "{") + f'"{group}":' + ("{" if leaves else "")))
        for li, leaf in enumerate(leaves or ("",)):
            if (group, leaf) in special:
                v = special[(group, leaf)]
            else:
                j += 1
                raw = (base + n * 5 + j) % 9
                v = F.when(stale, F.lit("99")).when(raw != 0, raw.cast("string")).otherwise("null")
            if leaves:
                stat.append(F.lit(("," if li else "") + f'"{leaf}":'))
            stat.append(v)
        if leaves:
            stat.append(F.lit("}"))
    stat.append(F.lit("}"))
    entry = F.when((n == 11) & drops_last, F.lit("")).otherwise(F.concat(*stat))
    return F.concat(*parts, entry, F.lit("]}"))


def _players_block() -> Column:
    """The 11 players of one side as text: one ``transform`` over 1..11 joined with commas."""
    return F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(11)),
        lambda n: _player_text(F.col("drops_last"), F.col("team"), F.col("pb"), n,
                               F.col("stale"))), ",")


def _players_body(key: Column) -> Column:
    """The players envelope as text, around the texts of the sides; no players for the away side when
    key % 13 = 0."""
    blocks = []
    for t, side in _sides():
        players = F.col(f"block_{side}")
        if side == 1:
            players = F.when(key % 13 == 0, F.lit("")).otherwise(players)
        blocks.append([
            F.lit('{"team":{"id":'), t.cast("string"), F.lit(',"name":"Team '), t.cast("string"),
            F.lit('"},"players":['), players, F.lit("]}")])
    return F.concat(
        F.lit('{"get":"fixtures/players","parameters":{"fixture":'), key.cast("string"),
        F.lit('},"errors":[],"results":2,"response":['), *blocks[0], F.lit(","), *blocks[1],
        F.lit("]}"))


def _lineups_response() -> Column:
    return F.array(*[F.struct(
        F.struct(t.alias("id"), F.concat(F.lit("Team "), t.cast("string")).alias("name")).alias("team"),
        F.lit("4-4-2").alias("formation"),
        F.array(*[F.struct(F.struct(
            (t * 100 + n).alias("id"),
            F.concat(F.lit("Player "), (t * 100 + n).cast("string")).alias("name")).alias("player"))
            for n in range(1, 12)]).alias("startXI"))
        for t, _ in _sides()])


def detail_payloads(facts: DataFrame) -> DataFrame:
    """Statistics, lineups and players payloads for every finished fixture.

    One projection per endpoint (each compiles only its own body builder), unioned; the stale
    copies are a per-row ``explode`` of a fixed two-element array and the sides' texts are looked up in
    small tables, so no payload is shuffled: rows stay in the partitions of ``facts``.
    """
    finished = _with_side_bases(facts.filter(F.col("short") != "NS"))
    key = F.col("fixture_id")
    rejected = key % 17 == 0
    params = F.struct(key.alias("fixture"))
    builders = (
        (S.STATISTICS, True, _STATISTICS_KEYS, _statistics_block, lambda: _statistics_body(key)),
        (S.LINEUPS, False, None, None,
         lambda: _envelope("fixtures/lineups", params, _lineups_response())),
        (S.PLAYERS, True, _PLAYERS_KEYS, _players_block, lambda: _players_body(key)),
    )
    parts = []
    for endpoint, has_stale, names, block, build in builders:
        rows = finished
        if has_stale:
            rows = (finished.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("stale"))
                    .filter(~F.col("stale") | ((key % 3 == 0) & ~rejected)))
        else:
            rows = finished.withColumn("stale", F.lit(False))
        if names:
            rows = _with_side_texts(rows, names, block())
        stale = F.col("stale")
        body = F.when(rejected, _error_envelope("fixtures/detail", params)).otherwise(build())
        fetched = (F.col("played_at") + F.expr("INTERVAL 24 HOURS")
                   - F.when(stale, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOURS")))
        parts.append(rows.select(*_landed(F.lit(endpoint), key, F.lit(None), F.lit(None),
                                          fetched, body)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def landed_from_orders(orders: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every landed payload (``LANDED`` schema) derived from ``orders``.

    ``tasks``: the narrow rows are dealt to that many before any text is made from them, so the work
    does not follow the row groups of the file: by ``fixture_id`` for the per-fixture payloads, which
    then lie in one partition for a fixture, and by league-season for the others, which need no other
    shuffle."""
    orders = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                           "o_orderpriority")
    by_fixture = by_season = orders.select("*", *_season_keys())
    if tasks is not None:
        by_fixture = by_fixture.repartition(tasks, F.col("o_orderkey").cast("bigint"))
        by_season = by_season.repartition(tasks, "league_id", "season")
    seasons = fixture_facts(by_season)
    return (fixtures_payloads(seasons)
            .unionByName(standings_payloads(seasons))
            .unionByName(detail_payloads(fixture_facts(by_fixture))))


def prior_queue(orders: DataFrame) -> DataFrame:
    """Queue state before seeding: earlier runs tracked every fixture with key % 4 = 0
    (``done`` when key % 8 = 0, else ``failed``; one attempt, two days after the match)."""
    key = F.col("o_orderkey")
    return (orders.filter(key % 4 == 0)
            .select(key.alias("fixture_id"),
                    F.explode(F.array(*[F.lit(e) for e in S.CHECKPOINT_ENDPOINTS])).alias("endpoint"),
                    F.when(key % 8 == 0, S.DONE).otherwise(S.FAILED).alias("status"),
                    F.lit(1).cast("int").alias("attempts"),
                    (F.col("o_orderdate") + F.expr("INTERVAL 48 HOURS")).cast("timestamp")
                    .alias("last_attempt_at")))
