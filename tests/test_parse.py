import json

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from pitchside.operators import explode_path, parse_json_column
from pitchside.sources import schemas as S
from tests.conftest import rows

GOOD_FIXTURE = {"response": [{"fixture": {"id": 1, "date": "d", "referee": None,
                                          "status": {"short": "FT", "long": "Match Finished"},
                                          "venue": {"name": "v", "city": "c"}},
                              "league": {"name": "Cup", "season": 2022, "round": "R1"},
                              "teams": {"home": {"id": 1, "name": "A", "code": "AAA"},
                                        "away": {"id": 2, "name": "B", "code": "BBB"}},
                              "goals": {"home": 1, "away": 0}}]}


def _df(spark, payloads):
    return spark.createDataFrame([(p,) for p in payloads], "raw_payload string")


def test_failfast_accepts_empty_forms_and_null(spark):
    df = _df(spark, [json.dumps(GOOD_FIXTURE), "{}", '{"response":[]}', None])
    out = parse_json_column(df, "raw_payload", S.FIXTURES_DDL, "j", mode="FAILFAST")
    assert len(explode_path(out, "j.response", "r").collect()) == 1


@pytest.mark.parametrize("bad", ["not json", '{"response": {"fixture": 1}}',
                                 '{"response":[{"fixture":{"id":"abc"}}]}'])
def test_failfast_raises_on_malformed(spark, bad):
    out = parse_json_column(_df(spark, [bad]), "raw_payload", S.FIXTURES_DDL, "j", mode="FAILFAST")
    with pytest.raises((PySparkException, Py4JJavaError)):
        out.collect()


def test_permissive_nulls_instead_of_failing(spark):
    df = _df(spark, ["not json", '{"response":[{"team":{"id":"x","name":"A"},"statistics":[]}]}'])
    out = parse_json_column(df, "raw_payload", S.STATISTICS_DDL, "j").collect()
    assert out[0].j is None or out[0].j.response is None
    assert out[1].j.response[0].team.id is None and out[1].j.response[0].team.name == "A"


def test_scalars_coerce_into_string_fields(spark):
    body = {"response": [{"team": {"id": 1, "name": "A"}, "statistics": [
        {"type": "a", "value": 5}, {"type": "b", "value": True}, {"type": "c", "value": 7.50},
        {"type": "d", "value": {"x": 1}}, {"type": "e", "value": None}, {"type": "f", "value": "61%"}]}]}
    out = parse_json_column(_df(spark, [json.dumps(body)]), "raw_payload", S.STATISTICS_DDL, "j")
    stats = out.collect()[0].j.response[0].statistics
    assert [s.value for s in stats] == ["5", "true", "7.5", '{"x":1}', None, "61%"]


def test_explode_outer_keeps_empty_explode_drops(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, [10, 11])], "k int, xs array<int>")
    inner = explode_path(df, "xs", "x", keep=["k"])
    outer = explode_path(df, "xs", "x", outer=True, keep=["k"])
    assert rows(inner, "k", "x") == [(3, 10), (3, 11)]
    assert rows(outer, "k", "x") == [(1, None), (2, None), (3, 10), (3, 11)]


def _players_body(**leaves):
    entry = {"games": {"minutes": 90, "position": "G", "rating": "7.3", "captain": True,
                       "substitute": False}, "offsides": None, "shots": {"total": 2, "on": 1},
             "passes": {"total": 30, "key": 1, "accuracy": "80%"}}
    for path, value in leaves.items():
        group, _, leaf = path.partition("__")
        if leaf:
            entry.setdefault(group, {})[leaf] = value
        else:
            entry[group] = value
    return {"response": [
        {"team": {"id": 1, "name": "A"}, "players": [
            {"player": {"id": 11, "name": "p"}, "statistics": [entry, None, {"games": None}]},
            {"player": {"id": 12, "name": "q"}, "statistics": []}, None]},
        None, {"team": None, "players": None}]}


def test_text_read_as_sent_equals_text_read_as_strings(spark):
    plain = json.dumps(_players_body())
    texts = [json.dumps(x) for x in [
        *(_players_body(games__minutes=v) for v in ("90", 90.5, "", True, None, 10 ** 30, 1 << 63,
                                                    -(1 << 63), [1], {"a": 1})),
        *(_players_body(offsides=v) for v in (3, {"a": 1}, [1, 2])),
        *(_players_body(games__captain=v) for v in ("true", 1, False, None)),
        _players_body(games__rating=7.50), _players_body(passes__accuracy=80),
        _players_body(shots="x"), _players_body(shots=[1]), {"response": []}, {"response": None},
        {"response": {}}, {"response": [{"team": {"id": "x", "name": 5}, "players": [
            {"player": {"id": 1.5}, "statistics": [{"games": {"minutes": 1}}]}]}]},
        {}, [], [_players_body()], 5, "s", None, {**_players_body(), "_corrupt_record": "x"}]]
    texts += [plain, None, "", "  ", "not json", plain[:-20], plain + " tail"]
    texts += [plain.replace("90", v, 1) for v in ("-0", "007", "1e3", "NaN", "'90'")]
    texts += [plain.replace('"minutes": 90', v, 1) for v in (
        '"minutes": 90, "minutes": "x"', '"minutes": "x", "minutes": 90', '"Minutes": 90')]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw_payload string")
    was = parse_json_column(df, "raw_payload", S.PLAYERS_DDL, "j", keep=["i"])
    now = parse_json_column(df, "raw_payload", S.PLAYERS_DDL, "j", keep=["i"],
                            sent_ddl=S.PLAYERS_SENT_DDL)
    assert was.schema["j"].dataType == now.schema["j"].dataType
    for text, a, b in zip(texts, was.orderBy("i").collect(), now.orderBy("i").collect()):
        assert a == b, text


def test_players_are_read_as_sent_in_model_and_view(spark):
    from pitchside.plans.staging import stg_player_statistics
    from pitchside.plans.views import stg_player_statistics_sql
    from tests.fixtures import T0, bronze, raw_row
    log = bronze(spark, [raw_row("players", _players_body(), T0, fixture_id=5)])
    plan = stg_player_statistics(log)._jdf.queryExecution().analyzed().toString()
    assert "aggregate(array(from_json(StructField(response" in plan
    assert "minutes: BIGINT" in stg_player_statistics_sql("log")
