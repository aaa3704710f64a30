import datetime as dt
import os
import tempfile

from pitchside.sources.bronze import append_log, create_log, qualified, read_log, schema_name
from pitchside.sources.landing import audit_summary, quarantine, read_landed_files, tag
from pitchside.sources.schemas import LANDED
from tests.conftest import rows

T0 = dt.datetime(2022, 12, 1)
OK = '{"errors":[],"results":1,"response":[1]}'
BAD = '{"errors":{"token":"bad"},"results":0,"response":[]}'


def _landed(spark):
    return spark.createDataFrame([
        ("fixtures", None, 1, 2022, T0, OK),
        ("standings", None, 1, 2022, T0, OK),
        ("statistics", 5, 1, 2022, T0, OK),      # league/season params are not tags here
        ("players", 5, None, None, T0, BAD),
        ("lineups", 6, None, None, T0, "<html>502</html>"),
    ], LANDED)


def test_tagging_rules_and_quarantine(spark):
    landed = _landed(spark)
    tagged = tag(landed).select("endpoint", "fixture_id", "league_id", "season")
    assert rows(tagged, "endpoint") == [("fixtures", None, 1, 2022), ("standings", None, None, None),
                                        ("statistics", 5, None, None)]
    assert rows(quarantine(landed).select("endpoint", "fixture_id", "error_text"), "endpoint") == [
        ("lineups", 6, None), ("players", 5, '{"token":"bad"}')]
    summary = {r.endpoint: tuple(r)[1:] for r in audit_summary(landed).collect()}
    assert summary["players"] == (1, 0, 1, None) and summary["statistics"] == (1, 1, 0, 1)


def test_append_and_read_files_round_trip(spark):
    root = tempfile.mkdtemp(prefix="pitchside-land-")
    for ep, name, body in [("statistics", "fixture=5.json", OK), ("fixtures", "league=1_season=2022.json", OK),
                           ("players", "fixture=6.json", BAD)]:
        os.makedirs(os.path.join(root, "in", ep), exist_ok=True)
        with open(os.path.join(root, "in", ep, name), "w") as f:
            f.write(body)
    landed = read_landed_files(spark, os.path.join(root, "in"))
    assert rows(landed.select("endpoint", "fixture_id", "league_id", "season"), "endpoint") == [
        ("fixtures", None, 1, 2022), ("players", 6, None, None), ("statistics", 5, None, None)]
    log = create_log(spark, "landed_files_log", os.path.join(root, "raw"), 8)
    append_log(tag(landed), log, "first")
    append_log(tag(landed), log, "second")   # append-only: a second load lands beside the first
    append_log(tag(landed), log, "second")   # a repeated load replaces itself
    raw = read_log(spark, log)
    assert raw.count() == 4
    assert raw.filter("endpoint = 'statistics'").count() == 2
    assert os.path.isdir(os.path.join(root, "raw", "load_id=first", "endpoint=statistics"))


def test_layer_routing():
    assert schema_name(None, "dev") == "dev"
    assert schema_name("  silver ", "dev") == "silver"
    assert qualified("gold", "profile", "wc") == "wc.gold.profile"


def test_landed_files_in_api_path_layout(spark):
    root = tempfile.mkdtemp(prefix="pitchside-api-")
    for rel in ["fixtures/statistics/fixture=7.json", "fixtures/players/fixture=7.json",
                "fixtures/league=3_season=2021.json"]:
        os.makedirs(os.path.join(root, os.path.dirname(rel)), exist_ok=True)
        with open(os.path.join(root, rel), "w") as f:
            f.write(OK)
    landed = read_landed_files(spark, root)
    assert rows(landed.select("endpoint", "fixture_id", "league_id", "season"), "endpoint") == [
        ("fixtures", None, 3, 2021), ("players", 7, None, None), ("statistics", 7, None, None)]
