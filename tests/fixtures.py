"""Hand-built bronze rows for model tests."""

from __future__ import annotations

import datetime as dt
import json

T0 = dt.datetime(2022, 12, 1)


def fixture(fid, home, away, hg, ag, referee="Ref A", short="FT", cup="WC", season=2022):
    return {"fixture": {"id": fid, "date": f"2022-12-{(fid or 0) % 28 + 1:02d}", "referee": referee,
                        "status": {"short": short, "long": f"Long {short}"},
                        "venue": {"name": "V", "city": "C"}},
            "league": {"name": cup, "season": season, "round": "R"},
            "teams": {"home": {"id": home, "name": f"T{home}", "code": "X"},
                      "away": {"id": away, "name": f"T{away}", "code": "Y"}},
            "goals": {"home": hg, "away": ag}}


def stats(team, **values):
    return {"team": {"id": team, "name": f"T{team}"},
            "statistics": [{"type": k, "value": v} for k, v in values.items()]}


def raw_row(endpoint, payload, at, fixture_id=None, league_id=None, season=None):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    return (at, endpoint, fixture_id, text, league_id, season)


def bronze(spark, rows):
    from pitchside.sources.schemas import RAW_API_RESPONSES
    return spark.createDataFrame(rows, RAW_API_RESPONSES)
