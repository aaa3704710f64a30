
from pitchside.functions import (match_points, match_result, payload_error_text, payload_is_ok,
                                 payload_result_count, percent_fraction, try_cast_as)


def test_try_cast_int_is_lenient(spark):
    df = spark.createDataFrame([(v,) for v in ["12.5", "1e3", "12abc", "", "99999999999",
                                               " 12 ", "+7", "-3", None]], "v string")
    got = [r[0] for r in df.select(try_cast_as("v", "int")).collect()]
    assert got == [None, None, None, None, None, 12, 7, -3, None]


def test_try_cast_boolean_and_double(spark):
    df = spark.createDataFrame([("true", "7.5"), ("FALSE", "x"), ("t", "5.0")], "b string, d string")
    got = df.select(try_cast_as("b", "boolean"), try_cast_as("d", "double")).collect()
    assert [tuple(r) for r in got] == [(True, 7.5), (False, None), (True, 5.0)]


def test_percent_fraction(spark):
    df = spark.createDataFrame([("61%",), ("N/A",), ("",), (None,), ("5",)], "v string")
    assert [r[0] for r in df.select(percent_fraction("v")).collect()] == [0.61, None, None, None, 0.05]


def test_match_result_null_goals_is_a_draw(spark):
    df = spark.createDataFrame([(2, 1), (0, 3), (1, 1), (None, 2), (None, None)], "gf int, ga int")
    got = df.select(match_result("gf", "ga").alias("r")).select("r", match_points("r")).collect()
    assert [tuple(r) for r in got] == [("W", 3), ("L", 0), ("D", 1), ("D", 1), ("D", 1)]


def test_payload_audit_forms(spark):
    cases = [
        ('{"errors":[],"results":3,"response":[]}', True, "[]", 3),
        ('{"errors":{},"results":0}', True, "{}", 0),
        ('{"results":1}', True, None, 1),
        ('{"errors":null}', True, None, None),
        ('{"errors":""}', True, "", None),
        ('{"errors":false}', True, "false", None),
        ('{"errors":0}', True, "0", None),
        ('{"errors":{"fixture":"no data"},"results":0}', False, '{"fixture":"no data"}', 0),
        ('{"errors":["bad key"]}', False, '["bad key"]', None),
        ("not json", False, None, None),
        ("[1, 2]", False, None, None),
        (None, False, None, None),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "p string")
    got = df.select(payload_is_ok("p"), payload_error_text("p"), payload_result_count("p")).collect()
    assert [tuple(r) for r in got] == [c[1:] for c in cases]


def test_json_strings_in_errors_are_errors(spark):
    from pitchside.functions.payload import payload_is_ok
    bad = ['{"errors":"false"}', '{"errors":"[]"}', '{"errors":"0.0"}', '{"errors":"0"}',
           '{"errors":"{}"}', '{"errors":1}', '{"errors":true}']
    good = ['{"errors":""}', '{"errors":0}', '{"errors":0.0}', '{"errors":false}',
            '{"errors":null}', '{"errors":[]}', '{"errors":{}}', '{}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(bad + good)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(payload_is_ok("t")).collect()]
    assert got == [False] * len(bad) + [True] * len(good)


def test_exact_avg_keeps_every_value(spark):
    from pitchside.plans.marts import average_parts, exact_avg
    rows_ = [("a", 0.55), ("a", 0.45), ("b", 10000.0), ("b", 0.123456), ("c", float("inf")),
             ("c", 1.0), ("d", 1e25), ("e", None)]
    got = dict(spark.createDataFrame(rows_, "k string, v double").groupBy("k")
               .agg(*average_parts("v")).groupBy("k").agg(exact_avg("v")).collect())
    assert got == {"a": 0.5, "b": 5000.06, "c": float("inf"), "d": 1e25, "e": None}


def test_text_chars_is_length(spark):
    from pitchside.functions.payload import _COPIED, text_chars
    texts = ["", "abc", "caf\u00e9", "\u00e9", "\u20ac5", "\U0001f600", "a\U0001f600\u00e9", "a" * _COPIED,
             "a" * (_COPIED + 1), "\u00e9" * _COPIED, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", text_chars("t").alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [None if t is None else len(t) for t in texts]
    assert got[0].n == 0 and df.select(text_chars("t")).schema[0].dataType.simpleString() == "int"
