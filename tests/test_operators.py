import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitchside.operators import (duplicate_keys, insert_missing, latest_per_key, partition_count,
                                 pivot_long, take_ordered, two_sided, upsert_counted)
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def test_latest_per_key_one_row_per_key_with_tiebreak(spark):
    df = spark.createDataFrame([
        (1, T0, "a"), (1, T0 + dt.timedelta(hours=1), "b"),
        (2, T0, "x"), (2, T0, "y"),              # equal times: the tiebreak decides
        (None, T0, "n1"), (None, T0 + dt.timedelta(hours=2), "n2"),  # NULL keys are one group
    ], "k long, at timestamp, p string")
    out = latest_per_key(df, ["k"], ["at"], ["p"])
    assert rows(out.select("k", "p")) == sorted([(1, "b"), (2, "y"), (None, "n2")], key=repr)


def test_latest_per_key_plans_a_partial_top1_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("strategy", ["aggregate", "window"])
def test_partition_count_counts_null_as_one_group(spark, strategy):
    df = spark.createDataFrame([(1, "r1"), (2, "r1"), (3, None), (4, None), (5, None), (6, "r2")],
                               "id int, ref string")
    out = partition_count(df, ["ref"], "n", strategy=strategy)
    assert rows(out, "id") == [(1, "r1", 2), (2, "r1", 2), (3, None, 3), (4, None, 3),
                               (5, None, 3), (6, "r2", 1)]


def test_pivot_long_absent_vs_present_null(spark):
    df = spark.createDataFrame([
        (1, 10, "T", "Yellow Cards", None),   # present with null value -> 0
        (1, 10, "T", "Fouls", "N/A"),         # unparseable -> NULL
        (1, 10, "T", "Ball Possession", "61%"),
        (2, 20, "U", "Fouls", "7"),           # Yellow Cards absent -> NULL
    ], "f int, t int, name string, type string, value string")
    spec = [("Yellow Cards", "yellow", lambda v: F.coalesce(v.try_cast("int"), F.lit(0))),
            ("Fouls", "fouls", lambda v: v.try_cast("int")),
            ("Ball Possession", "poss",
             lambda v: F.replace(v, F.lit("%"), F.lit("")).try_cast("double") / 100)]
    out = pivot_long(df, ["f", "t"], "type", "value", spec, carry=[F.max("name").alias("name")])
    assert rows(out.select("f", "t", "name", "yellow", "fouls", "poss"), "f") == [
        (1, 10, "T", 0, None, 0.61), (2, 20, "U", None, 7, None)]


def test_two_sided_equals_union_all(spark):
    df = spark.createDataFrame([(1, "a", "b", 2, 1), (2, "c", "d", None, 0)],
                               "id int, h string, a string, hg int, ag int")
    out = two_sided(df, ["id"], [
        {"team": F.col("h"), "gf": F.col("hg"), "ga": F.col("ag")},
        {"team": F.col("a"), "gf": F.col("ag"), "ga": F.col("hg")},
    ])
    union = (df.select("id", F.col("h").alias("team"), F.col("hg").alias("gf"), F.col("ag").alias("ga"))
             .unionByName(df.select("id", F.col("a").alias("team"), F.col("ag").alias("gf"),
                                    F.col("hg").alias("ga"))))
    assert rows(out) == rows(union)


def _queue(spark, data):
    return spark.createDataFrame(data, "fixture_id long, endpoint string, status string, "
                                       "attempts int, last_attempt_at timestamp")


def test_insert_missing_is_idempotent_and_leaves_existing_rows(spark):
    q = _queue(spark, [(1, "players", "done", 3, T0)])
    src = spark.createDataFrame([(1, "players"), (2, "players"), (2, "players")],
                                "fixture_id long, endpoint string")
    defaults = {"status": F.lit("pending"), "attempts": F.lit(0),
                "last_attempt_at": F.lit(None).cast("timestamp")}
    once = insert_missing(q, src, ["fixture_id", "endpoint"], defaults)
    twice = insert_missing(once, src, ["fixture_id", "endpoint"], defaults)
    expected = [(1, "players", "done", 3, T0), (2, "players", "pending", 0, None)]
    assert rows(once, "fixture_id") == expected
    assert rows(twice, "fixture_id") == expected


def test_upsert_counted_matches_inserts_and_folds_repeats(spark):
    q = _queue(spark, [(1, "stats", "pending", 0, None), (2, "stats", "failed", 1, T0)])
    t1, t2 = T0 + dt.timedelta(days=1), T0 + dt.timedelta(days=2)
    outcomes = spark.createDataFrame([
        (1, "stats", "failed", t1), (1, "stats", "done", t2),   # same key twice: +2, latest wins
        (3, "stats", "done", t1),                               # unseen key: inserted, 1 attempt
    ], "fixture_id long, endpoint string, status string, at timestamp")
    out = upsert_counted(q, outcomes, ["fixture_id", "endpoint"], "status", "at", "attempts",
                         "last_attempt_at")
    assert rows(out, "fixture_id") == [(1, "stats", "done", 2, t2), (2, "stats", "failed", 1, T0),
                                       (3, "stats", "done", 1, t1)]


def test_take_ordered_and_limit_check(spark):
    df = spark.createDataFrame([(3, "b"), (1, "b"), (1, "a"), (2, "c")], "k int, e string")
    out = take_ordered(df, F.col("e") != "c", [F.col("k"), F.col("e")], 2)
    assert [tuple(r) for r in out.collect()] == [(1, "a"), (1, "b")]
    with pytest.raises(ValueError):
        take_ordered(df, None, [F.col("k")], 0)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "k int, e string")
    assert rows(duplicate_keys(df, ["k", "e"])) == [(1, "a", 2)]


def test_hot_key_dedupe_and_counts(spark):
    # One key holds a third of the rows (and NULL another share): results stay exact.
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, F.lit(None))
         .otherwise(F.col("id")).cast("long").alias("k"),
        F.col("id").alias("v"))
    latest = latest_per_key(df, ["k"], ["v"])
    got = {r.k: r.v for r in latest.collect()}
    assert got[0] == 2997 and got[None] == 2998 and len(got) == 2 + n // 3
    counts = partition_count(df, ["k"], "n")
    assert {(r.k, r.n) for r in counts.filter("k = 0 OR k IS NULL").distinct().collect()} == {
        (0, 1000), (None, 1000)}
