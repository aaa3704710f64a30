"""The (fixture_id, endpoint) work queue: seed, claim, mark, requeue, and one backfill batch.

Every mutation is a pure ``DataFrame -> DataFrame`` function over the whole queue, so a batch of any
size is one join; nothing loops over rows on the driver. ``buckets`` says that the queue is stored in
that many buckets of its key (``sources.queue_store``): then only the batch is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.operators import (flag_matches, insert_missing, latest_per_key, take_ordered,
                                 upsert_counted)
from pitchside.plans.staging import latest_fixtures_payloads
from pitchside.sources import schemas as S
from pitchside.sources.landing import audit, tag

KEYS = list(S.CHECKPOINT_KEYS)

# Narrow read of a fixtures payload: only what the finished-fixture extraction needs.
_FINISHED_DDL = "response ARRAY<STRUCT<fixture: STRUCT<id: BIGINT, status: STRUCT<short: STRING>>>>"


def finished_fixtures(raw: DataFrame) -> DataFrame:
    """Ids of finished fixtures (FT, PEN, AET) in the latest fixtures payload of each
    league-season. A payload without ``response`` contributes nothing."""
    return finished_in_payloads(latest_fixtures_payloads(raw).select("raw_payload"))


def finished_in_payloads(payloads: DataFrame) -> DataFrame:
    """Finished fixture ids inside fixtures payload texts (``raw_payload``). A payload that is not
    JSON fails the job, as it fails the fixtures model: a season must not go missing silently."""
    fx = (payloads.select(F.explode(F.from_json("raw_payload", _FINISHED_DDL, {"mode": "FAILFAST"})
                                     ["response"]).alias("f"))
          .select(F.col("f.fixture.id").alias("fixture_id"),
                  F.col("f.fixture.status.short").alias("short")))
    return (fx.filter(F.col("short").isin(*S.FINISHED_STATUSES) & F.col("fixture_id").isNotNull())
            .select("fixture_id"))


def queue_pairs(fixture_ids: DataFrame, endpoints: Sequence[str] = S.CHECKPOINT_ENDPOINTS) -> DataFrame:
    """Every (fixture, endpoint) pair: a per-row ``explode`` of the fixed endpoint list, so the
    product needs no join and no shuffle."""
    return fixture_ids.select(
        F.col("fixture_id").cast("bigint").alias("fixture_id"),
        F.explode(F.array(*[F.lit(e) for e in endpoints])).alias("endpoint"))


def seed(queue: DataFrame, fixture_ids: DataFrame,
         endpoints: Sequence[str] = S.CHECKPOINT_ENDPOINTS, buckets: int | None = None) -> DataFrame:
    """Insert unseen pairs as ``pending`` with 0 attempts and no attempt time; tracked pairs keep
    their state, so seeding twice equals seeding once."""
    return insert_missing(queue, queue_pairs(fixture_ids, endpoints), KEYS, {
        "status": F.lit(S.PENDING),
        "attempts": F.lit(0),
        "last_attempt_at": F.lit(None).cast("timestamp"),
    }, buckets)


def offered_pairs(fixture_ids: DataFrame,
                  endpoints: Sequence[str] = S.CHECKPOINT_ENDPOINTS) -> DataFrame:
    """How many pairs a seed offers (not how many it inserts), as a one-row DataFrame."""
    return queue_pairs(fixture_ids, endpoints).agg(F.count(F.lit(1)).alias("pairs_offered"))


def budget(limit: int | None, default: int = S.DEFAULT_DAILY_BUDGET) -> int:
    """An explicit limit wins, else the default; a limit below 1 is refused."""
    n = default if limit is None else limit
    if n < 1:
        raise ValueError("limit must be 1 or greater")
    return n


def claim(queue: DataFrame, limit: int | None = None,
          statuses: Sequence[str] = (S.PENDING, S.FAILED),
          with_last_attempt: bool = False) -> DataFrame:
    """Up to ``limit`` pairs in ``statuses``, lowest fixture first (endpoint breaks ties, so the
    cut is deterministic). The default statuses select failed pairs again, as the source code
    does; pass ``statuses=("pending",)`` for the documented terminal-failure behaviour."""
    return take_ordered(queue, F.col("status").isin(*statuses),
                        [F.col("fixture_id").asc(), F.col("endpoint").asc()], budget(limit),
                        columns=["fixture_id", "endpoint", "status"]
                        + ["last_attempt_at"] * with_last_attempt)


def mark(queue: DataFrame, outcomes: DataFrame, at: Column | None = None,
         buckets: int | None = None) -> DataFrame:
    """Apply attempt outcomes ``(fixture_id, endpoint, status[, at])``: a tracked pair takes the
    latest status, its attempts grow by the number of outcomes and its time becomes the latest;
    an untracked pair is inserted with that many attempts."""
    if "at" not in outcomes.columns:
        outcomes = outcomes.withColumn("at", at if at is not None else F.current_timestamp())
    outcomes = outcomes.select(*KEYS, "status", F.col("at").cast("timestamp").alias("at"))
    return upsert_counted(queue, outcomes, KEYS, status_col="status", at_col="at",
                          count_col="attempts", last_at_col="last_attempt_at", buckets=buckets)


def requeue(queue: DataFrame, pairs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Set the listed pairs back to ``pending``; attempts and times are unchanged."""
    flagged = flag_matches(queue, pairs, KEYS, "__requeue", buckets)
    return flagged.select(
        *[F.when(F.col("__requeue"), F.lit(S.PENDING)).otherwise(F.col(c)).alias(c)
          if c == "status" else F.col(c) for c in queue.columns])


def attempt_outcomes(claimed: DataFrame, landed: DataFrame, only_new: bool = False) -> DataFrame:
    """What one fetch attempt of each claimed pair yields: the latest landed body for the pair, or
    nothing. ``done`` when a body landed and passes the audit, ``failed`` otherwise (absent or
    rejected). Carries the body for the append.

    ``only_new``: one attempt is one new fetch, so only bodies fetched after the pair's
    ``last_attempt_at`` (a column of ``claimed`` then) count.

    The landed side is first cut to the claimed keys with a semi join, so only the claimed pairs'
    bodies reach the dedupe shuffle; the planner picks its form by the claim's size.
    """
    keys = claimed.select(*KEYS)
    if only_new:
        since = claimed.select(*KEYS, F.col("last_attempt_at").alias("__since"))
        landed = landed.join(since, KEYS).filter(
            F.col("__since").isNull() | (F.col("fetched_at") > F.col("__since"))).drop("__since")
    wanted = (landed.filter(F.col("endpoint").isin(*S.CHECKPOINT_ENDPOINTS))
              .join(keys, KEYS, "left_semi"))
    latest = latest_per_key(wanted, KEYS, ["fetched_at"], ["raw_payload"])
    got = audit(latest).select(*KEYS, "fetched_at", "raw_payload", "is_ok", "league_id", "season")
    joined = claimed.select(*KEYS).join(got, KEYS, "left")
    ok = F.coalesce(F.col("is_ok"), F.lit(False))
    return joined.select(*KEYS, F.when(ok, S.DONE).otherwise(S.FAILED).alias("status"),
                         "fetched_at", "raw_payload", "league_id", "season")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """``(done, failed, requested)`` of one batch, as one row."""
    return outcomes.agg(
        F.count_if(F.col("status") == S.DONE).alias("done"),
        F.count_if(F.col("status") == S.FAILED).alias("failed"),
        F.count(F.lit(1)).alias("requested"),
    )


def bootstrap(queue: DataFrame, landed: DataFrame,
              buckets: int | None = None) -> dict[str, DataFrame]:
    """The bootstrap run: accepted fixtures and standings payloads become bronze rows, and every
    finished fixture of the freshest fixtures payload per league-season is seeded into the queue
    (seeding twice changes nothing, so re-running never resets progress)."""
    season_level = landed.filter(F.col("endpoint").isin(S.FIXTURES, S.STANDINGS))
    appended = tag(season_level)
    fixtures = latest_per_key(
        appended.filter(F.col("endpoint") == S.FIXTURES)
        .filter(F.col("league_id").isNotNull() & F.col("season").isNotNull()),
        ["league_id", "season"], ["ingested_at"], ["raw_payload"])
    return {"appended": appended,
            "queue": seed(queue, finished_in_payloads(fixtures), buckets=buckets)}


def backfill_batch(queue: DataFrame, landed: DataFrame, limit: int | None = None,
                   dry_run: bool = False, at: Column | None = None,
                   buckets: int | None = None) -> dict[str, DataFrame]:
    """One budgeted batch: claim -> fetch outcome per pair -> bronze rows to append for the good
    ones -> the queue with every outcome marked. A dry run returns only the claim.

    A live run (``at`` is None) stamps the current time and counts only bodies fetched after a
    pair's last attempt; a replay at a given time takes the latest body."""
    live = at is None
    claimed = claim(queue, limit, with_last_attempt=live)
    if dry_run:
        return {"claimed": claimed.drop("last_attempt_at")}
    outcomes = attempt_outcomes(claimed, landed, only_new=live)
    good = outcomes.filter(F.col("status") == S.DONE).select(
        "endpoint", "fixture_id", "league_id", "season", "fetched_at", "raw_payload")
    marked = mark(queue, outcomes.select(*KEYS, "status"), at=at, buckets=buckets)
    claimed = claimed.drop("last_attempt_at")
    return {"claimed": claimed, "outcomes": outcomes, "appended": tag(good), "queue": marked,
            "counts": outcome_counts(outcomes)}
