"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Each reads the driver tables of ``sf_dir`` or data Spark derives from them (the landed payloads and
the bronze log), over whole tables.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.functions.payload import endpoint_path, payload_text
from pitchside.operators import duplicate_keys, latest_per_key, pivot_long, take_ordered
from pitchside.plans import queue as Q
from pitchside.plans.incremental import Incremental
from pitchside.plans.intermediate import int_player_stats, int_team_match_stats
from pitchside.plans.marts import in_gold_order, match_results, team_tournament_profile
from pitchside.plans.staging import (fixture_rows, latest_fixture_payloads,
                                     latest_fixtures_payloads, stg_fixtures, stg_match_statistics,
                                     stg_player_statistics)
from pitchside.plans.views import STAGING_VIEWS
from pitchside.session import ensure_utc
from pitchside.sources import inputs
from pitchside.sources.bronze import (append_log, create_bronze, create_log, log_bucket_count,
                                      publish, publish_view, qualified, read_log)
from pitchside.sources import schemas as S
from pitchside.sources.landing import audit, audit_summary, quarantine, read_landed, tag
from pitchside.sources.queue_store import SORT as QUEUE_SORT, refused_keys, write_queue
from pitchside.sources.storage import build_once, path_exists, table_path
from pitchside.sources.tables import (in_file_order, open_bucketed, table_location,
                                      write_bucketed)
from pitchside.streaming.landing_stream import (queue_from_outcome_log, read_outcome_log,
                                                run_landing_stream)

Query = Callable[[SparkSession, str], DataFrame]

# Run time of the registered backfill batch (a parameter; a live run uses current_timestamp()).
BATCH_RUN_AT = "2002-01-01 00:00:00"
CLAIM_LIMIT = 30
TOP_OPEN_ORDERS = 20
# Bytes of one micro-batch: the number of batches follows the data, not the number of files.
STREAM_BYTES_PER_TRIGGER = str(1 << 30)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.bronze(spark, sf_dir)
    return team_tournament_profile(fixture_rows(raw),
                                   int_team_match_stats(stg_match_statistics(raw)))


def _queue_buckets(spark: SparkSession, sf_dir: str) -> int:
    return inputs.buckets(spark, sf_dir)


def _stored_queue(spark: SparkSession, sf_dir: str, name: str,
                  build: Callable[[], DataFrame]) -> DataFrame:
    """A committed queue version of ``sf_dir``, in the layout of the queue store."""
    ensure_utc(spark)
    source = [f"{sf_dir.rstrip('/')}/orders.parquet"]
    layout = ((_queue_buckets(spark, sf_dir), Q.KEYS), QUEUE_SORT)
    path = build_once(spark, f"queue-{name}", source,
                      lambda folder: write_bucketed(build(), folder, *layout))
    table = "pitchside_queue_" + re.sub(r"[^0-9a-zA-Z]+", "_", "_".join(path.rsplit("/", 2)[-2:]))
    return open_bucketed(spark, table, S.INGESTION_CHECKPOINT, path, *layout)


def _prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_queue(spark, sf_dir, "prior", lambda: inputs.prior_queue(spark, sf_dir))


def _seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.seed(_prior(spark, sf_dir), Q.finished_fixtures(inputs.bronze(spark, sf_dir)),
                  buckets=_queue_buckets(spark, sf_dir))


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue after seeding, as stored: what claims and batches start from."""
    return _stored_queue(spark, sf_dir, "seeded", lambda: _seeded(spark, sf_dir))


def _all_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed detail body as one attempt outcome (done if it passes the audit)."""
    details = inputs.landed(spark, sf_dir).filter(F.col("endpoint").isin(*S.CHECKPOINT_ENDPOINTS))
    return audit(details).select(
        *Q.KEYS, F.when(F.col("is_ok"), S.DONE).otherwise(S.FAILED).alias("status"),
        F.col("fetched_at").alias("at"))


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.mark(_queue(spark, sf_dir), _all_outcomes(spark, sf_dir),
                  buckets=_queue_buckets(spark, sf_dir))


def _marked_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_queue(spark, sf_dir, "marked", lambda: _marked(spark, sf_dir))


def _batch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return Q.backfill_batch(_queue(spark, sf_dir), inputs.landed(spark, sf_dir), CLAIM_LIMIT,
                            at=F.lit(BATCH_RUN_AT).cast("timestamp"),
                            buckets=_queue_buckets(spark, sf_dir))


def _requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = _marked_queue(spark, sf_dir)
    failed_stats = marked.filter((F.col("status") == S.FAILED)
                                 & (F.col("endpoint") == S.STATISTICS))
    return Q.requeue(marked, failed_stats, buckets=_queue_buckets(spark, sf_dir))


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.bronze(spark, sf_dir).select("ingested_at", "endpoint", "fixture_id",
                                               "league_id", "season")


def _one_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One log filled by both producers: the bootstrap appends the season-level payloads, then the
    landing stream drains the per-fixture ones in several micro-batches. Returns (log, outcome log).
    Repeating is harmless: the append replaces its own load, and the stream checkpoint remembers which
    files were processed."""
    folder = inputs.landed_files(spark, sf_dir)
    landed = read_landed(spark, folder, audited=True)
    root = table_path(spark, "landing-log", [f"{sf_dir.rstrip('/')}/orders.parquet"])
    log = "pitchside_log_" + re.sub(r"[^0-9a-zA-Z]+", "_", root.rsplit("pitchside/", 1)[-1])
    create_log(spark, log, f"{root}/raw_api_responses", inputs.buckets(spark, sf_dir))
    if not path_exists(spark, f"{root}/raw_api_responses/load_id=bootstrap"):
        append_log(Q.bootstrap(_prior(spark, sf_dir), landed)["appended"], log, "bootstrap")
    run_landing_stream(spark, folder, log, f"{root}/outcomes", f"{root}/_checkpoint",
                       schema=S.LANDED_AUDITED, max_bytes_per_trigger=STREAM_BYTES_PER_TRIGGER,
                       endpoints=S.CHECKPOINT_ENDPOINTS, placed=True)
    return read_log(spark, log), read_outcome_log(spark, f"{root}/outcomes")


def _one_log_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _one_log(spark, sf_dir)[0]
    return team_tournament_profile(fixture_rows(log), int_team_match_stats(stg_match_statistics(log)))


def _tag(spark: SparkSession, sf_dir: str) -> str:
    """A name part that tells input folders (and rebuilt inputs) apart."""
    path = table_path(spark, "x", [f"{sf_dir.rstrip('/')}/orders.parquet"])
    return re.sub(r"[^0-9a-zA-Z]+", "_", path.rsplit("pitchside/", 1)[-1])


def _bronze_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze namespace made and filled: its tables by qualified name, with their rows."""
    log = inputs.bronze_table(spark, sf_dir)
    queue = _queue(spark, sf_dir)
    database = f"pitchside_bronze_{_tag(spark, sf_dir)}"
    root = table_path(spark, "bronze-namespace", [f"{sf_dir.rstrip('/')}/orders.parquet"])
    tables = create_bronze(spark, database, root, log_bucket_count(spark, log),
                           log_location=table_location(spark, log))
    write_queue(queue, qualified(database, "ingestion_checkpoint"), _queue_buckets(spark, sf_dir))
    counts = [spark.table(qualified(database, t)).agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(qualified("bronze", t, "wc_project")).alias("qualified_name"), "n_rows")
              for t in tables]
    return functools.reduce(DataFrame.unionByName, counts)


def _silver_view(name: str) -> Query:
    """A staging view of its layer's database, read by a second session."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = inputs.bronze_table(spark, sf_dir)
        view = publish_view(spark, STAGING_VIEWS[name](log), f" silver_{_tag(spark, sf_dir)} ",
                            name, "dev")
        return spark.newSession().table(view)
    return run


def _published_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table, rebuilt under its readers and read in the order of its files."""
    table = publish(in_gold_order(gold(spark, sf_dir)), f"gold_{_tag(spark, sf_dir)}",
                    "gold_team_all_tournaments_profile", "dev")
    return in_file_order(spark, table)


def _refused_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer every fixture's pairs, and those of finished fixtures once more, to the queue."""
    raw = inputs.bronze(spark, sf_dir)
    ids = fixture_rows(raw).select("fixture_id").union(Q.finished_fixtures(raw))
    return refused_keys(_queue(spark, sf_dir), Q.queue_pairs(ids), _queue_buckets(spark, sf_dir))


def _live_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill batch run now; its times are reduced to whether a pair has one."""
    batch = Q.backfill_batch(_queue(spark, sf_dir), inputs.landed(spark, sf_dir), CLAIM_LIMIT,
                             buckets=_queue_buckets(spark, sf_dir))
    return batch["queue"].withColumn("last_attempt_at", F.col("last_attempt_at").isNotNull()
                                     ).withColumnRenamed("last_attempt_at", "attempted")


def _payload_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that a JSON reader has already parsed, back as the text the log stores."""
    orders = inputs.table(spark, sf_dir, "orders")
    body = F.struct(F.col("o_orderkey").alias("id"), F.struct(
        F.col("o_orderstatus").alias("short"), F.lit(None).cast("string").alias("long"))
        .alias("status"), F.array(F.col("o_custkey")).alias("teams"))
    return orders.select("o_orderkey", payload_text(body, is_text=False).alias("raw_payload"))


#: The last year of each load of the incremental query's log (all later rows are the last load).
LOAD_YEARS = (1994, 1996)


def _incremental(spark: SparkSession, sf_dir: str) -> Incremental:
    """Three successive loads of one log (by fetch time), applied in turn: the first two once, the
    last, the load of the day, in every run."""
    source = [f"{sf_dir.rstrip('/')}/orders.parquet"]
    root = table_path(spark, "incremental", source)
    landed = inputs.landed(spark, sf_dir)
    n = inputs.buckets(spark, sf_dir)
    tag_ = _tag(spark, sf_dir)
    log = create_log(spark, f"pitchside_loads_{tag_}", f"{root}/log", n)
    year = F.year("ingested_at")
    late = sum(((year > y).cast("int") for y in LOAD_YEARS), F.lit(0))
    loads = [f"load-{i}" for i in range(len(LOAD_YEARS) + 1)]
    models = Incremental(spark, log, f"pitchside_incremental_{tag_}", f"{root}/models", n)
    for i, load in enumerate(loads):
        if not path_exists(spark, f"{root}/log/load_id={load}"):
            append_log(tag(landed).filter(late == i), log, load, placed=True)
        if load == loads[-1] or not path_exists(spark, f"{root}/models/fixture_loads/load_id={load}"):
            models.apply(load)
    return models


def _latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    return latest_per_key(events, ["user_id"], ["ts"], ["event_id"])


def _parse_event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").select("event_id", "user_id", "props")
    parsed = events.select("event_id", "user_id", F.from_json("props", "k INT").alias("p"))
    return parsed.select("event_id", "user_id", F.col("p.k").alias("k"))


def _orders_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    ident = lambda v: v
    spec = [("F", "max_price_f", ident), ("O", "max_price_o", ident), ("P", "max_price_p", ident)]
    return pivot_long(orders, ["o_custkey"], "o_orderstatus", "o_totalprice", spec,
                      carry=[F.count(F.lit(1)).alias("n_orders")])


def _top_open_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    return take_ordered(orders, F.col("o_orderstatus") == "O",
                        [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()],
                        TOP_OPEN_ORDERS,
                        columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])


QUERIES: dict[str, Query] = {
    # models
    "stg_fixtures": lambda s, d: stg_fixtures(inputs.bronze(s, d)),
    "stg_match_statistics": lambda s, d: stg_match_statistics(inputs.bronze(s, d)),
    "int_team_match_stats": lambda s, d: int_team_match_stats(
        stg_match_statistics(inputs.bronze(s, d))),
    "match_results": lambda s, d: match_results(fixture_rows(inputs.bronze(s, d))),
    "team_tournament_profile": gold,
    "stg_player_statistics": lambda s, d: stg_player_statistics(inputs.bronze(s, d)),
    "int_player_stats": lambda s, d: int_player_stats(stg_player_statistics(inputs.bronze(s, d))),
    # dedupe and window operators on the log
    "latest_payload_by_season": lambda s, d: latest_fixtures_payloads(inputs.bronze(s, d))
        .select("league_id", "season", "ingested_at"),
    "latest_payload_by_fixture": lambda s, d: latest_fixture_payloads(
        inputs.bronze(s, d), S.STATISTICS).select("fixture_id", "ingested_at"),
    "referee_games": lambda s, d: stg_fixtures(inputs.bronze(s, d))
        .select("fixture_id", "referee", "referee_games"),
    # work queue
    "finished_fixtures": lambda s, d: Q.finished_fixtures(inputs.bronze(s, d)),
    "queue_seed": _seeded,
    "bootstrap_queue": lambda s, d: Q.bootstrap(_prior(s, d), inputs.landed(s, d))["queue"],
    "queue_seed_offered": lambda s, d: Q.offered_pairs(Q.finished_fixtures(inputs.bronze(s, d))),
    "queue_claim": lambda s, d: Q.claim(_queue(s, d), CLAIM_LIMIT),
    "queue_claim_pending_only": lambda s, d: Q.claim(_queue(s, d), CLAIM_LIMIT, (S.PENDING,)),
    "queue_mark": _marked,
    "queue_requeue": _requeue,
    "queue_outcomes": lambda s, d: _batch(s, d)["counts"],
    "queue_after_backfill": lambda s, d: _batch(s, d)["queue"],
    "queue_duplicate_keys": lambda s, d: duplicate_keys(_marked_queue(s, d), Q.KEYS, "n_rows"),
    "log_repeated_pairs": lambda s, d: duplicate_keys(
        inputs.bronze(s, d).filter(F.col("endpoint").isin(*S.CHECKPOINT_ENDPOINTS)),
        Q.KEYS, "n_payloads"),
    # landing and audit
    "payload_audit": lambda s, d: audit_summary(inputs.landed(s, d)),
    "payload_quarantine": lambda s, d: quarantine(inputs.landed(s, d)),
    "tagged_payloads": _tagged,
    # one log filled by a batch append and the landing stream (same answers as the batch path)
    "stream_tagged_payloads": lambda s, d: _one_log(s, d)[0].select(
        "ingested_at", "endpoint", "fixture_id", "league_id", "season"),
    "stream_queue_mark": lambda s, d: queue_from_outcome_log(_queue(s, d), _one_log(s, d)[1]),
    "one_log_gold": _one_log_gold,
    # models kept up to date load by load (same answers as the full rebuild)
    "incremental_gold": lambda s, d: _incremental(s, d).gold(),
    # layers: views and tables of their databases
    "bronze_tables": _bronze_tables,
    "silver_view_fixtures": _silver_view("stg_fixtures"),
    "silver_view_statistics": _silver_view("stg_match_statistics"),
    "silver_view_players": _silver_view("stg_player_statistics"),
    "gold_read_order": _published_gold,
    # single operators of the landing and the queue
    "payload_texts": _payload_texts,
    "queue_endpoint_paths": lambda s, d: _queue(s, d).select(
        *Q.KEYS, endpoint_path("endpoint").alias("path")),
    "queue_dry_run": lambda s, d: Q.backfill_batch(
        _queue(s, d), inputs.landed(s, d), dry_run=True)["claimed"],
    "queue_live_backfill": _live_batch,
    "queue_refused_keys": _refused_keys,
    # operator checks straight on driver tables
    "latest_event_per_user": _latest_event_per_user,
    "parse_event_props": _parse_event_props,
    "orders_pivot_by_status": _orders_pivot,
    "top_open_orders": _top_open_orders,
}
