"""The bronze tables: the payload log (create, append, scan), the queue table, and the layer
namespace helpers.

The log is one catalog table that every producer appends to and every model scans. It is partitioned
by load and endpoint and bucketed by ``fixture_id``. A *load* is one append: writing it again replaces
it, so a repeated job or a replayed micro-batch leaves its rows once. Beside the columns of the log
the files hold two narrow ones, the payload's hash and length, which let the dedupe choose its winners
without reading payload text.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchside.functions.payload import text_chars
from pitchside.sources import schemas as S
from pitchside.sources.storage import path_exists
from pitchside.sources.tables import column_list

#: What the log's files hold beside the log's own columns.
LOG_EXTRAS = (("payload_hash", "bigint"), ("payload_chars", "int"))
LOG_COLUMNS = (*S.RAW_API_RESPONSES.fieldNames(), *(name for name, _ in LOG_EXTRAS))
LOG_PARTITIONS = ("load_id", "endpoint")
_LOAD_ID = re.compile(r"[A-Za-z0-9_.-]{1,200}")

# Target bytes of one bucket of the log: a bucketed scan reads each bucket in one task, so the
# bucket count follows the data volume (a fixed value of our sizing policy).
TARGET_BUCKET_BYTES = 256 * 1024 * 1024
MIN_BUCKETS, MAX_BUCKETS = 8, 65_536

# Codec of payload text in files (JSON repeats its member names: several times smaller than snappy's).
COMPRESSION = "zstd"

# Files that a task of an append may keep open: it needs one per endpoint and bucket it meets. Above
# that Spark sorts the rest of its rows by file, as it does with all of them by default.
OPEN_FILES = 32


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw payload rows from a folder, with their fixed schema (never inferred)."""
    rows = spark.read.schema(S.RAW_API_RESPONSES).parquet(path)
    return rows.select(*S.RAW_API_RESPONSES.fieldNames())


def log_buckets(log_bytes: int, target: int = TARGET_BUCKET_BYTES) -> int:
    """Bucket count of a log of about ``log_bytes``: the power of two that leaves at most
    ``target`` in a bucket. It depends on the data alone, so every session reads the same
    log; a power of two lets small appends group whole buckets in fewer tasks."""
    need = max(1, -(-log_bytes // target))
    return max(MIN_BUCKETS, min(MAX_BUCKETS, 1 << (need - 1).bit_length()))


def create_log(spark: SparkSession, table: str, location: str, buckets: int) -> str:
    """Create the payload log if absent (its files may already exist: loads found there are part of
    it)."""
    if not spark.catalog.tableExists(table):
        columns = column_list(T.StructType([f for f in S.RAW_API_RESPONSES if f.name != "endpoint"]))
        extras = ", ".join(f"{name} {kind}" for name, kind in LOG_EXTRAS)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {extras}, load_id STRING, "
                  f"endpoint STRING) USING parquet OPTIONS (compression '{COMPRESSION}') "
                  f"PARTITIONED BY ({', '.join(LOG_PARTITIONS)}) "
                  f"CLUSTERED BY (fixture_id) INTO {buckets} BUCKETS LOCATION '{location}'")
        if path_exists(spark, location):
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return table


def log_bucket_count(spark: SparkSession, table: str) -> int:
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    return int(row["data_type"])


def _with_conf(spark: SparkSession, key: str, value: str, action: Callable[[], object]) -> None:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        action()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def append_log(rows: DataFrame, table: str, load_id: str, tasks: int | None = None,
               placed: bool = False) -> None:
    """Append bronze rows to the log as the load ``load_id`` (never update or delete another load).

    Rows of per-fixture endpoints go to their buckets, one file per bucket: ``tasks`` of them (all
    buckets for a bulk load, by default about the session's shuffle partitions, always a power of two so
    that a bucket's rows meet in one task). Season-level rows, whose ``fixture_id`` is NULL, keep their
    own partitioning, so no task gathers them. A per-fixture row without a fixture fails the append, as
    does an unknown endpoint: the landing audit quarantines both before.

    ``placed``: the rows of a fixture already lie together, dealt to about as many partitions as the
    log has buckets (as ``inputs.landed`` derives them); they are written from where they are and no
    payload text is shuffled. The log is right for any partitioning; another one only makes more files.
    Text is not sorted on its way to the files either (``OPEN_FILES``)."""
    if not _LOAD_ID.fullmatch(load_id):
        raise ValueError(f"load_id {load_id!r} must match {_LOAD_ID.pattern}")
    spark = rows.sparkSession
    buckets = log_bucket_count(spark, table)
    wanted = min(buckets, tasks or int(spark.conf.get("spark.sql.shuffle.partitions")))
    endpoint, fixture = F.col("endpoint"), F.col("fixture_id")
    detail = endpoint.isin(*S.CHECKPOINT_ENDPOINTS)
    bad = F.coalesce(~(endpoint.isin(S.FIXTURES, S.STANDINGS) | (detail & fixture.isNotNull())),
                     F.lit(True))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("not a row of the log: endpoint "),
                                                 F.coalesce(endpoint, F.lit("NULL"))))
                     .cast("string")).otherwise(endpoint)
    rows = rows.select(*[f for f in S.RAW_API_RESPONSES.fieldNames() if f != "endpoint"],
                       F.xxhash64("raw_payload").alias("payload_hash"),
                       text_chars("raw_payload").alias("payload_chars"), checked.alias("endpoint"))
    laid = rows if placed else (rows.filter("fixture_id IS NOT NULL")
                                .repartition(1 << (wanted.bit_length() - 1), "fixture_id")
                                .unionByName(rows.filter("fixture_id IS NULL")))
    _with_conf(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES), lambda: spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (load_id = '{load_id}', endpoint) "
        "SELECT * FROM {laid}", laid=laid))


def read_log(spark: SparkSession, table: str) -> DataFrame:
    """Every row of the log; scans on ``fixture_id`` keep its buckets."""
    return spark.table(table).select(*LOG_COLUMNS)


def read_log_splits(spark: SparkSession, location: str) -> DataFrame:
    """The log's rows in ordinary splits instead of buckets, for a log in which one fixture holds so
    many rows that its bucket is too much for one task."""
    rows = spark.read.schema(f"ingested_at timestamp, fixture_id bigint, raw_payload string, "
                             f"league_id int, season int, payload_hash bigint, payload_chars int, "
                             f"load_id string, endpoint string").parquet(location)
    return rows.select(*LOG_COLUMNS)


def largest_bucket_share(raw: DataFrame, buckets: int) -> float:
    """Share of the payload characters of per-fixture rows in the fullest bucket (reads two narrow
    columns). Near ``1 / buckets`` when fixtures are of a kind; a hot fixture lifts it."""
    per = (raw.filter("fixture_id IS NOT NULL")
           .groupBy(F.pmod(F.hash("fixture_id"), F.lit(buckets)).alias("bucket"))
           .agg(F.sum(F.col("payload_chars").cast("long")).alias("chars")))
    top = per.agg(F.max("chars").alias("top"), F.sum("chars").alias("all")).first()
    return top["top"] / top["all"] if top["all"] else 0.0


def endpoint_rows(raw: DataFrame, endpoint: str) -> DataFrame:
    """Rows of one endpoint; a partition filter when the log is partitioned by endpoint."""
    return raw.filter(F.col("endpoint") == F.lit(endpoint))


def schema_name(custom: str | None, default: str) -> str:
    """Layer routing: a custom schema is used verbatim (trimmed), otherwise the default."""
    return default if custom is None else custom.strip()


def qualified(schema: str, name: str, catalog: str | None = None) -> str:
    return f"{catalog}.{schema}.{name}" if catalog else f"{schema}.{name}"


def create_bronze(spark: SparkSession, database: str, location: str, buckets: int = MIN_BUCKETS,
                  log_location: str | None = None) -> list[str]:
    """Create the namespace, the payload log (over its files, where there are any) and the (empty)
    queue table if absent; return the names of the tables present. The models scan this log and the
    queue operations rebuild this queue.

    The queue's key cannot be declared (Parquet tables take no constraints): it is enforced where
    rows are inserted (``sources.queue_store``)."""
    from pitchside.sources.queue_store import create_queue
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    create_log(spark, f"{database}.raw_api_responses",
               log_location or f"{location}/raw_api_responses", buckets)
    create_queue(spark, f"{database}.ingestion_checkpoint", buckets)
    return list_tables(spark, database)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database)
                  if t.tableType != "TEMPORARY")


def publish(df: DataFrame, layer: str | None, name: str, default_schema: str,
            **layout) -> str:
    """Rebuild a model's table in its layer's database (see ``tables.rebuild_table``); returns the
    qualified name."""
    from pitchside.sources.tables import rebuild_table
    return rebuild_table(df, qualified(schema_name(layer, default_schema), name), **layout)


def publish_view(spark: SparkSession, sql: str, layer: str | None, name: str,
                 default_schema: str) -> str:
    """(Re)create a model's view in its layer's database from its SQL text: recomputed on every read,
    by any session of the catalog. Returns the qualified name."""
    schema = schema_name(layer, default_schema)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    target = qualified(schema, name)
    spark.sql(f"CREATE OR REPLACE VIEW {target} AS {sql}")
    return target
