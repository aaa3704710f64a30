"""Landed API payloads -> audited, tagged rows of the bronze log.

A fetcher (not part of this package) leaves one body per request. We read those bodies in bulk,
split them by the envelope's ``errors`` member (bad payloads never reach the log), tag each good one
by endpoint, and append it to the log (``sources.bronze.append_log``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.functions.payload import (envelope_error_text, envelope_is_ok,
                                         envelope_result_count, payload_envelope)
from pitchside.sources import schemas as S

# Landed file layout for raw bodies: <root>/<endpoint path>/<params>.json with params either
# ``league=<id>_season=<year>`` or ``fixture=<id>`` (fixed values of our own layout).
_FILE_PARAMS = r"(?:league=(\d+)_season=(\d+)|fixture=(\d+))\.json$"


def read_landed(spark: SparkSession, path: str, audited: bool = False) -> DataFrame:
    """Landed payloads stored as Parquet, partitioned by endpoint (``LANDED`` schema, or
    ``LANDED_AUDITED`` when the audit was recorded at landing)."""
    return spark.read.schema(S.LANDED_AUDITED if audited else S.LANDED).parquet(path)


def read_landed_files(spark: SparkSession, root: str) -> DataFrame:
    """Raw bodies, one JSON document per file, as the ``LANDED`` schema.

    The endpoint is the folder name and the request parameters come from the file name, so no
    body needs parsing to be routed. ``fetched_at`` is the file's modification time.
    """
    raw = (spark.read.option("wholetext", "true").option("recursiveFileLookup", "true")
           .option("pathGlobFilter", "*.json").text(root)
           .select(F.col("value").alias("raw_payload"),
                   F.col("_metadata.file_path").alias("__path"),
                   F.col("_metadata.file_modification_time").alias("fetched_at")))
    path = F.col("__path")
    endpoint = F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1)
    league = F.nullif(F.regexp_extract(path, _FILE_PARAMS, 1), F.lit(""))
    season = F.nullif(F.regexp_extract(path, _FILE_PARAMS, 2), F.lit(""))
    fixture = F.nullif(F.regexp_extract(path, _FILE_PARAMS, 3), F.lit(""))
    return raw.select(
        endpoint.alias("endpoint"),
        fixture.cast("bigint").alias("fixture_id"),
        league.cast("int").alias("league_id"),
        season.cast("int").alias("season"),
        F.col("fetched_at").cast("timestamp").alias("fetched_at"),
        F.col("raw_payload"),
    )


AUDIT_COLUMNS = ("is_ok", "error_text", "result_count")


#: Error text of a good body that names no known endpoint, or no fixture where its endpoint needs one.
UNROUTABLE = "unroutable"


def routable():
    """Whether a landed body can be tagged: its endpoint is known, and a per-fixture body names its
    fixture. Others are quarantined instead of meeting under a NULL key."""
    endpoint = F.col("endpoint")
    detail = endpoint.isin(*S.CHECKPOINT_ENDPOINTS)
    return F.coalesce(endpoint.isin(S.FIXTURES, S.STANDINGS)
                      | (detail & F.col("fixture_id").isNotNull()), F.lit(False))


def audit(landed: DataFrame) -> DataFrame:
    """Attach ``is_ok``, ``error_text`` and ``result_count`` to every landed payload (one JSON
    pass per payload: the envelope is parsed once and the three checks read its fields).

    Rows that already carry the audit (recorded at landing) are passed through, so the payload
    text is parsed once per landing, not once per consumer.
    """
    if all(c in landed.columns for c in AUDIT_COLUMNS):
        return landed
    env = F.col("__env")
    # Exploding a list of one keeps a filter on the audit above the parse: pushed below it, it would
    # parse the text once for every field it reads.
    return (landed.select("*", F.explode(F.array(payload_envelope("raw_payload"))).alias("__env"))
            .select(*landed.columns,
                    (envelope_is_ok(env) & routable()).alias("is_ok"),
                    F.when(envelope_is_ok(env) & ~routable(), F.lit(UNROUTABLE))
                    .otherwise(envelope_error_text(env)).alias("error_text"),
                    envelope_result_count(env).alias("result_count")))


def audit_summary(landed: DataFrame) -> DataFrame:
    """Per endpoint: payloads landed, accepted, rejected, and results carried by accepted ones."""
    a = audit(landed)
    return a.groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("n_landed"),
        F.count_if(F.col("is_ok")).alias("n_ok"),
        F.count_if(~F.col("is_ok")).alias("n_bad"),
        F.sum(F.when(F.col("is_ok"), F.col("result_count"))).cast("bigint").alias("ok_results"),
    )


def quarantine(landed: DataFrame) -> DataFrame:
    """Rejected payloads with their request parameters and error text."""
    return (audit(landed).filter(~F.col("is_ok"))
            .select("endpoint", "fixture_id", "league_id", "season", "fetched_at", "error_text"))


def tag(landed: DataFrame) -> DataFrame:
    """Bronze rows from accepted payloads, tagged per endpoint.

    fixtures -> league and season, no fixture id; standings -> no tags; the per-fixture endpoints
    -> fixture id only. ``ingested_at`` is the fetch time, so re-landing is reproducible.
    """
    ep = F.col("endpoint")
    is_fixtures = ep == F.lit(S.FIXTURES)
    is_detail = ep.isin(*S.CHECKPOINT_ENDPOINTS)
    return (audit(landed).filter(F.col("is_ok")).select(
        F.col("fetched_at").alias("ingested_at"),
        ep.alias("endpoint"),
        F.when(is_detail, F.col("fixture_id")).cast("bigint").alias("fixture_id"),
        F.col("raw_payload"),
        F.when(is_fixtures, F.col("league_id")).cast("int").alias("league_id"),
        F.when(is_fixtures, F.col("season")).cast("int").alias("season"),
    ))
