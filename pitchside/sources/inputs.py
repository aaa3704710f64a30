"""Inputs of the registered queries: driver tables and the landed / bronze data derived from them.

The landed payloads are derived from ``orders`` by the job that consumes them. The bronze log they are
appended to is built once per input folder into ``spark.checkpoint.dir`` (see ``storage``) and read back
as Parquet partitioned by endpoint, so the models scan a real log with partition pruning rather than
re-deriving JSON text on every query.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from pitchside.session import ensure_utc
from pitchside.sources import synth
from pitchside.sources.bronze import COMPRESSION, append_log, create_log, log_buckets, read_log
from pitchside.sources.landing import audit, tag
from pitchside.sources.schemas import LANDED_AUDITED
from pitchside.sources.storage import build_once, materialize_once, path_size


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bytes of ``orders`` (narrow, compressed) behind one bucket of what is derived from it. A byte of
#: them becomes some 650 of payload text, so a task makes and writes less than 1 GB of text.
ORDERS_BYTES_PER_BUCKET = 1 << 20


def _orders(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/orders.parquet"


def buckets(spark: SparkSession, sf_dir: str) -> int:
    """Tasks and buckets of everything derived from ``orders``: a power of two that follows its size."""
    return log_buckets(path_size(spark, _orders(sf_dir)), ORDERS_BYTES_PER_BUCKET)


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed API body derived from ``orders`` (good and rejected) with its envelope audit. The
    text is made where it is read and never stored: a consumer makes and audits the bodies of the
    endpoints it asks for. Bodies of a fixture lie in one partition (see ``append_log``)."""
    ensure_utc(spark)
    return audit(synth.landed_from_orders(table(spark, sf_dir, "orders"), buckets(spark, sf_dir))
                 ).select(*LANDED_AUDITED.fieldNames())


def landed_files(spark: SparkSession, sf_dir: str) -> str:
    """The same bodies as the folder a fetcher fills, with the audit recorded at landing time, for
    consumers that read files (the landing stream): Parquet partitioned by endpoint, written once."""
    ensure_utc(spark)
    return materialize_once(spark, "landed", [_orders(sf_dir)], lambda: landed(spark, sf_dir),
                            partition_by=["endpoint"], compression=COMPRESSION)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw payload log: audited, tagged landed bodies, appended to a log table (see
    ``sources.bronze``) as one load."""
    ensure_utc(spark)
    return read_log(spark, bronze_table(spark, sf_dir))


def bronze_table(spark: SparkSession, sf_dir: str) -> str:
    """Name of the log table, built by one append if absent."""
    ensure_utc(spark)
    n = buckets(spark, sf_dir)

    def build(location: str) -> None:
        name = f"pitchside_build_{uuid.uuid4().hex}"
        create_log(spark, name, location, n)
        append_log(tag(landed(spark, sf_dir)), name, "landed", placed=True)
        spark.sql(f"DROP TABLE {name}")                  # external: the files stay

    path = build_once(spark, f"raw_api_responses-b{n}", [_orders(sf_dir)], build)
    name = "pitchside_raw_" + re.sub(r"[^0-9a-zA-Z]+", "_", "_".join(path.rsplit("/", 2)[-2:]))
    return create_log(spark, name, path, n)


def prior_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return synth.prior_queue(table(spark, sf_dir, "orders"))
