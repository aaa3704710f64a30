"""The stored work queue: one catalog table, bucketed by its key, whose key is enforced on insert.

Every mutation (seed, mark, requeue) rebuilds the table (``sources.tables``), so a failed run never
loses the queue. Buckets follow the key ``(fixture_id, endpoint)``: joining a batch to the queue moves the
batch to the buckets and leaves the queue in place. Inside a bucket rows are sorted by status and
fixture, so a claim skips the row groups of finished pairs by their statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pitchside.sources.schemas import CHECKPOINT_KEYS, INGESTION_CHECKPOINT
from pitchside.sources.tables import rebuild_table

SORT = ("status", "fixture_id", "endpoint")
KEYS = list(CHECKPOINT_KEYS)


class DuplicateKeyError(ValueError):
    """An insert offered a key that is NULL, repeated or already in the queue."""


def write_queue(queue: DataFrame, table: str, buckets: int, check=None) -> str:
    """Commit ``queue`` as the table's new content (it may be computed from the old one)."""
    rows = queue.select(*INGESTION_CHECKPOINT.fieldNames())
    return rebuild_table(rows, table, bucket_by=(buckets, KEYS), sort_by=SORT, check=check)


def create_queue(spark: SparkSession, table: str, buckets: int) -> str:
    """An empty queue, if absent."""
    if not spark.catalog.tableExists(table):
        write_queue(spark.createDataFrame([], INGESTION_CHECKPOINT), table, buckets)
    return table


def read_queue(spark: SparkSession, table: str) -> DataFrame:
    """The queue's committed rows."""
    return spark.table(table).select(*INGESTION_CHECKPOINT.fieldNames())


def _offered(queue: DataFrame, rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` once per key, with the number of ``__offered`` rows and whether it is ``__tracked``;
    only the batch moves to the queue's buckets."""
    others = [c for c in rows.columns if c not in KEYS]
    offered = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("__offered"),
                                      *[F.first(c).alias(c) for c in others])
    tracked = queue.select(*KEYS, F.lit(True).alias("__tracked"))
    return (offered.repartition(buckets, *KEYS).join(tracked, KEYS, "left")
            .withColumn("__tracked", F.coalesce("__tracked", F.lit(False))))


_REFUSED = "__offered > 1 OR __tracked OR fixture_id IS NULL OR endpoint IS NULL"


def refused_keys(queue: DataFrame, rows: DataFrame, buckets: int) -> DataFrame:
    """Keys that an insert of ``rows`` would be refused for (repeated, tracked or NULL), with the
    number of ``offered`` rows and whether the key is ``tracked``."""
    return _offered(queue, rows.select(*KEYS), buckets).filter(_REFUSED).select(
        *KEYS, F.col("__offered").alias("offered"), F.col("__tracked").alias("tracked"))


def insert_rows(rows: DataFrame, table: str, buckets: int) -> None:
    """``INSERT`` of whole queue rows under the key: the insert is refused as a whole, and the queue
    stays as it was, if a key is NULL, offered twice or already tracked.

    The same pass that writes the new content counts the violations (``DataFrame.observe``); the table
    is switched to it only if there are none."""
    queue = read_queue(rows.sparkSession, table)
    names = INGESTION_CHECKPOINT.fieldNames()
    seen = Observation()
    new = (_offered(queue, rows.select(*names), buckets)
           .observe(seen, F.count_if(F.expr(_REFUSED)).alias("refused")).select(*names))

    def check() -> None:
        if seen.get["refused"]:
            raise DuplicateKeyError(f"{seen.get['refused']} keys are NULL, repeated or tracked")

    write_queue(queue.unionByName(new), table, buckets, check)
