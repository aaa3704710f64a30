"""Catalog tables that are rebuilt under their readers.

A rebuild writes every file to a fresh folder and then points the table there, a metadata change:
readers see the old rows until it, the new rows after it, and a build that fails in between leaves the
table as it was. The folder of the build before stays for readers that have already planned on it; the
one before that is removed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchside.sources.storage import fs_path, path_exists

_PREVIOUS = "pitchside.previous_build"


def column_list(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return rows.first()["data_type"]


def _property(spark: SparkSession, table: str, name: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == name).collect()
    return rows[0]["value"] if rows else None


def _layout(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """Columns and buckets of a table: a rebuild that changes them replaces the table's entry."""
    rows = [(r["col_name"], r["data_type"]) for r in
            spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    keep = [r for r in rows[:next((i for i, r in enumerate(rows) if r[0] in ("", "# Detailed Table Information")),
                                  len(rows))]]
    return keep + [r for r in rows if r[0] in ("Num Buckets", "Bucket Columns", "Sort Columns")]


def write_bucketed(df: DataFrame, location: str, bucket_by: tuple[int, Sequence[str]],
                   sort_by: Sequence[str] = ()) -> None:
    """Write ``df`` to a folder in Spark buckets, sorted inside each."""
    n, columns = bucket_by
    stage = f"pitchside_build_{uuid.uuid4().hex}"
    (df.write.format("parquet").option("path", location).bucketBy(n, *columns)
     .sortBy(*(sort_by or columns)).saveAsTable(stage))
    df.sparkSession.sql(f"DROP TABLE {stage}")            # external: the files stay


def open_bucketed(spark: SparkSession, table: str, schema: T.StructType, location: str,
                  bucket_by: tuple[int, Sequence[str]], sort_by: Sequence[str] = ()) -> DataFrame:
    """Register a folder of ``write_bucketed`` as a table (metadata only; buckets are known to the
    catalog, not to the files) and return it."""
    n, columns = bucket_by
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({column_list(schema)}) USING parquet CLUSTERED BY "
              f"({', '.join(columns)}) SORTED BY ({', '.join(sort_by or columns)}) INTO {n} BUCKETS "
              f"LOCATION '{location}'")
    return spark.table(table)


def rebuild_table(df: DataFrame, table: str, bucket_by: tuple[int, Sequence[str]] | None = None,
                  sort_by: Sequence[str] = (), check: Callable[[], None] | None = None) -> str:
    """Rebuild ``table`` (``database.name``, Parquet) from ``df``, which may read the table itself.

    ``bucket_by=(n, columns)`` writes Spark buckets, sorted by ``sort_by`` inside each. ``check`` runs
    after the files are written and before the switch; if it raises, the table stays as it was. One
    writer at a time is assumed. Returns the table's name."""
    spark = df.sparkSession
    database, name = table.rsplit(".", 1)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    build = uuid.uuid4().hex
    fresh, stage = f"{root}/{name}-builds/{build}", f"{database}.{name}__{build}"
    writer = df.write.format("parquet").option("path", fresh)
    if bucket_by:
        n, columns = bucket_by
        writer = writer.bucketBy(n, *columns).sortBy(*(sort_by or columns))
    try:
        writer.saveAsTable(stage)
        if check:
            check()
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")        # external: an unused folder is left
        raise
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {stage} RENAME TO {table}")
        return table
    old, older = table_location(spark, table), _property(spark, table, _PREVIOUS)
    if _layout(spark, stage) == _layout(spark, table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
        spark.sql(f"DROP TABLE {stage}")
    else:
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {stage} RENAME TO {table}")
    spark.catalog.refreshTable(table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_PREVIOUS}' = '{old}')")
    if older and re.search(rf"/{re.escape(name)}-builds/[0-9a-f]{{32}}/?$", older):
        p, fs = fs_path(spark, older)
        fs.delete(p, True)
    return table


def in_file_order(spark: SparkSession, table: str, position: str = "position") -> DataFrame:
    """The rows of a table with their 1-based place in its files, taken by name: what a reader that
    goes through the files in order meets. No sort: a row's place is the rows of the files before
    (one number per file) plus its index in its own."""
    rows = spark.table(table)
    placed = rows.select("*", F.col("_metadata.file_name").alias("__file"),
                         F.col("_metadata.row_index").alias("__row"))
    sizes = placed.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select(                                 # one row per file
        "__file", (F.sum("__n").over(Window.orderBy("__file")) - F.col("__n")).alias("__before"))
    return (placed.join(before, "__file")
            .select(*rows.columns, (F.col("__before") + F.col("__row") + 1).alias(position)))


def create_load_table(spark: SparkSession, table: str, schema: T.StructType, location: str,
                      bucket_by: tuple[int, Sequence[str]]) -> str:
    """Create, if absent, a bucketed table that grows by whole loads (files found at ``location`` are
    part of it)."""
    if not spark.catalog.tableExists(table):
        n, columns = bucket_by
        spark.sql(f"CREATE TABLE {table} ({column_list(schema)}, load_id STRING) USING parquet "
                  f"PARTITIONED BY (load_id) CLUSTERED BY ({', '.join(columns)}) INTO {n} BUCKETS "
                  f"LOCATION '{location}'")
        if path_exists(spark, location):
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return table


def write_load(rows: DataFrame, table: str, load_id: str) -> None:
    """Write one load of a load table; writing it again replaces it."""
    rows.sparkSession.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (load_id = '{load_id}') "
                          "SELECT * FROM {rows}", rows=rows)
