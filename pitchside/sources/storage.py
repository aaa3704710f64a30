"""Durable, reusable intermediate tables under ``spark.checkpoint.dir``.

A table is built once per (name, input folder, version) and reused by later jobs. Every build writes
to a fresh attempt folder below the table's; Spark's writer puts ``_SUCCESS`` there as its last step,
and readers take the first attempt that has it. Nothing is renamed, so a killed build, or a store
where a rename is a copy, never makes half a table readable, and concurrent builders of the same
content never see each other's files.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from pitchside.session import checkpoint_root

# Bump when a builder's output changes, so stale copies are not reused.
BUILD_VERSION = 13

# Extra path component; a benchmark sets a fresh one to time a cold build.
BUILD_SCOPE = ""


def fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = fs_path(spark, path)
    return bool(fs.exists(p))


def path_size(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path`` (0 when absent)."""
    p, fs = fs_path(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def _input_tag(spark: SparkSession, inputs: Sequence[str]) -> str:
    """Hash of the inputs' paths, sizes and times, asked of the file system that holds them."""
    h = hashlib.sha1()
    for path in inputs:
        p, fs = fs_path(spark, path)
        h.update(path.encode())
        if fs.exists(p):
            size = fs.getContentSummary(p)
            h.update(f"{size.getLength()}:{size.getFileCount()}:"
                     f"{fs.getFileStatus(p).getModificationTime()}".encode())
    return h.hexdigest()[:16]


def table_path(spark: SparkSession, name: str, inputs: Sequence[str]) -> str:
    scope = f"{BUILD_SCOPE}/" if BUILD_SCOPE else ""
    return f"{checkpoint_root(spark)}/pitchside/{scope}{name}-v{BUILD_VERSION}-{_input_tag(spark, inputs)}"


def built_path(spark: SparkSession, name: str, inputs: Sequence[str]) -> str | None:
    """The committed attempt of a table, or None."""
    p, fs = fs_path(spark, table_path(spark, name, inputs))
    if not fs.exists(p):
        return None
    done = sorted(str(s.getPath()) for s in fs.listStatus(p)
                  if path_exists(spark, f"{s.getPath()}/_SUCCESS"))
    return done[0] if done else None


def build_once(spark: SparkSession, name: str, inputs: Sequence[str],
               build: Callable[[str], None]) -> str:
    """Return the folder of a committed table, first having ``build(folder)`` write it if absent."""
    found = built_path(spark, name, inputs)
    if found:
        return found
    attempt = f"{table_path(spark, name, inputs)}/attempt-{uuid.uuid4().hex}"
    build(attempt)
    found = built_path(spark, name, inputs)
    if not found:
        raise RuntimeError(f"{attempt} was not committed")
    return found


def materialize_once(spark: SparkSession, name: str, inputs: Sequence[str],
                     build: Callable[[], DataFrame], partition_by: Sequence[str] = (),
                     compression: str | None = None) -> str:
    """Return the folder of a committed Parquet table, building it first if absent."""
    return build_once(spark, name, inputs, lambda path: build().write.mode("overwrite")
                      .partitionBy(*partition_by).parquet(path, compression=compression))
