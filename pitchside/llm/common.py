"""Helpers shared by the corpus operators: input tables, shared scratch storage, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.session import checkpoint_root
from pitchside.sources.storage import fs_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_root(spark)}/pitchside-llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at files that every
    executor sees, so a lost executor costs its running tasks only."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def drop_stored(*tables: DataFrame | SparkSession) -> None:
    """Delete tables of ``stored`` that nothing reads any more, and let Spark's cleaner remove the
    shuffle files of finished steps: it does so when the driver collects garbage, which on a driver
    with a large heap may be long after the disks are full. A session in place of tables asks for that
    alone."""
    for t in tables:
        spark = t if isinstance(t, SparkSession) else t.sparkSession
        if t is not spark:
            path, fs = fs_path(spark, t.stored_path)
            fs.delete(path, True)
    spark.sparkContext._jvm.System.gc()


#: Bytes of an Arrow batch within ``small_batches``.
BATCH_BYTES = 2 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside hand rows to Python in Arrow batches that end with the row that reaches
    ``BATCH_BYTES``, not at Spark's 64 MB: a batch is held several times over, by the executor beside its
    heap, where its buffers grow by doubling, and by the Python task."""
    before = spark.conf.get(_BATCH_CONF)
    spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_CONF, before)


def ids_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the two columns the text operators read; a null text is an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 40) -> DataFrame:
    """Distributed union-find: (node, component) for every node that has an edge; ``component`` is
    the smallest node reachable.

    Alternates the large-star and small-star steps (Kiveris et al., 2014) until the edge set is a
    set of stars. Every step is a grouped minimum, which Spark computes map-side first, and a join
    that adaptive execution splits when a hub is hot; no neighbour list is ever gathered. Self
    loops, null ends and repeated edges are ignored.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"),
                      F.col(b).alias("_b"))
         .filter("_a IS NOT NULL AND _b IS NOT NULL AND u > v").select("u", "v").distinct())
    e = stored(e, "cc-edges")
    seen = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"),
                                                            F.col("m").alias("v")).distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u")
                 .select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                          F.struct(F.col("u"), F.col("m").alias("v")))))
                 .filter("u > v").distinct())
        before, e = e, stored(small, "cc-edges")
        drop_stored(before)
        state = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
