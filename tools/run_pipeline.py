"""End-to-end run in the reference's operating order, on landed payloads derived from a driver
folder:

    python tools/run_pipeline.py /root/testdata/sf0.001 [budget]

1. bootstrap: append the season-level payloads to the log table and seed the queue table;
2. backfill: claim ``budget`` pairs, append their accepted payloads as a load, mark outcomes;
3. build: publish the staging views, intermediate tables and the gold table; print the top rows.
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from pitchside.plans import queue as Q  # noqa: E402
from pitchside.plans.marts import gold_ordered  # noqa: E402
from pitchside.plans.pipeline import GOLD, Layers, build_models  # noqa: E402
from pitchside.session import build_session, checkpoint_root  # noqa: E402
from pitchside.sources import inputs  # noqa: E402
from pitchside.sources.bronze import append_log, create_bronze, read_log  # noqa: E402
from pitchside.sources.queue_store import read_queue, write_queue  # noqa: E402

BUCKETS = 8


def main(sf_dir: str, budget: int) -> None:
    spark = build_session("pitchside-run", master="local[4]", shuffle_partitions=4)
    run = uuid.uuid4().hex[:12]
    landed = inputs.landed(spark, sf_dir)
    database = f"bronze_{run}"
    print("tables:", create_bronze(spark, database, f"{checkpoint_root(spark)}/pitchside/run-{run}",
                                   BUCKETS))
    log, queue = f"{database}.raw_api_responses", f"{database}.ingestion_checkpoint"

    boot = Q.bootstrap(read_queue(spark, queue), landed, buckets=BUCKETS)
    append_log(boot["appended"], log, "bootstrap")
    write_queue(boot["queue"], queue, BUCKETS)

    batch = Q.backfill_batch(read_queue(spark, queue), landed, budget, buckets=BUCKETS)
    print("claimed:", [tuple(r) for r in batch["claimed"].collect()][:5], "...")
    print("batch (done, failed, requested):", tuple(batch["counts"].collect()[0]))
    append_log(batch["appended"], log, "backfill-1")
    write_queue(batch["queue"], queue, BUCKETS)
    print("queue by status:", sorted(tuple(r) for r in read_queue(spark, queue)
                                     .groupBy("status").count().collect()))

    names = build_models(spark, log, Layers(default=f"dev_{run}", staging=f"silver_{run}",
                                            intermediate=f"silver_{run}", marts=f"gold_{run}"))
    print("published:", names)
    gold_ordered(spark.table(names[GOLD])).show(5)
    print("log rows by endpoint:", sorted(tuple(r) for r in read_log(spark, log)
                                          .groupBy("endpoint").agg(F.count(F.lit(1))).collect()))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 30)
