"""Benchmark: time every registered query at one scale factor; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

``land_bronze`` is the cold build of the landed payloads and the bronze log from ``orders`` (JSON
generation, audit, tagging, two Parquet writes). Every query is then run to completion with the
``noop`` sink (full computation, no collect); the reported time per query is the median of
``BENCH_REPEAT`` runs (default 3), and ``first_run`` gives each query's first run (it includes
one-off work such as the first drain of the streaming landing job).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pitchside.catalog import QUERIES  # noqa: E402
from pitchside.session import build_session  # noqa: E402
from pitchside.sources import inputs, storage  # noqa: E402

HEADLINE = "team_tournament_profile"


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session("pitchside-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                          conf={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    storage.BUILD_SCOPE = f"bench-{uuid.uuid4().hex[:12]}"

    t0 = time.perf_counter()
    inputs.bronze(spark, sf_dir)
    land = time.perf_counter() - t0

    times: dict[str, float] = {"land_bronze": round(land, 3)}
    cold: dict[str, float] = {}
    for name, q in QUERIES.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(repeat):
            t = time.perf_counter()
            _run(q(spark, sf_dir))
            runs.append(time.perf_counter() - t)
        times[name] = round(statistics.median(runs), 3)
        cold[name] = round(runs[0], 3)

    total = round(sum(v for k, v in times.items() if k != "land_bronze"), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_query_medians",
        "value": total,
        "unit": "sec",
        "headline": {HEADLINE: times.get(HEADLINE)},
        "queries": times,
        "first_run": cold,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
