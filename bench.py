"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then once more, short ones twice with the
better time counting. The whole result is computed and thrown away (``noop`` sink), and eager steps of a
query (stored intermediate tables) are part of its time.

    python bench.py [--all]
"""

from __future__ import annotations

import json
import os
import sys
import time

from wakeline.registry import QUERIES
from wakeline.session import local_session

HEADLINE = (
    "c01_trip_discovery",
    "c02_engine_table",
    "c03_gps_table",
    "c04_disruption_cells",
    "c06_heatmap",
    "j01_interval_join",
    "j03_nearest_hour",
    "j03_nearest_any_grid",
    "j08_trip_summary",
    "a03_resample",
    "a13_cell_trips",
    "a22_min_max",
    "f15_outliers_two_sided",
    "m01_sequence_errors",
    "m03_gps_scoring",
    "m07_training_set",
    "m08_port_starboard",
    "t05_stream_resample",
    "u03_upsert",
    "w01_trips_gap20",
    "w05_forward_fill",
    "w13_rolling_orders",
    "w17_chunks",
)


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = list(QUERIES) if "--all" in sys.argv else HEADLINE
    spark = local_session(
        cpus,
        **{
            "spark.sql.shuffle.partitions": cpus,
            # Coalescing is for many small tasks; here there is one per core.
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    times = {}
    for name in names:
        run(spark, name, folder)
        best = run(spark, name, folder)
        if best < 3:
            best = min(best, run(spark, name, folder))
        times[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
