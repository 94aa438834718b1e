"""Times the headline queries: one JSON line on standard output.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every result
is computed in full (``noop`` sink); the first query only warms the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import get_session  # noqa: E402

HEADLINE = (
    "cdc_events",
    "offset_vector",
    "offset_vector_64",
    "offset_vector_256",
    "skip_operations",
    "tombstones",
    "messages_json",
    "write_events",
    "begin_at",
    "observe_where",
    "snapshot_rows",
    "snapshot_events",
    "snapshot_then_stream",
    "snapshot_progress",
    "oldest_snapshot_begin",
    "stale_check",
    "event_counters",
    "heartbeats",
    "current_state",
    "column_masks",
    "decimal_modes",
    "temporal_modes",
    "time_durations",
    "binary_modes",
    "vector_array",
    "vector_binary",
    "geography_wkb",
    "defaults",
    "stream_cdc_events",
    "stream_current_state",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run(HEADLINE[0])
    seconds = {name: run(name) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
