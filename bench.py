"""Times the named queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder and ``BENCH_CPUS`` the local cores.
Every query is run to the end into Spark's no-op sink, once to warm up and
then ``BENCH_RUNS`` times, of which the median counts.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from callpulse.plans.queries import QUERIES
from callpulse.session import build_session

HEADLINE = [
    "kpi_average_handling_time",
    "kpi_queuers_and_callers",
    "kpi_wait_time",
    "kpi_queuers_per_service",
    "kpi_combined",
    "kpi_per_batch_total",
    "message_queuers_per_service",
    "kpi_frames",
    "call_observations",
    "quarantined_lines",
    "call_records_with_metadata",
    "envelope_key_roundtrip",
    "envelope_data_roundtrip",
    "stream_call_observations",
    "stream_kpi_per_batch",
    "stream_kpi_windowed",
    "stream_restart",
    "stream_publish_figures",
    "stream_quarantine",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    shared = os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="callpulse-bench-")
    spark = build_session(
        "callpulse-bench",
        spark__checkpoint__dir=f"file://{shared}",
        spark__master=f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__sql__shuffle__partitions=cpus,
        spark__sql__session__timeZone="UTC",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
