"""Headline timings as one JSON line.

BENCH_SF_DIR   folder of the input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     runs per query, the first being warm-up (default 10)
"""

from __future__ import annotations

import json
import os
import time

from ontime.operators.cleaning import clean_flights
from ontime.plans import reports
from ontime.plans.bench import measure
from ontime.plans.job import Layout, read_delays, read_monthly, refresh_states
from ontime.session import remove_folder, session, work_folder
from ontime.sinks import write_partitioned
from ontime.sources import flights, scan_partitioned

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "10"))
WRITE_RUNS = 3


def main() -> None:
    spark = session(
        "bench",
        f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=CPUS,
    )
    spark.sparkContext.setLogLevel("ERROR")
    layout = Layout(work_folder(spark, "bench"))

    def write_seconds(rebalance: bool) -> float:
        """Warm: the first of the runs is left out."""
        taken = []
        for _ in range(WRITE_RUNS):
            start = time.perf_counter()
            write_partitioned(
                clean_flights(flights(spark, SF_DIR)), layout.clean, rebalance=rebalance
            )
            taken.append(time.perf_counter() - start)
        return sum(taken[1:]) / len(taken[1:])

    unbalanced = write_seconds(rebalance=False)
    balanced = write_seconds(rebalance=True)
    refresh_states(scan_partitioned(spark, layout.clean), layout)

    def clean():
        return scan_partitioned(spark, layout.clean)

    def monthly():
        return read_monthly(spark, layout.monthly)

    def stored_histogram():
        return reports.q3_histogram_from_states(read_delays(spark, layout.delays))

    timings = {
        "clean_flights": measure(lambda: clean_flights(flights(spark, SF_DIR)), RUNS),
        "q1_monthly_delay": measure(lambda: reports.q1_monthly_delay(clean()), RUNS),
        "q2_top_carriers": measure(lambda: reports.q2_top_carriers(clean()), RUNS),
        "q3_percentiles": measure(lambda: reports.q3_percentiles(clean()), RUNS),
        "q3_percentiles_interpolated": measure(
            lambda: reports.q3_percentiles(clean(), method="interpolated"), RUNS
        ),
        "q3_percentiles_approx": measure(
            lambda: reports.q3_percentiles(clean(), method="approx"), RUNS
        ),
        "q3_min_max": measure(lambda: reports.q3_min_max(clean()), RUNS),
        "q1_from_states": measure(
            lambda: reports.q1_from_states(monthly()), RUNS
        ),
        "q2_from_states": measure(
            lambda: reports.q2_from_states(monthly()), RUNS
        ),
        "q3_percentiles_from_states": measure(
            lambda: reports.q3_percentiles_of(stored_histogram()), RUNS
        ),
        "q3_min_max_from_states": measure(
            lambda: reports.q3_min_max_of(stored_histogram()), RUNS
        ),
    }
    queries = {name: round(timing.mean, 4) for name, timing in timings.items()}
    print(
        json.dumps(
            {
                "metric": "mean seconds per query, noop sink, summed over queries",
                "value": round(sum(queries.values()), 4),
                "unit": "sec",
                "queries": queries,
                "median": {name: round(t.median, 4) for name, t in timings.items()},
                "min": {name: round(t.best, 4) for name, t in timings.items()},
                "write_partitioned": round(balanced, 4),
                "write_partitioned_without_rebalance": round(unbalanced, 4),
                "runs": RUNS,
                "cpus": int(CPUS),
                "spark": spark.version,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    remove_folder(spark, layout.root)
    spark.stop()


if __name__ == "__main__":
    main()
