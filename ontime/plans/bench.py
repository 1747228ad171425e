"""Timing protocol: whole query from its scan to a sink that discards the rows."""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ontime.session import temporary_folders
from ontime.sinks import noop_run, write_report_csv


@dataclass(frozen=True)
class Timing:
    """Seconds of each run, the first one (warm-up) included."""

    runs: tuple[float, ...]

    @property
    def warm(self) -> tuple[float, ...]:
        return self.runs[1:] or self.runs

    @property
    def mean(self) -> float:
        return statistics.mean(self.warm)

    @property
    def median(self) -> float:
        return statistics.median(self.warm)

    @property
    def best(self) -> float:
        return min(self.warm)


def measure(
    build: Callable[[], DataFrame], runs: int = 10, report_path: str | None = None
) -> Timing:
    """Time `runs` runs; the plan is built anew each time, and what it stores on
    the way is removed after each.

    With a `report_path` the last run writes the report file instead.
    """
    seconds = []
    for i in range(runs):
        with temporary_folders(SparkSession.active()):
            start = time.perf_counter()
            df = build()
            if report_path is not None and i == runs - 1:
                write_report_csv(df, report_path)
            else:
                noop_run(df)
            seconds.append(time.perf_counter() - start)
    return Timing(tuple(seconds))
