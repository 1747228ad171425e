from __future__ import annotations

import os
import sys
from collections.abc import Callable

import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ontime import schema as S  # noqa: E402
from ontime.session import session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    built = session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def small_dir() -> str:
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def oracle_dir() -> str:
    return f"{TESTDATA}/sf0.01"


# A flown, punctual flight; tests override what matters to them.
FLIGHT = {
    S.MONTH: 1,
    S.CARRIER: "AA",
    S.SCHEDULED_DEPARTURE: 900,
    S.CANCELLED: 0.0,
    S.DIVERTED: 0.0,
    S.DEP_DELAY: 0.0,
    S.ARR_DELAY: 0.0,
} | dict.fromkeys(S.CAUSES, 0.0)


@pytest.fixture(scope="session")
def make_flights(spark) -> Callable[..., DataFrame]:
    def make(*overrides: dict) -> DataFrame:
        rows = [FLIGHT | override for override in overrides]
        return spark.createDataFrame(
            [tuple(row[name] for name in S.FLIGHT_SCHEMA.names) for row in rows],
            S.FLIGHT_SCHEMA,
        )

    return make
