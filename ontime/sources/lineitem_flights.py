"""Flight-shaped records derived row by row from the `lineitem` table.

The expressions are plain SQL with integer arithmetic and whole-number doubles
only, so that another engine can compute the same. They inject every case the cleaning
rules handle: missing required fields, explained and unexplained missing
delays, causes on short delays, causes left on cancelled flights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Upper bound (exclusive) of `l_partkey % 100` -> carrier.
CARRIER_SHARES = {
    25: "AA",
    45: "DL",
    60: "UA",
    72: "WN",
    80: "OO",
    86: "B6",
    90: "MQ",
    93: "OH",
    95: "F9",
    97: "G4",
    98: "HA",
    99: "AS",
}
OTHER_CARRIER = "NK"

# The carrier of each remainder below the last bound: one literal, where a chain
# of comparisons would make the generated methods too long to be compiled.
CARRIER_BY_SHARE = "array({})".format(
    ", ".join(
        "'" + next(code for bound, code in CARRIER_SHARES.items() if share < bound) + "'"
        for share in range(max(CARRIER_SHARES))
    )
)

BASE_COLUMNS = {
    "s": "CAST(l_partkey % 100 AS INT)",
    "canc": "(l_orderkey + l_linenumber) % 53 = 0",
    "divt": "(l_orderkey + l_partkey) % 71 = 0",
    "dd": "CAST((l_partkey*31 + l_orderkey*17 + l_linenumber*13) % 211 - 40 AS DOUBLE)",
}

FLIGHT_COLUMNS = {
    "MONTH": "CAST(month(l_shipdate) AS INT)",
    "OP_UNIQUE_CARRIER": "CASE WHEN l_orderkey % 97 = 0 THEN NULL "
    f"ELSE coalesce(get({CARRIER_BY_SHARE}, CASE WHEN s < 0 THEN 0 ELSE s END), '{OTHER_CARRIER}') END",
    "CRS_DEP_TIME": "CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE "
    "CAST(((l_partkey*7 + l_linenumber*5) % 24)*100 + l_orderkey % 60 AS INT) END",
    "CANCELLED": "CAST(CASE WHEN canc THEN 1 ELSE 0 END AS DOUBLE)",
    "DIVERTED": "CAST(CASE WHEN divt AND NOT canc THEN 1 ELSE 0 END AS DOUBLE)",
    "DEP_DELAY": "CASE WHEN canc AND l_linenumber % 2 = 0 THEN NULL "
    "WHEN l_orderkey % 89 = 0 THEN NULL ELSE dd END",
    "ARR_DELAY": "CASE WHEN canc OR divt THEN NULL WHEN l_orderkey % 83 = 0 THEN NULL ELSE ad END",
    "CARRIER_DELAY": "CASE WHEN ad >= 15 OR l_orderkey % 7 = 0 "
    "THEN CAST(l_orderkey % 29 AS DOUBLE) END",
    "WEATHER_DELAY": "CASE WHEN ad >= 15 THEN CAST(l_orderkey % 5 AS DOUBLE) END",
    "NAS_DELAY": "CASE WHEN ad >= 15 THEN CAST(l_partkey % 13 AS DOUBLE) END",
    "SECURITY_DELAY": "CASE WHEN ad >= 15 AND l_linenumber = 1 "
    "THEN CAST(l_partkey % 3 AS DOUBLE) END",
    "LATE_AIRCRAFT_DELAY": "CASE WHEN ad >= 15 THEN CAST(l_suppkey % 37 AS DOUBLE) END",
}

ARRIVAL = "dd + (l_suppkey % 21) - 10"


def flights_sql(table: str = "lineitem", keep: tuple[str, ...] = ()) -> str:
    """The derivation as one SELECT; `keep` adds source columns to the result."""
    base = ", ".join(f"{expression} AS {name}" for name, expression in BASE_COLUMNS.items())
    columns = ", ".join(
        [*keep, *[f"{expression} AS {name}" for name, expression in FLIGHT_COLUMNS.items()]]
    )
    return (
        f"SELECT {columns} FROM (SELECT b.*, {ARRIVAL} AS ad FROM "
        f"(SELECT *, {base} FROM {table}) b) c"
    )


def flights(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw flight records, one per line item, whatever is null in it."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return spark.sql(flights_sql("{lineitem}", keep), lineitem=lineitem)
