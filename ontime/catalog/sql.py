"""The same results in plain SQL, for another engine to compute.

Nothing is shared with the Spark side: derivation, rules and reports are stated
here a second time.
"""

from __future__ import annotations



def flights_view(kept: str = "") -> str:
    """Flights out of line items, one each."""
    return f"""SELECT {kept}
    CAST(month(l_shipdate) AS INT) AS MONTH,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL
      WHEN l_partkey % 100 < 25 THEN 'AA' WHEN l_partkey % 100 < 45 THEN 'DL'
      WHEN l_partkey % 100 < 60 THEN 'UA' WHEN l_partkey % 100 < 72 THEN 'WN'
      WHEN l_partkey % 100 < 80 THEN 'OO' WHEN l_partkey % 100 < 86 THEN 'B6'
      WHEN l_partkey % 100 < 90 THEN 'MQ' WHEN l_partkey % 100 < 93 THEN 'OH'
      WHEN l_partkey % 100 < 95 THEN 'F9' WHEN l_partkey % 100 < 97 THEN 'G4'
      WHEN l_partkey % 100 < 98 THEN 'HA' WHEN l_partkey % 100 < 99 THEN 'AS'
      ELSE 'NK' END AS OP_UNIQUE_CARRIER,
    CASE WHEN l_orderkey % 101 = 0 THEN NULL
      ELSE CAST(((l_partkey * 7 + l_linenumber * 5) % 24) * 100 + l_orderkey % 60 AS INT)
      END AS CRS_DEP_TIME,
    CAST(CASE WHEN off THEN 1 ELSE 0 END AS DOUBLE) AS CANCELLED,
    CAST(CASE WHEN astray AND NOT off THEN 1 ELSE 0 END AS DOUBLE) AS DIVERTED,
    CASE WHEN off AND l_linenumber % 2 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN NULL
      ELSE out END AS DEP_DELAY,
    CASE WHEN off OR astray THEN NULL WHEN l_orderkey % 83 = 0 THEN NULL
      ELSE home END AS ARR_DELAY,
    CASE WHEN home >= 15 OR l_orderkey % 7 = 0 THEN CAST(l_orderkey % 29 AS DOUBLE) END
      AS CARRIER_DELAY,
    CASE WHEN home >= 15 THEN CAST(l_orderkey % 5 AS DOUBLE) END AS WEATHER_DELAY,
    CASE WHEN home >= 15 THEN CAST(l_partkey % 13 AS DOUBLE) END AS NAS_DELAY,
    CASE WHEN home >= 15 AND l_linenumber = 1 THEN CAST(l_partkey % 3 AS DOUBLE) END
      AS SECURITY_DELAY,
    CASE WHEN home >= 15 THEN CAST(l_suppkey % 37 AS DOUBLE) END AS LATE_AIRCRAFT_DELAY
  FROM (
    SELECT *, out + l_suppkey % 21 - 10 AS home FROM (
      SELECT *, (l_orderkey + l_linenumber) % 53 = 0 AS off,
        (l_orderkey + l_partkey) % 71 = 0 AS astray,
        CAST((l_partkey * 31 + l_orderkey * 17 + l_linenumber * 13) % 211 - 40 AS DOUBLE) AS out
      FROM lineitem))"""


RAW = flights_view()
RAW_WITH_ORDER = flights_view("l_orderkey,")

CAUSE_RULE = ", ".join(
    f"CASE WHEN ARR_DELAY < 15 THEN CAST(0 AS DOUBLE) "
    f"ELSE coalesce({cause}, CAST(0 AS DOUBLE)) END AS {cause}"
    for cause in (
        "CARRIER_DELAY",
        "WEATHER_DELAY",
        "NAS_DELAY",
        "SECURITY_DELAY",
        "LATE_AIRCRAFT_DELAY",
    )
)
HEAD = (
    "MONTH, OP_UNIQUE_CARRIER, CRS_DEP_TIME, CANCELLED, DIVERTED, DEP_DELAY, ARR_DELAY"
)
PRESENT = (
    "OP_UNIQUE_CARRIER IS NOT NULL AND MONTH IS NOT NULL AND CRS_DEP_TIME IS NOT NULL "
    "AND CANCELLED IS NOT NULL AND DIVERTED IS NOT NULL"
)
ARRIVAL_EXPLAINED = "NOT (ARR_DELAY IS NULL AND CANCELLED <> 1 AND DIVERTED <> 1)"
DEPARTURE_EXPLAINED = "NOT (DEP_DELAY IS NULL AND CANCELLED <> 1)"

COMMON = f"""WITH raw AS ({RAW}),
clean AS (
  SELECT {HEAD}, {CAUSE_RULE} FROM raw
  WHERE {PRESENT} AND {ARRIVAL_EXPLAINED} AND {DEPARTURE_EXPLAINED}
),
q1 AS (
  SELECT MONTH AS month, OP_UNIQUE_CARRIER AS carrier,
    round(avg(DEP_DELAY) FILTER (WHERE CANCELLED = 0), 2) AS dep_delay_mean,
    min(DEP_DELAY) FILTER (WHERE CANCELLED = 0) AS dep_delay_min,
    max(DEP_DELAY) FILTER (WHERE CANCELLED = 0) AS dep_delay_max,
    round(100.0::DOUBLE * count(*) FILTER (WHERE CANCELLED = 1) / count(*), 2)
      AS cancellation_rate
  FROM clean WHERE MONTH <= 4 AND OP_UNIQUE_CARRIER IN ('AA', 'DL') GROUP BY 1, 2
),
carriers AS (
  SELECT OP_UNIQUE_CARRIER AS carrier, count(*) AS records,
    round(avg(ARR_DELAY), 2) AS arr_delay_mean,
    round(avg(CARRIER_DELAY), 2) AS carrier_delay_mean,
    round(avg(WEATHER_DELAY), 2) AS weather_delay_mean,
    round(avg(NAS_DELAY), 2) AS nas_delay_mean,
    round(avg(SECURITY_DELAY), 2) AS security_delay_mean,
    round(avg(LATE_AIRCRAFT_DELAY), 2) AS late_aircraft_delay_mean
  FROM clean WHERE MONTH <= 4 AND CANCELLED = 0 AND DIVERTED = 0 GROUP BY 1
),
q1_all AS (
  SELECT MONTH AS month, OP_UNIQUE_CARRIER AS carrier,
    round(avg(DEP_DELAY) FILTER (WHERE CANCELLED = 0), 2) AS dep_delay_mean,
    min(DEP_DELAY) FILTER (WHERE CANCELLED = 0) AS dep_delay_min,
    max(DEP_DELAY) FILTER (WHERE CANCELLED = 0) AS dep_delay_max,
    round(100.0::DOUBLE * count(*) FILTER (WHERE CANCELLED = 1) / count(*), 2)
      AS cancellation_rate
  FROM clean GROUP BY 1, 2
),
all_carriers AS (
  SELECT OP_UNIQUE_CARRIER AS carrier, count(*) AS records,
    round(avg(ARR_DELAY), 2) AS arr_delay_mean,
    round(avg(CARRIER_DELAY), 2) AS carrier_delay_mean,
    round(avg(WEATHER_DELAY), 2) AS weather_delay_mean,
    round(avg(NAS_DELAY), 2) AS nas_delay_mean,
    round(avg(SECURITY_DELAY), 2) AS security_delay_mean,
    round(avg(LATE_AIRCRAFT_DELAY), 2) AS late_aircraft_delay_mean
  FROM clean WHERE CANCELLED = 0 AND DIVERTED = 0 GROUP BY 1
),
all_board AS (
  SELECT CAST(row_number() OVER (ORDER BY arr_delay_mean DESC, carrier) AS INT) AS position, *
  FROM all_carriers WHERE records >= 150
),
all_flown AS (
  SELECT OP_UNIQUE_CARRIER AS carrier, CAST(CRS_DEP_TIME // 100 AS INT) AS hour_bucket, DEP_DELAY
  FROM clean WHERE CANCELLED = 0
),
q2 AS (
  SELECT * FROM carriers WHERE records >= 500
  ORDER BY arr_delay_mean DESC, carrier LIMIT 10
),
board AS (
  SELECT CAST(row_number() OVER (ORDER BY arr_delay_mean DESC, carrier) AS INT) AS position, *
  FROM carriers WHERE records >= 150
),
flown AS (
  SELECT OP_UNIQUE_CARRIER AS carrier, CAST(CRS_DEP_TIME // 100 AS INT) AS hour_bucket, DEP_DELAY
  FROM clean
  WHERE MONTH <= 4 AND CANCELLED = 0 AND OP_UNIQUE_CARRIER IN ('AA', 'DL', 'UA', 'WN')
),
q3_p AS (
  SELECT carrier, hour_bucket,
    quantile_disc(DEP_DELAY, 0.25) AS p25, quantile_disc(DEP_DELAY, 0.5) AS p50,
    quantile_disc(DEP_DELAY, 0.75) AS p75, quantile_disc(DEP_DELAY, 0.9) AS p90
  FROM flown GROUP BY 1, 2
),
q3_mm AS (
  SELECT carrier, min(DEP_DELAY) AS dep_delay_min, max(DEP_DELAY) AS dep_delay_max
  FROM flown GROUP BY 1
),
delay_state AS (
  SELECT OP_UNIQUE_CARRIER, count(*) AS flights,
    count(*) FILTER (WHERE CANCELLED = 1) AS cancelled,
    count(DEP_DELAY) FILTER (WHERE CANCELLED = 0) AS delay_count,
    sum(DEP_DELAY) FILTER (WHERE CANCELLED = 0) AS delay_sum,
    min(DEP_DELAY) FILTER (WHERE CANCELLED = 0) AS delay_min,
    max(DEP_DELAY) FILTER (WHERE CANCELLED = 0) AS delay_max
  FROM clean GROUP BY 1
),
completed AS (SELECT * FROM clean WHERE CANCELLED = 0 AND DIVERTED = 0)
"""

TEXT_FLAGS = f"""WITH flags AS (
  SELECT MONTH, CASE WHEN l_orderkey % 67 = 0 THEN '' ELSE OP_UNIQUE_CARRIER END
      AS OP_UNIQUE_CARRIER,
    CASE WHEN l_orderkey % 59 = 0 THEN 'x' WHEN l_orderkey % 61 <> 0
      THEN CAST(CANCELLED AS VARCHAR) END AS CANCELLED,
    CASE WHEN l_orderkey % 73 = 0 THEN '?' WHEN l_orderkey % 79 <> 0
      THEN CAST(DIVERTED AS VARCHAR) END AS DIVERTED,
    DEP_DELAY, ARR_DELAY
  FROM ({RAW_WITH_ORDER}) r
)
"""

MEANS = """round(avg(ARR_DELAY), 2) AS arr_delay_mean,
    round(avg(CARRIER_DELAY), 2) AS carrier_delay_mean,
    round(avg(WEATHER_DELAY), 2) AS weather_delay_mean,
    round(avg(NAS_DELAY), 2) AS nas_delay_mean,
    round(avg(SECURITY_DELAY), 2) AS security_delay_mean,
    round(avg(LATE_AIRCRAFT_DELAY), 2) AS late_aircraft_delay_mean"""

Q1_HEADINGS = """SELECT month AS "Mese", carrier AS "Compagnia Aerea",
  dep_delay_mean AS "Ritardo Medio Partenza (min)",
  dep_delay_min AS "Ritardo Minimo Partenza (min)",
  dep_delay_max AS "Ritardo Massimo Partenza (min)",
  cancellation_rate AS "Percentuale voli cancellati" FROM q1_all"""

Q1_FIELDS = """month AS mese, carrier AS compagnia, dep_delay_mean AS ritardo_medio_part,
  dep_delay_min AS ritardo_min_part, dep_delay_max AS ritardo_max_part,
  cancellation_rate AS perc_cancellati"""


def month_figures(source: str, first: int, last: int) -> str:
    """Monthly figures of all carriers as keyed records."""
    return f"""SELECT 'q1:' || OP_UNIQUE_CARRIER || ':' || MONTH AS key,
    MONTH AS month, OP_UNIQUE_CARRIER AS carrier,
    round(avg(CASE WHEN CANCELLED = 0 THEN DEP_DELAY END), 2) AS dep_delay_mean,
    min(CASE WHEN CANCELLED = 0 THEN DEP_DELAY END) AS dep_delay_min,
    max(CASE WHEN CANCELLED = 0 THEN DEP_DELAY END) AS dep_delay_max,
    round(sum(CANCELLED) / count(*) * 100, 2) AS cancellation_rate
  FROM {source} WHERE MONTH BETWEEN {first} AND {last}
    AND OP_UNIQUE_CARRIER IS NOT NULL GROUP BY MONTH, OP_UNIQUE_CARRIER"""


def quantiles(function: str, rounded: bool = False) -> str:
    columns = []
    for name, p in (("p25", "0.25"), ("p50", "0.5"), ("p75", "0.75"), ("p90", "0.9")):
        call = f"{function}(DEP_DELAY, {p})"
        columns.append(f"{f'round({call}, 2)' if rounded else call} AS {name}")
    return ", ".join(columns)


_AFTER_COMMON = {
    # sources and sinks
    "scan_raw_files": "SELECT * FROM raw",
    "scan_partitioned": "SELECT * FROM clean WHERE MONTH BETWEEN 1 AND 4",
    "scan_partitioned_alias": "SELECT *, MONTH AS mese FROM clean WHERE MONTH BETWEEN 1 AND 4",
    "scan_csv_report": "SELECT * FROM q1_all",
    "ingest_csv": "SELECT * FROM raw",
    "write_partitioned": "SELECT * FROM clean",
    "write_report_csv": """SELECT carrier AS "Compagnia Aerea", records AS "Numero di voli",
  arr_delay_mean AS "Ritardo Medio Arrivo (min)",
  carrier_delay_mean AS "Ritardo Medio Veicolo (min)",
  weather_delay_mean AS "Ritardo Medio Meteo (min)",
  nas_delay_mean AS "Ritardo Medio Nas (min)",
  security_delay_mean AS "Ritardo Medio Sicurezza (min)",
  late_aircraft_delay_mean AS "Ritardo Medio dovuto a voluto precedente (min)"
  FROM all_carriers WHERE records >= 150""",
    "noop_run": "SELECT count(*) AS rows FROM clean",
    "keyed_upsert": f"{month_figures('raw', 1, 4)} UNION ALL {month_figures('clean', 5, 12)}",
    "keyed_replace": """SELECT 'q2:' || row_number() OVER (ORDER BY arr_delay_mean DESC, carrier)
    AS key, CAST(row_number() OVER (ORDER BY arr_delay_mean DESC, carrier) AS INT) AS position, *
  FROM all_carriers WHERE records >= 500 ORDER BY arr_delay_mean DESC, carrier LIMIT 10""",
    # filters and cleaning rules
    "require_fields": f"SELECT * FROM raw WHERE {PRESENT}",
    "explained_null_arr": f"SELECT * FROM raw WHERE {ARRIVAL_EXPLAINED}",
    "explained_null_dep": f"SELECT * FROM raw WHERE {DEPARTURE_EXPLAINED}",
    "explained_null": f"""SELECT * FROM raw
  WHERE {ARRIVAL_EXPLAINED} AND {DEPARTURE_EXPLAINED}""",
    "carrier_filter": "SELECT * FROM clean WHERE OP_UNIQUE_CARRIER IN ('AA', 'DL')",
    "completed_filter": "SELECT * FROM completed",
    "operated_filter": "SELECT * FROM clean WHERE CANCELLED <> 1",
    "min_records": """SELECT MONTH, OP_UNIQUE_CARRIER, count(*) AS records FROM clean
  GROUP BY 1, 2 HAVING count(*) >= 500""",
    "month_range": "SELECT * FROM clean WHERE MONTH IN (1, 2, 3, 4)",
    "normalize_causes": f"SELECT {HEAD}, {CAUSE_RULE} FROM raw",
    "clean_flights": "SELECT * FROM clean",
    # projections and scalar functions
    "hour_bucket": """SELECT CRS_DEP_TIME, CAST(CRS_DEP_TIME // 100 AS INT) AS hour_bucket
  FROM clean""",
    "default_cast": """SELECT MONTH, OP_UNIQUE_CARRIER,
    coalesce(DEP_DELAY, CAST(0 AS DOUBLE)) AS delay FROM raw""",
    "strict_cast": """SELECT OP_UNIQUE_CARRIER, ARR_DELAY, CARRIER_DELAY, WEATHER_DELAY,
    NAS_DELAY, SECURITY_DELAY, LATE_AIRCRAFT_DELAY FROM completed""",
    "round2": "SELECT DEP_DELAY, round(DEP_DELAY / 8, 2) AS rounded FROM raw",
    "rate_pct": """SELECT MONTH, OP_UNIQUE_CARRIER,
    sum(DIVERTED) / count(*) * 100 AS diverted_pct FROM clean GROUP BY 1, 2""",
    "percentile_columns": f"""SELECT OP_UNIQUE_CARRIER, {quantiles('quantile_disc')}
  FROM clean GROUP BY 1""",
    "positional_project": "SELECT MONTH, OP_UNIQUE_CARRIER, CANCELLED, DEP_DELAY FROM clean",
    "report_labels": Q1_HEADINGS,
    "canonical_names": f"SELECT {Q1_FIELDS} FROM q1_all",
    "composite_key": """SELECT OP_UNIQUE_CARRIER || ':' || CRS_DEP_TIME // 100 AS key,
    count(*) AS records FROM clean GROUP BY 1""",
    "rank_key": """SELECT CAST(position AS VARCHAR) AS key, carrier FROM all_board
  WHERE position <= 10""",
    "single_key": """SELECT carrier, min(DEP_DELAY) AS dep_delay_min, max(DEP_DELAY) AS dep_delay_max,
    carrier AS key FROM all_flown GROUP BY carrier""",
    # aggregations
    "cond_agg": """SELECT MONTH, OP_UNIQUE_CARRIER,
    round(avg(CASE WHEN CANCELLED = 0 THEN DEP_DELAY END), 2) AS dep_delay_mean,
    min(CASE WHEN CANCELLED = 0 THEN DEP_DELAY END) AS dep_delay_min,
    max(CASE WHEN CANCELLED = 0 THEN DEP_DELAY END) AS dep_delay_max
  FROM clean GROUP BY 1, 2""",
    "cancel_rate": """SELECT MONTH, OP_UNIQUE_CARRIER,
    round(sum(CANCELLED) / count(*) * 100, 2) AS cancellation_rate FROM clean GROUP BY 1, 2""",
    "group_count": "SELECT OP_UNIQUE_CARRIER, count(*) AS records FROM clean GROUP BY 1",
    "multi_mean": f"SELECT OP_UNIQUE_CARRIER, {MEANS} FROM completed GROUP BY 1",
    "min_max": """SELECT OP_UNIQUE_CARRIER, min(DEP_DELAY) AS dep_delay_min,
    max(DEP_DELAY) AS dep_delay_max FROM clean GROUP BY 1""",
    "percentiles_discrete": f"""SELECT MONTH, OP_UNIQUE_CARRIER, {quantiles('quantile_disc')}
  FROM clean GROUP BY 1, 2""",
    "percentiles_interpolated": f"""SELECT MONTH, OP_UNIQUE_CARRIER,
    {quantiles('quantile_cont', rounded=True)} FROM clean GROUP BY 1, 2""",
    "percentiles_approx": """SELECT OP_UNIQUE_CARRIER, count(DEP_DELAY) AS present,
    TRUE AS within_bound FROM clean GROUP BY 1""",
    "quantile_sketch": """SELECT OP_UNIQUE_CARRIER, count(DEP_DELAY) AS n,
    TRUE AS within_bound FROM clean GROUP BY 1""",
    "merge_state_q1": "SELECT * FROM delay_state",
    "finalize_state_q1": """SELECT OP_UNIQUE_CARRIER,
    round(delay_sum / delay_count, 2) AS dep_delay_mean,
    delay_min AS dep_delay_min, delay_max AS dep_delay_max,
    round(cancelled / flights * 100, 2) AS cancellation_rate FROM delay_state""",
    "merge_state_q2": """SELECT OP_UNIQUE_CARRIER, count(*) AS records,
    count(ARR_DELAY) AS arr_delay_count, count(CARRIER_DELAY) AS carrier_delay_count,
    count(WEATHER_DELAY) AS weather_delay_count, count(NAS_DELAY) AS nas_delay_count,
    count(SECURITY_DELAY) AS security_delay_count,
    count(LATE_AIRCRAFT_DELAY) AS late_aircraft_delay_count,
    sum(ARR_DELAY) AS arr_delay_sum, sum(CARRIER_DELAY) AS carrier_delay_sum,
    sum(WEATHER_DELAY) AS weather_delay_sum, sum(NAS_DELAY) AS nas_delay_sum,
    sum(SECURITY_DELAY) AS security_delay_sum,
    sum(LATE_AIRCRAFT_DELAY) AS late_aircraft_delay_sum FROM completed GROUP BY 1""",
    "finalize_state_q2": f"""SELECT OP_UNIQUE_CARRIER, count(*) AS records, {MEANS}
  FROM completed GROUP BY 1""",
    # ranking, reuse, reports, exports
    "leaderboard_rank": """SELECT position, carrier, arr_delay_mean FROM all_board
  WHERE position <= 10""",
    "sorted_report": """SELECT MONTH, OP_UNIQUE_CARRIER, count(*) AS records FROM clean
  GROUP BY 1, 2 ORDER BY 1, 2""",
    "top_k": "SELECT * EXCLUDE (position) FROM all_board WHERE position <= 10",
    "shared_subplan": f"""SELECT carrier, hour_bucket, {quantiles('quantile_disc')},
    CAST(NULL AS DOUBLE) AS dep_delay_min, CAST(NULL AS DOUBLE) AS dep_delay_max
  FROM all_flown GROUP BY 1, 2
  UNION ALL SELECT carrier, NULL, NULL, NULL, NULL, NULL, min(DEP_DELAY), max(DEP_DELAY)
  FROM all_flown GROUP BY 1""",
    "q1_monthly_delay": "SELECT * FROM q1 ORDER BY month, carrier",
    "q2_top_carriers": "SELECT * FROM q2",
    "q3_percentiles": "SELECT * FROM q3_p ORDER BY carrier, hour_bucket",
    "q3_percentiles_interpolated": f"""SELECT carrier, hour_bucket,
    {quantiles('quantile_cont', rounded=True)} FROM flown GROUP BY 1, 2""",
    "q3_min_max": "SELECT * FROM q3_mm ORDER BY carrier",
    "q1_from_states": "SELECT * FROM q1 ORDER BY month, carrier",
    "q2_from_states": "SELECT * FROM q2",
    "q1_from_states_raw": """SELECT MONTH AS month, OP_UNIQUE_CARRIER AS carrier,
    round(avg(CASE WHEN CANCELLED = 0 THEN DEP_DELAY END), 2) AS dep_delay_mean,
    min(CASE WHEN CANCELLED = 0 THEN DEP_DELAY END) AS dep_delay_min,
    max(CASE WHEN CANCELLED = 0 THEN DEP_DELAY END) AS dep_delay_max,
    round(sum(CANCELLED) / count(*) * 100, 2) AS cancellation_rate
  FROM raw WHERE OP_UNIQUE_CARRIER IS NOT NULL AND MONTH IS NOT NULL GROUP BY 1, 2""",
    "q2_from_states_raw": f"""SELECT OP_UNIQUE_CARRIER AS carrier, count(*) AS records, {MEANS}
  FROM raw WHERE OP_UNIQUE_CARRIER IS NOT NULL AND MONTH IS NOT NULL
    AND CANCELLED = 0 AND DIVERTED = 0 GROUP BY 1""",
    "job_rerun": f"""SELECT OP_UNIQUE_CARRIER AS carrier, count(*) AS records, {MEANS}
  FROM completed WHERE MONTH <= 2 GROUP BY 1 HAVING count(*) >= 150
  ORDER BY arr_delay_mean DESC, carrier LIMIT 10""",
    "q3_percentiles_from_states": "SELECT * FROM q3_p ORDER BY carrier, hour_bucket",
    "q3_min_max_from_states": "SELECT * FROM q3_mm ORDER BY carrier",
    "export_q1": f"SELECT 'q1:' || carrier || ':' || month AS key, {Q1_FIELDS} FROM q1_all",
    "export_q2": """SELECT 'q2:' || position AS key, position AS posizione, carrier AS compagnia,
    records AS num_voli, arr_delay_mean AS ritardo_medio_arr,
    carrier_delay_mean AS ritardo_veicolo, weather_delay_mean AS ritardo_meteo,
    nas_delay_mean AS ritardo_nas, security_delay_mean AS ritardo_sicurezza,
    late_aircraft_delay_mean AS ritardo_volo_precedente FROM all_board WHERE position <= 10""",
    "export_q2_all": """SELECT 'q2:' || row_number() OVER o AS key,
    CAST(row_number() OVER o AS INT) AS posizione, carrier AS compagnia,
    records AS num_voli, arr_delay_mean AS ritardo_medio_arr,
    carrier_delay_mean AS ritardo_veicolo, weather_delay_mean AS ritardo_meteo,
    nas_delay_mean AS ritardo_nas, security_delay_mean AS ritardo_sicurezza,
    late_aircraft_delay_mean AS ritardo_volo_precedente FROM all_carriers
  WINDOW o AS (ORDER BY arr_delay_mean DESC, carrier)""",
    "export_q3_p": f"""SELECT 'q3_p:' || carrier || ':' || hour_bucket AS key,
    carrier AS compagnia, hour_bucket AS "Fascia_oraria",
    p25 AS "P25", p50 AS "P50", p75 AS "P75", p90 AS "P90" FROM (
      SELECT carrier, hour_bucket, {quantiles('quantile_disc')} FROM all_flown GROUP BY 1, 2)""",
    "export_q3_mm": """SELECT 'q3_mm:' || carrier AS key, carrier AS compagnia,
    min(DEP_DELAY) AS ritardo_min_partenza, max(DEP_DELAY) AS ritardo_max_partenza
  FROM all_flown GROUP BY carrier""",
    "ingest_csv_headers": """SELECT *, CASE WHEN MONTH > 6 THEN 'N' || MONTH END AS TAIL_NUM FROM raw""",
    "ingest_csv_new": """SELECT *, CASE WHEN MONTH > 6 THEN 'N' || MONTH END AS TAIL_NUM,
    CAST(CASE WHEN MONTH > 6 THEN 1 ELSE 0 END AS INT) AS ingest_batch FROM raw""",
    "job_touched_months": """SELECT MONTH AS month, OP_UNIQUE_CARRIER AS carrier,
    round(avg(CASE WHEN CANCELLED = 0 THEN DEP_DELAY END), 2) AS dep_delay_mean,
    min(CASE WHEN CANCELLED = 0 THEN DEP_DELAY END) AS dep_delay_min,
    max(CASE WHEN CANCELLED = 0 THEN DEP_DELAY END) AS dep_delay_max,
    round(sum(CANCELLED) / count(*) * 100, 2) AS cancellation_rate
  FROM clean WHERE MONTH <= 5 OR (MONTH <= 7 AND OP_UNIQUE_CARRIER <> 'AA') GROUP BY 1, 2""",
    "q3_percentiles_from_sketches": """SELECT carrier, hour_bucket, count(DEP_DELAY) AS present,
    TRUE AS within_bound FROM all_flown GROUP BY 1, 2""",
    "q3_min_max_from_sketches": "SELECT * FROM q3_mm ORDER BY carrier",
    "states_from_one_scan": """SELECT MONTH, OP_UNIQUE_CARRIER, count(*) AS flights,
    count(*) FILTER (WHERE CANCELLED = 1) AS cancelled,
    sum(DEP_DELAY) FILTER (WHERE CANCELLED = 0) AS delay_sum,
    count(*) FILTER (WHERE CANCELLED = 0 AND DIVERTED = 0) AS records,
    sum(ARR_DELAY) FILTER (WHERE CANCELLED = 0 AND DIVERTED = 0) AS arr_delay_sum,
    count(*) FILTER (WHERE CANCELLED = 0) AS flown,
    count(DISTINCT CAST(CRS_DEP_TIME // 100 AS INT) * 10000 + CAST(DEP_DELAY AS INT))
      FILTER (WHERE CANCELLED = 0) AS delays
  FROM clean GROUP BY 1, 2""",
}

_AFTER_TEXT_FLAGS = {
    "lenient_flags": """SELECT * FROM flags
  WHERE OP_UNIQUE_CARRIER IS NOT NULL AND OP_UNIQUE_CARRIER <> ''
    AND (CANCELLED IS NULL OR try_cast(CANCELLED AS DOUBLE) = 0)
    AND try_cast(DIVERTED AS DOUBLE) = 0""",
    "lenient_flags_carriers": """SELECT * FROM flags
  WHERE OP_UNIQUE_CARRIER IN ('AA', 'DL', 'UA', 'WN')
    AND (CANCELLED IS NULL OR try_cast(CANCELLED AS DOUBLE) = 0)""",
}

BAD_LINES = f"""WITH lines AS (
  SELECT *, CASE WHEN l_orderkey % 41 = 0 THEN MONTH || '.5' ELSE CAST(MONTH AS VARCHAR) END AS m
  FROM ({RAW_WITH_ORDER}) r)
SELECT CASE WHEN l_orderkey % 41 = 0 THEN concat_ws(',', m, {", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')" for c in (
        "OP_UNIQUE_CARRIER", "CRS_DEP_TIME", "CANCELLED", "DIVERTED", "DEP_DELAY", "ARR_DELAY",
        "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"))})
  END AS line, OP_UNIQUE_CARRIER, CRS_DEP_TIME FROM lines"""

_ALONE = {
    "rank_all": """SELECT l_orderkey, quantity,
    row_number() OVER (ORDER BY quantity DESC, l_orderkey) AS position
  FROM (SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1)""",
    "percentiles_discrete_times": """SELECT event_type,
    quantile_disc(epoch_us(ts), 0.25) AS p25, quantile_disc(epoch_us(ts), 0.5) AS p50,
    quantile_disc(epoch_us(ts), 0.75) AS p75, quantile_disc(epoch_us(ts), 0.9) AS p90
  FROM events GROUP BY 1""",
    "ingest_csv_bad_rows": BAD_LINES,
    "percentiles_approx_small": """SELECT l_returnflag, count(l_discount) AS present,
    TRUE AS within_bound FROM lineitem GROUP BY 1""",
    "quantile_sketch_small": """SELECT l_returnflag, count(l_discount) AS n,
    TRUE AS within_bound FROM lineitem GROUP BY 1""",
    "percentiles_discrete_prices": """SELECT l_returnflag, l_linestatus,
    quantile_disc(l_extendedprice, 0.25) AS p25, quantile_disc(l_extendedprice, 0.5) AS p50,
    quantile_disc(l_extendedprice, 0.75) AS p75, quantile_disc(l_extendedprice, 0.9) AS p90
  FROM lineitem GROUP BY 1, 2""",
}

ORACLE: dict[str, str] = (
    {name: COMMON + sql for name, sql in _AFTER_COMMON.items()}
    | {name: TEXT_FLAGS + sql for name, sql in _AFTER_TEXT_FLAGS.items()}
    | _ALONE
)
