"""Column names, declared schemas and name maps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH = "MONTH"
CARRIER = "OP_UNIQUE_CARRIER"
SCHEDULED_DEPARTURE = "CRS_DEP_TIME"
CANCELLED = "CANCELLED"
DIVERTED = "DIVERTED"
DEP_DELAY = "DEP_DELAY"
ARR_DELAY = "ARR_DELAY"

# The five reported causes of an arrival delay.
CAUSES = (
    "CARRIER_DELAY",
    "WEATHER_DELAY",
    "NAS_DELAY",
    "SECURITY_DELAY",
    "LATE_AIRCRAFT_DELAY",
)

# The fields without which a record is dropped.
REQUIRED_FIELDS = (CARRIER, MONTH, SCHEDULED_DEPARTURE, CANCELLED, DIVERTED)

FLIGHT_SCHEMA = T.StructType(
    [
        T.StructField(MONTH, T.IntegerType()),
        T.StructField(CARRIER, T.StringType()),
        T.StructField(SCHEDULED_DEPARTURE, T.IntegerType()),
        T.StructField(CANCELLED, T.DoubleType()),
        T.StructField(DIVERTED, T.DoubleType()),
        T.StructField(DEP_DELAY, T.DoubleType()),
        T.StructField(ARR_DELAY, T.DoubleType()),
        *[T.StructField(cause, T.DoubleType()) for cause in CAUSES],
    ]
)

Q1_SCHEMA = T.StructType(
    [
        T.StructField("month", T.IntegerType()),
        T.StructField("carrier", T.StringType()),
        T.StructField("dep_delay_mean", T.DoubleType()),
        T.StructField("dep_delay_min", T.DoubleType()),
        T.StructField("dep_delay_max", T.DoubleType()),
        T.StructField("cancellation_rate", T.DoubleType()),
    ]
)

Q2_SCHEMA = T.StructType(
    [
        T.StructField("carrier", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("arr_delay_mean", T.DoubleType()),
        T.StructField("carrier_delay_mean", T.DoubleType()),
        T.StructField("weather_delay_mean", T.DoubleType()),
        T.StructField("nas_delay_mean", T.DoubleType()),
        T.StructField("security_delay_mean", T.DoubleType()),
        T.StructField("late_aircraft_delay_mean", T.DoubleType()),
    ]
)

Q3_PERCENTILES_SCHEMA = T.StructType(
    [
        T.StructField("carrier", T.StringType()),
        T.StructField("hour_bucket", T.IntegerType()),
        T.StructField("p25", T.DoubleType()),
        T.StructField("p50", T.DoubleType()),
        T.StructField("p75", T.DoubleType()),
        T.StructField("p90", T.DoubleType()),
    ]
)

Q3_MIN_MAX_SCHEMA = T.StructType(
    [
        T.StructField("carrier", T.StringType()),
        T.StructField("dep_delay_min", T.DoubleType()),
        T.StructField("dep_delay_max", T.DoubleType()),
    ]
)

# Stored states: what the first two questions need of a month and carrier, and
# the flown flights per month, carrier, hour and delay.
MONTHLY_STATE_SCHEMA = T.StructType(
    [
        T.StructField(CARRIER, T.StringType()),
        T.StructField("flights", T.LongType()),
        T.StructField("cancelled", T.LongType()),
        T.StructField("delay_count", T.LongType()),
        T.StructField("delay_sum", T.DoubleType()),
        T.StructField("delay_min", T.DoubleType()),
        T.StructField("delay_max", T.DoubleType()),
        T.StructField("records", T.LongType()),
        *[T.StructField(f"{c.lower()}_count", T.LongType()) for c in (ARR_DELAY, *CAUSES)],
        *[T.StructField(f"{c.lower()}_sum", T.DoubleType()) for c in (ARR_DELAY, *CAUSES)],
        T.StructField(MONTH, T.IntegerType()),
    ]
)
MONTHLY_DELAYS_SCHEMA = T.StructType(
    [
        T.StructField(CARRIER, T.StringType()),
        T.StructField("hour_bucket", T.IntegerType()),
        T.StructField(DEP_DELAY, T.DoubleType()),
        T.StructField("n", T.LongType()),
        T.StructField(MONTH, T.IntegerType()),
    ]
)
MONTHLY_SKETCHES_SCHEMA = T.StructType(
    [
        T.StructField(CARRIER, T.StringType()),
        T.StructField("hour_bucket", T.IntegerType()),
        T.StructField("sketch", T.BinaryType()),
        T.StructField("dep_delay_min", T.DoubleType()),
        T.StructField("dep_delay_max", T.DoubleType()),
        T.StructField(MONTH, T.IntegerType()),
    ]
)

# The report headings, exactly as the report files spell them.
Q1_LABELS = {
    "month": "Mese",
    "carrier": "Compagnia Aerea",
    "dep_delay_mean": "Ritardo Medio Partenza (min)",
    "dep_delay_min": "Ritardo Minimo Partenza (min)",
    "dep_delay_max": "Ritardo Massimo Partenza (min)",
    "cancellation_rate": "Percentuale voli cancellati",
}
Q2_LABELS = {
    "carrier": "Compagnia Aerea",
    "records": "Numero di voli",
    "arr_delay_mean": "Ritardo Medio Arrivo (min)",
    "carrier_delay_mean": "Ritardo Medio Veicolo (min)",
    "weather_delay_mean": "Ritardo Medio Meteo (min)",
    "nas_delay_mean": "Ritardo Medio Nas (min)",
    "security_delay_mean": "Ritardo Medio Sicurezza (min)",
    "late_aircraft_delay_mean": "Ritardo Medio dovuto a voluto precedente (min)",
}
Q3_PERCENTILES_LABELS = {
    "carrier": "Compagnia_Aerea",
    "hour_bucket": "Fascia_oraria",
    "p25": "P25",
    "p50": "P50",
    "p75": "P75",
    "p90": "P90",
}
Q3_MIN_MAX_LABELS = {
    "carrier": "Compagnia_Aerea",
    "dep_delay_min": "Ritardo Minimo Partenza (Min)",
    "dep_delay_max": "Ritardo Massimo Partenza (Min)",
}

# Heading -> field name of an exported record. Headings that are
# not listed keep their spelling in the record (P25, Fascia_oraria, ...).
Q1_RECORD_FIELDS = {
    "Compagnia Aerea": "compagnia",
    "Mese": "mese",
    "Ritardo Medio Partenza (min)": "ritardo_medio_part",
    "Ritardo Minimo Partenza (min)": "ritardo_min_part",
    "Ritardo Massimo Partenza (min)": "ritardo_max_part",
    "Percentuale voli cancellati": "perc_cancellati",
}
Q2_RECORD_FIELDS = {
    "Compagnia Aerea": "compagnia",
    "Numero di voli": "num_voli",
    "Ritardo Medio Arrivo (min)": "ritardo_medio_arr",
    "Ritardo Medio Veicolo (min)": "ritardo_veicolo",
    "Ritardo Medio Meteo (min)": "ritardo_meteo",
    "Ritardo Medio Nas (min)": "ritardo_nas",
    "Ritardo Medio Sicurezza (min)": "ritardo_sicurezza",
    "Ritardo Medio dovuto a voluto precedente (min)": "ritardo_volo_precedente",
}
Q3_PERCENTILES_RECORD_FIELDS = {"Compagnia_Aerea": "compagnia"}
Q3_MIN_MAX_RECORD_FIELDS = {
    "Compagnia_Aerea": "compagnia",
    "Ritardo Minimo Partenza (Min)": "ritardo_min_partenza",
    "Ritardo Massimo Partenza (Min)": "ritardo_max_partenza",
}


def labelled(schema: T.StructType, labels: dict[str, str]) -> T.StructType:
    """The same schema under the display names of a report."""
    return T.StructType(
        [T.StructField(labels.get(f.name, f.name), f.dataType) for f in schema.fields]
    )


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail at planning time when a needed column is absent."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the input has {df.columns}")
    return df


def require_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail at planning time when a declared column is absent or has another type."""
    require_columns(df, schema.names)
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = {
        f.name: (actual[f.name].simpleString(), f.dataType.simpleString())
        for f in schema.fields
        if actual[f.name] != f.dataType
    }
    if wrong:
        raise TypeError(f"columns with an unexpected type (found, declared): {wrong}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast declared columns that have another type; further columns stay as they are.

    Under ANSI mode a value that does not fit its declared type fails the job.
    """
    require_columns(df, schema.names)
    actual = {f.name: f.dataType for f in df.schema.fields}
    casts = {
        f.name: F.col(f.name).cast(f.dataType)
        for f in schema.fields
        if actual[f.name] != f.dataType
    }
    return df.withColumns(casts) if casts else df
