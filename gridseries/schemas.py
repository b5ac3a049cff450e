"""Column names, fixed lists and declared schemas of the data sets."""

from __future__ import annotations

from pyspark.sql import types as T

# Parameters of the monthly service, feature order and targets of the model.
PARAMETERS = ["T2M", "T2M_MAX", "T2M_MIN", "PRECTOTCORR", "ALLSKY_SFC_SW_DWN", "RH2M", "QV2M"]
WINDOW_PARAMETERS = ["T2M", "T2M_MAX", "T2M_MIN", "PRECTOTCORR", "RH2M", "ALLSKY_SFC_SW_DWN"]
INDICATORS = ["TXx", "TNn", "CDD", "CWD", "SPI", "HDD", "CDD_energy", "hot_days", "frost_days", "GSL", "GDD"]
CONTINUOUS = ["T2M", "T2M_MAX", "T2M_MIN", "PRECTOTCORR", "RH2M", "ALLSKY_SFC_SW_DWN"]
TEMPORAL = ["month_sin", "month_cos", "year_norm"]
SPATIAL = ["latitude", "longitude"]
ENGINEERED = ["T2M_range", "heat_index", "precip_log"]
SEASON_FLAGS = ["season_Fall", "season_Spring", "season_Summer", "season_Winter"]
FEATURES = [f"{c}_transformed" for c in CONTINUOUS] + TEMPORAL + SPATIAL + ENGINEERED + SEASON_FLAGS
TARGETS = ["T2M_anom", "PRECTOTCORR_anom"]
TEMPERATURES = ["T2M", "T2M_MAX", "T2M_MIN"]
LAGGED = ["T2M", "PRECTOTCORR", "RH2M"]
LAG_MONTHS = [1, 3, 6, 12]

# Columns that each kind of cleaning step leaves alone.
NOT_MEASURED = ["location_id", "year", "month", "latitude", "longitude"]
NOT_SCALED = ["location_id", "year", "month"]
NOT_ENCODED = ["time", "description"]

LOCATION = T.StructType([
    T.StructField("location_id", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("grid_type", T.StringType()),
    T.StructField("description", T.StringType()),
])

CITY_FILE = T.StructType([
    T.StructField("city_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("country", T.StringType()),
])

RESPONSE = T.StructType([
    T.StructField("properties", T.StructType([
        T.StructField("parameter", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))),
    ])),
])

# Responses packed as JSON lines: thousands per file instead of one small file each.
PACKED_RESPONSE = T.StructType([
    T.StructField("location_id", T.LongType()),
    T.StructField("request", T.StringType()),
    *RESPONSE.fields,
])

CLIMATE = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in sorted(PARAMETERS)]
    + [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("location_id", T.LongType()),
        T.StructField("time", T.TimestampType()),
    ]
)

MASTER = T.StructType(
    CLIMATE.fields
    + [
        T.StructField("grid_type", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("T2M_range", T.DoubleType()),
        T.StructField("heat_index", T.DoubleType()),
        T.StructField("precip_log", T.DoubleType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("season", T.StringType()),
        T.StructField("year", T.IntegerType()),
    ]
)

BASELINE = T.StructType([
    T.StructField("lat_rounded", T.DoubleType()),
    T.StructField("lon_rounded", T.DoubleType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("baseline_temp", T.DoubleType()),
    T.StructField("baseline_precip", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

SCENARIO = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("months", T.IntegerType()),
])

WINDOW_REQUEST = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("months_back", T.IntegerType()),
])


def numeric_columns(schema: T.StructType, excluding: list[str] | None = None) -> list[str]:
    skip = set(excluding or ())
    return [f.name for f in schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def floating_columns(schema: T.StructType, excluding: list[str] | None = None) -> list[str]:
    skip = set(excluding or ())
    return [f.name for f in schema if isinstance(f.dataType, T.FractionalType) and f.name not in skip]


def text_columns(schema: T.StructType, excluding: list[str] | None = None) -> list[str]:
    skip = set(excluding or ())
    return [f.name for f in schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def require_columns(columns: list[str], needed: list[str]) -> None:
    missing = [c for c in needed if c not in columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
