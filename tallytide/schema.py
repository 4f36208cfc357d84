"""Explicit schemas and the fixed values of the data model."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import types as T

# Fixed values of the data model.
SEED = 42
EDA_SAMPLE_SIZE = 150
AM_RUSH = (7, 9)
PM_RUSH = (16, 19)
KELVIN_OFFSET = 273.15
MPS_TO_KMH = 3.6
ROLLING_WINDOWS = (60, 300)
LABELS = ("low", "medium", "high")
EVENT_LAGS = (1, 3, 5)
TOP_STOPS = 20
OTHER = "__other__"
PLACEHOLDER = "-"
INDEX_FLAG_ABOVE = 20.0
TEMPORAL_CUTOFF = datetime(2022, 1, 1, tzinfo=timezone.utc)
CONTEXT_LENGTH = 512
CONTEXT_STRIDE = 60
CONTEXT_MIN = 64
TRAIN_CONTEXT_ROWS = 2048
VECTOR_SIZE = 32


def _struct(kind: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names.split()]


# All 26 columns at rest; a query prunes what it does not select.
TELEMETRY = T.StructType(
    _struct(T.TimestampType(), "time_iso")
    + _struct(T.LongType(), "time_unix")
    + _struct(T.DoubleType(), "electric_powerDemand gnss_altitude gnss_course gnss_latitude gnss_longitude")
    + _struct(T.StringType(), "itcs_busRoute")
    + _struct(T.DoubleType(), "itcs_numberOfPassengers")
    + _struct(T.StringType(), "itcs_stopName")
    + _struct(
        T.DoubleType(),
        "odometry_articulationAngle odometry_steeringAngle odometry_vehicleSpeed "
        "odometry_wheelSpeed_fl odometry_wheelSpeed_fr odometry_wheelSpeed_ml "
        "odometry_wheelSpeed_mr odometry_wheelSpeed_rl odometry_wheelSpeed_rr",
    )
    + _struct(
        T.IntegerType(),
        "status_doorIsOpen status_gridIsAvailable status_haltBrakeIsActive status_parkBrakeIsActive",
    )
    + _struct(
        T.DoubleType(),
        "temperature_ambient traction_brakePressure traction_tractionForce",
    )
)

# The columns the feature work reads.
TELEMETRY_READ = [
    "time_iso",
    "time_unix",
    "gnss_latitude",
    "gnss_longitude",
    "gnss_altitude",
    "itcs_busRoute",
    "itcs_numberOfPassengers",
    "itcs_stopName",
    "odometry_vehicleSpeed",
    "status_doorIsOpen",
    "status_gridIsAvailable",
    "status_haltBrakeIsActive",
    "status_parkBrakeIsActive",
    "temperature_ambient",
    "electric_powerDemand",
    "traction_tractionForce",
    "traction_brakePressure",
]

METADATA = T.StructType(
    _struct(T.StringType(), "name")
    + _struct(T.IntegerType(), "busNumber")
    + _struct(T.TimestampType(), "startTime_iso")
    + _struct(T.LongType(), "startTime_unix")
    + _struct(T.TimestampType(), "endTime_iso")
    + _struct(T.LongType(), "endTime_unix")
    + _struct(T.DoubleType(), "drivenDistance")
    + _struct(T.StringType(), "busRoute")
    + _struct(
        T.DoubleType(),
        "energyConsumption itcs_numberOfPassengers_mean itcs_numberOfPassengers_min "
        "itcs_numberOfPassengers_max status_gridIsAvailable_mean temperature_ambient_mean "
        "temperature_ambient_min temperature_ambient_max",
    )
)

DAILY_INDEX = T.StructType(_struct(T.DateType(), "date") + _struct(T.DoubleType(), "stringency"))

_CLASS_METRICS = T.StructType(
    _struct(T.DoubleType(), "precision recall f1") + _struct(T.LongType(), "support")
)
METRICS = T.StructType(
    _struct(T.StringType(), "model framework")
    + _struct(T.DoubleType(), "macro_f1 balanced_accuracy")
    + [
        T.StructField("confusion_matrix", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("per_class", T.MapType(T.StringType(), _CLASS_METRICS)),
    ]
    + _struct(T.DoubleType(), "train_time_s predict_time_s")
    + [T.StructField("params", T.MapType(T.StringType(), T.StringType()))]
)

# Feature name -> group, exact names first, then prefixes.
FEATURE_GROUPS = {
    "hour": "Temporal",
    "dayofweek": "Temporal",
    "month": "Temporal",
    "year": "Temporal",
    "is_weekend": "Temporal",
    "is_rush_hour": "Temporal",
    "lat_deg": "Spatial",
    "lon_deg": "Spatial",
    "gnss_altitude": "Spatial",
    "speed_kmh": "Operational",
    "acceleration": "Operational",
    "speed_roll_mean_60": "Operational",
    "speed_roll_std_60": "Operational",
    "speed_roll_mean_300": "Operational",
    "speed_roll_std_300": "Operational",
    "electric_powerDemand": "Sensor",
    "power_roll_mean_60": "Sensor",
    "power_roll_std_60": "Sensor",
    "power_roll_mean_300": "Sensor",
    "power_roll_std_300": "Sensor",
    "traction_tractionForce": "Sensor",
    "traction_brakePressure": "Sensor",
    "status_doorIsOpen": "Status",
    "status_gridIsAvailable": "Status",
    "status_haltBrakeIsActive": "Status",
    "status_parkBrakeIsActive": "Status",
    "covid_flag": "COVID",
    "covid_intensity": "COVID",
    "pax_stop_lag_1": "Lag",
    "pax_stop_lag_3": "Lag",
    "pax_stop_lag_5": "Lag",
}
FEATURE_GROUP_PREFIXES = {"route_": "Categorical", "stop_": "Categorical"}
UNKNOWN_GROUP = "Unknown"
