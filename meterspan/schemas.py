"""Table schemas. Every series table carries ``household_id`` first."""

from pyspark.sql import types as T

from meterspan import fixed


def _table(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_D, _S, _L, _I = T.DoubleType(), T.StringType(), T.LongType(), T.IntegerType()

# The meter file itself has no household column: one file per household.
RAW_FILE = _table(("Date", _S), ("Time", _S), *[(c, _S) for c in fixed.MEASURES])
DAILY = _table(("household_id", _L), ("date", T.DateType()), *[(c, _D) for c in fixed.ROLLUP_COLUMNS])
HOURLY = _table(
    ("household_id", _L), ("datetime", T.TimestampNTZType()), *[(c, _D) for c in fixed.ROLLUP_COLUMNS]
)
FEATURES = T.StructType(
    DAILY.fields
    + [T.StructField(c, _I, True) for c in fixed.CALENDAR_FEATURES]
    + [T.StructField(c, _D, True) for c in fixed.DAILY_FEATURES if c not in fixed.CALENDAR_FEATURES]
)
ANOMALIES = _table(
    ("household_id", _L),
    ("date", T.DateType()),
    ("energy_kwh", _D),
    ("rolling_mean_7", _D),
    ("rolling_std_7", _D),
    ("anomaly_score", _D),
)
MODEL_COMPARISON = _table(("Model", _S), ("MAE", _D), ("RMSE", _D), ("R2", _D), ("Training_Time", _D))
CLUSTER_SUMMARY = _table(
    ("cluster", _I), ("count", _L), ("mean", _D), ("median", _D), ("min", _D), ("max", _D)
)
APPLIANCE = _table(
    ("id", _S),
    ("name", _S),
    ("type", _S),
    ("powerWatts", _D),
    ("quantity", _D),
    ("currentDailyHours", _D),
    ("proposedDailyHours", _D),
    ("daysPerMonth", _D),
)
RECOMMENDATION = _table(
    ("rec_id", _S),
    ("category", _S),
    ("monthly_savings_kwh", _D),
    ("impact", _S),
    ("difficulty", _S),
    ("target_type", _S),
    ("target_hours", _D),
)
