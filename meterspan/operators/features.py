"""Time-series features. Lags and windows count records, not calendar days.

Daily windows run per household: a household has at most one row per calendar
day (the rollup key), so forty years are under 15,000 rows in one task however
large the reading table is. Hourly windows run per household and year, at most
8,784 rows.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.functions.calendar import daily_calendar, hourly_calendar


def series_window(keys=("household_id",), time="date"):
    return Window.partitionBy(*keys).orderBy(time)


def lag_columns(window, value="energy_kwh", lags=fixed.LAGS):
    return {f"lag_{n}": F.lag(value, n).over(window) for n in lags}


def rolling_columns(window, value="energy_kwh", widths=fixed.ROLLING_WINDOWS):
    """Mean and sample deviation of the previous ``n`` records, null until there are n."""
    out = {}
    for n in widths:
        frame = window.rowsBetween(-n, -1)
        full = F.count(value).over(frame) == n
        out[f"rolling_mean_{n}"] = F.when(full, F.avg(value).over(frame))
        out[f"rolling_std_{n}"] = F.when(full, F.stddev_samp(value).over(frame))
    return out


def add_ewm_state(daily, spans=fixed.EWM_SPANS, value="energy_kwh", keys=("household_id",), time="date"):
    """Adds ``_num_s`` and ``_den_s`` per span: the weighted sum of all values up
    to and including the row, newest weight 1, and the sum of the weights.

    With decay c the sum is kept by running totals of x * c**-i inside blocks of
    B records plus the closing total of the block before. B is the length after
    which the slowest weight has fallen to 1e-21, so older blocks are below double
    precision. Cost is linear in the series length, and all spans share the sorts.
    """
    decays = {s: 1.0 - 2.0 / (s + 1.0) for s in spans}
    size = math.ceil(math.log(1e-21) / math.log(max(decays.values())))
    if min(decays.values()) ** size < 1e-250:
        raise ValueError(f"spans {list(spans)} are too far apart for one block length")
    window = series_window(keys, time)
    so_far = window.rowsBetween(Window.unboundedPreceding, -1)
    in_block = (
        Window.partitionBy(*keys, "_block")
        .orderBy(time)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    rest = F.col("_position") % size
    power = {s: F.pow(F.lit(c), rest) for s, c in decays.items()}

    def closing(s):
        last = F.when(rest == size - 1, F.col(f"_local_{s}"))
        return F.coalesce(F.last(last, ignorenulls=True).over(so_far), F.lit(0.0))

    return (
        daily.withColumn("_position", F.row_number().over(window) - 1)
        .withColumn("_block", F.floor(F.col("_position") / size))
        .withColumns({f"_local_{s}": F.sum(F.col(value) / power[s]).over(in_block) * power[s] for s in spans})
        .withColumns(
            {f"_num_{s}": F.col(f"_local_{s}") + closing(s) * power[s] * c for s, c in decays.items()}
        )
        .withColumns(
            {
                f"_den_{s}": (1.0 - F.pow(F.lit(c), F.col("_position") + 1)) / (1.0 - c)
                for s, c in decays.items()
            }
        )
        .drop("_block", *[f"_local_{s}" for s in spans])
    )


def ewm_columns(window, spans=fixed.EWM_SPANS):
    """Exponentially weighted mean over all earlier records (weights normalised)."""
    return {
        f"ewm_{s}": F.lag(F.col(f"_num_{s}") / F.col(f"_den_{s}"), 1).over(window) for s in spans
    }


def daily_features(daily, keys=("household_id",)):
    """Daily table with the 26 features; the first rows carry nulls."""
    window = series_window(keys)
    return (
        add_ewm_state(daily, keys=keys)
        .withColumns(lag_columns(window))
        .withColumns(rolling_columns(window))
        .withColumns(ewm_columns(window))
        .withColumns(daily_calendar(F.col("date")))
        .select(*[c for c in daily.columns if c not in fixed.DAILY_FEATURES], *fixed.DAILY_FEATURES)
    )


def complete_features(daily, keys=("household_id",)):
    """The table models are fitted on: every feature present."""
    return daily_features(daily, keys).na.drop(subset=fixed.DAILY_FEATURES)


def target_features(daily, targets, keys=("household_id",)):
    """Feature rows of given target days from the records strictly before them.

    ``targets`` holds one date per household and lies after its last record. The
    target joins the series as a row without energy and is read back."""
    placeholder = targets.select(*keys, F.col("target_date").alias("date"))
    extended = daily.select(*keys, "date", "energy_kwh", F.lit(False).alias("_target")).unionByName(
        placeholder.withColumns({"energy_kwh": F.lit(None).cast("double"), "_target": F.lit(True)})
    )
    return (
        daily_features(extended, keys)
        .filter("_target")
        .select(*keys, "date", *fixed.DAILY_FEATURES)
    )


def feature_contract(features, keys=("household_id", "date")):
    """Rows that break the model-input contract, with the first bad column.

    Raises when the columns themselves differ from the agreed order."""
    given = [c for c in features.columns if c in set(fixed.DAILY_FEATURES)]
    if given != fixed.DAILY_FEATURES:
        raise ValueError(f"feature columns must be {fixed.DAILY_FEATURES}, got {given}")
    bad = [
        F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.lit(c))
        for c in fixed.DAILY_FEATURES
    ]
    return features.select(*keys, F.coalesce(*bad).alias("bad_column")).filter("bad_column is not null")


def hourly_features(hourly, by_year=True, keys=("household_id",)):
    """Hourly table with temporal columns, lags, shrinking averages that include
    the current hour, and the next hour as target. Rows without a full day of
    history or without a next hour are dropped.

    With ``by_year`` the lags start afresh each year, which keeps the published
    hour counts; without it they run through."""
    parts = [*keys, "year"] if by_year else list(keys)
    window = Window.partitionBy(*parts).orderBy("datetime")
    energy = "energy_kwh"
    return (
        hourly.withColumns(hourly_calendar(F.col("datetime")))
        .withColumns(
            {
                "lag_1h": F.lag(energy, 1).over(window),
                "lag_24h": F.lag(energy, 24).over(window),
                "rolling_avg_3h": F.avg(energy).over(window.rowsBetween(-2, 0)),
                "rolling_avg_24h": F.avg(energy).over(window.rowsBetween(-23, 0)),
                "target_next_hour_kwh": F.lead(energy, 1).over(window),
            }
        )
        .na.drop(subset=["lag_1h", "lag_24h", "target_next_hour_kwh"])
    )


def chronological_split(
    features, train=fixed.TRAIN_FRACTION, validation=fixed.VALIDATION_FRACTION, keys=("household_id",)
):
    """Adds ``split``: training, validation or test by row position in time."""
    window = series_window(keys)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    train_end, validation_end = F.floor(n * F.lit(train)), F.floor(n * F.lit(train + validation))
    return (
        features.withColumn("_row", F.row_number().over(window))
        .withColumn("_train", train_end)
        .withColumn("_validation", validation_end)
        .withColumn(
            "split",
            F.when(F.col("_row") <= F.col("_train"), "training")
            .when(F.col("_row") <= F.col("_validation"), "validation")
            .otherwise("test"),
        )
        .drop("_row", "_train", "_validation")
    )


def split_summary(split, keys=("household_id",)):
    return split.groupBy(*keys, "split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
    )


def date_split(df, threshold, time="datetime", seed=42):
    """Rows before and from a date; 80/20 at random when one side is empty."""
    edge = F.lit(threshold).cast("timestamp_ntz")
    before, after = df.filter(F.col(time) < edge), df.filter(F.col(time) >= edge)
    if before.isEmpty() or after.isEmpty():
        return df.randomSplit([0.8, 0.2], seed=seed)
    return before, after


def history_gaps(daily, max_gap=fixed.MAX_GAP_DAYS, keys=("household_id",)):
    """Steps between consecutive records that are longer than allowed."""
    window = series_window(keys)
    return (
        daily.select(*keys, "date", F.lag("date").over(window).alias("previous_date"))
        .withColumn("gap_days", F.datediff("date", "previous_date"))
        .filter(F.col("gap_days") > max_gap)
    )
