"""Rollups. All are plain grouped aggregates: partial sums per task come first,
so a household with a large share of the rows costs no more than others."""

from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.functions.calendar import hour_start


def _energy_columns():
    return [
        (F.sum("Global_active_power") / 60.0).alias("energy_kwh"),
        F.avg("Voltage").alias("avg_voltage"),
        F.avg("Global_intensity").alias("avg_intensity"),
        F.avg("Global_reactive_power").alias("avg_reactive_power"),
        F.sum("Sub_metering_1").alias("sub_metering_1"),
        F.sum("Sub_metering_2").alias("sub_metering_2"),
        F.sum("Sub_metering_3").alias("sub_metering_3"),
    ]


def hourly_energy(readings, min_count=fixed.MIN_READINGS_PER_HOUR, keys=("household_id",)):
    """kWh per hour from one-minute kW readings; thin hours are left out."""
    return (
        readings.groupBy(*keys, hour_start(F.col("timestamp")).alias("datetime"))
        .agg(*_energy_columns(), F.count(F.lit(1)).alias("_readings"))
        .filter(F.col("_readings") >= min_count)
        .drop("_readings")
    )


def daily_energy(readings, keys=("household_id",)):
    """kWh per day; a day without energy readings sums to 0, a day without an
    average is dropped."""
    sums = ["energy_kwh", *[c.lower() for c in fixed.SUB_METERS]]
    return (
        readings.groupBy(*keys, F.to_date("timestamp").alias("date"))
        .agg(*_energy_columns())
        .fillna(0.0, subset=sums)
        .na.drop(subset=fixed.ROLLUP_COLUMNS)
    )


def table_range(df, time, keys=("household_id",)):
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(time).alias("first"),
        F.max(time).alias("last"),
    )


def hour_profile(hourly, keys=("household_id",)):
    return hourly.groupBy(*keys, F.hour("datetime").alias("hour")).agg(
        F.avg("energy_kwh").alias("avg_kwh"),
        F.min("energy_kwh").alias("min_kwh"),
        F.max("energy_kwh").alias("max_kwh"),
        F.count(F.lit(1)).alias("hour_count"),
    )


def daily_from_hourly(hourly, keys=("household_id",)):
    return hourly.groupBy(*keys, F.to_date("datetime").alias("date")).agg(
        F.sum("energy_kwh").alias("daily_total_kwh"), F.avg("energy_kwh").alias("daily_avg_kwh")
    )


def monthly_energy(features, keys=("household_id",)):
    return (
        features.groupBy(*keys, "year", "month")
        .agg(
            F.sum("energy_kwh").alias("monthly_total_kwh"),
            F.avg("energy_kwh").alias("monthly_avg_kwh"),
            F.count(F.lit(1)).alias("hours_count"),
        )
        .withColumn("yr_mo", F.format_string("%d-%02d", "year", "month"))
    )


def seasonal_energy(features, keys=("household_id",)):
    """Largest season first when the caller orders by ``season_total_kwh``."""
    return features.groupBy(*keys, "season").agg(
        F.sum("energy_kwh").alias("season_total_kwh"), F.avg("energy_kwh").alias("season_avg_kwh")
    )


def weekday_weekend(features, keys=("household_id",)):
    return (
        features.groupBy(*keys, "is_weekend")
        .agg(
            F.avg("energy_kwh").alias("avg_kwh"),
            F.sum("energy_kwh").alias("total_kwh"),
            F.count(F.lit(1)).alias("hours_count"),
        )
        .withColumn("day_type", F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday"))
    )


def stage_rows(stages):
    """Row count per named stage of a pipeline, as one small table.

    ``stages`` is an ordered list of (name, frame). Each count prunes all
    columns, so a stage costs its keys and filters only."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(position).alias("position"), F.lit(name).alias("stage"), "rows"
        )
        for position, (name, frame) in enumerate(stages, start=1)
    ]
    out = counted[0]
    for more in counted[1:]:
        out = out.unionByName(more)
    return out
