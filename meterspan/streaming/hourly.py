"""Hourly energy on a stream of readings, with a bound for late data."""

from pyspark.sql import functions as F

from meterspan import fixed


def stream_hourly_energy(readings, min_count=fixed.MIN_READINGS_PER_HOUR, late="2 hours"):
    """The hourly rollup as a windowed stream aggregate (append mode): an hour is
    emitted once, when the watermark has passed its end. Event time must be an
    instant, so the naive local time goes through the session time zone and back."""
    hour = F.window("timestamp", "1 hour").alias("_hour")
    return (
        readings.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        .withWatermark("timestamp", late)
        .groupBy("household_id", hour)
        .agg(
            (F.sum("Global_active_power") / 60.0).alias("energy_kwh"),
            F.avg("Voltage").alias("avg_voltage"),
            F.avg("Global_intensity").alias("avg_intensity"),
            F.avg("Global_reactive_power").alias("avg_reactive_power"),
            F.sum("Sub_metering_1").alias("sub_metering_1"),
            F.sum("Sub_metering_2").alias("sub_metering_2"),
            F.sum("Sub_metering_3").alias("sub_metering_3"),
            F.count(F.lit(1)).alias("_readings"),
        )
        .filter(F.col("_readings") >= min_count)
        .select("household_id", F.col("_hour.start").cast("timestamp_ntz").alias("datetime"), *fixed.ROLLUP_COLUMNS)
    )


def run_available(frame, path, checkpoint, mode="append"):
    """Process what is there and stop; the sink and its log survive restarts."""
    query = (
        frame.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
