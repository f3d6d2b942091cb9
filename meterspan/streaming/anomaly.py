"""Flags for daily rows that arrive on a stream, scored with a fitted forest."""

from pyspark.sql import Window
from pyspark.sql import functions as F

KEYS = ("household_id",)


def with_recent_window(new_days, recorded, n=7):
    """Mean and deviation of the n records before each new day.

    Only households in the batch are read from the table, and of those the records
    between the batch's first and last day and the n before them."""
    span = new_days.groupBy("household_id").agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    earlier = F.col("date") < F.col("_first")
    newest = Window.partitionBy("household_id", "_earlier").orderBy(F.col("date").desc())
    before = (
        recorded.select("household_id", "date", "energy_kwh")
        .join(span, "household_id")
        .filter(F.col("date") < F.col("_last"))
        .withColumn("_earlier", earlier)
        .withColumn("_r", F.row_number().over(newest))
        .filter(~F.col("_earlier") | (F.col("_r") <= n))
        .join(new_days.select("household_id", "date"), ["household_id", "date"], "left_anti")
        .select("household_id", "date", "energy_kwh", F.lit(False).alias("_new"))
    )
    line = before.unionByName(
        new_days.select("household_id", "date", "energy_kwh", F.lit(True).alias("_new"))
    )
    frame = Window.partitionBy("household_id").orderBy("date").rowsBetween(-n, -1)
    full = F.count("energy_kwh").over(frame) == n
    return (
        line.withColumn(f"rolling_mean_{n}", F.when(full, F.avg("energy_kwh").over(frame)))
        .withColumn(f"rolling_std_{n}", F.when(full, F.stddev_samp("energy_kwh").over(frame)))
        .filter("_new")
        .drop("_new")
    )


def score_stream(days, recorded, model, path, checkpoint):
    """Scores each micro-batch and writes it under its batch number, so a batch
    that is run again after a failure replaces its own output. The days of earlier
    batches, kept beside the output in ``path`` + "-days", belong to the history."""
    accepted = f"{path}-days"

    def write(batch, number):
        batch.persist()  # read several times: for its span, its rows and its record
        try:
            batch.write.mode("overwrite").parquet(f"{accepted}/batch={number}")
            kept = batch.sparkSession.read.parquet(accepted).filter(F.col("batch") < number)
            columns = ["household_id", "date", "energy_kwh"]
            history = recorded().select(*columns).unionByName(kept.select(*columns))
            complete = with_recent_window(batch, history).na.drop(subset=model.columns)
            model.score(complete).write.mode("overwrite").parquet(f"{path}/batch={number}")
        finally:
            batch.unpersist()

    query = (
        days.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
