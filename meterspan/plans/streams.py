"""The two stream jobs, run over the files that are there."""

from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.operators import clean, features, iforest
from meterspan.plans.registry import query, r, report, stamp
from meterspan.session import scratch_folder
from meterspan.sources import tables as t
from meterspan.streaming.anomaly import score_stream
from meterspan.streaming.hourly import run_available, stream_hourly_energy

NEW_DAYS = 60


@query(
    "stream_hourly",
    f"""WITH {t.HOURLY}, edge AS (SELECT max(timestamp) - INTERVAL 2 HOUR AS mark FROM readings)
SELECT household_id, {stamp('datetime')}, {r(*fixed.ROLLUP_COLUMNS)} FROM hourly, edge
WHERE datetime + INTERVAL 1 HOUR <= mark""",
)
def stream_hourly(spark, folder):
    """Hours closed by the watermark; the newest ones wait for more readings."""
    layout = t.table(spark, folder, "events").schema
    stream = spark.readStream.schema(layout).parquet(f"{folder}/events*.parquet")
    readings = clean.valid_readings(t.readings_of(stream))
    out = scratch_folder(spark, "hours")
    run_available(stream_hourly_energy(readings, t.MIN_COUNT), f"{out}/data", f"{out}/log")
    layout = ", ".join(
        ["household_id bigint", "datetime timestamp_ntz", *[f"{c} double" for c in fixed.ROLLUP_COLUMNS]]
    )
    return report(spark.read.schema(layout).parquet(f"{out}/data"))


@query("stream_anomaly")
def stream_anomaly(spark, folder):
    """The newest days of every household as a stream, scored with a forest
    fitted on the days before them."""
    daily = t.daily(spark, folder).select("household_id", "date", "energy_kwh")
    ends = daily.groupBy("household_id").agg(F.date_sub(F.max("date"), NEW_DAYS).alias("_cut"))
    marked = daily.join(ends, "household_id")
    recorded = marked.filter(F.col("date") <= F.col("_cut")).drop("_cut")
    out = scratch_folder(spark, "flags")
    marked.filter(F.col("date") > F.col("_cut")).drop("_cut").write.parquet(f"{out}/days")
    rolled = recorded.withColumns(
        features.rolling_columns(features.series_window(), widths=[7])
    )
    model = iforest.fit_isolation_forest(rolled)
    days = spark.readStream.schema(daily.schema).parquet(f"{out}/days")
    score_stream(days, lambda: recorded, model, f"{out}/scored", f"{out}/log")
    return report(spark.read.parquet(f"{out}/scored").drop("batch"))
