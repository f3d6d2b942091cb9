import datetime

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.operators import iforest
from meterspan.streaming import anomaly, hourly


def test_late_readings_and_open_hours(spark, tmp_path):
    source = tmp_path / "in"
    layout = "household_id long, timestamp timestamp_ntz, " + ", ".join(f"{c} double" for c in fixed.MEASURES)

    def arrive(minutes, name):
        rows = [
            (1, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m), *[6.0] * 7) for m in minutes
        ]
        spark.createDataFrame(rows, layout).coalesce(1).write.parquet(str(source / name))

    def run():
        stream = spark.readStream.schema(layout).option("recursiveFileLookup", True).parquet(str(source))
        out = hourly.stream_hourly_energy(stream, min_count=2)
        hourly.run_available(out, str(tmp_path / "out"), str(tmp_path / "log"))
        return spark.read.parquet(str(tmp_path / "out"))

    arrive(range(0, 300, 10), "a")
    first = {r.datetime.hour: r.energy_kwh for r in run().collect()}
    assert first == {0: 0.6, 1: 0.6}
    # Ten past midnight is too late by now; the fourth hour can still take one.
    arrive([10, 235, *range(300, 400, 10)], "b")
    second = {r.datetime.hour: r.energy_kwh for r in run().collect()}
    assert second[0] == 0.6 and second[3] == 0.7
    assert sorted(second) == [0, 1, 2, 3]


def test_recent_window_uses_recorded_days(spark):
    dates = pd.date_range("2024-01-01", periods=20).date
    days = spark.createDataFrame(
        pd.DataFrame({"household_id": 1, "date": dates, "energy_kwh": [float(i) for i in range(20)]})
    )
    old, new = days.filter(F.col("date") < dates[15]), days.filter(F.col("date") >= dates[15])
    rows = anomaly.with_recent_window(new, old).orderBy("date").collect()
    assert [r.rolling_mean_7 for r in rows] == [11.0, 12.0, 13.0, 14.0, 15.0]


def test_scored_stream(spark, tmp_path):
    dates = pd.date_range("2024-01-01", periods=400).date
    energy = np.random.default_rng(5).normal(20.0, 3.0, 400)
    energy[390:] = 20.0, 21.0, 19.0, 20.5, 19.5, 500.0, 480.0, 20.0, 21.0, 20.0
    days = spark.createDataFrame(pd.DataFrame({"household_id": 1, "date": dates, "energy_kwh": energy}))
    old, new = days.filter(F.col("date") < dates[390]), days.filter(F.col("date") >= dates[390])
    model = iforest.fit_isolation_forest(anomaly.with_recent_window(old, old.limit(0)), trees=30)
    new.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(new.schema).parquet(str(tmp_path / "in"))
    anomaly.score_stream(stream, lambda: old, model, str(tmp_path / "out"), str(tmp_path / "log"))
    scored = spark.read.parquet(str(tmp_path / "out"))
    assert scored.count() == 10
    flagged = {r.date for r in scored.filter("flagged").collect()}
    # The jump shows in the day's energy first and in its 7-day window after that.
    assert dates[396] in flagged and dates[390] not in flagged


def test_a_second_batch_knows_the_days_of_the_first(spark, tmp_path):
    dates = pd.date_range("2024-01-01", periods=30).date
    days = spark.createDataFrame(pd.DataFrame({"household_id": 1, "date": dates, "energy_kwh": [float(i) for i in range(30)]}))
    old = days.filter(F.col("date") < dates[10])
    model = iforest.fit_isolation_forest(anomaly.with_recent_window(days.filter(F.col("date") >= dates[8]), old), trees=5)
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(days.schema).parquet(str(tmp_path / "in"))
    for a, b in ((10, 18), (18, 30)):
        days.filter(F.col("energy_kwh").between(a, b - 1)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        anomaly.score_stream(stream, lambda: old, model, str(tmp_path / "out"), str(tmp_path / "log"))
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("date").collect()
    assert [r.rolling_mean_7 for r in rows] == [float(i - 4) for i in range(10, 30)]
