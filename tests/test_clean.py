import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.operators import clean, rollup


def series(values, seed=None):
    """Readings at one minute, or at irregular times when a seed is given."""
    n = len(values)
    if seed is None:
        times = pd.date_range("2024-03-01 22:17", periods=n, freq="min")
    else:
        gaps = np.random.default_rng(seed).integers(1, 900, n)
        times = pd.Timestamp("2024-03-01") + pd.to_timedelta(np.cumsum(gaps), unit="s")
    return pd.DataFrame({"household_id": 1, "reading_id": range(n), "timestamp": times, "x": values})


def frame_of(spark, local):
    frame = spark.createDataFrame(local.astype({"x": object}).where(local.notna(), None), "household_id long, reading_id long, timestamp timestamp_ntz, x double")
    return frame


def filled(spark, local, **options):
    out = clean.interpolate_gaps(frame_of(spark, local), ["x"], **options)
    return out.toPandas().sort_values(["household_id", "reading_id"])["x"].to_numpy(dtype=float)


def by_pandas(local, limit=60):
    x = local.set_index("timestamp")["x"]
    return x.interpolate(method="time", limit=limit, limit_direction="both").to_numpy()


@pytest.mark.parametrize("run, missing", [(60, 0), (120, 0), (121, 1), (130, 10), (300, 180)])
def test_inner_runs(spark, run, missing):
    values = [10.0] * 5 + [np.nan] * run + [30.0] * 5
    local = series(values)
    got = filled(spark, local)
    assert np.isnan(got).sum() == missing
    np.testing.assert_allclose(got, by_pandas(local), atol=1e-9)


def test_ends_take_the_nearest_value(spark):
    local = series([np.nan] * 70 + [4.0, 5.0] + [np.nan] * 65)
    got = filled(spark, local)
    assert np.isnan(got[:10]).all() and (got[10:70] == 4.0).all()
    assert (got[72:132] == 5.0).all() and np.isnan(got[132:]).all()


@pytest.mark.parametrize("block", [3600, 86400, 60])
def test_irregular_series_matches_pandas(spark, block):
    rng = np.random.default_rng(8)
    values = rng.normal(10, 3, 4000)
    for start in rng.integers(0, 3900, 60):
        values[start : start + int(rng.integers(1, 160))] = np.nan
    local = series(values, seed=5)
    np.testing.assert_allclose(filled(spark, local, block_seconds=block), by_pandas(local), atol=1e-7)


def test_households_do_not_mix(spark):
    a = series([1.0, np.nan, 3.0])
    b = series([np.nan, 8.0, np.nan]).assign(household_id=2)
    got = filled(spark, pd.concat([a, b]))
    np.testing.assert_allclose(got, [1, 2, 3, 8, 8, 8])


def test_all_missing_stays_missing(spark):
    assert np.isnan(filled(spark, series([np.nan] * 5))).all()


def test_plan_has_no_window_over_a_household_of_readings(spark):
    local = series([1.0, np.nan, 3.0])
    plan = clean.interpolate_gaps(frame_of(spark, local), ["x"])._jdf.queryExecution().optimizedPlan().toString()
    over_rows = [line for line in plan.splitlines() if "Window [row_number" in line]
    assert over_rows and all("_block" in line for line in over_rows)


RAW = "household_id long, reading_id long, Date string, Time string, " + ", ".join(
    f"{c} string" for c in fixed.MEASURES
)


def test_typing_and_validity(spark):
    rows = [
        (1, 0, "16/12/2006", "17:24:00", "4.216", "0.418", "234.84", "18.4", "0", "1", "17"),
        (1, 1, "6/2/2007", "17:25:00", "?", "?", "?", "?", "?", "?", "?"),
        (1, 2, "bad", "17:25:00", "1.0", "0", "230", "1", "0", "0", "0"),
        (1, 3, "6/2/2007", "00:00:30", "-1.0", "0", "230", "1", "0", "0", "0"),
        (1, 4, "6/2/2007", "00:01:00", "2.0", "x", "230", "1", "", "?", "0"),
    ]
    typed = clean.typed_readings(spark.createDataFrame(rows, RAW))
    assert typed.first().timestamp.isoformat() == "2006-12-16T17:24:00"
    assert typed.filter("timestamp is null").count() == 1
    valid = clean.valid_readings(typed).orderBy("reading_id").collect()
    assert [r.reading_id for r in valid] == [0, 4]
    assert (valid[1].Sub_metering_1, valid[1].Global_reactive_power) == (0.0, None)
    profile = {r.measure: r for r in clean.missing_profile(typed).collect()}
    assert profile["Global_active_power"].missing == 1
    assert profile["Sub_metering_1"].missing == 2
    assert profile["Voltage"].overall_missing_pct == pytest.approx(100 * 10 / 35)


def readings(spark, minutes):
    return spark.range(minutes).select(
        F.lit(1).alias("household_id"),
        (F.lit("2024-01-01 00:00").cast("timestamp_ntz") + F.make_interval(mins=F.col("id").cast("int"))).alias("timestamp"),
        *[F.lit(3.0).alias(c) for c in fixed.MEASURES],
    )


def test_hourly_energy_needs_thirty_readings(spark):
    hours = rollup.hourly_energy(readings(spark, 60 + 30 + 0)).collect()
    assert sorted(r.energy_kwh for r in hours) == [1.5, 3.0]
    assert rollup.hourly_energy(readings(spark, 60 + 29)).count() == 1


def test_daily_energy_drops_days_without_averages(spark):
    frame = readings(spark, 1441)
    late = F.col("timestamp") >= F.lit("2024-01-02").cast("timestamp_ntz")
    frame = frame.withColumns({c: F.when(~late, F.col(c)) for c in fixed.MEASURES})
    days = rollup.daily_energy(frame).collect()
    assert [r.energy_kwh for r in days] == [72.0]


def test_positive_days_and_energy_series(spark):
    frame = spark.createDataFrame(
        [("2020-01-01", "5"), ("2020-01-02", "0"), (None, "4"), ("2020-01-03", "x")],
        "date string, energy_kwh string",
    )
    numbers = clean.energy_series(frame.withColumn("date", F.to_date("date")))
    assert numbers.count() == 3
    assert clean.positive_days(numbers).count() == 1
