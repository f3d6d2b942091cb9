import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.functions.calendar import season_code, shift_dates
from meterspan.operators import features, forecast, quality


def irregular_days(n=1300, seed=3, household=1):
    """A series with missing days, so that records and days differ."""
    rng = np.random.default_rng(seed)
    steps = rng.choice([1, 1, 1, 2, 4], size=n)
    dates = pd.Timestamp("2020-01-01") + pd.to_timedelta(np.cumsum(steps), unit="D")
    return pd.DataFrame(
        {"household_id": household, "date": dates.date, "energy_kwh": rng.gamma(4.0, 6.0, n)}
    )


def expected(series):
    """The 17 series features by pandas, from values strictly before each row."""
    before = series.shift(1)
    out = {f"lag_{n}": series.shift(n) for n in fixed.LAGS}
    for n in fixed.ROLLING_WINDOWS:
        out[f"rolling_mean_{n}"] = before.rolling(n).mean()
        out[f"rolling_std_{n}"] = before.rolling(n).std()
    for n in fixed.EWM_SPANS:
        out[f"ewm_{n}"] = before.ewm(span=n).mean()
    return pd.DataFrame(out)


@pytest.fixture(scope="module")
def days(spark):
    frames = [irregular_days(seed=3, household=1), irregular_days(700, 4, 2)]
    return pd.concat(frames), spark.createDataFrame(pd.concat(frames))


def test_features_match_pandas(days):
    local, frame = days
    got = features.daily_features(frame).toPandas().sort_values(["household_id", "date"])
    for home, part in local.groupby("household_id"):
        want = expected(part["energy_kwh"].reset_index(drop=True))
        mine = got[got.household_id == home].reset_index(drop=True)
        for column in want:
            np.testing.assert_allclose(
                mine[column].to_numpy(dtype=float), want[column].to_numpy(), rtol=0, atol=1e-9
            )


def test_calendar_matches_pandas(days):
    _, frame = days
    got = features.daily_features(frame).toPandas()
    index = pd.DatetimeIndex(got["date"])
    assert (got["day_of_week"] == index.dayofweek).all()
    assert (got["week_of_year"] == index.isocalendar().week.to_numpy()).all()
    assert (got["day_of_year"] == index.dayofyear).all()
    assert (got["is_weekend"] == (index.dayofweek >= 5)).all()
    assert (got["season"] == (index.month % 12) // 3).all()


def test_seasons(spark):
    months = spark.range(1, 13).select("id", season_code(F.col("id")).alias("s")).collect()
    assert [s for _, s in sorted(months)] == [0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 0]


def test_first_thirty_rows_are_incomplete(days):
    local, frame = days
    complete = features.complete_features(frame)
    assert complete.count() == len(local) - 2 * 30
    assert features.feature_contract(complete).count() == 0
    assert features.feature_contract(features.daily_features(frame)).count() == 60


def test_contract_refuses_other_columns(days):
    _, frame = days
    with pytest.raises(ValueError):
        features.feature_contract(features.daily_features(frame).drop("ewm_30"))


def test_spans_too_far_apart(days):
    _, frame = days
    with pytest.raises(ValueError):
        features.add_ewm_state(frame, spans=[2, 4000])


def test_target_row_equals_table_row(days):
    local, frame = days
    last = local.groupby("household_id")["date"].max()
    table = features.daily_features(frame)
    ends = frame.groupBy("household_id").agg(F.max("date").alias("target_date"))
    history = frame.join(ends, "household_id").filter("date < target_date").drop("target_date")
    row = features.target_features(history, ends)
    deltas = quality.parity(table, row, fixed.DAILY_FEATURES).collect()
    assert {r.rows for r in deltas} == {len(last)}
    assert max(r.max_abs_delta for r in deltas) <= 1e-9


def test_splits(spark):
    dates = pd.date_range("2020-01-01", periods=1403)
    frame = spark.createDataFrame(
        pd.DataFrame({"household_id": 1, "date": dates.date, "energy_kwh": 1.0})
    )
    parts = features.split_summary(features.chronological_split(frame)).collect()
    sizes = {r.split: r.rows for r in parts}
    assert sizes == {"training": 982, "validation": 210, "test": 211}
    spans = {r.split: (r.start_date, r.end_date) for r in parts}
    assert spans["training"][1] < spans["validation"][0] and spans["validation"][1] < spans["test"][0]


def test_date_split_falls_back_to_random(spark):
    frame = spark.range(100).withColumn("datetime", F.lit("2020-01-01").cast("timestamp_ntz"))
    left, right = features.date_split(frame, "2021-01-01")
    assert left.count() + right.count() == 100
    assert 60 < left.count() < 95


def test_hourly_lags_by_year_and_through(spark):
    hours = spark.range(24 * 10).select(
        F.lit(1).alias("household_id"),
        (F.lit("2019-12-28").cast("timestamp_ntz") + F.make_interval(hours=F.col("id").cast("int"))).alias("datetime"),
        F.col("id").cast("double").alias("energy_kwh"),
    )
    by_year = features.hourly_features(hours)
    assert by_year.count() == (96 - 25) + (144 - 25)
    through = features.hourly_features(hours, by_year=False)
    assert through.count() == 240 - 25
    row = through.filter("energy_kwh = 100").first()
    assert (row.lag_1h, row.lag_24h, row.target_next_hour_kwh) == (99.0, 76.0, 101.0)
    assert row.rolling_avg_3h == 99.0


def test_shift_keeps_month_and_turns_weekday(days):
    _, frame = days
    stored = features.daily_features(frame)
    moved = shift_dates(stored, ["date"])
    names = ["household_id", "date", "energy_kwh", *fixed.CALENDAR_FEATURES]
    report = quality.shift_report(stored.select(*names), moved.select(*names)).collect()
    for r in report:
        assert r.rows_before == r.rows_after
        assert (r.measures_changed, r.month_day_changed, r.calendar_stale) == (0, 0, 0)
        assert (r.weekday_delta_min, r.weekday_delta_max) == (6, 6)
    stale = stored.withColumn("date", F.date_add("date", fixed.DATE_SHIFT_DAYS))
    found = quality.shift_report(stored.select(*names), stale.select(*names)).first()
    assert found.calendar_stale > 0


def test_second_shift_is_refused(spark):
    frame = spark.createDataFrame([(datetime.date(2006, 12, 16),)], "date date")
    assert quality.already_shifted({"daily": frame}).count() == 0
    assert quality.already_shifted({"daily": shift_dates(frame, ["date"])}).first().table == "daily"


# --- forecast requests ---------------------------------------------------------


def request(spark, rows):
    return spark.createDataFrame(
        rows, "request_id int, household_id long, consumption array<double>, start_date date, horizon_days int"
    )


class Stub:
    """Predicts the previous value plus half the long weighted mean."""

    def transform(self, df):
        from pyspark.ml.functions import vector_to_array

        a = vector_to_array("features")
        names = fixed.DAILY_FEATURES
        return df.withColumn(
            "random_forest_kwh", a[names.index("lag_1")] + a[names.index("ewm_30")] / 2 - 10
        )


def test_roll_forward_matches_stepwise_features(spark, days):
    """Each step again by pandas: recorded days before the target, the last 30
    replaced by the sliding context."""
    local, frame = days
    home = local[local.household_id == 1].reset_index(drop=True)
    start = home["date"][600]
    context = [float(x) for x in np.linspace(5, 60, 30)]
    planned = forecast.plan_requests(request(spark, [(7, 1, context, start, 12)]), frame)
    got = forecast.roll_forward(planned, Stub(), 4.0).orderBy("step").collect()

    window, wanted = list(context), []
    for step in range(12):
        target = start + datetime.timedelta(days=step)
        prior = home.loc[home["date"] < target, "energy_kwh"].to_numpy().copy()
        prior[-30:] = window[-30:]
        row = expected(pd.Series([*prior, np.nan])).iloc[-1]
        wanted.append(max(0.0, row["lag_1"] + row["ewm_30"] / 2 - 10))
        window.append(wanted[-1])
    np.testing.assert_allclose([r.predicted_kwh for r in got], wanted, rtol=1e-9)
    assert got[0].lower_kwh == pytest.approx(max(0.0, wanted[0] - 4.0))
    totals = forecast.horizon_totals(spark.createDataFrame(got)).first()
    assert totals.total_predicted_kwh == pytest.approx(sum(round(x, 3) for x in wanted))
    assert totals.horizon_days == 12


def test_requests_are_refused_with_a_reason(spark, days):
    local, frame = days
    home = local[local.household_id == 1].reset_index(drop=True)
    good, day = [1.0] * 30, home["date"][200]
    rows = [
        (1, 1, good, day, 1),
        (2, 1, good[:29], day, 1),
        (3, 1, [-1.0, *good[:29]], day, 1),
        (4, 1, [float("nan"), *good[:29]], day, 1),
        (5, 1, good, home["date"][10], 1),
        (6, 1, good, home["date"][0] - datetime.timedelta(days=1), 1),
        (7, 1, good, home["date"].iloc[-1], 3),
        (8, 1, good, day, 31),
        (9, 99, good, day, 1),
    ]
    planned = forecast.plan_requests(request(spark, rows), frame).collect()
    reason = {r.request_id: r.reject_reason or "" for r in planned}
    assert reason[1] == ""
    for key, part in {
        2: "Exactly 30",
        3: "negative",
        4: "finite",
        5: "Not enough history",
        6: "before the start",
        7: "after the end",
        8: "Horizon",
        9: "No recorded days",
    }.items():
        assert part in reason[key], key


def test_long_steps_refuse_later_requests(spark):
    early = pd.date_range("2020-01-01", periods=40)
    late = pd.date_range(early[-1] + pd.Timedelta(days=7), periods=40)
    frame = spark.createDataFrame(
        pd.DataFrame({"household_id": 1, "date": [*early.date, *late.date], "energy_kwh": 2.0})
    )
    good = [1.0] * 30
    rows = [
        (1, 1, good, early[35].date(), 1),
        (2, 1, good, late[35].date(), 1),
        (3, 1, good, late[0].date(), 1),
    ]
    planned = forecast.plan_requests(request(spark, rows), frame).collect()
    reason = {r.request_id: r.reject_reason or "" for r in planned}
    assert reason[1] == ""
    assert "step longer" in reason[2]
    assert "ends more than" in reason[3]
    assert features.history_gaps(frame).first().gap_days == 7
