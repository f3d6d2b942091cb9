"""Statistics, bills, incidents and what-if rules on small tables."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterspan import fixed, schemas
from meterspan.functions import arrays
from meterspan.functions.scalars import (
    clamp,
    co2_kg,
    fixed_decimals,
    percent_change,
    round_half_up,
    round_half_up_or_zero,
    share_of_max,
    text_or,
    zero_pad,
)
from meterspan.operators import anomalies, billing, quality, state, stats, whatif
from meterspan.operators.quantiles import exact_quantiles
from meterspan.sources import readers


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def number(x):
    return F.lit(x).cast("double")


@pytest.mark.parametrize(
    "value, places, wanted",
    [
        (590.625, 2, 590.63),
        (3178.125, 2, 3178.13),
        (0.125, 2, 0.13),
        (1.005, 2, 1.01),
        (1.23456, 3, 1.235),
        (-590.625, 2, -590.63),
    ],
)
def test_half_up(spark, value, places, wanted):
    assert one(spark, x=round_half_up(number(value), places)).x == wanted


def test_scalars(spark):
    row = one(
        spark,
        zero=round_half_up_or_zero(number(float("nan"))),
        change=percent_change(number(15.0), number(10.0)),
        none=percent_change(number(15.0), number(0.0)),
        cut=clamp(number(30.0), 0.0, 24.0),
        co2=co2_kg(number(10.0), F.lit(None).cast("double")),
        share=share_of_max(number(5.0), number(4.0)),
        text=fixed_decimals(number(2.5), 3),
        padded=zero_pad(F.lit(7)),
        name=text_or(F.lit("  abc "), F.lit("d"), 2),
        blank=text_or(F.lit(" \t\n"), F.lit("d")),
    )
    assert row.asDict() == {
        "zero": 0.0,
        "change": 50.0,
        "none": 0.0,
        "cut": 24.0,
        "co2": 7.9,
        "share": 1.0,
        "text": "2.500",
        "padded": "07",
        "name": "ab",
        "blank": "d",
    }


BILLS = [
    # daily, tariff, days, fixed, consumption, charge, total
    (22.6419, 8.5, 1, 0.0, 22.642, 192.46, 192.46),
    (22.6419, 8.5, 30, 0.0, 679.257, 5773.68, 5773.68),
    (22.6419, 8.5, 30, 150.0, 679.257, 5773.68, 5923.68),
    (12.5, 8.475, 30, 0.0, 375.0, 3178.13, 3178.13),
    (0.593776, 11.1234, 30, 0.0, 17.813, 198.14, 198.14),
]


def test_bills(spark):
    rows = [(i, *b[:4]) for i, b in enumerate(BILLS)]
    layout = "id int, daily_kwh double, tariff_per_kwh double, days int, fixed_charge_per_period double"
    bills = billing.compute_bills(billing.check_bills(spark.createDataFrame(rows, layout)))
    for r in bills.collect():
        assert (r.consumption_kwh, r.energy_charge, r.estimated_bill) == BILLS[r.id][4:]


def test_bill_rejects(spark):
    nan = float("nan")
    rows = [
        (0, 0.0, 8.0, 30.0, 0.0),
        (1, 5.0, 0.0, 30.0, 0.0),
        (2, 5.0, 8.0, 0.0, 0.0),
        (3, 5.0, 8.0, 366.0, 0.0),
        (4, 5.0, 8.0, 1.5, 0.0),
        (5, 5.0, 8.0, 30.0, -1.0),
        (6, nan, 8.0, 30.0, 0.0),
        (7, None, 8.0, None, None),
        (8, 5.0, 8.0, None, None),
    ]
    layout = "id int, daily_kwh double, tariff_per_kwh double, days double, fixed_charge_per_period double"
    checked = billing.check_bills(spark.createDataFrame(rows, layout))
    kinds = {text: key for key, text in fixed.BILL_REASONS.items()}
    found = {r.id: kinds[r.reject_reason] for r in billing.rejected_bills(checked).collect()}
    assert found == {
        0: "daily",
        1: "tariff",
        2: "days",
        3: "days",
        4: "days",
        5: "fixed",
        6: "daily",
        7: "daily",
    }
    bill = billing.compute_bills(checked).first()
    assert (bill.id, bill.period_days, bill.estimated_bill) == (8, 30, 1200.0)


def test_default_appliances_at_the_default_tariff(spark):
    items = spark.createDataFrame([], "household_id long, position int, item variant")
    homes = spark.createDataFrame([(1, 8.0, 0.79)], "household_id long, tariff double, carbon_intensity double")
    rows = whatif.repair_appliances(items, homes)
    totals = whatif.simulate_household(whatif.simulate_appliances(rows, homes)).first()
    # 360 + 144 + 18 + 15 + 120 + 108 + 27 and 270 + 144 + 12.6 + 10 + 72 + 81 + 20.25 kWh
    assert totals.current_kwh == pytest.approx(792.0)
    assert totals.proposed_kwh == pytest.approx(609.85)
    assert totals.saved_cost == pytest.approx(182.15 * 8)
    assert totals.reduction_pct == pytest.approx(182.15 / 792 * 100)
    assert totals.co2_saved_kg == pytest.approx(182.15 * 0.79)


def incident(energy, mean, std, score, day=1):
    return (1, datetime.date(2024, 1, day), energy, mean, std, score)


def test_incident_rules(spark):
    rows = [
        incident(60.0, 10.0, 5.0, -0.2, 1),
        incident(14.0, 10.0, 5.0, -0.02, 2),
        incident(5.0, 10.0, 0.0, -0.2, 3),
        incident(8.0, 10.0, 2.0, -0.2, 4),
        incident(16.0, 10.0, 2.0, -0.2, 5),
        incident(5.0, 0.0, 2.0, -0.2, 6),
    ]
    frame = spark.createDataFrame(rows, schemas.ANOMALIES)
    got = {r.date.day: r for r in anomalies.enrich_anomalies(frame).collect()}
    assert [got[i].severity for i in range(1, 7)] == ["CRITICAL", "CRITICAL", "LOW", "MEDIUM", "HIGH", "MEDIUM"]
    assert got[1].category == "Extreme Outlier" and got[2].category == "Base Load Drift"
    assert got[3].category == "Low Usage / Absence" and got[3].z_score == 0.0
    assert got[6].deviation_pct == 0.0
    assert got[1].headline == "Consumption ran 500% above the 7-day baseline"
    assert got[3].headline == "Consumption fell 50% below the 7-day baseline"
    assert got[1].cause.startswith(
        "60.0 kWh against a 7-day moving average of 10.0 kWh (+50.0 kWh, +10.0σ). Possible cause: "
    )
    ranked = anomalies.ranked_incidents(anomalies.enrich_anomalies(frame)).orderBy("position").collect()
    assert [r.date.day for r in ranked] == [1, 2, 5, 4, 6, 3]
    tariffs = spark.createDataFrame([(1, 2.0)], "household_id long, tariff double")
    summary = anomalies.anomaly_summary(anomalies.enrich_anomalies(frame), tariffs).first()
    assert (summary.total, summary.critical, summary.high, summary.medium, summary.low) == (6, 2, 1, 2, 1)
    assert summary.excess_kwh == 65.0 and summary.excess_cost == 130.0
    assert summary.most_severe_date.day == 1


def test_summary_statistics_match_pandas(spark):
    x = np.random.default_rng(1).gamma(3, 5, 500)
    dates = pd.date_range("2022-01-01", periods=500).date
    frame = spark.createDataFrame(pd.DataFrame({"household_id": 1, "date": dates, "energy_kwh": x}))
    row, s = stats.summary_statistics(frame).first(), pd.Series(x)
    wanted = {
        "mean": s.mean(),
        "median": s.median(),
        "std": s.std(),
        "variance": s.var(),
        "q25": s.quantile(0.25),
        "q75": s.quantile(0.75),
        "iqr": s.quantile(0.75) - s.quantile(0.25),
        "skewness": s.skew(),
        "kurtosis": s.kurtosis(),
    }
    for name, value in wanted.items():
        assert row[name] == pytest.approx(value, rel=1e-10), name


def test_window_summary_takes_the_first_day_on_ties(spark):
    days = [datetime.date(2024, 1, d) for d in range(1, 6)]
    rows = [(1, d, x) for d, x in zip(days, [3.0, 9.0, 9.0, 1.0, 1.0])]
    frame = spark.createDataFrame(rows, "household_id long, date date, energy_kwh double")
    row = stats.window_summary(frame).first()
    assert (row.peak_date.day, row.low_date.day) == (2, 4)
    single = stats.window_summary(frame.limit(1)).first()
    assert single.std_dev == 0.0


def test_statistics_blocks(spark):
    dates = pd.date_range("2023-06-05", periods=5).date
    local = pd.DataFrame({"household_id": 1, "date": dates, "energy_kwh": 2.0})
    for c in fixed.ROLLUP_COLUMNS[1:]:
        local[c] = 1000.0
    blocks = stats.dataset_statistics(spark.createDataFrame(local))
    week = {r.day_index: r for r in blocks["day_of_week_breakdown"].collect()}
    assert [week[i]["count"] for i in range(7)] == [1, 1, 1, 1, 1, 0, 0]
    assert week[6].mean_kwh == 0.0 and week[6].is_weekend
    split = blocks["submetering"].first()
    assert split.unmetered_kwh == 0.0 and split.sub_1_kwh == 5.0
    assert blocks["weekday_vs_weekend"].first().weekend_elevation_ratio is None


def test_histogram_of_equal_values(spark):
    frame = spark.createDataFrame([(1, 4.0)] * 3, "household_id long, x double")
    bins = stats.histogram(frame, "x", 4).orderBy("bin").collect()
    assert [b["count"] for b in bins] == [3, 0, 0, 0]
    assert bins[0]["to"] == 4.25


@pytest.mark.parametrize("kind", ["normal", "ties", "heavy"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, 30_000)
    if kind == "ties":
        x = np.round(x, 1)
    if kind == "heavy":
        x = np.where(rng.random(30_000) < 0.9, 1.0, np.exp(20 * np.abs(x)))
    group = rng.integers(0, 3, 30_000)
    group = np.where(group == 2, 0, group)
    frame = spark.createDataFrame(pd.DataFrame({"g": group, "x": x}))
    probs = [0.0, 0.02, 0.5, 0.753, 1.0]
    for r in exact_quantiles(frame, "x", probs, ["g"], accuracy=200).collect():
        wanted = np.quantile(x[group == r.g], probs)
        np.testing.assert_allclose([r[f"q{i}"] for i in range(5)], wanted, rtol=1e-12)
    whole = exact_quantiles(frame, "x", [0.5]).first()
    assert whole.q0 == pytest.approx(np.median(x), rel=1e-12)


def test_vectors(spark):
    row = one(spark, v=arrays.parse_vector(F.lit("1, 2;3\n4  x 5e1 Infinity 1d")))
    assert row.v == [1.0, 2.0, 3.0, 4.0, 50.0]
    values = F.array(*[number(x) for x in (1.0, 2.0, 4.0, 9.0)])
    row = one(
        spark,
        pushed=arrays.push(values, number(5.0), 3),
        std=arrays.tail_std(values, 3),
        mean=arrays.tail_mean(values, 2),
        kept=arrays.keep_in_range(F.array(number(-1.0), number(7.0), number(1e9))),
        **arrays.vector_stats(F.array().cast("array<double>")),
    )
    assert row.pushed == [4.0, 9.0, 5.0]
    assert row["std"] == pytest.approx(np.std([2, 4, 9], ddof=1)) and row["mean"] == 6.5
    assert row.kept == [7.0]
    assert (row.average, row["max"], row["min"], row.total) == (0.0, 0.0, 0.0, 0.0)


def test_presets(spark):
    items = spark.createDataFrame([], "household_id long, position int, item variant")
    homes = spark.createDataFrame([(1,)], "household_id long")
    rows = whatif.repair_appliances(items, homes)

    def hours(name):
        return {r.type: r.proposedDailyHours for r in whatif.apply_preset(rows, name).collect()}

    assert hours("ac")["ac"] == 6.0 and hours("ac")["tv"] == 3.5
    assert hours("efficient") == {
        "ac": 5.0,
        "fridge": 18.0,
        "tv": 3.0,
        "washing_machine": 0.8,
        "water_heater": 1.0,
        "fan": 8.0,
        "lights": 4.0,
    }
    assert hours("standby")["lights"] == 4.8 and hours("standby")["tv"] == 3.5
    assert hours("reset")["washing_machine"] == 1.5
    with pytest.raises(ValueError):
        whatif.apply_preset(rows, "other")


LISTS = [
    (1, '[{"id": "a", "powerWatts": 100}, {"id": "a", "powerWatts": 5}, 3, null, {"powerWatts": "60", "name": " x "}]'),
    (2, '[{"id": "b", "powerWatts": 0}, {"id": "b", "powerWatts": 7, "quantity": 0, "daysPerMonth": null}]'),
    (3, '{"id": "c"}'),
    (4, "not json"),
    (5, '[{"id": 5, "powerWatts": 9, "currentDailyHours": 25, "type": "  "}]'),
]


def test_stored_lists_are_repaired(spark):
    stored = spark.createDataFrame(LISTS, "household_id long, appliances_json string")
    items = readers.json_rows(stored, "appliances_json", ["household_id"])
    rows = whatif.repair_appliances(items, stored).orderBy("household_id", "position").collect()
    by_home = {}
    for r in rows:
        by_home.setdefault(r.household_id, []).append(r)
    assert [(r.id, r.powerWatts, r.name) for r in by_home[1]] == [
        ("a", 100.0, "Unnamed device"),
        ("a-restored-4", 60.0, "x"),
    ]
    assert [(r.position, r.id, r.quantity, r.daysPerMonth) for r in by_home[2]] == [(1, "b", 1.0, 30.0)]
    assert len(by_home[3]) == len(by_home[4]) == len(fixed.DEFAULT_APPLIANCES)
    assert (by_home[5][0].id, by_home[5][0].type, by_home[5][0].currentDailyHours) == (
        "a-restored-0",
        "generic",
        0.0,
    )


def test_stored_settings_are_repaired(spark):
    text = '{"userName": " Ann ", "electricityTariff": "7.5", "billingDays": null, "currency": 4, "notifications": {"bill": false, "weekly": 1}}'
    stored = spark.createDataFrame([(1, text), (2, None)], "household_id long, settings_json string")
    rows = {r.household_id: r for r in state.repair_settings(stored).collect()}
    assert (rows[1].userName, rows[1].electricityTariff, rows[1].billingDays, rows[1].currency) == (
        "Ann",
        7.5,
        0.0,
        "INR",
    )
    assert (rows[1].notifications.bill, rows[1].notifications.weekly) == (False, True)
    assert rows[2].electricityTariff == 8.0 and rows[2].userName == "Homeowner"


def test_drafts(spark):
    rows = [("Fan", "75", "1", "24", "31"), (" ", "x", "0", "25", "0"), (None, "0", "1", "", "1")]
    layout = "name string, powerWatts string, quantity string, currentDailyHours string, daysPerMonth string"
    found = [r.errors for r in whatif.draft_errors(spark.createDataFrame(rows, layout)).collect()]
    assert found[0] == []
    assert found[1] == ["name", "powerWatts", "quantity", "currentDailyHours", "daysPerMonth"]
    assert found[2] == ["name", "powerWatts"]


def test_upserts(spark):
    current = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "household_id long, name string, tariff double")
    patches = spark.createDataFrame(
        [(1, 1, "x", None), (1, 2, None, 5.0), (1, 3, "y", None), (9, 1, "z", 1.0)],
        "household_id long, seq int, name string, tariff double",
    )
    got = billing.upsert_settings(current, patches, ["name", "tariff"]).orderBy("household_id").collect()
    assert [tuple(r) for r in got] == [(1, "y", 5.0), (2, "b", 2.0)]
    whole = billing.replace_state(current, patches, ["name", "tariff"]).orderBy("household_id").collect()
    assert [tuple(r) for r in whole] == [(1, "y", None), (2, "b", 2.0), (9, "z", 1.0)]


def test_sets(spark):
    a, b = spark.range(4).toDF("x"), spark.range(2, 6).toDF("x")
    assert quality.set_difference(a, a).count() == 0
    sides = {(r.x, r.side) for r in quality.set_difference(a, b).collect()}
    assert sides == {(0, "left"), (1, "left"), (4, "right"), (5, "right")}
    assert quality.common_rows(a, spark.range(10, 12).toDF("x")).count() == 0
