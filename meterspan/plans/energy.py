"""Readings to hourly and daily energy, profiles and hourly features."""

from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.operators import clean, features, rollup
from meterspan.plans.registry import day, query, r, report, small, stamp, whole
from meterspan.sources import tables as t

SPLIT_DATE = "2024-01-24"


def hourly(spark, folder):
    return rollup.hourly_energy(clean.valid_readings(t.readings(spark, folder)), t.MIN_COUNT)


def hourly_features(spark, folder):
    return features.hourly_features(hourly(spark, folder))


def typed(spark, folder, one_series=False):
    return clean.typed_readings(t.raw_readings(spark, folder, one_series))


def daily_from_readings(spark, folder):
    return rollup.daily_energy(clean.interpolate_gaps(typed(spark, folder)))


def _interpolated(source, household):
    """Gap filling in SQL: neighbours by position, then one CASE."""
    limit = fixed.INTERPOLATION_LIMIT
    over = "PARTITION BY household_id ORDER BY i ROWS BETWEEN"
    return f"""{t.RAW}, seq AS (
  SELECT {household} AS household_id, * EXCLUDE (household_id),
    row_number() OVER (PARTITION BY {household} ORDER BY timestamp, reading_id) AS i FROM {source}
), near AS (
  SELECT *, CASE WHEN global_active_power IS NOT NULL THEN i END AS known FROM seq
), spots AS (
  SELECT *, max(known) OVER ({over} UNBOUNDED PRECEDING AND CURRENT ROW) AS p,
    min(known) OVER ({over} CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM near
), filled AS (
  SELECT s.* REPLACE (CASE
    WHEN s.global_active_power IS NOT NULL THEN s.global_active_power
    WHEN a.i IS NOT NULL AND b.i IS NOT NULL AND (s.i - a.i <= {limit} OR b.i - s.i <= {limit})
      THEN a.global_active_power + (b.global_active_power - a.global_active_power)
        * coalesce((epoch_us(s.timestamp) - epoch_us(a.timestamp))
          / nullif(CAST(epoch_us(b.timestamp) - epoch_us(a.timestamp) AS DOUBLE), 0), 0)
    WHEN b.i IS NULL AND s.i - a.i <= {limit} THEN a.global_active_power
    WHEN a.i IS NULL AND b.i - s.i <= {limit} THEN b.global_active_power END AS global_active_power)
  FROM spots s LEFT JOIN seq a ON a.household_id = s.household_id AND a.i = s.p
    LEFT JOIN seq b ON b.household_id = s.household_id AND b.i = s.n
)"""


@query(
    "hourly_energy",
    f"WITH {t.HOURLY} SELECT household_id, {stamp('datetime')}, {r(*fixed.ROLLUP_COLUMNS)} FROM hourly",
)
def hourly_energy(spark, folder):
    return report(hourly(spark, folder))


@query(
    "hour_profile",
    f"""WITH {t.HOURLY_FEATURES} SELECT household_id, {small('hour(datetime) AS hour')},
  {r('avg(energy_kwh) AS avg_kwh', 'min(energy_kwh) AS min_kwh', 'max(energy_kwh) AS max_kwh')},
  count(*) AS hour_count FROM hourly_features GROUP BY household_id, hour(datetime)""",
)
def hour_profile(spark, folder):
    return report(rollup.hour_profile(hourly_features(spark, folder)))


@query(
    "daily_energy",
    f"""WITH {_interpolated('raw', 'household_id')}, days AS (
  SELECT household_id, CAST(timestamp AS DATE) AS date,
    coalesce(sum(global_active_power), 0) / 60.0 AS energy_kwh, avg(voltage) AS avg_voltage,
    avg(global_intensity) AS avg_intensity, avg(global_reactive_power) AS avg_reactive_power,
    sum(sub_metering_1) AS sub_metering_1, sum(sub_metering_2) AS sub_metering_2,
    sum(sub_metering_3) AS sub_metering_3
  FROM filled GROUP BY 1, 2
) SELECT household_id, {day('date')}, {r(*fixed.ROLLUP_COLUMNS)} FROM days""",
)
def daily_energy(spark, folder):
    return report(daily_from_readings(spark, folder))


@query(
    "daily_from_hourly",
    f"""WITH {t.HOURLY_FEATURES} SELECT household_id, {day('CAST(datetime AS DATE)', 'date')},
  {r('sum(energy_kwh) AS daily_total_kwh', 'avg(energy_kwh) AS daily_avg_kwh')}
  FROM hourly_features GROUP BY household_id, CAST(datetime AS DATE)""",
)
def daily_from_hourly(spark, folder):
    return report(rollup.daily_from_hourly(hourly_features(spark, folder)))


@query(
    "monthly_energy",
    f"""WITH {t.HOURLY_FEATURES} SELECT household_id, {small('year', 'month')},
  {r('sum(energy_kwh) AS monthly_total_kwh', 'avg(energy_kwh) AS monthly_avg_kwh')},
  count(*) AS hours_count, printf('%d-%02d', CAST(year AS INTEGER), CAST(month AS INTEGER)) AS yr_mo
  FROM hourly_features GROUP BY household_id, year, month""",
)
def monthly_energy(spark, folder):
    return report(rollup.monthly_energy(hourly_features(spark, folder)))


@query(
    "seasonal_energy",
    f"""WITH {t.HOURLY_FEATURES} SELECT household_id, season,
  {r('sum(energy_kwh) AS season_total_kwh', 'avg(energy_kwh) AS season_avg_kwh')}
  FROM hourly_features GROUP BY household_id, season ORDER BY season_total_kwh DESC""",
)
def seasonal_energy(spark, folder):
    seasons = rollup.seasonal_energy(hourly_features(spark, folder))
    return report(seasons.orderBy(F.col("season_total_kwh").desc()))


@query(
    "weekday_weekend",
    f"""WITH {t.HOURLY_FEATURES} SELECT household_id, {small('is_weekend')},
  {r('avg(energy_kwh) AS avg_kwh', 'sum(energy_kwh) AS total_kwh')}, count(*) AS hours_count,
  CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type
  FROM hourly_features GROUP BY household_id, is_weekend""",
)
def weekday_weekend(spark, folder):
    return report(rollup.weekday_weekend(hourly_features(spark, folder)))


_CLEAN = ", ".join(c.lower() for c in fixed.MEASURES)


@query(
    "clean_readings",
    f"""WITH {t.RAW} SELECT household_id, reading_id, {stamp('timestamp')},
  {r(*[c.lower() for c in fixed.MEASURES])} FROM raw WHERE global_active_power >= 0""",
)
def clean_readings(spark, folder):
    valid = clean.valid_readings(typed(spark, folder))
    return report(valid.toDF(*[c.lower() for c in valid.columns]))


@query(
    "missing_profile",
    f"""WITH {t.RAW}, totals AS (
  SELECT count(*) AS n, {', '.join(f"count(*) - count({c.lower()}) AS {c.lower()}" for c in fixed.MEASURES)}
  FROM raw
), long AS ({' UNION ALL '.join(
    f"SELECT '{c}' AS measure, {c.lower()} AS missing, n, "
    f"100.0 * ({' + '.join(m.lower() for m in fixed.MEASURES)}) / (n * {len(fixed.MEASURES)}) AS pct FROM totals"
    for c in fixed.MEASURES)})
SELECT measure, {whole('missing', 'n AS rows')}, {r('pct AS overall_missing_pct')} FROM long""",
)
def missing_profile(spark, folder):
    return report(clean.missing_profile(typed(spark, folder)))


@query(
    "interpolated_readings",
    f"""WITH {_interpolated('raw', 'CAST(0 AS BIGINT)')}
SELECT reading_id, {stamp('timestamp')}, {r('global_active_power')} FROM filled""",
)
def interpolated_readings(spark, folder):
    filled = clean.interpolate_gaps(typed(spark, folder, one_series=True))
    return report(
        filled.select("reading_id", "timestamp", F.col("Global_active_power").alias("global_active_power"))
    )


_HOURLY_INTS = ["year", "month", "day", "hour", "day_of_week", "quarter", "is_weekend"]
_HOURLY_REALS = [
    *fixed.ROLLUP_COLUMNS,
    "lag_1h",
    "lag_24h",
    "rolling_avg_3h",
    "rolling_avg_24h",
    "target_next_hour_kwh",
]


@query(
    "hourly_features",
    f"""WITH {t.HOURLY_FEATURES} SELECT household_id, {stamp('datetime')}, season,
  {small(*_HOURLY_INTS)}, {r(*_HOURLY_REALS)} FROM hourly_features""",
)
def hourly_feature_table(spark, folder):
    return report(hourly_features(spark, folder))


@query(
    "date_split",
    f"""WITH {t.HOURLY_FEATURES} SELECT household_id,
  CASE WHEN datetime < TIMESTAMP '{SPLIT_DATE}' THEN 'train' ELSE 'test' END AS side,
  count(*) AS rows, {stamp('min(datetime)', 'first')}, {stamp('max(datetime)', 'last')}
  FROM hourly_features GROUP BY 1, 2""",
)
def date_split(spark, folder):
    train, test = features.date_split(hourly_features(spark, folder), SPLIT_DATE)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return report(rollup.table_range(both, "datetime", ["household_id", "side"]))


@query(
    "reading_range",
    f"""WITH {t.RAW} SELECT household_id, count(*) AS rows, {stamp('min(timestamp)', 'first')},
  {stamp('max(timestamp)', 'last')} FROM raw WHERE global_active_power >= 0 GROUP BY household_id""",
)
def reading_range(spark, folder):
    valid = clean.valid_readings(typed(spark, folder))
    return report(rollup.table_range(valid, "timestamp"))


@query(
    "stage_rows",
    f"""WITH {t.RAW}, valid AS (SELECT * FROM raw WHERE global_active_power >= 0), hourly AS (
  SELECT household_id, date_trunc('hour', timestamp) AS datetime, year(min(timestamp)) AS year FROM valid
  GROUP BY 1, 2 HAVING count(*) >= {t.MIN_COUNT}
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY household_id, year ORDER BY datetime) AS i,
    count(*) OVER (PARTITION BY household_id, year) AS n FROM hourly
)
SELECT CAST(1 AS INTEGER) AS position, 'raw' AS stage, count(*) AS rows FROM raw
UNION ALL SELECT CAST(2 AS INTEGER), 'valid', count(*) FROM valid
UNION ALL SELECT CAST(3 AS INTEGER), 'hourly', count(*) FROM hourly
UNION ALL SELECT CAST(4 AS INTEGER), 'features', count(*) FROM ranked WHERE i > 24 AND i < n""",
)
def stage_rows(spark, folder):
    raw = typed(spark, folder)
    valid = clean.valid_readings(raw)
    hours = rollup.hourly_energy(valid, t.MIN_COUNT)
    stages = [("raw", raw), ("valid", valid), ("hourly", hours), ("features", features.hourly_features(hours))]
    return rollup.stage_rows(stages)
