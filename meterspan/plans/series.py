"""Daily features, splits and date checks."""

from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.functions.calendar import daily_calendar, shift_dates
from meterspan.operators import features, quality, stats
from meterspan.plans.registry import day, query, r, report, small, whole
from meterspan.sources import tables as t

FEATURES = t.features_sql()
PLAIN = t.features_sql(ewm=False)
_INTS = fixed.CALENDAR_FEATURES
_REALS = fixed.LAG_FEATURES + fixed.ROLLING_MEAN_FEATURES + fixed.ROLLING_STD_FEATURES + fixed.EWM_FEATURES
_COMPLETE = f"{FEATURES}, complete AS (SELECT * FROM features WHERE lag_30 IS NOT NULL)"
_SPLIT = f"""{PLAIN}, complete AS (SELECT * FROM features WHERE lag_30 IS NOT NULL), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY date) AS i,
    count(*) OVER (PARTITION BY household_id) AS n FROM complete
), split AS (
  SELECT *, CASE WHEN i <= floor(n * CAST(0.70 AS DOUBLE)) THEN 'training'
    WHEN i <= floor(n * CAST(0.85 AS DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM ranked
)"""


def feature_table(spark, folder, households=4):
    return features.daily_features(t.daily(spark, folder, households))


def split_table(spark, folder, households=4):
    return features.chronological_split(features.complete_features(t.daily(spark, folder, households)))


@query(
    "calendar_features",
    f"WITH {PLAIN} SELECT household_id, {day('date')}, {small(*_INTS)} FROM features",
)
def calendar_features(spark, folder):
    dates = t.daily(spark, folder).select("household_id", "date")
    return report(dates.withColumns(daily_calendar(F.col("date"))))


@query(
    "lag_features",
    f"WITH {PLAIN} SELECT household_id, {day('date')}, {r(*fixed.LAG_FEATURES)} FROM features",
)
def lag_features(spark, folder):
    window = features.series_window()
    lagged = t.daily(spark, folder).withColumns(features.lag_columns(window))
    return report(lagged.select("household_id", "date", *fixed.LAG_FEATURES))


_ROLLING = fixed.ROLLING_MEAN_FEATURES + fixed.ROLLING_STD_FEATURES


@query(
    "rolling_features",
    f"WITH {PLAIN} SELECT household_id, {day('date')}, {r(*_ROLLING)} FROM features",
)
def rolling_features(spark, folder):
    window = features.series_window()
    rolled = t.daily(spark, folder).withColumns(features.rolling_columns(window))
    return report(rolled.select("household_id", "date", *_ROLLING))


@query(
    "ewm_features",
    f"WITH {FEATURES} SELECT household_id, {day('date')}, {r(*fixed.EWM_FEATURES)} FROM features",
)
def ewm_features(spark, folder):
    state = features.add_ewm_state(t.daily(spark, folder))
    return report(
        state.withColumns(features.ewm_columns(features.series_window())).select(
            "household_id", "date", *fixed.EWM_FEATURES
        )
    )


@query(
    "daily_feature_table",
    f"""WITH {_COMPLETE} SELECT household_id, {day('date')}, {r(*fixed.ROLLUP_COLUMNS, digits=4)},
  {small(*_INTS)}, {r(*_REALS, digits=4)} FROM complete""",
)
def daily_feature_table(spark, folder):
    return report(features.complete_features(t.daily(spark, folder)), 4)


@query(
    "aligned_features",
    f"""WITH {PLAIN} SELECT household_id, {day('date')}, {r('avg_voltage', 'avg_intensity', digits=4)},
  {r('lag_1', 'rolling_mean_7')} FROM features WHERE rolling_mean_7 IS NOT NULL""",
)
def aligned_features(spark, folder):
    """Measures joined to separately computed features on household and date."""
    daily = t.daily(spark, folder)
    window = features.series_window()
    computed = daily.select(
        "household_id",
        "date",
        features.lag_columns(window, lags=[1])["lag_1"].alias("lag_1"),
        features.rolling_columns(window, widths=[7])["rolling_mean_7"].alias("rolling_mean_7"),
    ).na.drop()
    measures = daily.select("household_id", "date", "avg_voltage", "avg_intensity")
    joined = measures.join(computed, ["household_id", "date"])
    return report(joined.withColumns({c: F.round(c, 4) for c in ("avg_voltage", "avg_intensity")}))


@query(
    "target_feature_row",
    f"""WITH base AS (SELECT 1), {FEATURES.replace(
    'numbered AS (', "extended AS (SELECT * FROM daily UNION ALL SELECT household_id, "
    "max(date) + 1, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM daily GROUP BY household_id), numbered AS (", 1
    ).replace('AS rn FROM daily', 'AS rn FROM extended')}
SELECT household_id, {day('date')}, {small(*_INTS)}, {r(*_REALS)} FROM features WHERE energy_kwh IS NULL""",
)
def target_feature_row(spark, folder):
    daily = t.daily(spark, folder)
    last = daily.groupBy("household_id").agg(F.date_add(F.max("date"), 1).alias("target_date"))
    return report(features.target_features(daily, last))


@query(
    "feature_contract",
    f"""WITH {PLAIN} SELECT CASE WHEN lag_1 IS NULL THEN 'lag_1' WHEN lag_2 IS NULL THEN 'lag_2'
  WHEN lag_3 IS NULL THEN 'lag_3' WHEN lag_7 IS NULL THEN 'lag_7' WHEN lag_14 IS NULL THEN 'lag_14'
  WHEN lag_21 IS NULL THEN 'lag_21' ELSE 'lag_30' END AS bad_column, count(*) AS rows
FROM features WHERE lag_30 IS NULL GROUP BY 1""",
)
def feature_contract(spark, folder):
    bad = features.feature_contract(feature_table(spark, folder))
    return bad.groupBy("bad_column").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "chrono_split",
    f"WITH {_SPLIT} SELECT household_id, {day('date')}, split, {r('energy_kwh')} FROM split",
)
def chrono_split(spark, folder):
    return report(split_table(spark, folder).select("household_id", "date", "split", "energy_kwh"))


@query(
    "split_boundaries",
    f"""WITH {_SPLIT} SELECT household_id, split, count(*) AS rows, {day('min(date)', 'start_date')},
  {day('max(date)', 'end_date')} FROM split GROUP BY household_id, split""",
)
def split_boundaries(spark, folder):
    return report(features.split_summary(split_table(spark, folder)))


@query(
    "gap_report",
    f"""WITH {t.DAILY}, steps AS (
  SELECT household_id, date, lag(date) OVER (PARTITION BY household_id ORDER BY date) AS previous_date FROM daily
) SELECT household_id, {day('date')}, {day('previous_date')}, {small("date_diff('day', previous_date, date) AS gap_days")}
FROM steps WHERE date_diff('day', previous_date, date) > {fixed.MAX_GAP_DAYS}""",
)
def gap_report(spark, folder):
    return report(features.history_gaps(t.daily(spark, folder)))


@query(
    "uniqueness_check",
    f"""WITH {t.DAILY} SELECT household_id, count(*) AS rows, count(DISTINCT date) AS distinct_dates,
  {whole('count(*) - count(DISTINCT date) AS repeated_dates')} FROM daily GROUP BY household_id""",
)
def uniqueness_check(spark, folder):
    return stats.series_uniqueness(t.daily(spark, folder))


@query(
    "order_check",
    """WITH seq AS (
  SELECT o_custkey % 4 AS household_id, CAST(o_orderdate AS DATE) AS date, o_orderkey AS position FROM orders
), steps AS (
  SELECT *, lag(date) OVER (PARTITION BY household_id ORDER BY position) AS previous FROM seq
) SELECT household_id, count(*) AS rows, count(*) FILTER (WHERE date < previous) AS out_of_order,
  count(*) FILTER (WHERE date = previous) AS repeated FROM steps GROUP BY household_id""",
)
def order_check(spark, folder):
    stored = t.table(spark, folder, "orders").select(
        (F.col("o_custkey") % 4).alias("household_id"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderkey").alias("position"),
    )
    return quality.series_check(stored, rows_per_block=1000)


_SHIFTED = f"{t.DAILY}, shifted AS (SELECT * REPLACE (date + {fixed.DATE_SHIFT_DAYS} AS date) FROM daily)"


@query(
    "date_shift",
    f"""WITH {PLAIN.replace('numbered AS (', f'''moved AS (
  SELECT * REPLACE (date + {fixed.DATE_SHIFT_DAYS} AS date) FROM daily), numbered AS (''', 1)
  .replace('AS rn FROM daily', 'AS rn FROM moved')}
SELECT household_id, {day('date')}, {r('energy_kwh')}, {small(*_INTS)} FROM features""",
)
def date_shift(spark, folder):
    stored = t.daily(spark, folder).select("household_id", "date", "energy_kwh")
    moved = shift_dates(stored.withColumns(daily_calendar(F.col("date"))), ["date"])
    return report(moved)


@query(
    "shift_checks",
    f"""WITH {_SHIFTED}, pairs AS (
  SELECT d.household_id, d.date AS old_date, s.date AS date, d.energy_kwh AS old_kwh, s.energy_kwh
  FROM daily d JOIN shifted s ON d.household_id = s.household_id AND s.date = d.date + {fixed.DATE_SHIFT_DAYS}
) SELECT household_id, count(*) AS rows_before, count(*) AS rows_after,
  count(*) FILTER (WHERE old_kwh <> energy_kwh) AS measures_changed,
  count(*) FILTER (WHERE month(date) <> month(old_date) OR day(date) <> day(old_date)) AS month_day_changed,
  CAST(0 AS BIGINT) AS calendar_stale,
  {small('min((isodow(date) - isodow(old_date) + 7) % 7) AS weekday_delta_min',
         'max((isodow(date) - isodow(old_date) + 7) % 7) AS weekday_delta_max')}
FROM pairs GROUP BY household_id""",
)
def shift_checks(spark, folder):
    daily = t.daily(spark, folder)
    stored = daily.withColumns(daily_calendar(F.col("date")))
    return quality.shift_report(daily, shift_dates(stored, ["date"]))


@query(
    "shift_refusal",
    f"""WITH {_SHIFTED} SELECT 'shifted' AS "table", {day('min(date)', 'first_date')} FROM shifted
HAVING min(date) >= DATE '2010-12-16'""",
)
def shift_refusal(spark, folder):
    daily = t.daily(spark, folder).select("household_id", "date")
    tables = {"recorded": daily, "shifted": shift_dates(daily, ["date"])}
    # The limit belongs to the published series; this one starts earlier.
    return report(quality.already_shifted(tables, limit="2010-12-16"))


@query(
    "parity_check",
    f"""WITH {PLAIN}, pairs AS (
  SELECT rolling_mean_7 AS a, round(rolling_mean_7, 3) AS b, rolling_std_7 AS c, round(rolling_std_7, 3) AS d
  FROM features WHERE lag_30 IS NOT NULL
) SELECT 'rolling_mean_7' AS feature, {r('max(abs(a - b)) AS max_abs_delta', 'avg(abs(a - b)) AS mean_abs_delta')},
  count(*) AS rows FROM pairs
UNION ALL SELECT 'rolling_std_7', {r('max(abs(c - d)) AS max_abs_delta', 'avg(abs(c - d)) AS mean_abs_delta')},
  count(*) FROM pairs""",
)
def parity_check(spark, folder):
    """Features against their stored form with three decimals."""
    names = ["rolling_mean_7", "rolling_std_7"]
    fresh = features.complete_features(t.daily(spark, folder)).select("household_id", "date", *names)
    stored = fresh.withColumns({c: F.round(c, 3) for c in names})
    return report(quality.parity(fresh, stored, names))


@query(
    "leakage_check",
    f"""WITH {PLAIN}, ends AS (SELECT household_id, max(date) AS last FROM daily GROUP BY household_id)
SELECT household_id, CAST(0 AS BIGINT) AS rows_changed, count(*) AS rows_compared FROM features
GROUP BY household_id""",
)
def leakage_check(spark, folder):
    """Feature rows that change when each household's last value is changed."""
    daily = t.daily(spark, folder).select("household_id", "date", "energy_kwh")
    ends = daily.groupBy("household_id").agg(F.max("date").alias("_last"))
    changed = daily.join(ends, "household_id").select(
        "household_id",
        "date",
        F.when(F.col("date") == F.col("_last"), F.col("energy_kwh") + 1000)
        .otherwise(F.col("energy_kwh"))
        .alias("energy_kwh"),
    )
    names = fixed.DAILY_FEATURES
    a = features.daily_features(daily).select("household_id", "date", F.struct(*names).alias("a"))
    b = features.daily_features(changed).select("household_id", "date", F.struct(*names).alias("b"))
    return (
        a.join(b, ["household_id", "date"])
        .groupBy("household_id")
        .agg(
            F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("rows_changed"),
            F.count(F.lit(1)).alias("rows_compared"),
        )
    )
