"""Statistics, recent windows and chart tables of daily series."""

from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.functions.calendar import iso_date, next_day, relative_label
from meterspan.operators import stats
from meterspan.plans.registry import day, query, r, report, small, whole
from meterspan.sources import tables as t

_X = "energy_kwh"


def _list(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


@query(
    "summary_stats",
    f"""WITH {t.DAILY} SELECT household_id, {r(
    f'avg({_X}) AS mean', f'median({_X}) AS median', f'stddev_samp({_X}) AS std', f'var_samp({_X}) AS variance',
    f'min({_X}) AS min', f'max({_X}) AS max', f'quantile_cont({_X}, 0.25) AS q25',
    f'quantile_cont({_X}, 0.75) AS q75', f'quantile_cont({_X}, 0.75) - quantile_cont({_X}, 0.25) AS iqr',
    f'skewness({_X}) AS skewness', f'kurtosis({_X}) AS kurtosis')}, count(*) AS count
FROM daily GROUP BY household_id""",
)
def summary_stats(spark, folder):
    return report(stats.summary_statistics(t.daily(spark, folder)))


def _side(name, test):
    return (
        f"count(*) FILTER (WHERE {test}) AS {name}_count, "
        + r(
            f"avg({_X}) FILTER (WHERE {test}) AS {name}_mean_kwh",
            f"median({_X}) FILTER (WHERE {test}) AS {name}_median_kwh",
            f"stddev_samp({_X}) FILTER (WHERE {test}) AS {name}_std_kwh",
        )
    )


@query(
    "weekday_stats",
    f"""WITH {t.DAILY} SELECT household_id, {_side('weekday', 'isodow(date) < 6')},
  {_side('weekend', 'isodow(date) >= 6')},
  {r(f'avg({_X}) FILTER (WHERE isodow(date) >= 6) / avg({_X}) FILTER (WHERE isodow(date) < 6) AS weekend_elevation_ratio')}
FROM daily GROUP BY household_id""",
)
def weekday_stats(spark, folder):
    return report(stats.weekday_statistics(t.daily(spark, folder)))


@query(
    "dow_breakdown",
    f"""WITH {t.DAILY}, homes AS (SELECT DISTINCT household_id FROM daily), grid AS (
  SELECT household_id, i AS day_index FROM homes, range(7) AS s(i)
), found AS (
  SELECT household_id, isodow(date) - 1 AS day_index, count(*) AS n, avg({_X}) AS a, median({_X}) AS m,
    stddev_samp({_X}) AS s FROM daily GROUP BY 1, 2
) SELECT household_id, {small('day_index')}, {_list(fixed.WEEKDAYS_FROM_MONDAY)}[day_index + 1] AS day_name,
  day_index >= 5 AS is_weekend, {whole('coalesce(n, 0) AS count')},
  {r('coalesce(a, 0) AS mean_kwh', 'coalesce(m, 0) AS median_kwh', 'coalesce(s, 0) AS std_kwh')}
FROM grid LEFT JOIN found USING (household_id, day_index)""",
)
def dow_breakdown(spark, folder):
    return report(stats.day_of_week_breakdown(t.daily(spark, folder)))


@query(
    "month_trend",
    f"""WITH {t.DAILY} SELECT household_id, {small('month(date) AS month_index')}, count(*) AS count,
  {r(f'avg({_X}) AS mean_kwh', f'median({_X}) AS median_kwh')},
  {_list(fixed.MONTHS)}[month(date)] AS month_name FROM daily GROUP BY household_id, month(date)""",
)
def month_trend(spark, folder):
    return report(stats.month_trend(t.daily(spark, folder)))


@query(
    "season_trend",
    f"""WITH {t.DAILY}, coded AS (SELECT *, CAST(floor((month(date) % 12) / 3) AS INTEGER) AS season_code FROM daily)
SELECT household_id, season_code, count(*) AS count, {r(f'avg({_X}) AS mean_kwh', f'median({_X}) AS median_kwh')},
  {_list(fixed.SEASONS)}[season_code + 1] AS season_name FROM coded GROUP BY household_id, season_code""",
)
def season_trend(spark, folder):
    return report(stats.season_trend(t.daily(spark, folder)))


@query(
    "submeter_split",
    f"""WITH {t.DAILY}, sums AS (
  SELECT household_id, sum(sub_metering_1) / 1000 AS s1, sum(sub_metering_2) / 1000 AS s2,
    sum(sub_metering_3) / 1000 AS s3, sum({_X}) AS total FROM daily GROUP BY household_id
), rest AS (SELECT *, greatest(0, total - s1 - s2 - s3) AS u FROM sums)
SELECT household_id, {r('s1 AS sub_1_kwh', 's2 AS sub_2_kwh', 's3 AS sub_3_kwh', 'total AS total_kwh',
  'u AS unmetered_kwh', 's1 / total * 100 AS sub_1_pct', 's2 / total * 100 AS sub_2_pct',
  's3 / total * 100 AS sub_3_pct', 'u / total * 100 AS unmetered_pct')} FROM rest""",
)
def submeter_split(spark, folder):
    return report(stats.submeter_split(t.daily(spark, folder)))


@query(
    "correlations",
    f"WITH {t.DAILY} "
    + " UNION ALL ".join(
        f"SELECT household_id, '{c}' AS measure, {r(f'corr({_X}, {c}) AS correlation')} FROM daily GROUP BY household_id"
        for c in fixed.ROLLUP_COLUMNS
    ),
)
def correlations(spark, folder):
    return report(stats.correlations(t.daily(spark, folder)))


_RECENT = f"""{t.DAILY}, recent AS (
  SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY date DESC) AS recency FROM daily
)"""


@query(
    "window_summary",
    f"""WITH {_RECENT} SELECT household_id, count(*) AS count, {r(f'sum({_X}) AS total', f'avg({_X}) AS average',
  f'coalesce(stddev_samp({_X}), 0) AS std_dev', f'max({_X}) AS peak_kwh', f'min({_X}) AS low_kwh')},
  {day(f'arg_max(date, {_X})', 'peak_date')}, {day(f'arg_min(date, {_X})', 'low_date')},
  {day('min(date)', 'start')}, {day('max(date)', '"end"')} FROM recent WHERE recency <= 90 GROUP BY household_id""",
)
def window_summary(spark, folder):
    return report(stats.window_summary(stats.latest_records(t.daily(spark, folder), 90)))


_COMPARED = f"""{_RECENT}, sides AS (
  SELECT household_id, count(*) FILTER (WHERE recency <= 30) AS current_count,
    coalesce(sum({_X}) FILTER (WHERE recency <= 30), 0) AS current_total,
    count(*) FILTER (WHERE recency > 30) AS previous_count,
    coalesce(sum({_X}) FILTER (WHERE recency > 30), 0) AS previous_total
  FROM recent WHERE recency <= 60 GROUP BY household_id
), compared AS (
  SELECT *, CASE WHEN previous_total = 0 THEN 0 ELSE (current_total - previous_total) / previous_total * 100 END
    AS change_pct FROM sides
)"""


@query(
    "window_compare",
    f"""WITH {_COMPARED} SELECT household_id, current_count, previous_count,
  {r('current_total', 'previous_total', 'change_pct')} FROM compared""",
)
def window_compare(spark, folder):
    return report(stats.compare_windows(t.daily(spark, folder), 30))


@query(
    "usage_status",
    f"""WITH {_COMPARED} SELECT household_id, {r('change_pct')}, CASE WHEN previous_total = 0 THEN NULL
  WHEN change_pct <= -10 THEN '{fixed.USAGE_STATUS[0][1]}' WHEN change_pct <= 5 THEN '{fixed.USAGE_STATUS[1][1]}'
  WHEN change_pct <= 20 THEN '{fixed.USAGE_STATUS[2][1]}' ELSE '{fixed.USAGE_STATUS[3][1]}' END AS usage_status
FROM compared""",
)
def usage_status(spark, folder):
    compared = stats.compare_windows(t.daily(spark, folder), 30)
    return report(stats.usage_status(compared).select("household_id", "change_pct", "usage_status"))


@query(
    "moving_average",
    f"""WITH {t.DAILY} SELECT household_id, {day('date')}, {r(_X)}, {r(f'''avg({_X}) OVER (PARTITION BY household_id
  ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS baseline''')} FROM daily""",
)
def moving_average(spark, folder):
    averaged = stats.moving_average(t.daily(spark, folder), 7)
    return report(averaged.select("household_id", "date", "energy_kwh", "baseline"))


@query(
    "local_mean",
    f"""WITH {t.DAILY}, means AS (SELECT household_id, date, avg({_X}) OVER w AS a, count(*) OVER w AS n FROM daily
  WINDOW w AS (PARTITION BY household_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
SELECT household_id, {day('date')}, {r('CASE WHEN n = 30 THEN a * 0.95 END AS local_estimate_kwh')} FROM means""",
)
def local_mean(spark, folder):
    estimated = stats.local_mean_estimate(t.daily(spark, folder))
    return report(estimated.select("household_id", "date", "local_estimate_kwh"))


_BY_WEEKDAY = f"""{t.DAILY}, homes AS (SELECT DISTINCT household_id FROM daily), grid AS (
  SELECT household_id, i AS weekday_index FROM homes, range(7) AS s(i)
), found AS (
  SELECT household_id, dayofweek(date) AS weekday_index, avg({_X}) AS a, sum({_X}) AS t, count(*) AS n
  FROM daily GROUP BY 1, 2
), by_weekday AS (
  SELECT household_id, weekday_index, {_list(fixed.WEEKDAYS_FROM_SUNDAY)}[weekday_index + 1] AS label,
    coalesce(a, 0) AS average, coalesce(t, 0) AS total, coalesce(n, 0) AS days
  FROM grid LEFT JOIN found USING (household_id, weekday_index)
)"""


@query(
    "average_by_weekday",
    f"""WITH {_BY_WEEKDAY} SELECT household_id, {small('weekday_index')}, label, {r('average', 'total')},
  {whole('days')} FROM by_weekday""",
)
def average_by_weekday(spark, folder):
    return report(stats.average_by_weekday(t.daily(spark, folder)))


@query(
    "peak_weekday",
    f"""WITH {_BY_WEEKDAY}, ranked AS (SELECT *, row_number() OVER (PARTITION BY household_id
  ORDER BY average DESC, weekday_index) AS i FROM by_weekday)
SELECT household_id, label AS peak_label, {r('average AS peak_average')} FROM ranked WHERE i = 1""",
)
def peak_weekday(spark, folder):
    return report(stats.peak_weekday(stats.average_by_weekday(t.daily(spark, folder))))


@query(
    "month_buckets",
    f"""WITH {t.DAILY} SELECT household_id, strftime(date, '%Y-%m') AS month, {r(f'sum({_X}) AS total',
  f'avg({_X}) AS average')}, count(*) AS days, strftime(min(date), '%b %y') AS label
FROM daily GROUP BY household_id, strftime(date, '%Y-%m')""",
)
def month_buckets(spark, folder):
    return report(stats.month_buckets(t.daily(spark, folder)))


def histogram_sql(source, value, bins):
    return f"""ranges AS (
  SELECT household_id, min({value}) AS low,
    (CASE WHEN max({value}) = min({value}) THEN 1 ELSE max({value}) - min({value}) END) / {bins}.0 AS width
  FROM {source} GROUP BY household_id
), counts AS (
  SELECT s.household_id, least({bins - 1}, CAST(floor((s.{value} - low) / width) AS INTEGER)) AS bin, count(*) AS n
  FROM {source} s JOIN ranges USING (household_id) GROUP BY 1, 2
), grid AS (SELECT ranges.*, CAST(i AS INTEGER) AS bin FROM ranges, range({bins}) AS s(i))
SELECT household_id, bin, {r('low + bin * width AS "from"', 'low + (bin + 1) * width AS "to"')},
  {whole('coalesce(n, 0) AS count')} FROM grid LEFT JOIN counts USING (household_id, bin)"""


@query("histogram", f"WITH {t.DAILY}, {histogram_sql('daily', _X, 12)}")
def histogram(spark, folder):
    return report(stats.histogram(t.daily(spark, folder), "energy_kwh", 12))


@query(
    "calendar_grid",
    f"""WITH {t.DAILY}, spans AS (
  SELECT household_id, min(date) AS first, max(date) AS last, greatest(max({_X}), 1) AS top FROM daily GROUP BY 1
), starts AS (SELECT *, last + CAST(6 - dayofweek(last) AS INTEGER) - 181 AS start FROM spans),
cells AS (
  SELECT starts.*, start + CAST(i AS INTEGER) AS date, i // 7 AS week, i % 7 AS weekday FROM starts, range(182) AS s(i)
), grid AS (
  SELECT c.household_id, c.date, week, weekday, c.date BETWEEN first AND last AS in_range, {_X} AS value,
    least(1.0, {_X} / top) AS intensity FROM cells c LEFT JOIN daily d ON d.household_id = c.household_id
    AND d.date = c.date
), heads AS (
  SELECT household_id, date, month(date) AS m, lag(month(date)) OVER (PARTITION BY household_id ORDER BY date) AS b
  FROM grid WHERE weekday = 0 AND in_range
) SELECT household_id, {day('g.date', 'date')}, {small('week', 'weekday')}, in_range, {r('value', 'intensity')},
  CASE WHEN m IS DISTINCT FROM b THEN {_list(fixed.MONTHS)}[m] END AS month_label
FROM grid g LEFT JOIN heads USING (household_id, date)""",
)
def calendar_grid(spark, folder):
    return report(stats.calendar_grid(t.daily(spark, folder)))


@query(
    "recent_days",
    f"""WITH {_RECENT}, shown AS (
  SELECT *, avg({_X}) OVER (PARTITION BY household_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
    AS baseline, max({_X}) OVER (PARTITION BY household_id) AS peak FROM recent WHERE recency <= 30
) SELECT household_id, {day('date')}, {small('recency')}, {r(_X, 'baseline', f'{_X} - baseline AS diff_kwh',
  f'({_X} - baseline) / baseline * 100 AS diff_pct', f'least(100, {_X} / peak * 100) AS bar_pct')}
FROM shown WHERE recency <= 8""",
)
def recent_days(spark, folder):
    return report(stats.recent_days(t.daily(spark, folder)))


@query(
    "latest_n",
    f"""WITH {_RECENT} SELECT household_id, {day('date')}, {r(_X, digits=3)} FROM recent WHERE recency <= 30
ORDER BY household_id, date""",
)
def latest_n(spark, folder):
    latest = stats.latest_records(t.daily(spark, folder), 30)
    return report(latest.select("household_id", "date", "energy_kwh").orderBy("household_id", "date"), 3)


@query(
    "history_before",
    f"""WITH {t.DAILY}, recent AS (
  SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY date DESC) AS recency FROM daily
  WHERE date < DATE '1998-01-01'
) SELECT household_id, {day('date')}, {r(_X, digits=3)} FROM recent WHERE recency <= 30""",
)
def history_before(spark, folder):
    latest = stats.latest_records(t.daily(spark, folder), 30, before="1998-01-01")
    return report(latest.select("household_id", "date", "energy_kwh"), 3)


@query(
    "relative_dates",
    f"""WITH {t.DAILY}, ends AS (SELECT *, max(date) OVER (PARTITION BY household_id) AS last FROM daily),
n AS (SELECT *, date_diff('day', last - 2, date) AS n FROM ends)
SELECT household_id, {day('date')}, {day('date + 1', 'next_date')}, CASE WHEN n = 0 THEN 'today'
  WHEN n = -1 THEN 'yesterday' WHEN n = 1 THEN 'tomorrow' WHEN n < 0 THEN abs(n) || ' days ago'
  ELSE 'in ' || n || ' days' END AS label FROM n""",
)
def relative_dates(spark, folder):
    """Every day relative to the second day before the household's last one."""
    daily = t.daily(spark, folder).select("household_id", "date")
    ends = daily.groupBy("household_id").agg(F.date_sub(F.max("date"), 2).alias("_today"))
    return daily.join(ends, "household_id").select(
        "household_id",
        iso_date(F.col("date")).alias("date"),
        iso_date(next_day(F.col("date"))).alias("next_date"),
        relative_label(F.col("date"), F.col("_today")).alias("label"),
    )
