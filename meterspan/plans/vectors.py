"""Context vectors and forecast requests derived from the daily series."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.functions import arrays
from meterspan.functions.scalars import clamp_day
from meterspan.operators import features, forecast
from meterspan.plans.registry import NUDGE, day, query, r, report, small
from meterspan.plans.series import PLAIN, split_table
from meterspan.sources import tables as t

RAISED = 1.1  # contexts are the recorded values times this, so replacing shows


def requests(spark, folder, horizon=1, households=4):
    """One request per household and year: the first day that has 30 records before
    it, with those records raised as the context."""
    known = forecast.contexts_before(t.daily(spark, folder, households)).filter("consumption is not null")
    first = Window.partitionBy("household_id", F.year("date")).orderBy("date")
    return (
        known.withColumn("_n", F.row_number().over(first))
        .filter(F.col("_n") == 1)
        .select(
            (F.col("household_id") * 10000 + F.year("date")).alias("request_id"),
            "household_id",
            F.transform("consumption", lambda x: x * RAISED).alias("consumption"),
            F.col("date").alias("start_date"),
            F.lit(horizon).alias("horizon_days"),
        )
    )


_REQUESTS = f"""{PLAIN}, firsts AS (
  SELECT *, row_number() OVER (PARTITION BY household_id, year ORDER BY date) AS i FROM features WHERE rn > 30
), requests AS (
  SELECT household_id * 10000 + year AS request_id, household_id, date AS start_date FROM firsts WHERE i = 1
), prior AS (
  SELECT q.request_id, q.household_id, q.start_date, f.date, f.energy_kwh,
    row_number() OVER (PARTITION BY q.request_id ORDER BY f.date DESC) AS back
  FROM requests q JOIN features f ON f.household_id = q.household_id AND f.date < q.start_date
), replaced AS (
  SELECT * REPLACE (CASE WHEN back <= 30 THEN energy_kwh * {RAISED} ELSE energy_kwh END AS energy_kwh) FROM prior
)"""


@query(
    "context_overwrite",
    f"""WITH {_REQUESTS} SELECT request_id, household_id, {day('date')}, {r('energy_kwh')},
  back <= 30 AS replaced FROM replaced""",
)
def context_overwrite(spark, folder):
    return report(forecast.overwrite_context(t.daily(spark, folder), requests(spark, folder)))


_LAGS = ", ".join(f"max(CASE WHEN back = {n} THEN energy_kwh END) AS lag_{n}" for n in fixed.LAGS)
_MEANS = ", ".join(
    f"{f}(CASE WHEN back <= {n} THEN energy_kwh END) AS rolling_{name}_{n}"
    for name, f in (("mean", "avg"), ("std", "stddev_samp"))
    for n in fixed.ROLLING_WINDOWS
)
_EWMS = ", ".join(
    f"sum(energy_kwh * pow(1.0 - 2.0 / {s + 1}.0, back - 1)) / sum(pow(1.0 - 2.0 / {s + 1}.0, back - 1)) AS ewm_{s}"
    for s in fixed.EWM_SPANS
)
_GAPS = f"""{_REQUESTS}, steps AS (
  SELECT *, date_diff('day', lag(date) OVER (PARTITION BY request_id ORDER BY date), date) AS gap FROM prior
), checked AS (
  SELECT request_id, household_id, start_date,
    CASE WHEN date_diff('day', max(date), start_date) > {fixed.MAX_GAP_DAYS}
      THEN 'History ends more than {fixed.MAX_GAP_DAYS} days before the target date.'
    WHEN max(gap) > {fixed.MAX_GAP_DAYS} THEN 'History has a step longer than {fixed.MAX_GAP_DAYS} days.'
    END AS reject_reason
  FROM steps GROUP BY 1, 2, 3
)"""
_REALS = fixed.LAG_FEATURES + fixed.ROLLING_MEAN_FEATURES + fixed.ROLLING_STD_FEATURES + fixed.EWM_FEATURES


@query(
    "request_features",
    f"""WITH {_GAPS}, rows_ AS (SELECT request_id, {_LAGS}, {_MEANS}, {_EWMS} FROM replaced GROUP BY request_id)
SELECT c.request_id, c.household_id, {day('start_date', 'date')}, {small(*fixed.CALENDAR_FEATURES)},
  {', '.join(r(f'rows_.{c} AS {c}') for c in _REALS)}
FROM checked c JOIN rows_ USING (request_id)
JOIN (SELECT household_id, date, {', '.join(fixed.CALENDAR_FEATURES)} FROM features) f
  ON f.household_id = c.household_id AND f.date = c.start_date WHERE reject_reason IS NULL""",
)
def request_features(spark, folder):
    planned = forecast.plan_requests(requests(spark, folder), t.daily(spark, folder))
    return report(forecast.request_features(planned))


@query(
    "request_rejects",
    f"WITH {_GAPS} SELECT request_id, household_id, {day('start_date')}, reject_reason FROM checked",
)
def request_rejects(spark, folder):
    planned = forecast.plan_requests(requests(spark, folder), t.daily(spark, folder))
    return report(planned.select("request_id", "household_id", "start_date", "reject_reason"))


@query(
    "target_range",
    f"""WITH {t.DAILY}, spans AS (SELECT household_id, min(date) AS first, max(date) AS last FROM daily GROUP BY 1),
targets AS (SELECT household_id, first, last, last + CAST(i AS INTEGER) * 3 - 6 AS target FROM spans, range(5) AS s(i))
SELECT household_id, {day('target')}, CASE WHEN target < first
  THEN 'Target date is before the start of the recorded range.' WHEN target > last
  THEN 'Target date is after the end of the recorded range.' END AS reject_reason FROM targets""",
)
def target_range(spark, folder):
    """Targets around the end of each household's record."""
    spans = t.daily(spark, folder).groupBy("household_id").agg(
        F.min("date").alias("first"), F.max("date").alias("last")
    )
    targets = spans.select(
        "household_id",
        F.explode(F.sequence(F.date_sub("last", 6), F.date_add("last", 6), F.expr("interval 3 days"))).alias(
            "target"
        ),
        "first",
        "last",
        # Only the range is under test here, so the history counts as complete.
        F.col("last").alias("last_date"),
        F.lit(fixed.CONTEXT_DAYS).alias("records"),
        F.lit(0).alias("largest_gap"),
    ).withColumn("last_date", F.col("target"))
    reason = forecast.target_reason(F.col("target"), F.col("first"), F.col("last"))
    return report(targets.select("household_id", "target", reason.alias("reject_reason")))


@query(
    "vector_stats",
    f"""WITH {t.DAILY}, w AS (
  SELECT household_id, date, avg(energy_kwh) OVER x AS a, max(energy_kwh) OVER x AS hi,
    min(energy_kwh) OVER x AS lo, sum(energy_kwh) OVER x AS total, count(*) OVER x AS n FROM daily
  WINDOW x AS (PARTITION BY household_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
) SELECT household_id, {day('date')}, {r('a AS average', 'hi AS max', 'lo AS min', 'total')} FROM w WHERE n = 30""",
)
def vector_stats(spark, folder):
    known = forecast.contexts_before(t.daily(spark, folder)).filter("consumption is not null")
    stats = arrays.vector_stats(F.col("consumption"))
    return report(known.select("household_id", "date", *[c.alias(n) for n, c in stats.items()]))


def pasted(spark, folder):
    """Per household and month the daily values as pasted text: separators differ,
    one month in two carries a stray word, one in three a negative value."""
    number = F.year("date") * 12 + F.month("date")
    value = F.round(F.col("energy_kwh") * NUDGE, 3)
    lists = (
        t.daily(spark, folder)
        .groupBy("household_id", number.alias("month_number"))
        .agg(F.array_sort(F.collect_list(F.struct("date", value.alias("x")))).alias("_l"))
    )
    texts = F.transform("_l", lambda s: s["x"].cast("string"))
    m = F.col("month_number")
    body = F.when(m % 2 == 0, F.concat(F.array_join(texts, "; "), F.lit(", kWh"))).otherwise(
        F.array_join(texts, "\n")
    )
    return lists.select(
        "household_id",
        "month_number",
        F.when(m % 3 == 0, F.concat(F.lit("-1.5 "), body)).otherwise(body).alias("text"),
    )


_PASTED = f"""{t.DAILY}, parts AS (
  SELECT household_id, year(date) * 12 + month(date) AS month_number, round(energy_kwh * {NUDGE}, 3) AS x FROM daily
  UNION ALL SELECT DISTINCT household_id, year(date) * 12 + month(date), -1.5 FROM daily
    WHERE (year(date) * 12 + month(date)) % 3 = 0
)"""


@query(
    "vector_parse",
    f"""WITH {_PASTED} SELECT household_id, CAST(month_number AS INTEGER) AS month_number,
  CAST(count(*) AS INTEGER) AS found, {r('sum(x) AS total')} FROM parts GROUP BY 1, 2""",
)
def vector_parse(spark, folder):
    parsed = pasted(spark, folder).withColumn("values", arrays.parse_vector(F.col("text")))
    return report(
        parsed.select(
            "household_id",
            "month_number",
            F.size("values").alias("found"),
            arrays.vector_total(F.col("values")).alias("total"),
        )
    )


@query(
    "vector_validate",
    f"""WITH {_PASTED} SELECT household_id, CAST(month_number AS INTEGER) AS month_number,
  CASE WHEN count(*) <> 30 THEN 'Exactly 30 consumption values are required.'
    WHEN min(x) < 0 THEN 'Consumption values cannot be negative.' END AS reject_reason
FROM parts GROUP BY 1, 2""",
)
def vector_validate(spark, folder):
    values = arrays.parse_vector(F.col("text"))
    return pasted(spark, folder).select(
        "household_id", "month_number", arrays.vector_reason(values).alias("reject_reason")
    )


@query(
    "clamped_days",
    f"""WITH {t.DAILY} SELECT household_id, {day('date')},
  {r('CASE WHEN energy_kwh * 20 - 60 >= 0 THEN least(200, energy_kwh * 20 - 60) END AS clamped')} FROM daily""",
)
def clamped_days(spark, folder):
    wide = F.col("energy_kwh") * 20 - 60
    return report(t.daily(spark, folder).select("household_id", "date", clamp_day(wide).alias("clamped")))


_PRESETS = ", ".join(f"('{n}', '{s}', {x}, {o})" for n, s, x, o in fixed.FORECAST_PRESETS)


@query(
    "preset_window",
    f"""WITH {PLAIN}, ranked AS (
  SELECT household_id, date, row_number() OVER (PARTITION BY household_id ORDER BY date) AS i,
    count(*) OVER (PARTITION BY household_id) AS n FROM features WHERE lag_30 IS NOT NULL
), starts AS (
  SELECT household_id, min(date) AS start FROM ranked WHERE i > floor(n * CAST(0.85 AS DOUBLE)) GROUP BY 1
), windows_ AS (
  SELECT 'test_split' AS source, f.household_id, f.date, f.energy_kwh, row_number() OVER (
    PARTITION BY f.household_id ORDER BY f.date DESC) AS back
  FROM features f JOIN starts s ON s.household_id = f.household_id AND f.date < s.start
  UNION ALL SELECT 'tail', household_id, date, energy_kwh, row_number() OVER (
    PARTITION BY household_id ORDER BY date DESC) FROM features
), presets(preset, source, scale, shift) AS (VALUES {_PRESETS})
SELECT household_id, preset, {small('30 - back AS position')}, {r('energy_kwh * scale AS value', digits=3)},
  {day("max(date) OVER (PARTITION BY household_id, preset) + CAST(shift + 1 AS INTEGER)", 'target_date')}
FROM windows_ JOIN presets USING (source) WHERE back <= 30""",
)
def preset_window(spark, folder):
    presets = forecast.preset_windows(t.daily(spark, folder), split_table(spark, folder))
    exploded = presets.select(
        "household_id", "preset", F.posexplode("consumption").alias("position", "value"), "target_date"
    )
    return report(exploded, 3)


@query(
    "history_gap_steps",
    f"""WITH {t.daily_sql(1)}, steps AS (
  SELECT date_diff('day', lag(date) OVER (ORDER BY date), date) AS gap_days FROM daily
) SELECT {small('gap_days')}, count(*) AS steps FROM steps WHERE gap_days > 1 GROUP BY gap_days""",
)
def history_gap_steps(spark, folder):
    """How often the pooled series skips days, by length of the step."""
    gaps = features.history_gaps(t.daily(spark, folder, households=1), max_gap=1)
    return gaps.groupBy("gap_days").agg(F.count(F.lit(1)).alias("steps"))
