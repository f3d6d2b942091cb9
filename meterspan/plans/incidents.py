"""Reports on flagged days. The score here is a z-score, so that SQL can follow."""

from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.operators import anomalies, features, quality
from meterspan.operators.stats import histogram, latest_records
from meterspan.plans.registry import day, query, r, report
from meterspan.plans.statistics import histogram_sql
from meterspan.sources import sinks
from meterspan.sources import tables as t


def scored(spark, folder):
    window = features.series_window()
    rolled = t.daily(spark, folder).withColumns(features.rolling_columns(window, widths=[7]))
    score = F.try_divide(
        -F.abs(F.col("energy_kwh") - F.col("rolling_mean_7")), F.col("rolling_std_7")
    )
    return (
        rolled.filter((F.col("rolling_std_7") > 0))
        .select("household_id", "date", "energy_kwh", "rolling_mean_7", "rolling_std_7")
        .withColumn("anomaly_score", score / 100)
        .withColumn("flagged", F.col("anomaly_score") < -0.02)
    )


def flagged(spark, folder):
    return scored(spark, folder).filter("flagged").drop("flagged")


def incidents(spark, folder):
    return anomalies.enrich_anomalies(flagged(spark, folder))


def tariffs(spark, folder):
    return t.households(spark, folder).select("household_id", "tariff")


def _quote(text):
    return "'" + text.replace("'", "''") + "'"


_CATEGORY = " ".join(
    f"WHEN abs(pct) <= {top} THEN {_quote(name)}" for top, name, _ in fixed.CAUSES if top is not None
)
_CAUSE = " ".join(
    f"WHEN abs(pct) <= {top} THEN {_quote(text)}" for top, _, text in fixed.CAUSES if top is not None
)
_AGAINST = "printf('%.1f kWh against a 7-day moving average of %.1f kWh', energy_kwh, rolling_mean_7)"
INCIDENTS = f"""{t.SCORED}, measured AS (
  SELECT *, energy_kwh - rolling_mean_7 AS diff,
    CASE WHEN rolling_mean_7 > 0 THEN (energy_kwh - rolling_mean_7) / rolling_mean_7 * 100 ELSE 0 END AS pct,
    CASE WHEN rolling_std_7 > 0 THEN (energy_kwh - rolling_mean_7) / rolling_std_7 ELSE 0 END AS z FROM flagged
), incidents AS (
  SELECT household_id, date, energy_kwh AS observed, rolling_mean_7 AS expected, diff AS deviation_kwh,
    pct AS deviation_pct, anomaly_score AS score, z AS z_score,
    CASE WHEN anomaly_score > -0.03 OR pct > 100 THEN 'CRITICAL' WHEN anomaly_score > -0.015 OR pct > 50 THEN 'HIGH'
      WHEN pct < -40 THEN 'LOW' ELSE 'MEDIUM' END AS severity,
    CASE WHEN pct < 0 THEN {_quote(fixed.LOW_USAGE_CATEGORY)} {_CATEGORY}
      ELSE {_quote(fixed.CAUSES[-1][1])} END AS category,
    CASE WHEN pct >= 0 THEN printf('Consumption ran %.0f%% above the 7-day baseline', abs(pct))
      ELSE printf('Consumption fell %.0f%% below the 7-day baseline', abs(pct)) END AS headline,
    CASE WHEN pct >= 0 THEN {_AGAINST} || printf(' (%+.1f kWh, %+.1fσ). Possible cause: ', diff, z)
      || CASE {_CAUSE} ELSE {_quote(fixed.CAUSES[-1][2])} END
      ELSE {_AGAINST} || {_quote('. ' + fixed.LOW_USAGE_CAUSE)} END AS cause,
    CASE WHEN pct >= 0 THEN {_quote(fixed.ACTION_HIGH)} ELSE {_quote(fixed.ACTION_LOW)} END AS action,
    greatest(0, diff) AS excess_kwh FROM measured
)"""
_NUMBERS = ["observed", "expected", "deviation_kwh", "deviation_pct", "score", "z_score", "excess_kwh"]
_TEXTS = "severity, category, headline, cause, action"
_RANK = f"list_position([{', '.join(_quote(s) for s in fixed.SEVERITIES)}], severity)"


@query(
    "anomaly_enrich",
    f"WITH {INCIDENTS} SELECT household_id, {day('date')}, {r(*_NUMBERS)}, {_TEXTS} FROM incidents",
)
def anomaly_enrich(spark, folder):
    return report(incidents(spark, folder))


@query(
    "anomaly_documented_rule",
    f"""WITH {INCIDENTS} SELECT household_id, {day('date')}, CASE
  WHEN score < -0.15 AND deviation_pct > 50 THEN 'CRITICAL' WHEN score < -0.10 AND deviation_pct > 30 THEN 'HIGH'
  WHEN score < -0.05 OR deviation_pct > 20 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM incidents""",
)
def anomaly_documented_rule(spark, folder):
    rows = anomalies.enrich_anomalies(flagged(spark, folder), rule="documented")
    return report(rows.select("household_id", "date", "severity"))


@query(
    "anomaly_summary",
    f"""WITH {INCIDENTS}, {t.HOUSEHOLDS}, sums AS (
  SELECT household_id, count(*) AS total, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical,
    count(*) FILTER (WHERE severity = 'HIGH') AS high, count(*) FILTER (WHERE severity = 'MEDIUM') AS medium,
    count(*) FILTER (WHERE severity = 'LOW') AS low, sum(excess_kwh) AS excess_kwh FROM incidents GROUP BY 1
), worst AS (
  SELECT household_id, date, row_number() OVER (PARTITION BY household_id ORDER BY {_RANK}, abs(deviation_pct) DESC,
    date) AS i FROM incidents
) SELECT s.household_id, total, critical, high, medium, low, {day('date', 'most_severe_date')},
  {r('excess_kwh', 'excess_kwh * tariff AS excess_cost')}
FROM sums s JOIN worst w ON w.household_id = s.household_id AND i = 1
JOIN households h ON h.household_id = s.household_id""",
)
def anomaly_summary(spark, folder):
    return report(anomalies.anomaly_summary(incidents(spark, folder), tariffs(spark, folder)))


@query(
    "anomaly_ranking",
    f"""WITH {INCIDENTS} SELECT household_id, {day('date')}, severity, {r('deviation_pct')},
  CAST(row_number() OVER (PARTITION BY household_id ORDER BY {_RANK}, abs(deviation_pct) DESC, date) AS INTEGER)
    AS position FROM incidents""",
)
def anomaly_ranking(spark, folder):
    ranked = anomalies.ranked_incidents(incidents(spark, folder))
    return report(ranked.select("household_id", "date", "severity", "deviation_pct", "position"))


@query(
    "anomaly_context",
    f"""WITH {t.SCORED} SELECT count(*) AS evaluated_rows, count(*) FILTER (WHERE anomaly_score < -0.02) AS flagged_rows,
  count(*) FILTER (WHERE anomaly_score >= -0.02) AS inliers,
  {r('count(*) FILTER (WHERE anomaly_score < -0.02) / CAST(count(*) AS DOUBLE) AS flagged_rate',
     'min(anomaly_score) AS score_min', 'max(anomaly_score) AS score_max', '0.02 AS configured_contamination')}
FROM scored""",
)
def anomaly_context(spark, folder):
    return report(anomalies.anomaly_context(scored(spark, folder)))


@query(
    "anomaly_flag_join",
    f"""WITH {t.SCORED} SELECT d.household_id, {day('d.date', 'date')}, {r('d.energy_kwh AS energy_kwh')},
  f.date IS NOT NULL AS is_anomaly FROM daily d LEFT JOIN flagged f USING (household_id, date)""",
)
def anomaly_flag_join(spark, folder):
    days = t.daily(spark, folder).select("household_id", "date", "energy_kwh")
    return report(anomalies.flag_days(days, flagged(spark, folder)))


@query(
    "anomaly_semi",
    f"""WITH {t.SCORED} SELECT d.household_id, {day('d.date', 'date')}, {r('d.avg_voltage AS avg_voltage', digits=4)}
FROM daily d WHERE EXISTS (SELECT 1 FROM flagged f WHERE f.household_id = d.household_id AND f.date = d.date)""",
)
def anomaly_semi(spark, folder):
    days = t.daily(spark, folder).select("household_id", "date", "avg_voltage")
    return report(anomalies.flagged_days(days, flagged(spark, folder)), 4)


@query(
    "anomaly_topn",
    f"""WITH {t.SCORED} SELECT household_id, {day('date')}, {r('energy_kwh', 'anomaly_score')} FROM scored
ORDER BY scored.anomaly_score, household_id, scored.date LIMIT 29""",
)
def anomaly_topn(spark, folder):
    lowest = anomalies.lowest_scores(scored(spark, folder), 29)
    return report(lowest.select("household_id", "date", "energy_kwh", "anomaly_score"))


@query(
    "anomaly_filter",
    f"""WITH {INCIDENTS} SELECT household_id, {day('date')}, severity, category FROM incidents
WHERE severity = 'CRITICAL' AND contains(lower(strftime(date, '%Y-%m-%d') || ' ' || headline || ' ' || category), 'surge')""",
)
def anomaly_filter(spark, folder):
    kept = anomalies.filter_incidents(incidents(spark, folder), "CRITICAL", " Surge ")
    return report(kept.select("household_id", "date", "severity", "category"))


@query(
    "excess_share",
    f"""WITH {INCIDENTS}, totals AS (SELECT household_id, sum(energy_kwh) AS recorded_kwh FROM daily GROUP BY 1),
excess AS (SELECT household_id, sum(excess_kwh) AS e FROM incidents GROUP BY 1)
SELECT household_id, {r('recorded_kwh', 'coalesce(e, 0) AS excess_kwh',
  'coalesce(e, 0) / recorded_kwh * 100 AS excess_share_pct')} FROM totals LEFT JOIN excess USING (household_id)""",
)
def excess_share(spark, folder):
    return report(anomalies.excess_share(incidents(spark, folder), t.daily(spark, folder)))


def _text(name, places=3):
    return f"CAST(CAST({name} AS DECIMAL(18,{places})) AS VARCHAR)"


@query(
    "incident_export",
    f"""WITH {INCIDENTS}, {t.HOUSEHOLDS} SELECT household_id, {day('date')}, severity, category,
  {_text('observed')} AS observed_kwh, {_text('expected')} AS baseline_kwh, {_text('deviation_kwh')} AS deviation_kwh,
  {_text('deviation_pct')} AS deviation_pct, {_text('z_score')} AS z_score, {_text('excess_kwh')} AS excess_kwh,
  {_text('excess_kwh * tariff', 2)} AS excess_cost FROM incidents JOIN households USING (household_id)""",
)
def incident_export(spark, folder):
    priced = incidents(spark, folder).join(tariffs(spark, folder), "household_id")
    return sinks.incident_rows(priced)


@query("score_histogram", f"WITH {t.SCORED}, {histogram_sql('scored', 'anomaly_score', 30)}")
def score_histogram(spark, folder):
    return report(histogram(scored(spark, folder), "anomaly_score", 30))


@query(
    "set_difference",
    f"""WITH {INCIDENTS}, a AS (SELECT household_id, date FROM flagged),
b AS (SELECT household_id, date FROM incidents WHERE severity = 'CRITICAL' OR deviation_pct < 0)
SELECT household_id, {day('date')}, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT household_id, {day('date')}, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def set_difference(spark, folder):
    """Flagged days against the days that are critical or low."""
    rows = incidents(spark, folder)
    critical = rows.filter("severity = 'CRITICAL' OR deviation_pct < 0").select("household_id", "date")
    days = flagged(spark, folder).select("household_id", "date")
    return report(quality.set_difference(days, critical))


@query(
    "common_days",
    f"""WITH {t.DAILY}, recent AS (
  SELECT household_id, date, row_number() OVER (PARTITION BY household_id ORDER BY date DESC) AS i FROM daily
) SELECT household_id, {day('date')} FROM recent WHERE i BETWEEN 31 AND 40""",
)
def common_days(spark, folder):
    """Days shared by the newest 40 and the 40 before the newest 30."""
    days = latest_records(t.daily(spark, folder), 70).select("household_id", "date", "recency")
    newest = days.filter("recency <= 40").drop("recency")
    older = days.filter("recency > 30").drop("recency")
    return report(quality.common_rows(newest, older))
