"""Reports on flagged days."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.functions.scalars import case_of, contains_text, signed_tenths

KEYS = ("household_id",)


def severity(score, pct, rule="code"):
    """Severity of an incident; the order of the cases matters.

    ``code`` is the rule results are published under. ``documented`` is the rule
    as described in prose, where a lower score means a rarer day."""
    if rule == "code":
        cases = [
            ((score > -0.03) | (pct > 100), F.lit("CRITICAL")),
            ((score > -0.015) | (pct > 50), F.lit("HIGH")),
            (pct < -40, F.lit("LOW")),
        ]
        return case_of(cases, F.lit("MEDIUM"))
    if rule == "documented":
        cases = [
            ((score < -0.15) & (pct > 50), F.lit("CRITICAL")),
            ((score < -0.10) & (pct > 30), F.lit("HIGH")),
            ((score < -0.05) | (pct > 20), F.lit("MEDIUM")),
        ]
        return case_of(cases, F.lit("LOW"))
    raise ValueError("rule must be 'code' or 'documented'")


def severity_rank(name):
    return F.array_position(F.array(*[F.lit(s) for s in fixed.SEVERITIES]), name)


def enrich_anomalies(flagged, rule="code"):
    """Deviation, severity, cause and wording per flagged day."""
    observed, expected = F.col("energy_kwh"), F.col("rolling_mean_7")
    diff = observed - expected
    spread = F.col("rolling_std_7")
    pct, z, size = F.col("deviation_pct"), F.col("z_score"), F.abs(F.col("deviation_pct"))
    *bounded, (_, last_category, last_cause) = fixed.CAUSES
    category = case_of([(size <= top, F.lit(name)) for top, name, _ in bounded], F.lit(last_category))
    cause = case_of([(size <= top, F.lit(text)) for top, _, text in bounded], F.lit(last_cause))
    up = pct >= 0
    against = F.format_string(
        "%.1f kWh against a 7-day moving average of %.1f kWh", F.col("observed"), F.col("expected")
    )
    return (
        flagged.select(
            "household_id",
            "date",
            observed.alias("observed"),
            expected.alias("expected"),
            diff.alias("deviation_kwh"),
            F.when(expected > 0, diff / expected * 100).otherwise(F.lit(0.0)).alias("deviation_pct"),
            F.col("anomaly_score").alias("score"),
            F.when(spread > 0, diff / spread).otherwise(F.lit(0.0)).alias("z_score"),
        )
        .withColumns(
            {
                "severity": severity(F.col("score"), pct, rule),
                "category": F.when(pct < 0, F.lit(fixed.LOW_USAGE_CATEGORY)).otherwise(category),
                "headline": F.concat(
                    F.when(up, F.lit("Consumption ran ")).otherwise(F.lit("Consumption fell ")),
                    F.format_string("%.0f%%", size),
                    F.when(up, F.lit(" above the 7-day baseline")).otherwise(
                        F.lit(" below the 7-day baseline")
                    ),
                ),
                "cause": F.when(
                    up,
                    F.concat(
                        against,
                        F.lit(" ("),
                        signed_tenths(F.col("deviation_kwh")),
                        F.lit(" kWh, "),
                        signed_tenths(z),
                        F.lit("σ). Possible cause: "),
                        cause,
                    ),
                ).otherwise(F.concat(against, F.lit(". " + fixed.LOW_USAGE_CAUSE))),
                "action": F.when(up, F.lit(fixed.ACTION_HIGH)).otherwise(F.lit(fixed.ACTION_LOW)),
                "excess_kwh": F.greatest(F.lit(0.0), F.col("deviation_kwh")),
            }
        )
    )


def incident_order():
    """Most severe first, then the largest deviation, then the earlier day."""
    return [
        severity_rank(F.col("severity")).asc(),
        F.abs("deviation_pct").desc(),
        F.col("date").asc(),
    ]


def ranked_incidents(incidents, keys=KEYS):
    """Adds the position of an incident in its household's report."""
    window = Window.partitionBy(*keys).orderBy(*incident_order())
    return incidents.withColumn("position", F.row_number().over(window))


def filter_incidents(incidents, level="ALL", query=""):
    kept = incidents if level == "ALL" else incidents.filter(F.col("severity") == level)
    shown = [F.date_format("date", "yyyy-MM-dd"), F.col("headline"), F.col("category")]
    return kept.filter(contains_text(shown, query))


def anomaly_summary(incidents, tariffs, keys=KEYS):
    """Counts by severity, excess energy and cost, and the most severe day.

    ``tariffs`` has one row per household and a ``tariff`` column."""
    worst = F.struct(
        severity_rank(F.col("severity")), -F.abs("deviation_pct"), F.col("date")
    )
    return (
        incidents.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(F.col("severity") == s).alias(s.lower()) for s in fixed.SEVERITIES],
            F.sum("excess_kwh").alias("excess_kwh"),
            F.min_by("date", worst).alias("most_severe_date"),
        )
        .join(tariffs.select(*keys, "tariff"), list(keys))
        .withColumn("excess_cost", F.col("excess_kwh") * F.col("tariff"))
        .drop("tariff")
    )


def excess_share(incidents, daily, keys=KEYS):
    """Excess energy as a percentage of recorded energy, 0 without either."""
    totals = daily.groupBy(*keys).agg(F.sum("energy_kwh").alias("recorded_kwh"))
    excess = incidents.groupBy(*keys).agg(F.sum("excess_kwh").alias("excess_kwh"))
    return (
        totals.join(excess, list(keys), "left")
        .fillna(0.0, subset=["excess_kwh"])
        .withColumn(
            "excess_share_pct",
            F.coalesce(F.try_divide(F.col("excess_kwh"), F.col("recorded_kwh")) * 100, F.lit(0.0)),
        )
    )


def anomaly_context(scored, contamination=fixed.CONTAMINATION, keys=()):
    """Evaluated, flagged and inlier rows, flag rate and score range."""
    flagged = F.count_if("flagged")
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("evaluated_rows"),
        flagged.alias("flagged_rows"),
        (F.count(F.lit(1)) - flagged).alias("inliers"),
        F.round(F.coalesce(F.try_divide(flagged, F.count(F.lit(1))), F.lit(0.0)), 6).alias("flagged_rate"),
        F.round(F.min("anomaly_score"), 6).alias("score_min"),
        F.round(F.max("anomaly_score"), 6).alias("score_max"),
        F.lit(contamination).alias("configured_contamination"),
    )


def flag_days(daily, flagged, keys=KEYS):
    """Every day with a flag; a flagged day appears once per household."""
    marks = flagged.select(*keys, "date", F.lit(True).alias("_mark"))
    return daily.join(marks, [*keys, "date"], "left").withColumn(
        "is_anomaly", F.col("_mark").isNotNull()
    ).drop("_mark")


def flagged_days(daily, flagged, keys=KEYS):
    """Daily rows of the flagged dates only."""
    return daily.join(flagged.select(*keys, "date"), [*keys, "date"], "left_semi")


def lowest_scores(scored, n=29):
    """The n most isolated rows, ties by household and date."""
    return scored.orderBy("anomaly_score", "household_id", "date").limit(n)
