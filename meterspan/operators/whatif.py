"""What-if runs over appliance lists and saved scenarios, per household.

An appliance list is keyed by (household_id, id). Nothing here gathers an
appliance list in one task: totals and first-of-type use partial aggregates, top-n
uses a ranked filter that Spark limits per group before the shuffle."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterspan import fixed, schemas
from meterspan.functions.arrays import literal_rows
from meterspan.functions.documents import with_fields
from meterspan.functions.scalars import co2_kg, is_finite, number_or, stripped, text_or, to_number

KEYS = ("household_id",)
#: Households next to recommendations, about, in one task.
HOUSEHOLDS_IN_TASK = 1 << 16


def monthly_kwh(hours):
    return F.col("powerWatts") * F.col("quantity") * hours / 1000 * F.col("daysPerMonth")


def appliance_saving(current=None, proposed=None):
    """kWh saved by one appliance in a month, never negative."""
    current = F.col("currentDailyHours") if current is None else current
    proposed = F.col("proposedDailyHours") if proposed is None else proposed
    return F.greatest(F.lit(0.0), monthly_kwh(current) - monthly_kwh(proposed))


def simulate_appliances(appliances, households, keys=KEYS):
    """Current and proposed energy and cost per appliance at the household tariff."""
    rates = households.select(*keys, "tariff", "carbon_intensity")
    return (
        appliances.join(rates, list(keys))
        .withColumns(
            {
                "current_kwh": monthly_kwh(F.col("currentDailyHours")),
                "proposed_kwh": monthly_kwh(F.col("proposedDailyHours")),
            }
        )
        .withColumns(
            {
                "current_cost": F.col("current_kwh") * F.col("tariff"),
                "proposed_cost": F.col("proposed_kwh") * F.col("tariff"),
                "saved_kwh": F.col("current_kwh") - F.col("proposed_kwh"),
            }
        )
        .withColumn("saved_cost", F.col("current_cost") - F.col("proposed_cost"))
    )


def simulate_household(rows, keys=KEYS):
    """Household totals, savings and emissions."""
    sums = rows.groupBy(*keys).agg(
        F.sum("current_kwh").alias("current_kwh"),
        F.sum("proposed_kwh").alias("proposed_kwh"),
        F.first("tariff").alias("_tariff"),
        F.first("carbon_intensity").alias("_factor"),
    )
    current, proposed, tariff = F.col("current_kwh"), F.col("proposed_kwh"), F.col("_tariff")
    saved = F.greatest(F.lit(0.0), current - proposed)
    saved_cost = F.greatest(F.lit(0.0), current * tariff - proposed * tariff)
    return sums.select(
        *keys,
        "current_kwh",
        "proposed_kwh",
        (current * tariff).alias("current_cost"),
        (proposed * tariff).alias("proposed_cost"),
        saved_cost.alias("saved_cost"),
        (saved_cost * 12).alias("annual_saved_cost"),
        saved.alias("saved_kwh"),
        F.when(current > 0, F.greatest(F.lit(0.0), saved / current * 100))
        .otherwise(F.lit(0.0))
        .alias("reduction_pct"),
        co2_kg(saved, F.col("_factor")).alias("co2_saved_kg"),
        co2_kg(current, F.col("_factor")).alias("current_co2_kg"),
    )


def apply_preset(appliances, preset):
    """Proposed hours under one preset, within 0..24 and to a tenth of an hour."""
    rules = [r for r in fixed.PRESET_RULES if r[0] == preset]
    if not rules:
        raise ValueError(f"unknown preset {preset!r}")
    current, kept = F.col("currentDailyHours"), F.col("proposedDailyHours")

    def hours(mode, value, floor):
        if mode == "keep":
            return kept
        if mode == "set":
            return F.lit(value)
        changed = current - value if mode == "minus" else current * value
        return F.greatest(F.lit(floor), changed)

    *typed, (_, _, *rest) = rules
    proposed = hours(*rest)
    for _, kind, *rule in typed:
        proposed = F.when(F.col("type") == kind, hours(*rule)).otherwise(proposed)
    limited = F.greatest(F.lit(0.0), F.least(F.lit(24.0), proposed))
    return appliances.withColumn("proposedDailyHours", F.round(limited, 1))


def appliance_mix(rows, n=6, keys=KEYS):
    """The largest consumers with their share of the shown total."""
    window = Window.partitionBy(*keys).orderBy(F.col("current_kwh").desc(), F.col("id"))
    top = (
        rows.filter("current_kwh > 0")
        .withColumn("rank", F.row_number().over(window))
        .filter(F.col("rank") <= n)
    )
    shown = F.sum("value").over(Window.partitionBy(*keys))
    return top.select(
        *keys, "rank", "id", "name", F.round("current_kwh", 1).alias("value")
    ).withColumn("share", F.try_divide(F.col("value"), shown))


def top_savers(rows, n=4, keys=KEYS):
    """Best savings above the threshold, with the bar width against the first."""
    window = Window.partitionBy(*keys).orderBy(F.col("saved_cost").desc(), F.col("id"))
    top = (
        rows.filter(F.col("saved_cost") > fixed.MIN_RANKED_SAVING)
        .withColumn("rank", F.row_number().over(window))
        .filter(F.col("rank") <= n)
    )
    first = F.max("saved_cost").over(Window.partitionBy(*keys))
    width = F.least(F.lit(100.0), F.col("saved_cost") / first * 100)
    return top.withColumn("bar_pct", width).select(
        *keys, "rank", "id", "name", "saved_cost", "bar_pct"
    )


def costliest(rows, n=8, keys=KEYS):
    window = Window.partitionBy(*keys).orderBy(F.col("current_cost").desc(), F.col("id"))
    return rows.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)


# --- repair of stored lists -------------------------------------------------


def _first_of_id(rows, keys, needed):
    """The first usable row per id by position; ``needed`` marks a usable row.

    The ranked filter is applied per group before the shuffle. Unusable rows are
    ranked last and dropped afterwards: a filter up front would be pushed below
    the parsing and parse every document once more."""
    order = Window.partitionBy(*keys, "id").orderBy(F.col(needed).isNull(), "position")
    return (
        rows.withColumn("_rank", F.row_number().over(order))
        .filter((F.col("_rank") == 1) & F.col(needed).isNotNull())
        .drop("_rank")
    )


def repair_appliances(items, households=None, keys=KEYS):
    """Usable appliance rows out of stored objects (``position`` and ``item``).
    Rows without a plausible wattage go, the first row of an id stays, other
    fields fall back to their defaults.

    With ``households``, one that is left without rows receives the default list."""
    restored = F.concat(F.lit("a-restored-"), F.col("position").cast("string"))
    bounds = {
        "powerWatts": (F.lit(None), 0.01, 100_000),
        "quantity": (F.lit(1.0), 1, 1000),
        "currentDailyHours": (F.lit(0.0), 0, 24),
        "proposedDailyHours": (F.lit(0.0), 0, 24),
        "daysPerMonth": (F.lit(30.0), 1, 31),
    }
    fields = with_fields(items, "item", ["id", "name", "type"], list(bounds))
    repaired = fields.select(
        *keys,
        "position",
        text_or(F.col("id"), restored, 64).alias("id"),
        text_or(F.col("name"), F.lit("Unnamed device"), 80).alias("name"),
        text_or(F.col("type"), F.lit("generic"), 40).alias("type"),
        *[number_or(F.col(n), *rule).alias(n) for n, rule in bounds.items()],
    )
    kept = _first_of_id(repaired, keys, "powerWatts")
    if households is None:
        return kept
    listed = literal_rows(schemas.APPLIANCE, fixed.DEFAULT_APPLIANCES)
    filled = (
        households.select(*keys)
        .join(kept.select(*keys).distinct(), list(keys), "left_anti")
        .select(*keys, F.posexplode(listed).alias("position", "_d"))
        .select(*keys, "position", "_d.*")
    )
    return kept.unionByName(filled)


def repair_scenarios(items, keys=KEYS):
    """Saved scenarios with a valid current energy, the first of an id kept."""
    restored = F.concat(F.lit("s-restored-"), F.col("position").cast("string"))
    bounds = {
        "currentKwh": (F.lit(None), 0, 1e7),
        "proposedKwh": (F.col("currentKwh"), 0, 1e7),
        "currentCost": (F.lit(0.0), 0, 1e9),
        "proposedCost": (F.lit(0.0), 0, 1e9),
        "savedCost": (F.lit(0.0), 0, 1e9),
        "reductionPct": (F.lit(0.0), 0, 100),
    }
    fields = with_fields(items, "item", ["id", "name", "createdAt"], list(bounds))
    repaired = fields.select(
        *keys,
        "position",
        text_or(F.col("id"), restored, 64).alias("id"),
        text_or(F.col("name"), F.lit("Untitled scenario"), 80).alias("name"),
        text_or(F.col("createdAt"), F.lit("1970-01-01T00:00:00.000Z")).alias("createdAt"),
        *[number_or(F.col(n), *rule).alias(n) for n, rule in bounds.items()],
    )
    return _first_of_id(repaired, keys, "currentKwh")


def draft_errors(drafts):
    """Adds ``errors``: the fields of an appliance draft that need attention."""

    def outside(name, low, high=None, open_low=False):
        x = to_number(F.col(name).cast("string"))
        bad = ~F.coalesce(is_finite(x), F.lit(False))
        bad = bad | ((x <= low) if open_low else (x < low))
        return bad if high is None else bad | (x > high)

    checks = [
        ("name", F.length(stripped(F.coalesce("name", F.lit("")))) == 0),
        ("powerWatts", outside("powerWatts", 0, open_low=True)),
        ("quantity", outside("quantity", 1)),
        ("currentDailyHours", outside("currentDailyHours", 0, 24)),
        ("daysPerMonth", outside("daysPerMonth", 1, 31)),
    ]
    found = F.array(*[F.when(bad, F.lit(name)) for name, bad in checks])
    return drafts.withColumn("errors", F.filter(found, lambda e: e.isNotNull()))


def apply_snapshot(appliances, snapshot, keys=KEYS):
    """Proposed hours of a saved plan written over the current list by id; plan
    entries without an appliance are ignored."""
    new = snapshot.select(*keys, "id", F.col("proposedDailyHours").alias("_hours"))
    return (
        appliances.join(new, [*keys, "id"], "left")
        .withColumn("proposedDailyHours", F.coalesce("_hours", "proposedDailyHours"))
        .drop("_hours")
    )


# --- recommendations ----------------------------------------------------------


def _with_recommendations(households, keys, *columns):
    """Every household next to every entry of the fixed recommendation list. Households
    are dealt out by key before that, so that a task holds the same number of them
    however large a file is; sums by household need no other shuffle."""
    listed = literal_rows(schemas.RECOMMENDATION, fixed.RECOMMENDATIONS)
    rows = households.select(*keys, *columns)
    dealt = rows.repartition(max(1, math.ceil(rows.count() / HOUSEHOLDS_IN_TASK)), *keys)
    return dealt.select(*keys, *columns, F.explode(listed).alias("_r")).select(
        *keys, *columns, "_r.*"
    )


def price_recommendations(households, keys=KEYS):
    """Every recommendation at every household's tariff."""
    return (
        _with_recommendations(households, keys, "tariff")
        .withColumn("monthly_savings", F.col("monthly_savings_kwh") * F.col("tariff"))
        .withColumn("annual_savings", F.col("monthly_savings") * 12)
    )


def _score(column, scores):
    table = F.create_map(*[F.lit(v) for pair in scores.items() for v in pair])
    return F.element_at(table, column)


def rank_recommendations(priced, by="savings", category="All", keys=KEYS):
    """Position by savings, impact or ease; savings, then id, break ties.

    A household has one row per recommendation, so the window is short."""
    kept = priced if category == "All" else priced.filter(F.col("category") == category)
    ties = [F.col("monthly_savings").desc(), F.col("rec_id")]
    first = {
        "savings": [],
        "impact": [_score(F.col("impact"), fixed.IMPACT_SCORE).desc()],
        "ease": [_score(F.col("difficulty"), fixed.DIFFICULTY_SCORE).asc()],
    }[by]
    window = Window.partitionBy(*keys).orderBy(*first, *ties)
    return kept.withColumn("position", F.row_number().over(window))


def recommendation_totals(priced, applied=(), keys=KEYS):
    """Monthly, yearly and CO2 totals with the applied part."""
    picked = F.col("rec_id").isin(list(applied)) if applied else F.lit(False)
    saved, kwh = F.col("monthly_savings"), F.col("monthly_savings_kwh")
    return priced.groupBy(*keys).agg(
        F.sum(saved).alias("total_monthly"),
        (F.sum(saved) * 12).alias("total_annual"),
        co2_kg(F.sum(kwh) * 12).alias("total_co2_kg"),
        F.sum(F.when(picked, saved).otherwise(0.0)).alias("applied_monthly"),
    )


def category_counts(priced, keys=KEYS):
    """Recommendations per category with the All row."""
    total = priced.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    parts = priced.groupBy(*keys, "category").agg(F.count(F.lit(1)).alias("count"))
    return total.select(*keys, F.lit("All").alias("category"), "count").unionByName(parts)


def match_recommendations(appliances, households, keys=KEYS):
    """The first appliance of the target type per household and recommendation,
    and whether there is one; matched rows carry the new proposed hours."""
    firsts = appliances.groupBy(*keys, "type").agg(F.min_by("id", "position").alias("appliance_id"))
    wanted = _with_recommendations(households, keys).select(
        *keys, "rec_id", "target_type", "target_hours"
    )
    return (
        wanted.join(firsts.withColumnRenamed("type", "target_type"), [*keys, "target_type"], "left")
        .withColumn("matched", F.col("appliance_id").isNotNull())
        .withColumn(
            "proposedDailyHours", F.when(F.col("matched"), F.round("target_hours", 1))
        )
        .drop("target_hours")
    )
