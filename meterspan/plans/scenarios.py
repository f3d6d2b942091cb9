"""What-if runs over appliance lists, saved plans and recommendations."""

from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.operators import state, whatif
from meterspan.plans.registry import query, r, report, small, whole
from meterspan.sources import readers
from meterspan.sources import tables as t

SNAPSHOT_EVERY = 3


def simulated(spark, folder):
    return whatif.simulate_appliances(t.appliances(spark, folder), t.households(spark, folder))


_COSTS = ["current_kwh", "proposed_kwh", "current_cost", "proposed_cost", "saved_kwh", "saved_cost"]


@query(
    "whatif_rows",
    f"WITH {t.SIMULATED} SELECT household_id, id, type, {r(*_COSTS)} FROM simulated",
)
def whatif_rows(spark, folder):
    return report(simulated(spark, folder).select("household_id", "id", "type", *_COSTS))


_TOTALS = f"""{t.SIMULATED}, sums AS (
  SELECT household_id, any_value(tariff) AS tariff, sum(current_kwh) AS c, sum(proposed_kwh) AS p
  FROM simulated GROUP BY 1
)"""


@query(
    "whatif_totals",
    f"""WITH {_TOTALS} SELECT household_id, {r('c AS current_kwh', 'p AS proposed_kwh', 'c * tariff AS current_cost',
  'p * tariff AS proposed_cost', 'greatest(0, c * tariff - p * tariff) AS saved_cost',
  'greatest(0, c * tariff - p * tariff) * 12 AS annual_saved_cost', 'greatest(0, c - p) AS saved_kwh',
  'CASE WHEN c > 0 THEN greatest(0, (c - p) / c * 100) ELSE 0 END AS reduction_pct',
  'greatest(0, c - p) * 0.79 AS co2_saved_kg', 'c * 0.79 AS current_co2_kg', digits=5)} FROM sums""",
)
def whatif_totals(spark, folder):
    return report(whatif.simulate_household(simulated(spark, folder)), 5)


_PRESET_SQL = {
    "ac": "CASE WHEN type = 'ac' THEN greatest(1, current_hours - 2) ELSE proposed_hours END",
    "efficient": """CASE type WHEN 'ac' THEN 5 WHEN 'water_heater' THEN 1 WHEN 'tv' THEN 3 WHEN 'fan' THEN 8
      WHEN 'lights' THEN 4 WHEN 'washing_machine' THEN 0.8 ELSE greatest(0.5, current_hours * 0.75) END""",
    "standby": """CASE type WHEN 'tv' THEN current_hours * 0.7 WHEN 'lights' THEN current_hours * 0.8
      ELSE proposed_hours END""",
    "vacation": """CASE type WHEN 'fridge' THEN 24 WHEN 'lights' THEN 3 WHEN 'fan' THEN 6 WHEN 'tv' THEN 2
      WHEN 'water_heater' THEN 0.8 WHEN 'ac' THEN 3 WHEN 'washing_machine' THEN 0.5 ELSE proposed_hours END""",
    "reset": "current_hours",
}


@query(
    "whatif_presets",
    f"WITH {t.APPLIANCES} "
    + " UNION ALL ".join(
        f"SELECT household_id, id, '{name}' AS preset, {r(f'greatest(0, least(24, {rule})) AS proposed_hours', digits=1)} "
        "FROM appliances"
        for name, rule in _PRESET_SQL.items()
    ),
)
def whatif_presets(spark, folder):
    rows = t.appliances(spark, folder)
    frames = [
        whatif.apply_preset(rows, name).select(
            "household_id", "id", F.lit(name).alias("preset"), F.col("proposedDailyHours").alias("proposed_hours")
        )
        for name in _PRESET_SQL
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return report(out)


@query(
    "single_savings",
    f"WITH {t.SIMULATED} SELECT household_id, id, {r('greatest(0, current_kwh - proposed_kwh) AS saving_kwh')} FROM simulated",
)
def single_savings(spark, folder):
    rows = t.appliances(spark, folder)
    return report(rows.select("household_id", "id", whatif.appliance_saving().alias("saving_kwh")))


@query(
    "appliance_mix",
    f"""WITH {t.SIMULATED}, top AS (
  SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY current_kwh DESC, id) AS rank FROM simulated
  WHERE current_kwh > 0
), shown AS (SELECT *, CAST(round(CAST(CAST(current_kwh AS VARCHAR) AS DECIMAL(36,16)), 1) AS DOUBLE) AS v FROM top WHERE rank <= 6)
SELECT household_id, {small('rank')}, id, name, {r('v AS value', 'v / sum(v) OVER (PARTITION BY household_id) AS share')}
FROM shown""",
)
def appliance_mix(spark, folder):
    return report(whatif.appliance_mix(simulated(spark, folder)))


@query(
    "top_savers",
    f"""WITH {t.SIMULATED}, top AS (
  SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY saved_cost DESC, id) AS rank FROM simulated
  WHERE saved_cost > 0.5
) SELECT household_id, {small('rank')}, id, name, {r('saved_cost',
  'least(100, saved_cost / max(saved_cost) OVER (PARTITION BY household_id) * 100) AS bar_pct')}
FROM top WHERE rank <= 4""",
)
def top_savers(spark, folder):
    return report(whatif.top_savers(simulated(spark, folder)))


@query(
    "costliest_appliances",
    f"""WITH {t.SIMULATED}, top AS (
  SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY current_cost DESC, id) AS rank FROM simulated
) SELECT household_id, {small('rank')}, id, {r('current_cost')} FROM top WHERE rank <= 8""",
)
def costliest_appliances(spark, folder):
    top = whatif.costliest(simulated(spark, folder))
    return report(top.select("household_id", "rank", "id", "current_cost"))


def stored_items(spark, folder):
    return readers.json_rows(t.stored_appliances(spark, folder), "appliances_json", ["household_id"])


# Entry 7 of a list is preceded by a bare number, which takes a place of its own.
_REPAIRED = f"""given AS (
  SELECT p_partkey // 8 AS household_id, p_partkey % 8 + CASE WHEN p_partkey % 8 = 7 THEN 1 ELSE 0 END AS position,
    p_partkey AS k, * FROM part WHERE p_partkey % 6 <> 0
), named AS (
  SELECT *, CASE WHEN k % 5 = 0 THEN 'a-restored-' || position WHEN k % 8 = 3 THEN 'p' || (k - 1)
    ELSE 'p' || k END AS id FROM given
), first AS (SELECT *, row_number() OVER (PARTITION BY household_id, id ORDER BY position) AS i FROM named),
repaired AS (
  SELECT household_id, position, id, CASE WHEN k % 7 = 0 THEN 'Unnamed device' ELSE p_name END AS name,
    'generic' AS type, p_retailprice AS power, CASE WHEN p_size % 4 >= 1 THEN p_size % 4 ELSE 1 END AS quantity,
    CASE WHEN p_size <= 24 THEN p_size ELSE 0 END AS current_hours, 0 AS proposed_hours,
    CASE WHEN 20 + p_size % 15 <= 31 THEN 20 + p_size % 15 ELSE 30 END AS days FROM first WHERE i = 1
), defaults(position, id, name, type, power, quantity, current_hours, proposed_hours, days) AS (VALUES {', '.join(
    f"({i}, '{a[0]}', '{a[1]}', '{a[2]}', {a[3]}, {a[4]}, {a[5]}, {a[6]}, {a[7]})"
    for i, a in enumerate(fixed.DEFAULT_APPLIANCES))}
), lists AS (
  SELECT * FROM repaired
  UNION ALL SELECT c_custkey, defaults.* FROM customer, defaults
    WHERE c_custkey NOT IN (SELECT household_id FROM repaired)
)"""


@query(
    "appliance_repair",
    f"""WITH {_REPAIRED} SELECT household_id, {small('position')}, id, name, type, {r('power AS power_watts', 'quantity',
  'current_hours', 'proposed_hours', 'days')} FROM lists""",
)
def appliance_repair(spark, folder):
    lists = whatif.repair_appliances(stored_items(spark, folder), t.households(spark, folder))
    return report(
        lists.select(
            "household_id",
            "position",
            "id",
            "name",
            "type",
            F.col("powerWatts").alias("power_watts"),
            "quantity",
            F.col("currentDailyHours").alias("current_hours"),
            F.col("proposedDailyHours").alias("proposed_hours"),
            F.col("daysPerMonth").alias("days"),
        )
    )


@query(
    "state_json",
    f"""SELECT p_partkey // 8 AS household_id, count(*) AS objects,
  {whole('max(p_partkey % 8 + CASE WHEN p_partkey % 8 = 7 THEN 1 ELSE 0 END) AS last_position')} FROM part GROUP BY 1""",
)
def state_json(spark, folder):
    return (
        stored_items(spark, folder)
        .groupBy("household_id")
        .agg(F.count(F.lit(1)).alias("objects"), F.max("position").cast("long").alias("last_position"))
    )


@query(
    "appliance_validate",
    """SELECT p_partkey // 8 AS household_id, p_partkey AS draft, concat_ws(',',
  CASE WHEN p_partkey % 7 = 0 THEN 'name' END, CASE WHEN p_partkey % 6 = 0 THEN 'powerWatts' END,
  CASE WHEN p_size % 4 < 1 THEN 'quantity' END, CASE WHEN p_size > 24 THEN 'currentDailyHours' END,
  CASE WHEN 20 + p_size % 15 > 31 THEN 'daysPerMonth' END) AS errors FROM part""",
)
def appliance_validate(spark, folder):
    key, size = F.col("p_partkey"), F.col("p_size")
    drafts = t.table(spark, folder, "part").select(
        F.floor(key / 8).alias("household_id"),
        key.alias("draft"),
        F.when(key % 7 != 0, F.col("p_name")).alias("name"),
        F.when(key % 6 == 0, F.lit("watts")).otherwise(F.col("p_retailprice").cast("string")).alias("powerWatts"),
        (size % 4).alias("quantity"),
        size.alias("currentDailyHours"),
        (20 + size % 15).alias("daysPerMonth"),
    )
    checked = whatif.draft_errors(drafts)
    return checked.select("household_id", "draft", F.array_join("errors", ",").alias("errors"))


@query(
    "snapshot_apply",
    f"""WITH {t.APPLIANCES} SELECT household_id, id, {r(f'''CASE WHEN CAST(substr(id, 2) AS BIGINT) % {SNAPSHOT_EVERY} = 0
  THEN 1.5 ELSE proposed_hours END AS proposed_hours''')} FROM appliances""",
)
def snapshot_apply(spark, folder):
    """A saved plan that names every third appliance and some that are gone."""
    rows = t.appliances(spark, folder)
    number = F.substring("id", 2, 20).cast("long")
    named = rows.filter(number % SNAPSHOT_EVERY == 0)
    gone = named.withColumn("id", F.concat(F.lit("gone-"), "id"))
    plan = named.unionByName(gone).withColumn("proposedDailyHours", F.lit(1.5))
    applied = whatif.apply_snapshot(rows, plan)
    return report(applied.select("household_id", "id", F.col("proposedDailyHours").alias("proposed_hours")))


@query(
    "scenario_repair",
    f"""WITH named AS (
  SELECT o_custkey AS household_id, o_orderkey AS k, CASE WHEN o_orderkey % 9 <> 0 THEN 's' || (o_orderkey % 3000)
    ELSE 's-restored-' || o_orderkey END AS id, * FROM orders WHERE o_orderkey % 13 <> 0
), first AS (SELECT *, row_number() OVER (PARTITION BY household_id, id ORDER BY k) AS i FROM named)
SELECT household_id, k AS position, id, CASE WHEN k % 4 <> 0 THEN 'Plan ' || o_orderpriority
  ELSE 'Untitled scenario' END AS name, CASE WHEN k % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d')
  ELSE '1970-01-01T00:00:00.000Z' END AS created_at,
  {r('k % 500 AS current_kwh', 'CASE WHEN k % 3 = 0 THEN k % 500 ELSE k % 400 END AS proposed_kwh',
     'o_totalprice AS current_cost', '0 AS proposed_cost', 'k % 1000 AS saved_cost',
     'CASE WHEN k % 150 <= 100 THEN k % 150 ELSE 0 END AS reduction_pct')} FROM first WHERE i = 1""",
)
def scenario_repair(spark, folder):
    repaired = whatif.repair_scenarios(t.stored_scenarios(spark, folder))
    names = {
        "createdAt": "created_at",
        "currentKwh": "current_kwh",
        "proposedKwh": "proposed_kwh",
        "currentCost": "current_cost",
        "proposedCost": "proposed_cost",
        "savedCost": "saved_cost",
        "reductionPct": "reduction_pct",
    }
    return report(repaired.withColumnsRenamed(names))


_RECS = f"""{t.HOUSEHOLDS}, recs(rec_id, category, kwh, impact, difficulty, target_type, target_hours) AS (VALUES {
    ', '.join(str(rec) for rec in fixed.RECOMMENDATIONS)}),
priced AS (SELECT household_id, recs.*, kwh * tariff AS monthly_savings FROM households, recs)"""


def priced(spark, folder):
    return whatif.price_recommendations(t.households(spark, folder))


_RANKS = {
    "savings": "",
    "impact": "CASE impact WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END DESC,",
    "ease": "CASE difficulty WHEN 'Very Easy' THEN 1 WHEN 'Easy' THEN 2 WHEN 'Medium' THEN 3 ELSE 4 END,",
}


@query(
    "recommendation_rank",
    f"""WITH {_RECS} SELECT household_id, rec_id, {r('monthly_savings', 'monthly_savings * 12 AS annual_savings')}, """
    + ", ".join(
        f"CAST(row_number() OVER (PARTITION BY household_id ORDER BY {rule} monthly_savings DESC, rec_id) AS INTEGER)"
        f" AS by_{name}"
        for name, rule in _RANKS.items()
    )
    + " FROM priced",
)
def recommendation_rank(spark, folder):
    out = priced(spark, folder)
    for by in _RANKS:
        out = whatif.rank_recommendations(out, by).withColumnRenamed("position", f"by_{by}")
    return report(
        out.select("household_id", "rec_id", "monthly_savings", "annual_savings", *[f"by_{n}" for n in _RANKS])
    )


@query(
    "recommendation_totals",
    f"""WITH {_RECS} SELECT household_id, {r('sum(monthly_savings) AS total_monthly',
  'sum(monthly_savings) * 12 AS total_annual', 'sum(kwh) * 12 * 0.79 AS total_co2_kg',
  "sum(CASE WHEN rec_id IN ('rec-fans', 'rec-geyser') THEN monthly_savings ELSE 0 END) AS applied_monthly")}
FROM priced GROUP BY household_id""",
)
def recommendation_totals(spark, folder):
    applied = ["rec-fans", "rec-geyser"]
    return report(whatif.recommendation_totals(priced(spark, folder), applied))


@query(
    "recommendation_categories",
    f"""WITH {_RECS} SELECT household_id, 'All' AS category, count(*) AS count FROM priced GROUP BY 1
UNION ALL SELECT household_id, category, count(*) FROM priced GROUP BY 1, 2""",
)
def recommendation_categories(spark, folder):
    return whatif.category_counts(priced(spark, folder))


@query(
    "recommendation_match",
    f"""WITH {_RECS}, {t.APPLIANCES}, firsts AS (
  SELECT household_id, type, arg_min(id, position) AS appliance_id FROM appliances GROUP BY 1, 2
) SELECT p.household_id, rec_id, target_type, appliance_id, appliance_id IS NOT NULL AS matched,
  {r('CASE WHEN appliance_id IS NOT NULL THEN target_hours END AS hours', digits=1)}
FROM priced p LEFT JOIN firsts f ON f.household_id = p.household_id AND f.type = p.target_type""",
)
def recommendation_match(spark, folder):
    matched = whatif.match_recommendations(t.appliances(spark, folder), t.households(spark, folder))
    return report(matched.withColumnRenamed("proposedDailyHours", "hours"))


@query(
    "profile_export",
    f"""WITH {_TOTALS}, plans AS (
  SELECT o_custkey AS household_id, count(DISTINCT CASE WHEN o_orderkey % 9 <> 0 THEN 's' || (o_orderkey % 3000)
    ELSE 's-restored-' || o_orderkey END) AS n FROM orders WHERE o_orderkey % 13 <> 0 GROUP BY 1
), lists AS (
  SELECT household_id, string_agg(id, ',' ORDER BY position) AS ids FROM appliances GROUP BY 1
) SELECT h.household_id, CAST(0 AS BIGINT) AS part, {r('h.tariff AS tariff')}, ids AS appliance_ids,
  CASE WHEN n IS NULL THEN 0 ELSE CAST(n AS INTEGER) END AS scenarios,
  {r('CASE WHEN c IS NOT NULL THEN greatest(0, c * s.tariff - p * s.tariff) END AS saved_cost', digits=5)}
FROM households h LEFT JOIN lists l USING (household_id) LEFT JOIN plans USING (household_id)
LEFT JOIN sums s USING (household_id)""",
)
def profile_export(spark, folder):
    """The nested documents, read back flat for the comparison."""
    profiles = state.export_profiles(
        t.households(spark, folder).select("household_id", "tariff", "fixed_charge", "billing_days"),
        t.appliances(spark, folder),
        whatif.repair_scenarios(t.stored_scenarios(spark, folder)),
        whatif.simulate_household(simulated(spark, folder)),
    )
    ids = F.transform("appliances", lambda a: a["id"])
    return report(
        profiles.select(
            "household_id",
            "part",
            F.col("settings.tariff").alias("tariff"),
            F.array_join(ids, ",").alias("appliance_ids"),
            F.coalesce(F.size("scenarios"), F.lit(0)).alias("scenarios"),
            F.col("simulation.saved_cost").alias("saved_cost"),
        ),
        5,
    )
