"""Bills, household settings and stored documents."""

from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.operators import billing, state, stats
from meterspan.plans.registry import day, query, r, report, whole
from meterspan.sources import tables as t

_REQUESTS = """requests AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity - 1 AS daily_kwh,
    l_discount * 100 + 0.0 AS tariff, l_linenumber * 60 AS days, l_tax * 1000 + 0.0 AS fixed FROM lineitem
), checked AS (
  SELECT *, CASE WHEN daily_kwh <= 0 THEN '{daily}' WHEN tariff <= 0 THEN '{tariff}'
    WHEN days NOT BETWEEN 1 AND 365 THEN '{days}' WHEN fixed < 0 THEN '{fixed}' END AS reject_reason FROM requests
)""".format(**fixed.BILL_REASONS)
_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query(
    "bill",
    f"""WITH {_REQUESTS} SELECT {_KEYS}, CAST(days AS INTEGER) AS period_days,
  {r('daily_kwh AS predicted_daily_kwh', 'daily_kwh * days AS consumption_kwh', digits=3)},
  {r('tariff AS tariff_per_kwh', digits=4)},
  {r('daily_kwh * days * tariff AS energy_charge', 'fixed AS fixed_charge_per_period',
     'daily_kwh * days * tariff + fixed AS estimated_bill', digits=2)}
FROM checked WHERE reject_reason IS NULL""",
)
def bill(spark, folder):
    return billing.compute_bills(billing.check_bills(t.bill_requests(spark, folder)))


@query("bill_rejects", f"WITH {_REQUESTS} SELECT {_KEYS}, reject_reason FROM checked WHERE reject_reason IS NOT NULL")
def bill_rejects(spark, folder):
    rejected = billing.rejected_bills(billing.check_bills(t.bill_requests(spark, folder)))
    return rejected.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "reject_reason")


@query(
    "window_bill",
    f"""WITH {t.DAILY}, {t.HOUSEHOLDS}, recent AS (
  SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY date DESC) AS recency FROM daily
), sums AS (SELECT household_id, sum(energy_kwh) AS total FROM recent WHERE recency <= 30 GROUP BY 1)
SELECT household_id, {r('total', 'total * tariff + fixed_charge AS bill_estimate',
  'total * carbon_intensity AS co2_estimate_kg')} FROM sums JOIN households USING (household_id)""",
)
def window_bill(spark, folder):
    window = stats.window_summary(stats.latest_records(t.daily(spark, folder), 30))
    bills = billing.window_bill(window, t.households(spark, folder))
    return report(bills.select("household_id", "total", "bill_estimate", "co2_estimate_kg"))


@query(
    "household_tariff",
    f"""WITH {t.DAILY}, {t.HOUSEHOLDS} SELECT household_id, {day('date')}, {r('energy_kwh * tariff AS cost')}
FROM daily JOIN households USING (household_id)""",
)
def household_tariff(spark, folder):
    priced = t.daily(spark, folder).join(t.households(spark, folder), "household_id")
    cost = F.col("energy_kwh") * F.col("tariff")
    return report(priced.select("household_id", "date", cost.alias("cost")))


def current_settings(spark, folder):
    return t.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("household_id"),
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") / 200).alias("electricity_tariff"),
        (30.0 + F.col("c_nationkey") % 4).alias("billing_days"),
    )


def settings_patches(spark, folder):
    """One patch per order; most fields of a patch are absent."""
    key = F.col("o_orderkey")
    return t.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("household_id"),
        key.alias("seq"),
        F.when(key % 3 == 0, F.concat(F.lit("Home "), key.cast("string"))).alias("name"),
        F.when(key % 2 == 0, 1.0 + key % 40).alias("electricity_tariff"),
        F.when(key % 7 == 0, 1.0 + key % 31).alias("billing_days"),
    )


_PATCHED = {
    "name": ("'Home ' || o_orderkey", "o_orderkey % 3 = 0"),
    "electricity_tariff": ("1.0 + o_orderkey % 40", "o_orderkey % 2 = 0"),
    "billing_days": ("1.0 + o_orderkey % 31", "o_orderkey % 7 = 0"),
}
_LATEST = ", ".join(f"arg_max({v}, o_orderkey) FILTER (WHERE {w}) AS n_{n}" for n, (v, w) in _PATCHED.items())


@query(
    "settings_upsert",
    f"""WITH latest AS (SELECT o_custkey AS household_id, {_LATEST} FROM orders GROUP BY 1)
SELECT c_custkey AS household_id, coalesce(n_name, c_name) AS name,
  {r('coalesce(n_electricity_tariff, c_acctbal / 200) AS electricity_tariff',
     'coalesce(n_billing_days, 30.0 + c_nationkey % 4) AS billing_days')}
FROM customer LEFT JOIN latest ON household_id = c_custkey""",
)
def settings_upsert(spark, folder):
    columns = ["name", "electricity_tariff", "billing_days"]
    return report(
        billing.upsert_settings(current_settings(spark, folder), settings_patches(spark, folder), columns)
    )


@query(
    "state_replace",
    """WITH latest AS (
  SELECT o_custkey + 100 AS household_id, arg_max(o_orderpriority, o_orderkey) AS doc, max(o_orderkey) AS version
  FROM orders GROUP BY 1
) SELECT coalesce(l.household_id, c_custkey) AS household_id, coalesce(doc, c_mktsegment) AS document,
  CAST(coalesce(version, -1) AS BIGINT) AS version FROM customer FULL JOIN latest l ON l.household_id = c_custkey""",
)
def state_replace(spark, folder):
    """Whole-document upsert; some households are new, some keep their document."""
    current = t.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("household_id"),
        F.col("c_mktsegment").alias("document"),
        F.lit(-1).cast("long").alias("version"),
    )
    incoming = t.table(spark, folder, "orders").select(
        (F.col("o_custkey") + 100).alias("household_id"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderpriority").alias("document"),
        F.col("o_orderkey").alias("version"),
    )
    return billing.replace_state(current, incoming, ["document", "version"])


@query(
    "settings_limits",
    f"""SELECT c_custkey AS household_id, c_name AS name, {r(
  'CASE WHEN c_acctbal / 150 BETWEEN 0.5 AND 50 THEN c_acctbal / 150 ELSE 8 END AS electricity_tariff',
  'CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN c_acctbal ELSE 120 END AS fixed_charges',
  'CASE WHEN c_nationkey * 2 BETWEEN 1 AND 31 THEN c_nationkey * 2 ELSE 30 END AS billing_days')} FROM customer""",
)
def settings_limits(spark, folder):
    balance = F.col("c_acctbal")
    given = t.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("household_id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("name"),
        (balance / 150).alias("electricity_tariff"),
        balance.alias("fixed_charges"),
        (F.col("c_nationkey") * 2).alias("billing_days"),
    )
    return report(state.household_limits(given))


@query(
    "settings_repair",
    f"""WITH s AS (SELECT c_custkey AS k, c_custkey % 17 = 0 AS broken, c_name FROM customer)
SELECT k AS household_id, CASE WHEN broken OR k % 5 = 0 THEN 'Homeowner' ELSE c_name END AS user_name,
  {r('''CASE WHEN broken OR k % 7 = 0 THEN 8 WHEN k % 7 = 1 THEN 0 WHEN k % 7 = 2 THEN k % 40
    ELSE k % 30 END AS electricity_tariff''',
    'CASE WHEN broken THEN 120 WHEN k % 3 = 0 THEN 1 ELSE k % 90 END AS fixed_charges',
    '30 AS billing_days')},
  CASE WHEN NOT broken AND k % 2 = 0 THEN false ELSE true END AS weekly FROM s""",
)
def settings_repair(spark, folder):
    repaired = state.repair_settings(t.stored_settings(spark, folder))
    return report(
        repaired.select(
            "household_id",
            F.col("userName").alias("user_name"),
            F.col("electricityTariff").alias("electricity_tariff"),
            F.col("fixedCharges").alias("fixed_charges"),
            F.col("billingDays").alias("billing_days"),
            F.col("notifications.weekly").alias("weekly"),
        )
    )


@query(
    "predictor_repair",
    f"""WITH {t.DAILY}, months AS (
  SELECT household_id, year(date) * 12 + month(date) AS m, energy_kwh - 4 AS x FROM daily
) SELECT household_id, CAST(m AS INTEGER) AS month_number, {whole('count(*) FILTER (WHERE x >= 0) AS kept')},
  {r('coalesce(sum(x) FILTER (WHERE x >= 0), 0) AS total')},
  CASE WHEN m % 2 = 0 THEN 'eco' ELSE 'benchmark' END AS preset FROM months GROUP BY household_id, m""",
)
def predictor_repair(spark, folder):
    """Form state per household and month; negative entries are dropped."""
    number = F.year("date") * 12 + F.month("date")
    documents = (
        t.daily(spark, folder)
        .groupBy("household_id", number.alias("month_number"))
        .agg(F.collect_list(F.col("energy_kwh") - 4).alias("consumption"))
        .withColumn("preset", F.when(F.col("month_number") % 2 == 0, F.lit("eco")).otherwise(F.lit(" ")))
        .select("*", F.to_json(F.struct("consumption", "preset")).alias("predictor_json"))
    )
    keys = ["household_id", "month_number"]
    repaired = state.repair_predictor(documents, keys=keys)
    total = F.aggregate("consumption", F.lit(0.0), lambda a, x: a + x)
    return report(
        repaired.select(*keys, F.size("consumption").cast("long").alias("kept"), total.alias("total"), "preset")
    )
