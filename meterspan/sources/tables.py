"""Readings, daily series, households, appliances and requests derived from the
star-schema tables. Each adapter is a projection or a grouped aggregate of the
whole table; ``SQL`` holds the same derivations for the SQL side of the checks."""

from pyspark.sql import functions as F

from meterspan import fixed

MIN_COUNT = 3  # readings per hour in these tables; a meter has 60


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _reading_columns():
    value, k = F.col("value"), F.get_json_object("props", "$.k").cast("int")
    return {
        "Global_active_power": value,
        "Global_reactive_power": k / 100.0,
        "Voltage": 230.0 + k / 10.0,
        "Global_intensity": value * 4,
        "Sub_metering_1": F.when(F.col("event_type") == "click", value).otherwise(0.0),
        "Sub_metering_2": F.when(F.col("event_type") == "view", value).otherwise(0.0),
        "Sub_metering_3": F.when(F.col("event_type") == "purchase", value).otherwise(0.0),
    }


def readings(spark, folder):
    """Typed readings of three households."""
    return readings_of(table(spark, folder, "events"))


def readings_of(events):
    return events.select(
        (F.col("user_id") % 3).alias("household_id"),
        F.col("event_id").alias("reading_id"),
        F.col("ts").alias("timestamp"),
        *[c.alias(name) for name, c in _reading_columns().items()],
    )


def raw_readings(spark, folder, one_series=False):
    """Readings as the text a meter file holds, with missing marks: single ones
    and a long run, so that some gaps stay open."""
    number = F.col("event_id")
    lost = (number % 80 == 0) | (number % 1000).between(200, 345)
    household = F.lit(0).cast("long") if one_series else F.col("user_id") % 3
    columns = _reading_columns()
    power = columns.pop("Global_active_power").cast("string")
    return table(spark, folder, "events").select(
        household.alias("household_id"),
        number.alias("reading_id"),
        F.date_format("ts", "d/M/yyyy").alias("Date"),
        F.date_format("ts", "HH:mm:ss").alias("Time"),
        F.when(lost, F.lit(fixed.MISSING_MARK)).otherwise(power).alias("Global_active_power"),
        *[c.cast("string").alias(name) for name, c in columns.items()],
    )


def daily(spark, folder, households=4):
    """Daily rollup of the order book; one series when ``households`` is 1."""
    status = F.col("o_orderstatus")

    def hundred(code):
        return F.count_if(status == code) * 100.0

    return (
        table(spark, folder, "orders")
        .groupBy(
            (F.col("o_custkey") % households).alias("household_id"),
            F.to_date("o_orderdate").alias("date"),
        )
        .agg(
            (F.sum("o_totalprice") / 60000).alias("energy_kwh"),
            F.avg("o_totalprice").alias("avg_voltage"),
            F.avg("o_custkey").alias("avg_intensity"),
            F.avg(F.col("o_orderkey") % 100).alias("avg_reactive_power"),
            hundred("O").alias("sub_metering_1"),
            hundred("F").alias("sub_metering_2"),
            hundred("P").alias("sub_metering_3"),
        )
    )


def households(spark, folder):
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("household_id"),
        (4.0 + key % 10).alias("tariff"),
        (100.0 + key % 50).alias("fixed_charge"),
        F.lit(fixed.CO2_KG_PER_KWH).alias("carbon_intensity"),
        F.lit(fixed.BILLING_DAYS).alias("billing_days"),
    )


def appliances(spark, folder):
    """Eight appliances per household, in stored order."""
    key, size = F.col("p_partkey"), F.col("p_size")
    kinds = F.array(*[F.lit(t) for t in fixed.APPLIANCE_TYPES])
    hours = (size % 25).cast("double")
    return table(spark, folder, "part").select(
        F.floor(key / 8).alias("household_id"),
        (key % 8).cast("int").alias("position"),
        F.concat(F.lit("p"), key.cast("string")).alias("id"),
        F.col("p_name").alias("name"),
        F.element_at(kinds, (size % 12).cast("int") + 1).alias("type"),
        F.col("p_retailprice").alias("powerWatts"),
        (1.0 + size % 4).alias("quantity"),
        hours.alias("currentDailyHours"),
        F.greatest(F.lit(0.0), hours - 2).alias("proposedDailyHours"),
        (20.0 + size % 11).alias("daysPerMonth"),
    )


def bill_requests(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (F.col("l_quantity") - 1).alias("daily_kwh"),
        (F.col("l_discount") * 100 + 0.0).alias("tariff_per_kwh"),
        (F.col("l_linenumber") * 60).alias("days"),
        (F.col("l_tax") * 1000 + 0.0).alias("fixed_charge_per_period"),
    )


def stored_appliances(spark, folder):
    """The appliance lists as stored JSON text, one text per household, with the
    defects a stored list can have: no id, repeated ids, odd wattage, hours out
    of range, blank names, unknown fields, entries that are no objects."""
    key, size = F.col("p_partkey"), F.col("p_size")
    text = F.concat(
        F.when(key % 8 == 7, F.lit("7,")).otherwise(F.lit("")),
        F.lit('{"extra": 1, '),
        F.when(key % 5 == 0, F.lit(""))
        .when(key % 8 == 3, F.concat(F.lit('"id": "p'), (key - 1).cast("string"), F.lit('", ')))
        .otherwise(F.concat(F.lit('"id": "p'), key.cast("string"), F.lit('", '))),
        F.lit('"name": "'),
        F.when(key % 7 == 0, F.lit("   ")).otherwise(F.concat(F.lit(" "), F.col("p_name"))),
        F.lit('", "powerWatts": '),
        F.when(key % 6 == 0, F.lit("0")).otherwise(F.col("p_retailprice").cast("string")),
        F.lit(', "quantity": '),
        (size % 4).cast("string"),
        F.lit(', "currentDailyHours": '),
        size.cast("string"),
        F.lit(', "daysPerMonth": '),
        (20 + size % 15).cast("string"),
        F.lit("}"),
    )
    return (
        table(spark, folder, "part")
        .groupBy(F.floor(key / 8).alias("household_id"))
        .agg(F.array_sort(F.collect_list(F.struct(key.alias("k"), text.alias("t")))).alias("_items"))
        .select(
            "household_id",
            F.concat(
                F.lit("["), F.array_join(F.transform("_items", lambda s: s["t"]), ", "), F.lit("]")
            ).alias("appliances_json"),
        )
    )


def stored_scenarios(spark, folder):
    """Saved plans as JSON objects, one row per plan with its place in the list;
    some lack an id or a name or hold text and numbers out of range."""
    key = F.col("o_orderkey")

    document = F.to_json(
        F.struct(
            F.when(key % 9 != 0, F.concat(F.lit("s"), (key % 3000).cast("string"))).alias("id"),
            F.when(key % 4 != 0, F.concat(F.lit(" Plan "), "o_orderpriority", F.lit(" "))).alias("name"),
            F.when(key % 11 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("createdAt"),
            F.when(key % 13 == 0, F.lit("n/a")).otherwise((key % 500).cast("string")).alias("currentKwh"),
            F.when(key % 3 == 0, F.lit(-1)).otherwise(key % 400).alias("proposedKwh"),
            F.col("o_totalprice").alias("currentCost"),
            (key % 1000).alias("savedCost"),
            (key % 150).alias("reductionPct"),
        )
    )
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("household_id"),
        key.alias("position"),
        F.try_parse_json(document).alias("item"),
    )


def stored_settings(spark, folder):
    """Settings documents derived from customers, with wrong types and gaps."""
    key = F.col("c_custkey")
    text = F.concat(
        F.lit('{"old": 1, "userName": '),
        F.when(key % 5 == 0, F.lit("17")).otherwise(F.concat(F.lit('" '), "c_name", F.lit('"'))),
        F.lit(', "electricityTariff": '),
        F.when(key % 7 == 0, F.lit('"high"'))
        .when(key % 7 == 1, F.lit("null"))
        .when(key % 7 == 2, F.concat(F.lit('"'), (key % 40).cast("string"), F.lit('"')))
        .otherwise((key % 30).cast("string")),
        F.lit(', "fixedCharges": '),
        F.when(key % 3 == 0, F.lit("true")).otherwise((key % 90).cast("string")),
        F.lit(', "notifications": {"weekly": '),
        F.when(key % 2 == 0, F.lit("false")).otherwise(F.lit('"no"')),
        F.lit("}}"),
    )
    broken = F.when(key % 17 == 0, F.lit("{")).otherwise(text)
    return table(spark, folder, "customer").select(
        key.alias("household_id"), broken.alias("settings_json")
    )


READINGS = """
events_k AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events
), readings AS (
  SELECT user_id % 3 AS household_id, event_id AS reading_id, ts AS timestamp,
    value AS global_active_power, k / 100.0 AS global_reactive_power,
    230.0 + k / 10.0 AS voltage, value * 4 AS global_intensity,
    CASE WHEN event_type = 'click' THEN value ELSE 0.0 END AS sub_metering_1,
    CASE WHEN event_type = 'view' THEN value ELSE 0.0 END AS sub_metering_2,
    CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS sub_metering_3
  FROM events_k
)"""

RAW = READINGS + """, raw AS (
  SELECT r.* REPLACE (
    date_trunc('second', timestamp) AS timestamp,
    CASE WHEN reading_id % 80 = 0 OR reading_id % 1000 BETWEEN 200 AND 345
      THEN NULL ELSE global_active_power END AS global_active_power)
  FROM readings r
)"""

_ROLLUP = """
  sum(global_active_power) / 60.0 AS energy_kwh, avg(voltage) AS avg_voltage,
  avg(global_intensity) AS avg_intensity, avg(global_reactive_power) AS avg_reactive_power,
  sum(sub_metering_1) AS sub_metering_1, sum(sub_metering_2) AS sub_metering_2,
  sum(sub_metering_3) AS sub_metering_3"""

HOURLY = READINGS + f""", hourly AS (
  SELECT household_id, date_trunc('hour', timestamp) AS datetime, {_ROLLUP}
  FROM readings WHERE global_active_power >= 0
  GROUP BY 1, 2 HAVING count(*) >= {MIN_COUNT}
)"""

HOURLY_FEATURES = HOURLY + """, hourly_all AS (
  SELECT *, year(datetime) AS year, month(datetime) AS month, day(datetime) AS day,
    hour(datetime) AS hour, dayofweek(datetime) + 1 AS day_of_week, quarter(datetime) AS quarter,
    CASE WHEN dayofweek(datetime) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN month(datetime) IN (12, 1, 2) THEN 'Winter' WHEN month(datetime) IN (3, 4, 5) THEN 'Spring'
      WHEN month(datetime) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
  FROM hourly
), hourly_features AS (
  SELECT * FROM (
    SELECT *, lag(energy_kwh, 1) OVER w AS lag_1h, lag(energy_kwh, 24) OVER w AS lag_24h,
      avg(energy_kwh) OVER (PARTITION BY household_id, year ORDER BY datetime
        ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_avg_3h,
      avg(energy_kwh) OVER (PARTITION BY household_id, year ORDER BY datetime
        ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS rolling_avg_24h,
      lead(energy_kwh, 1) OVER w AS target_next_hour_kwh
    FROM hourly_all WINDOW w AS (PARTITION BY household_id, year ORDER BY datetime))
  WHERE lag_1h IS NOT NULL AND lag_24h IS NOT NULL AND target_next_hour_kwh IS NOT NULL
)"""


def daily_sql(households=4):
    return f"""
daily AS (
  SELECT o_custkey % {households} AS household_id, CAST(o_orderdate AS DATE) AS date,
    sum(o_totalprice) / 60000 AS energy_kwh, avg(o_totalprice) AS avg_voltage,
    avg(o_custkey) AS avg_intensity, avg(o_orderkey % 100) AS avg_reactive_power,
    100.0 * count(*) FILTER (WHERE o_orderstatus = 'O') AS sub_metering_1,
    100.0 * count(*) FILTER (WHERE o_orderstatus = 'F') AS sub_metering_2,
    100.0 * count(*) FILTER (WHERE o_orderstatus = 'P') AS sub_metering_3
  FROM orders GROUP BY 1, 2
)"""


DAILY = daily_sql()


def features_sql(households=4, ewm=True):
    """Feature table in SQL: windows for lags and rolling values, a self-join on
    the row number for the exponentially weighted means."""
    over = "PARTITION BY household_id ORDER BY date"
    lags = ", ".join(
        f"lag(energy_kwh, {n}) OVER ({over}) AS lag_{n}" for n in fixed.LAGS
    )
    rolling = ", ".join(
        f"CASE WHEN rn > {n} THEN {f}(energy_kwh) OVER ({over} ROWS BETWEEN {n} PRECEDING "
        f"AND 1 PRECEDING) END AS rolling_{name}_{n}"
        for name, f in (("mean", "avg"), ("std", "stddev_samp"))
        for n in fixed.ROLLING_WINDOWS
    )
    decay = {s: f"(1.0 - 2.0 / {s + 1}.0)" for s in fixed.EWM_SPANS}
    means = ", ".join(
        f"sum(b.energy_kwh * pow({c}, a.rn - 1 - b.rn)) / sum(pow({c}, a.rn - 1 - b.rn)) AS ewm_{s}"
        for s, c in decay.items()
    )
    weighted = f"""
, weighted AS (
  SELECT a.household_id, a.date, {means}
  FROM numbered a JOIN numbered b ON a.household_id = b.household_id AND b.rn < a.rn GROUP BY 1, 2
), features AS (
  SELECT f.*, w.ewm_7, w.ewm_30 FROM windows f LEFT JOIN weighted w USING (household_id, date)
)"""
    return daily_sql(households) + f""", numbered AS (
  SELECT *, row_number() OVER ({over}) AS rn FROM daily
), windows AS (
  SELECT household_id, date, energy_kwh, avg_voltage, avg_intensity, avg_reactive_power,
    sub_metering_1, sub_metering_2, sub_metering_3, rn,
    year(date) AS year, month(date) AS month, day(date) AS day, isodow(date) - 1 AS day_of_week,
    dayofyear(date) AS day_of_year, weekofyear(date) AS week_of_year, quarter(date) AS quarter,
    CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    CAST(floor((month(date) % 12) / 3) AS INTEGER) AS season, {lags}, {rolling}
  FROM numbered
)""" + (weighted if ewm else ", features AS (SELECT * FROM windows)")


HOUSEHOLDS = """
households AS (
  SELECT c_custkey AS household_id, 4.0 + c_custkey % 10 AS tariff, 100.0 + c_custkey % 50 AS fixed_charge,
    0.79 AS carbon_intensity FROM customer
)"""

_KINDS = "[" + ", ".join(f"'{t}'" for t in fixed.APPLIANCE_TYPES) + "]"

APPLIANCES = f"""
appliances AS (
  SELECT p_partkey // 8 AS household_id, p_partkey % 8 AS position, 'p' || p_partkey AS id, p_name AS name,
    {_KINDS}[p_size % 12 + 1] AS type, p_retailprice AS power, 1.0 + p_size % 4 AS quantity,
    CAST(p_size % 25 AS DOUBLE) AS current_hours,
    greatest(0.0, CAST(p_size % 25 AS DOUBLE) - 2) AS proposed_hours, 20.0 + p_size % 11 AS days
  FROM part
)"""

SIMULATED = HOUSEHOLDS + "," + APPLIANCES + """, rows_ AS (
  SELECT a.*, h.tariff, power * quantity * current_hours / 1000 * days AS current_kwh,
    power * quantity * proposed_hours / 1000 * days AS proposed_kwh
  FROM appliances a JOIN households h USING (household_id)
), simulated AS (
  SELECT *, current_kwh * tariff AS current_cost, proposed_kwh * tariff AS proposed_cost,
    current_kwh - proposed_kwh AS saved_kwh, current_kwh * tariff - proposed_kwh * tariff AS saved_cost
  FROM rows_
)"""

SCORED = features_sql(ewm=False) + """, scored AS (
  SELECT household_id, date, energy_kwh, rolling_mean_7, rolling_std_7,
    -abs(energy_kwh - rolling_mean_7) / nullif(rolling_std_7, 0) / 100 AS anomaly_score
  FROM features WHERE rolling_mean_7 IS NOT NULL AND rolling_std_7 > 0
), flagged AS (SELECT * FROM scored WHERE anomaly_score < -0.02)"""
