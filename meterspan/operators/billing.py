"""Flat-tariff bills and household settings."""

from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.functions.scalars import co2_kg, first_reason, is_finite, round_half_up

KEYS = ("household_id",)


def bill_reason(daily, tariff, days, fixed_charge):
    """Why a bill request is refused; null when it is fine."""
    reasons = fixed.BILL_REASONS

    def finite(x):
        return F.coalesce(is_finite(x), F.lit(False))

    return first_reason(
        [
            (~finite(daily) | (daily <= 0), reasons["daily"]),
            (~finite(tariff) | (tariff <= 0), reasons["tariff"]),
            (
                ~finite(days) | (days != F.floor(days)) | ~days.between(1, fixed.MAX_BILLING_DAYS),
                reasons["days"],
            ),
            (~finite(fixed_charge) | (fixed_charge < 0), reasons["fixed"]),
        ]
    )


def check_bills(requests):
    """Adds ``reject_reason`` to requests with daily_kwh, tariff_per_kwh, days
    and fixed_charge_per_period; absent days and charge take the defaults."""
    filled = requests.withColumns(
        {
            "days": F.coalesce(F.col("days").cast("double"), F.lit(float(fixed.BILLING_DAYS))),
            "fixed_charge_per_period": F.coalesce(F.col("fixed_charge_per_period"), F.lit(0.0)),
        }
    )
    columns = ["daily_kwh", "tariff_per_kwh", "days", "fixed_charge_per_period"]
    return filled.withColumn("reject_reason", bill_reason(*[F.col(c) for c in columns]))


def compute_bills(checked):
    """Bills of the accepted requests. Only the outputs are rounded, and the
    standing charge is added once for the period."""
    consumption = F.col("daily_kwh") * F.col("days")
    charge = consumption * F.col("tariff_per_kwh")
    inputs = {"daily_kwh", "tariff_per_kwh", "days", "fixed_charge_per_period", "reject_reason"}
    passed = [c for c in checked.columns if c not in inputs]
    return checked.filter("reject_reason is null").select(
        *passed,
        F.col("days").cast("int").alias("period_days"),
        round_half_up(F.col("daily_kwh"), 3).alias("predicted_daily_kwh"),
        round_half_up(consumption, 3).alias("consumption_kwh"),
        round_half_up(F.col("tariff_per_kwh"), 4).alias("tariff_per_kwh"),
        round_half_up(charge, 2).alias("energy_charge"),
        round_half_up(F.col("fixed_charge_per_period"), 2).alias("fixed_charge_per_period"),
        round_half_up(charge + F.col("fixed_charge_per_period"), 2).alias("estimated_bill"),
    )


def rejected_bills(checked):
    return checked.filter("reject_reason is not null")


def window_bill(summaries, households, keys=KEYS):
    """Bill and emission estimate of summarised windows (a ``total`` column).

    Both sides have one row per household; the optimizer broadcasts the smaller
    one when it is under its size threshold and merges them otherwise."""
    return (
        summaries.join(households, list(keys))
        .withColumn(
            "bill_estimate", F.col("total") * F.col("tariff") + F.coalesce("fixed_charge", F.lit(0.0))
        )
        .withColumn("co2_estimate_kg", co2_kg(F.col("total"), F.col("carbon_intensity")))
    )


def upsert_settings(current, patches, columns, keys=KEYS):
    """Settings after a batch of patches: per field the latest non-null value
    wins, fields never patched keep their current value.

    ``patches`` carries ``seq``, its order. Fields are reduced to one row per
    household with partial aggregates, so a household with most of the patches
    is no hot spot."""
    latest = patches.groupBy(*keys).agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(f"_new_{c}")
            for c in columns
        ]
    )
    return current.join(latest, list(keys), "left").select(
        *keys, *[F.coalesce(f"_new_{c}", c).alias(c) for c in columns]
    )


def replace_state(current, incoming, columns, keys=KEYS):
    """Whole-record upsert: the latest record per household replaces the old one,
    new households are added."""
    latest = (
        incoming.groupBy(*keys)
        .agg(F.max_by(F.struct(*columns), "seq").alias("_s"))
        .select(*keys, F.lit(True).alias("_new"), *[F.col(f"_s.{c}").alias(f"_new_{c}") for c in columns])
    )
    return current.join(latest, list(keys), "full_outer").select(
        *keys, *[F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )


def prediction_band(predicted, mae):
    """Typical error band around a forecast, never below zero."""
    low = F.greatest(F.lit(0.0), predicted - mae)
    high = predicted + mae
    return {"lower_kwh": low, "upper_kwh": high, "width_kwh": high - low}
