"""Stored household documents: settings, predictor state, profile export."""

from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.functions.arrays import keep_in_range
from meterspan.functions.documents import number_value, with_fields
from meterspan.functions.scalars import number_or, text_or

KEYS = ("household_id",)


def repair_settings(stored, column="settings_json", keys=KEYS):
    """Known settings out of a JSON text: each keeps its value when it has the
    right type and takes its default otherwise. Unknown keys are dropped."""
    flags = fixed.SETTINGS_NOTIFICATIONS
    fields = with_fields(
        stored.withColumn("_document", F.try_parse_json(column)),
        "_document",
        list(fixed.SETTINGS_TEXTS),
        list(fixed.SETTINGS_NUMBERS),
        [f"notifications.{n}" for n in flags],
    )
    return fields.select(
        *keys,
        *[text_or(F.col(n), F.lit(d)).alias(n) for n, d in fixed.SETTINGS_TEXTS.items()],
        *[number_or(F.col(n), F.lit(d)).alias(n) for n, d in fixed.SETTINGS_NUMBERS.items()],
        F.struct(*[F.coalesce(n, F.lit(d)).alias(n) for n, d in flags.items()]).alias("notifications"),
    )


def repair_predictor(stored, column="predictor_json", keys=KEYS):
    """Predictor form state: valid daily values only, texts with their defaults."""
    parsed = stored.withColumn("_document", F.try_parse_json(column)).withColumn(
        "_entries", F.try_variant_get("_document", "$.consumption", "array<variant>")
    )
    numbers = keep_in_range(F.transform("_entries", number_value))
    none = F.array().cast("array<double>")
    return with_fields(parsed, "_document", ["targetDate", "preset"]).select(
        *keys,
        F.coalesce(numbers, none).alias("consumption"),
        text_or(F.col("targetDate"), F.lit("")).alias("target_date"),
        text_or(F.col("preset"), F.lit("benchmark")).alias("preset"),
    )


def household_limits(households):
    """Household settings inside their bounds, else the default."""
    numbers = {
        name: F.when(F.col(name).cast("double").between(low, high), F.col(name).cast("double")).otherwise(
            F.lit(default)
        )
        for name, (default, low, high) in fixed.HOUSEHOLD_NUMBERS.items()
        if name in households.columns
    }
    texts = {
        name: text_or(F.col(name), F.lit(default), longest)
        for name, (default, longest) in fixed.HOUSEHOLD_TEXTS.items()
        if name in households.columns
    }
    return households.withColumns({**numbers, **texts})


def export_profiles(settings, appliances, scenarios, totals, keys=KEYS, part_size=1000):
    """Nested documents: settings, appliances, scenarios and totals per household.

    A household is one document, part 0, unless its lists are longer than
    ``part_size``: then they are dealt to as many parts as needed, each carrying
    the settings and totals, so that no task holds a list of any length. Entries
    keep their ``position``: sorted by it over all parts, they are the stored list."""
    keys = list(keys)
    by_part = [*keys, "part"]

    def listed(df, name, order):
        fields = [c for c in df.columns if c not in keys and c != order]
        entry = F.struct(order, *fields)
        sizes = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / part_size).alias("_parts"))
        return (
            df.join(sizes, keys)
            .withColumn("part", F.pmod(F.xxhash64(order), F.col("_parts")))
            .groupBy(*by_part)
            .agg(F.array_sort(F.collect_list(entry)).alias(name))
        )

    fields = [c for c in settings.columns if c not in keys]
    sums = [c for c in totals.columns if c not in keys]
    first = settings.select(*keys, F.lit(0).cast("long").alias("part"))
    return (
        first.join(listed(appliances, "appliances", "position"), by_part, "full_outer")
        .join(listed(scenarios, "scenarios", "position"), by_part, "full_outer")
        .join(settings.select(*keys, F.struct(*fields).alias("settings")), keys)
        .join(totals.select(*keys, F.struct(*sums).alias("simulation")), keys, "left")
    )
