"""Typing, filtering and gap filling of readings."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.session import written


def typed_readings(raw):
    """Text readings to doubles and a naive local time stamp; bad text becomes null."""
    stamp = F.try_to_timestamp(F.concat_ws(" ", "Date", "Time"), F.lit(fixed.RAW_TIME_FORMAT))
    passed = [c for c in raw.columns if c not in {"Date", "Time", *fixed.MEASURES}]
    return raw.select(
        *passed,
        stamp.cast("timestamp_ntz").alias("timestamp"),
        *[F.col(c).try_cast("double").alias(c) for c in fixed.MEASURES],
    )


def valid_readings(readings):
    """Readings with a time and a non-negative power; missing sub-meters count 0."""
    power = F.col("Global_active_power")
    return readings.filter(
        F.col("timestamp").isNotNull() & power.isNotNull() & (power >= 0)
    ).fillna(0.0, subset=fixed.SUB_METERS)


def positive_days(daily):
    """Filter of the processed-table path."""
    return daily.filter(F.col("date").isNotNull() & (F.col("energy_kwh") > 0))


def energy_series(daily):
    """Energy as a number, rows without one dropped. Sort at the sink, not here."""
    return daily.withColumn("energy_kwh", F.col("energy_kwh").try_cast("double")).na.drop(
        subset=["energy_kwh"]
    )


def missing_profile(readings, columns=tuple(fixed.MEASURES)):
    """Null count per column and the overall share over rows x columns.

    One pass with one output row, then turned into one row per column."""
    counts = readings.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    total = sum((F.col(c) for c in columns), F.lit(0))
    cells = F.col("rows") * len(columns)
    pairs = F.array(
        *[F.struct(F.lit(c).alias("measure"), F.col(c).alias("missing")) for c in columns]
    )
    return counts.select(
        F.explode(pairs).alias("p"),
        "rows",
        F.coalesce(F.try_divide(total * F.lit(100.0), cells), F.lit(0.0)).alias("overall_missing_pct"),
    ).select("p.measure", "p.missing", "rows", "overall_missing_pct")


def interpolate_gaps(
    readings,
    columns=tuple(fixed.MEASURES),
    limit=fixed.INTERPOLATION_LIMIT,
    keys=("household_id",),
    time="timestamp",
    order=("reading_id",),
    block_seconds=3600,
):
    """Linear-in-time fill between known neighbours, at most ``limit`` records
    from either side; runs at the ends take the nearest value. Readings without
    a time are left out.

    Complete readings pass through one narrow scan. For the others the series is
    cut into time blocks. A grouped count finds the blocks with a missing value;
    those and the blocks next to them hold every neighbour a gap can need, since
    a block without a gap ends and begins with known values. The list of these
    blocks is written to the shared scratch folder; its size then decides whether
    it is broadcast, so that only the readings near gaps are shuffled. Inside a
    block the neighbours come from a sorted window, across blocks from the first
    and last known values per block. Windows over a whole household see one row
    per block, at most the hours of the calendar, so a household may hold any
    share of the readings and a gap any length.
    """
    keys, columns = list(keys), list(columns)
    in_block = [*keys, "_block"]
    window, blocks = _over(in_block, [time, *order]), _over(keys, ["_block"])
    begin = F.lit("1970-01-01").cast("timestamp_ntz")
    gap = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])

    def each(text):
        return [text.format(c=c) for c in columns]

    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [time, *keys]])
    complete = readings.filter(present & ~gap)
    rows = (
        readings.withColumn("_time", F.timestamp_diff("MICROSECOND", begin, F.col(time)))
        .withColumn("_block", F.expr(f"_time div {int(block_seconds) * 1_000_000}L"))
        .filter(present & F.col("_block").isNotNull())
    )
    near_gaps = (
        rows.groupBy(*in_block)
        .agg(F.count(F.lit(1)).alias("_count"), F.max(gap).alias("_gap"))
        .selectExpr(
            *in_block,
            f"sum(_count) OVER {blocks} - _count AS _offset",
            f"_gap OR lag(_gap, 1, false) OVER {blocks} OR lead(_gap, 1, false) OVER {blocks} AS _near",
        )
        .filter("_near")
        .drop("_near")
    )
    near_gaps = written(near_gaps, "near-gaps")
    marks = (
        rows.join(near_gaps, in_block)
        .selectExpr("*", f"_offset + row_number() OVER {window} AS _place")
        .selectExpr(
            "*",
            *each(
                "CASE WHEN `{c}` IS NOT NULL THEN struct(_place AS i, _time AS t, `{c}` AS x) END AS `_mark_{c}`"
            ),
        )
    )
    # Structs compare by their first field, the place in the series.
    edges = (
        marks.groupBy(*in_block)
        .agg(
            *[F.expr(text) for text in each("min(`_mark_{c}`) AS `_head_{c}`")],
            *[F.expr(text) for text in each("max(`_mark_{c}`) AS `_tail_{c}`")],
        )
        .selectExpr(
            *in_block,
            *each(f"lag(`_tail_{{c}}`) IGNORE NULLS OVER {blocks} AS `_prior_{{c}}`"),
            *each(f"lead(`_head_{{c}}`) IGNORE NULLS OVER {blocks} AS `_later_{{c}}`"),
        )
    )
    joined = (
        marks.selectExpr(
            *[f"`{c}`" for c in [*readings.columns, "_block", "_place", "_time"]],
            *each(f"lag(`_mark_{{c}}`) IGNORE NULLS OVER {window} AS `_before_{{c}}`"),
            *each(f"lead(`_mark_{{c}}`) IGNORE NULLS OVER {window} AS `_after_{{c}}`"),
        )
        .filter(gap)
        .join(edges, in_block)
        .selectExpr(
            *[f"`{c}`" for c in [*readings.columns, "_place", "_time"]],
            *each("coalesce(`_before_{c}`, `_prior_{c}`) AS `_a_{c}`"),
            *each("coalesce(`_after_{c}`, `_later_{c}`) AS `_b_{c}`"),
        )
    )
    # Without a neighbour on one side the value of the other is taken.
    between = (
        "`_a_{c}`.x + (`_b_{c}`.x - `_a_{c}`.x) * "
        "coalesce(try_divide(_time - `_a_{c}`.t, `_b_{c}`.t - `_a_{c}`.t), 0D)"
    )
    filled = (
        "coalesce(`{c}`, CASE WHEN _place - `_a_{c}`.i <= LIMIT OR `_b_{c}`.i - _place <= LIMIT "
        f"THEN coalesce({between}, `_a_{{c}}`.x, `_b_{{c}}`.x) END) AS `{{c}}`"
    ).replace("LIMIT", str(int(limit)))
    repaired = joined.selectExpr(
        *[filled.format(c=c) if c in columns else f"`{c}`" for c in readings.columns]
    )
    return complete.unionByName(repaired)


def _over(keys, order):
    """Window text; lag and lead over non-null entries exist in SQL text only."""
    by, sort = (", ".join(f"`{c}`" for c in group) for group in (keys, order))
    return f"(PARTITION BY {by} ORDER BY {sort})"
