"""Descriptive statistics of daily series, per household.

``percentile`` buffers the distinct values of its group. Groups here are one
household's days, bounded by the calendar; pooled columns use
``operators.quantiles`` instead."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.functions.calendar import month_key, season_code
from meterspan.functions.scalars import case_of, percent_change, share_of_max

KEYS = ("household_id",)


def _or_zero(x):
    return F.coalesce(x, F.lit(0.0))


def _labels(column, names, start=0):
    """CASE from an integer column to its label."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), column - start + 1)


def summary_statistics(daily, keys=KEYS):
    """Moments, quartiles and range; skewness and kurtosis are bias-corrected
    and null below 3 and 4 records."""
    x, n = F.col("energy_kwh"), F.col("count")
    base = daily.groupBy(*keys).agg(
        F.avg(x).alias("mean"),
        F.percentile(x, [0.25, 0.5, 0.75]).alias("_q"),
        F.stddev_samp(x).alias("std"),
        F.var_samp(x).alias("variance"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.skewness(x).alias("_g1"),
        F.kurtosis(x).alias("_g2"),
        F.count(x).alias("count"),
    )
    skew = F.try_divide(F.col("_g1") * F.sqrt(n * (n - 1)), n - 2)
    kurt = F.try_divide(((n + 1) * F.col("_g2") + 6) * (n - 1), (n - 2) * (n - 3))
    return base.select(
        *keys,
        "mean",
        F.col("_q")[1].alias("median"),
        "std",
        "variance",
        "min",
        "max",
        F.col("_q")[0].alias("q25"),
        F.col("_q")[2].alias("q75"),
        (F.col("_q")[2] - F.col("_q")[0]).alias("iqr"),
        F.when(n > 2, skew).alias("skewness"),
        F.when(n > 3, kurt).alias("kurtosis"),
        "count",
    )


def weekday_statistics(daily, keys=KEYS):
    """Weekday and weekend side by side with the ratio of their means."""
    weekend = F.weekday("date") >= 5
    columns = []
    for name, on in (("weekday", ~weekend), ("weekend", weekend)):
        x = F.when(on, F.col("energy_kwh"))
        columns += [
            F.count(x).alias(f"{name}_count"),
            F.avg(x).alias(f"{name}_mean_kwh"),
            F.median(x).alias(f"{name}_median_kwh"),
            F.stddev_samp(x).alias(f"{name}_std_kwh"),
        ]
    ratio = F.try_divide(F.col("weekend_mean_kwh"), F.col("weekday_mean_kwh"))
    return (
        daily.groupBy(*keys)
        .agg(*columns)
        .withColumn(
            "weekend_elevation_ratio",
            F.when(F.col("weekday_count") > 0, ratio).otherwise(F.lit(1.0)),
        )
    )


def with_every(df, keys, values, name):
    """One row per key and listed value: the frame for zero-filled groups."""
    wanted = F.explode(F.array(*[F.lit(v) for v in values])).alias(name)
    return df.select(*keys).distinct().select(*keys, wanted)


def day_of_week_breakdown(daily, keys=KEYS):
    """All seven days from Monday, zeros where a day has no records."""
    index = "day_index"
    found = daily.groupBy(*keys, F.weekday("date").alias(index)).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("energy_kwh").alias("mean_kwh"),
        F.median("energy_kwh").alias("median_kwh"),
        F.stddev_samp("energy_kwh").alias("std_kwh"),
    )
    return (
        with_every(daily, keys, range(7), index)
        .join(found, [*keys, index], "left")
        .select(
            *keys,
            index,
            _labels(F.col(index), fixed.WEEKDAYS_FROM_MONDAY).alias("day_name"),
            (F.col(index) >= 5).alias("is_weekend"),
            F.coalesce("count", F.lit(0)).alias("count"),
            *[_or_zero(F.col(c)).alias(c) for c in ("mean_kwh", "median_kwh", "std_kwh")],
        )
    )


def _trend(daily, keys, code, index, label, names, start):
    return (
        daily.groupBy(*keys, code.alias(index))
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("energy_kwh").alias("mean_kwh"),
            F.median("energy_kwh").alias("median_kwh"),
        )
        .withColumn(label, _labels(F.col(index), names, start))
    )


def month_trend(daily, keys=KEYS):
    """Only months present."""
    return _trend(daily, keys, F.month("date"), "month_index", "month_name", fixed.MONTHS, 1)


def season_trend(daily, keys=KEYS):
    """Only seasons present."""
    code = season_code(F.month("date"))
    return _trend(daily, keys, code, "season_code", "season_name", fixed.SEASONS, 0)


def submeter_split(daily, keys=KEYS):
    """Sub-meter Wh as kWh, the unmetered rest, and percent shares of the total."""
    parts = ["sub_1", "sub_2", "sub_3"]
    sums = daily.groupBy(*keys).agg(
        *[(F.sum(f"sub_metering_{i}") / 1000.0).alias(f"{p}_kwh") for i, p in enumerate(parts, 1)],
        F.sum("energy_kwh").alias("total_kwh"),
    )
    metered = sum((F.col(f"{p}_kwh") for p in parts[1:]), F.col("sub_1_kwh"))
    sums = sums.withColumn("unmetered_kwh", F.greatest(F.lit(0.0), F.col("total_kwh") - metered))
    total = F.col("total_kwh")
    return sums.withColumns(
        {
            f"{p}_pct": F.when(total > 0, F.col(f"{p}_kwh") / total * 100).otherwise(F.lit(0.0))
            for p in [*parts, "unmetered"]
        }
    )


def correlations(daily, keys=KEYS):
    """Pearson correlation of energy with every measure, one row per measure."""
    wide = daily.groupBy(*keys).agg(*[F.corr("energy_kwh", c).alias(c) for c in fixed.ROLLUP_COLUMNS])
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("measure"), F.col(c).alias("correlation"))
            for c in fixed.ROLLUP_COLUMNS
        ]
    )
    return wide.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.*")


def dataset_statistics(daily, keys=KEYS):
    """All blocks of the statistics report, one frame each."""
    return {
        "summary": summary_statistics(daily, keys),
        "weekday_vs_weekend": weekday_statistics(daily, keys),
        "day_of_week_breakdown": day_of_week_breakdown(daily, keys),
        "monthly_trends": month_trend(daily, keys),
        "seasonal_trends": season_trend(daily, keys),
        "submetering": submeter_split(daily, keys),
        "correlations": correlations(daily, keys),
    }


# --- windows of recent records ---------------------------------------------


def latest_records(daily, n, keys=KEYS, before=None):
    """The last n records per household, optionally before a date.

    The ranked filter becomes a per-group limit before the shuffle."""
    if before is not None:
        # A zone in the text is dropped; a time of day takes the whole day in.
        cutoff = F.lit(before).cast("timestamp_ntz")
        part_day = (cutoff > F.to_date(cutoff).cast("timestamp_ntz")).cast("int")
        daily = daily.filter(F.col("date") < F.date_add(F.to_date(cutoff), part_day))
    newest_first = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    return (
        daily.withColumn("recency", F.row_number().over(newest_first))
        .filter(F.col("recency") <= n)
    )


def window_summary(series, keys=KEYS, prefix=""):
    """Count, total, average, sample deviation (0 below two records), peak and
    low day (earliest on ties), first and last date."""
    x, day = F.col("energy_kwh"), F.col("date")
    # The earliest day wins a tie: order by value, then by the reversed date.
    age = -F.datediff(day, F.lit("1970-01-01").cast("date"))
    columns = {
        "count": F.count(F.lit(1)),
        "total": F.sum(x),
        "average": F.avg(x),
        "std_dev": F.coalesce(F.stddev_samp(x), F.lit(0.0)),
        "peak_date": F.max_by(day, F.struct(x, age)),
        "peak_kwh": F.max(x),
        "low_date": F.min_by(day, F.struct(x, -age)),
        "low_kwh": F.min(x),
        "start": F.min(day),
        "end": F.max(day),
    }
    return series.groupBy(*keys).agg(*[c.alias(prefix + n) for n, c in columns.items()])


def compare_windows(daily, days, keys=KEYS):
    """Totals of the last ``days`` records and of those before, with the change."""
    recent = latest_records(daily, 2 * days, keys)
    current, energy = F.col("recency") <= days, F.col("energy_kwh")
    out = recent.groupBy(*keys).agg(
        F.count_if(current).alias("current_count"),
        _or_zero(F.sum(F.when(current, energy))).alias("current_total"),
        F.count_if(~current).alias("previous_count"),
        _or_zero(F.sum(F.when(~current, energy))).alias("previous_total"),
    )
    change = percent_change(F.col("current_total"), F.col("previous_total"))
    return out.withColumn("change_pct", change)


def usage_status(compared):
    """Label of a period change; null when there is no earlier period."""
    change = F.col("change_pct")
    *bounded, (_, last) = fixed.USAGE_STATUS
    label = case_of([(change <= top, F.lit(text)) for top, text in bounded], F.lit(last))
    return compared.withColumn("usage_status", F.when(F.col("previous_total") != 0, label))


def moving_average(daily, n=7, keys=KEYS, name="baseline"):
    """Average over up to n records ending at the current one."""
    frame = Window.partitionBy(*keys).orderBy("date").rowsBetween(-(n - 1), 0)
    return daily.withColumn(name, F.avg("energy_kwh").over(frame))


def local_mean_estimate(daily, n=fixed.CONTEXT_DAYS, keys=KEYS):
    """Stand-in forecast from the n records before a day, null until there are n."""
    frame = Window.partitionBy(*keys).orderBy("date").rowsBetween(-n, -1)
    full = F.count("energy_kwh").over(frame) == n
    mean = F.avg("energy_kwh").over(frame)
    return daily.withColumn("local_estimate_kwh", F.when(full, mean * fixed.LOCAL_ESTIMATE_FACTOR))


def average_by_weekday(daily, keys=KEYS):
    """Sunday to Saturday, zeros where a day has no records."""
    index = "weekday_index"
    found = daily.groupBy(*keys, (F.dayofweek("date") - 1).alias(index)).agg(
        F.avg("energy_kwh").alias("average"),
        F.sum("energy_kwh").alias("total"),
        F.count(F.lit(1)).alias("days"),
    )
    return (
        with_every(daily, keys, range(7), index)
        .join(found, [*keys, index], "left")
        .select(
            *keys,
            index,
            _labels(F.col(index), fixed.WEEKDAYS_FROM_SUNDAY).alias("label"),
            _or_zero(F.col("average")).alias("average"),
            _or_zero(F.col("total")).alias("total"),
            F.coalesce("days", F.lit(0)).alias("days"),
        )
    )


def peak_weekday(by_weekday, keys=KEYS):
    """Weekday with the highest average; the first one wins a tie."""
    rank = F.struct(F.col("average"), -F.col("weekday_index"))
    return by_weekday.groupBy(*keys).agg(
        F.max_by("label", rank).alias("peak_label"), F.max("average").alias("peak_average")
    )


def month_buckets(daily, keys=KEYS):
    return (
        daily.groupBy(*keys, month_key(F.col("date")).alias("month"))
        .agg(
            F.sum("energy_kwh").alias("total"),
            F.avg("energy_kwh").alias("average"),
            F.count(F.lit(1)).alias("days"),
        )
        .withColumn(
            "label",
            F.concat(
                _labels(F.substring("month", 6, 2).cast("int"), fixed.MONTHS, 1),
                F.lit(" "),
                F.substring("month", 3, 2),
            ),
        )
    )


def histogram(df, value, bins=12, keys=KEYS):
    """Equal bins over the range, the last one closed, empty bins kept.

    Only the range per key is joined back; rows meet it by key and are counted
    with partial sums."""
    keys = list(keys)
    x = F.col(value)
    span = F.max(x) - F.min(x)
    ranges = df.groupBy(*keys).agg(
        F.min(x).alias("_low"),
        (F.when(span == 0, F.lit(1.0)).otherwise(span) / bins).alias("_width"),
    )
    place = F.floor((x - F.col("_low")) / F.col("_width")).cast("int")
    counts = (
        df.filter(x.isNotNull())
        .join(ranges, keys)
        .groupBy(*keys, F.least(F.lit(bins - 1), place).alias("bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    low, width, i = F.col("_low"), F.col("_width"), F.col("bin")
    return (
        ranges.filter("_low is not null")
        .select(*keys, "_low", "_width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .join(counts, [*keys, "bin"], "left")
        .select(
            *keys,
            "bin",
            (low + i * width).alias("from"),
            (low + (i + 1) * width).alias("to"),
            F.coalesce("_n", F.lit(0)).alias("count"),
        )
    )


def calendar_grid(daily, weeks=26, keys=KEYS):
    """One row per cell of a weeks x 7 grid that ends on the Saturday on or after
    the last day: value or null, in-range flag, share of the top value, and the
    month label on the first in-range column of a month."""
    spans = daily.groupBy(*keys).agg(
        F.min("date").alias("_first"),
        F.max("date").alias("_last"),
        F.greatest(F.max("energy_kwh"), F.lit(1.0)).alias("_top"),
    )
    # next_day is strictly later, so step back one day first.
    anchor = F.next_day(F.date_sub("_last", 1), "SAT")
    cells = spans.withColumn("_start", F.date_sub(anchor, weeks * 7 - 1)).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(weeks * 7 - 1))).alias("_cell")
    )
    cells = cells.withColumn("date", F.date_add("_start", F.col("_cell"))).select(
        *keys,
        "date",
        F.floor(F.col("_cell") / 7).cast("int").alias("week"),
        (F.col("_cell") % 7).alias("weekday"),
        F.col("date").between(F.col("_first"), F.col("_last")).alias("in_range"),
        "_top",
    )
    grid = cells.join(daily.select(*keys, "date", "energy_kwh"), [*keys, "date"], "left")
    heads = Window.partitionBy(*keys).orderBy("date")
    shown = F.when((F.col("weekday") == 0) & F.col("in_range"), F.month("date"))
    label = _labels(F.month("date"), fixed.MONTHS, 1)
    before = F.last("_month", ignorenulls=True).over(heads.rowsBetween(Window.unboundedPreceding, -1))
    return (
        grid.withColumn("_month", shown)
        .withColumn("_before", before)
        .select(
            *keys,
            "date",
            "week",
            "weekday",
            "in_range",
            F.col("energy_kwh").alias("value"),
            share_of_max(F.col("energy_kwh"), F.col("_top")).alias("intensity"),
            F.when(
                F.col("_month").isNotNull() & ~F.col("_month").eqNullSafe(F.col("_before")), label
            ).alias("month_label"),
        )
    )


def recent_days(daily, window_days=30, shown=8, keys=KEYS):
    """The newest days against their 7-day baseline inside the window, with the
    bar share of the window's peak."""
    rows = moving_average(latest_records(daily, window_days, keys), 7, keys)
    peak = F.max("energy_kwh").over(Window.partitionBy(*keys))
    diff = F.col("energy_kwh") - F.col("baseline")
    share = F.try_divide(F.col("energy_kwh"), F.col("_peak")) * 100
    return (
        rows.withColumn("_peak", peak)
        .filter(F.col("recency") <= shown)
        .select(
            *keys,
            "date",
            "recency",
            "energy_kwh",
            "baseline",
            diff.alias("diff_kwh"),
            percent_change(F.col("energy_kwh"), F.col("baseline")).alias("diff_pct"),
            F.least(F.lit(100.0), share).alias("bar_pct"),
        )
    )


def series_uniqueness(daily, keys=KEYS):
    """Rows, distinct dates and duplicates per household, by grouped counts."""
    per_date = daily.groupBy(*keys, "date").agg(F.count(F.lit(1)).alias("_n"))
    return per_date.groupBy(*keys).agg(
        F.sum("_n").alias("rows"),
        F.count(F.lit(1)).alias("distinct_dates"),
        F.count_if(F.col("_n") > 1).alias("repeated_dates"),
    )
