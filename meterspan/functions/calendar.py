"""Calendar expressions. Two weekday conventions exist side by side:
Monday = 0 at the daily grain and Sunday = 1 at the hourly grain."""

from pyspark.sql import functions as F

from meterspan import fixed


def season_code(month):
    """0 winter, 1 spring, 2 summer, 3 autumn."""
    return F.floor((month % 12) / 3).cast("int")


def season_label(month, names=fixed.SEASONS):
    return F.element_at(F.array(*[F.lit(n) for n in names]), season_code(month) + 1)


def daily_calendar(date):
    """The nine calendar features, in model order."""
    weekday = F.weekday(date)
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": weekday,
        "day_of_year": F.dayofyear(date),
        "week_of_year": F.weekofyear(date),
        "quarter": F.quarter(date),
        "is_weekend": (weekday >= 5).cast("int"),
        "season": season_code(F.month(date)),
    }


def hourly_calendar(ts):
    """Temporal columns of the hourly table (Sunday = 1, weekend 1 and 7)."""
    weekday = F.dayofweek(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "day_of_week": weekday,
        "quarter": F.quarter(ts),
        "is_weekend": weekday.isin(1, 7).cast("int"),
        "season": season_label(F.month(ts), fixed.SEASONS_HOURLY),
    }


def hour_start(ts):
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def iso_date(date):
    return F.date_format(date, "yyyy-MM-dd")


def month_key(date):
    return F.date_format(date, "yyyy-MM")


def next_day(date, days=1):
    return F.date_add(date, days)


def relative_label(date, today):
    """today / yesterday / tomorrow / in n days / n days ago."""
    n = F.datediff(date, today)
    return (
        F.when(n == 0, "today")
        .when(n == -1, "yesterday")
        .when(n == 1, "tomorrow")
        .when(n < 0, F.concat(F.abs(n).cast("string"), F.lit(" days ago")))
        .when(n > 0, F.concat(F.lit("in "), n.cast("string"), F.lit(" days")))
    )


def shift_dates(df, columns, days=fixed.DATE_SHIFT_DAYS):
    """Move the date columns; calendar columns present are computed afresh."""
    moved = {c: F.date_add(F.col(c), days) for c in columns}
    out = df.withColumns(moved)
    stale = [c for c in fixed.CALENDAR_FEATURES if c in df.columns]
    if stale:
        fresh = daily_calendar(F.col(columns[0]))
        out = out.withColumns({c: fresh[c] for c in stale})
    return out
