"""Scalar expressions shared by the operators."""

from functools import reduce

from pyspark.sql import functions as F

from meterspan import fixed


# A plain decimal number. A cast alone would also take Java suffixes such as 1d.
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Spark's trim takes spaces only; these are the blanks of a text field.
BLANKS = " \t\n\r\x0b\x0c\u00a0\ufeff"


def stripped(text):
    return F.btrim(text, F.lit(BLANKS))


def to_number(text):
    """Number of a text field; blank counts as 0, other text as missing."""
    return F.when(stripped(text) == "", F.lit(0.0)).when(
        text.rlike(NUMBER_TEXT), text.try_cast("double")
    )


def is_finite(x):
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def round_half_up(x, places=2):
    """Half away from zero on the decimal text of the double."""
    return F.round(x, places)


def round_half_up_or_zero(x, places=2):
    """The same, with 0 for a missing or non-finite value."""
    return F.when(is_finite(x), F.round(x, places)).otherwise(F.lit(0.0))


def percent_change(current, previous):
    return F.coalesce(F.try_divide(current - previous, previous) * 100, F.lit(0.0))


def clamp(x, low, high):
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def clamp_day(x):
    """0..200 kWh; anything negative or not finite is missing."""
    return F.when(is_finite(x) & (x >= 0), F.least(F.lit(200.0), x))


def number_or(x, fallback, low=None, high=None):
    """A finite number inside the bounds, else the fallback."""
    ok = is_finite(x)
    if low is not None:
        ok = ok & (x >= low)
    if high is not None:
        ok = ok & (x <= high)
    return F.when(ok, x).otherwise(fallback)


def text_or(text, fallback, max_length=500):
    """Trimmed and cut to length; blank text takes the fallback."""
    trimmed = stripped(text)
    return F.when(F.length(trimmed) > 0, F.substring(trimmed, 1, max_length)).otherwise(fallback)


def co2_kg(kwh, factor=None):
    """Emissions at the given factor; the default stands in for a missing one."""
    default = F.lit(fixed.CO2_KG_PER_KWH)
    return kwh * (default if factor is None else F.coalesce(factor, default))


def share_of_max(x, top):
    return F.least(F.lit(1.0), F.try_divide(x, top))


def is_whole_number_text(text):
    return text.rlike(r"^\d+$")


def contains_text(columns, needle):
    """Case-insensitive search over several columns; blank needle matches all."""
    wanted = needle.strip().lower()
    if not wanted:
        return F.lit(True)
    return F.lower(F.concat_ws(" ", *columns)).contains(wanted)


def first_reason(reasons):
    """First reason whose condition holds, null when none does.

    ``reasons`` is a list of (condition that makes the row bad, text)."""
    return F.coalesce(*[F.when(bad, F.lit(text)) for bad, text in reasons])


def case_of(pairs, otherwise=None):
    """CASE from (condition, value) pairs, in order."""
    (condition, value), *rest = pairs
    chain = reduce(lambda c, p: c.when(p[0], p[1]), rest, F.when(condition, value))
    return chain if otherwise is None else chain.otherwise(otherwise)


def signed_tenths(x):
    """One decimal, with a plus sign from zero up."""
    return F.format_string("%+.1f", x)


def fixed_decimals(x, places):
    """Text with a fixed number of decimals."""
    return F.coalesce(x, F.lit(0.0)).cast(f"decimal(38,{places})").cast("string")


def zero_pad(x, width=2):
    return F.lpad(x.cast("string"), width, "0")
