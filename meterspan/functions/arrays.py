"""Expressions over the context vector: the last 30 daily values, oldest first."""

from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.functions.scalars import first_reason, is_finite, to_number


def parse_vector(text):
    """Finite numbers of a pasted list, in order; anything else is skipped."""
    return F.filter(F.transform(F.split(text, r"[\s,;]+"), to_number), is_finite)


def vector_reason(values, size=fixed.CONTEXT_DAYS):
    """Why a context vector cannot be used; null when it can."""
    return first_reason(
        [
            (values.isNull() | (F.size(values) != size), f"Exactly {size} consumption values are required."),
            (
                ~F.forall(values, is_finite),
                "Consumption values must be finite numbers.",
            ),
            (F.exists(values, lambda x: x < 0), "Consumption values cannot be negative."),
        ]
    )


def vector_total(values):
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def vector_stats(values):
    """Average, max, min and total over the finite entries; zeros when empty."""
    finite = F.filter(values, is_finite)
    empty = F.size(finite) == 0
    zero = F.lit(0.0)
    return {
        "average": F.when(empty, zero).otherwise(vector_total(finite) / F.size(finite)),
        "max": F.when(empty, zero).otherwise(F.array_max(finite)),
        "min": F.when(empty, zero).otherwise(F.array_min(finite)),
        "total": vector_total(finite),
    }


def scale_vector(values, factor):
    return F.transform(values, lambda x: F.round(x * factor, 3))


def keep_in_range(values, low=0.0, high=100_000.0):
    """Entries inside the bounds; the rest is dropped."""
    return F.filter(values, lambda x: is_finite(x) & x.between(low, high))


def newest(values, n):
    """The last n entries."""
    return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), n)


def push(values, x, size=fixed.CONTEXT_DAYS):
    """Append one value and keep the newest ``size``."""
    return newest(F.concat(values, F.array(x)), size)


def tail_mean(values, n):
    return vector_total(newest(values, n)) / n


def tail_std(values, n):
    """Sample standard deviation of the last n entries."""
    part = newest(values, n)
    mean = vector_total(part) / n
    squares = F.aggregate(part, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.sqrt(squares / (n - 1))


def literal_rows(schema, rows):
    """A short fixed table as an array of structs, to unpack next to any row."""
    return F.array(
        *[
            F.struct(*[F.lit(x).cast(f.dataType).alias(f.name) for f, x in zip(schema, row)])
            for row in rows
        ]
    )
