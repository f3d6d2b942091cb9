"""The list of named queries. A query is a callable (spark, folder) -> DataFrame;
where SQL can say the same, the SQL stands next to it."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES = {}
SQL = {}

# Values a hair below a rounding tie are lifted over it: engines that add in
# another order differ in the last bits and would round a tie differently.
NUDGE = 1.0000000000001


def query(name, sql=None):
    def register(build):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def report(df, digits=6):
    """Report form of a result: dates as ISO text, doubles rounded and without
    negative zero, so that engines that add in another order print the same."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double") * NUDGE, digits) + F.lit(0.0)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def r(*names, digits=6):
    """SQL side of ``report`` for doubles; ``expression AS name`` is allowed."""
    out = []
    for text in names:
        expression, _, name = text.rpartition(" AS ")
        out.append(f"round(CAST({expression or name} AS DOUBLE) * {NUDGE}, {digits}) + 0.0 AS {name}")
    return ", ".join(out)


def day(name, alias=None):
    return f"strftime({name}, '%Y-%m-%d') AS {alias or name}"


def stamp(name, alias=None):
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S') AS {alias or name}"


def whole(*names):
    """Counts as 64-bit integers; ``expression AS name`` is allowed."""
    out = []
    for text in names:
        expression, _, name = text.rpartition(" AS ")
        out.append(f"CAST({expression or name} AS BIGINT) AS {name}")
    return ", ".join(out)


def small(*names):
    return whole(*names).replace("AS BIGINT)", "AS INTEGER)")
