"""Sinks. All write folders with overwrite semantics and keep the data distributed."""

from pyspark.sql import functions as F

from meterspan.functions.scalars import fixed_decimals


def write_csv(df, path, order=()):
    """Cells with a quote, comma or newline are quoted; a quote is doubled.

    With ``order`` the files are range-partitioned and sorted, so that they read
    in order one after the other."""
    (
        (df.orderBy(*order) if order else df)
        .write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )


def write_metrics(df, path):
    """Key-value report of a one-row metric frame."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in df.columns])
    )
    df.select(pairs.alias("m")).select("m.*").write.mode("overwrite").json(path)


def write_columnar(df, path, by=("year",)):
    """Parquet partitioned by year; the rebalance splits a year too large for one task."""
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def incident_rows(incidents):
    """The ten export columns with fixed decimals; needs a ``tariff`` column."""
    return incidents.select(
        "household_id",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "severity",
        "category",
        fixed_decimals(F.col("observed"), 3).alias("observed_kwh"),
        fixed_decimals(F.col("expected"), 3).alias("baseline_kwh"),
        fixed_decimals(F.col("deviation_kwh"), 3).alias("deviation_kwh"),
        fixed_decimals(F.col("deviation_pct"), 3).alias("deviation_pct"),
        fixed_decimals(F.col("z_score"), 3).alias("z_score"),
        fixed_decimals(F.col("excess_kwh"), 3).alias("excess_kwh"),
        fixed_decimals(F.col("excess_kwh") * F.col("tariff"), 2).alias("excess_cost"),
    )


def write_profiles(profiles, path):
    """One JSON object per household."""
    profiles.write.mode("overwrite").json(path)
