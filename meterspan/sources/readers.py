"""Scans. Schemas are always given, never inferred: inference reads the data twice."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterspan import fixed, schemas
from meterspan.functions.documents import is_object, items
from meterspan.functions.scalars import is_whole_number_text, stripped


def raw_readings(spark, path, household_id=0):
    """Semicolon-separated meter file of one household, every field as text.

    ``reading_id`` keeps the file order of readings that share a time stamp."""
    return (
        spark.read.schema(schemas.RAW_FILE)
        .option("sep", ";")
        .option("header", True)
        .csv(path)
        .select(
            F.lit(household_id).cast("long").alias("household_id"),
            F.monotonically_increasing_id().alias("reading_id"),
            "*",
        )
    )


def daily_table(spark, path, fmt="parquet"):
    """Typed daily table; as CSV it carries a ``datetime`` text column."""
    if fmt == "parquet":
        return spark.read.schema(schemas.DAILY).parquet(path)
    fields = [f"{c} double" for c in fixed.ROLLUP_COLUMNS]
    frame = (
        spark.read.schema(", ".join(["datetime string", *fields])).option("header", True).csv(path)
    )
    return frame.select(
        F.lit(0).cast("long").alias("household_id"),
        F.col("datetime").try_cast("date").alias("date"),
        *fixed.ROLLUP_COLUMNS,
    )


def feature_table(spark, path):
    """The daily feature table as it was written, with its agreed types."""
    return spark.read.schema(schemas.FEATURES).parquet(path)


def readings_or_daily(spark, raw_path=None, processed_path=None, household_id=0):
    """The raw file when it is there, else the processed table, else an error.

    Returns the frame and whether it holds raw readings."""
    if raw_path:
        try:
            return raw_readings(spark, raw_path, household_id), True
        except AnalysisException:
            if not processed_path:
                raise
    if not processed_path:
        raise FileNotFoundError("neither a raw file nor a processed table was given")
    return daily_table(spark, processed_path, "csv"), False


def metric_table(spark, path, schema=schemas.MODEL_COMPARISON):
    """Small metric table; spaces around column names are dropped."""
    frame = spark.read.option("header", True).csv(path)
    frame = frame.toDF(*[c.strip() for c in frame.columns])
    return frame.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def optional_table(spark, path, schema, fmt="csv"):
    """An absent table reads as an empty one."""
    reader = spark.read.schema(schema)
    try:
        return reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def grouped_summary(spark, path, schema=schemas.CLUSTER_SUMMARY):
    """Summary file with two header lines and an index line: only rows with a
    whole-number key are data."""
    text = ", ".join(f"{f.name} string" for f in schema)
    frame = spark.read.schema(text).option("header", False).csv(path)
    key = schema.fields[0].name
    return frame.filter(is_whole_number_text(F.col(key))).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    )


def forgiving_csv(spark, path, columns):
    """Quoted, ragged CSV without header; short rows are padded, blank rows dropped."""
    frame = (
        spark.read.schema(", ".join(f"{c} string" for c in columns))
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    blank = F.concat_ws("", *[stripped(F.coalesce(F.col(c), F.lit(""))) for c in columns]) == ""
    return frame.filter(~blank)


def json_rows(df, column, keep):
    """One row per object of a JSON array column: its position and ``item``.

    Text that is no JSON array gives no rows; neither do entries that are no
    objects."""
    return df.select(*keep, F.posexplode(items(F.col(column))).alias("position", "item")).filter(
        is_object(F.col("item"))
    )
