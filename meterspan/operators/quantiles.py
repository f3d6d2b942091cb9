"""Exact quantiles over groups of any size."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterspan.session import written


def exact_quantiles(df, value, probs, keys=(), accuracy=10_000):
    """Linearly interpolated quantiles, one row per key: columns ``q0, q1, ...``.

    The built-in exact percentile gathers all distinct values of a group in one
    buffer, which is fine for one household's days but not for a pooled column.
    Here a mergeable sketch brackets each quantile, a counting pass finds how
    many rows lie below, and only the rows in the bracket (a share of about
    4 / accuracy, equal values folded) are ranked. A bracket that misses its
    rank is widened to the whole range, so the answer is exact in every case.
    """
    keys = list(keys)
    group = keys or ["_all"]
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    if not keys:
        # One group by a value that is not folded away, so the joins keep a key.
        rows = rows.withColumn("_all", F.pmod(F.xxhash64("_v"), F.lit(1)))
    margin = 2.0 / accuracy
    cuts = [c for p in probs for c in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = rows.groupBy(*group).agg(
        F.percentile_approx("_v", cuts, accuracy).alias("_cuts"), F.count(F.lit(1)).alias("_n")
    )
    targets = sketch.select(
        *group,
        "_n",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("_i"),
                        F.lit(float(p)).alias("_p"),
                        F.col("_cuts")[2 * i].alias("_low"),
                        F.col("_cuts")[2 * i + 1].alias("_high"),
                    )
                    for i, p in enumerate(probs)
                ]
            )
        ).alias("_t"),
    ).select(*group, "_n", "_t.*")
    # One row per group and quantile. Written, their size is known, so the join
    # below broadcasts them when small and splits a large group otherwise.
    targets = written(targets.withColumn("_h", F.col("_p") * (F.col("_n") - 1)), "quantile-targets")

    per_value = rows.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_c"))
    counted = (
        per_value.join(targets, group)
        .groupBy(*group, "_i", "_n", "_h", "_low", "_high")
        .agg(
            F.sum(F.when(F.col("_v") < F.col("_low"), F.col("_c")).otherwise(0)).alias("_below"),
            F.sum(
                F.when(F.col("_v").between(F.col("_low"), F.col("_high")), F.col("_c")).otherwise(0)
            ).alias("_inside"),
        )
    )
    holds = (F.col("_below") <= F.floor("_h")) & (
        F.col("_below") + F.col("_inside") > F.ceil("_h")
    )
    brackets = counted.select(
        *group,
        "_i",
        "_h",
        F.when(holds, F.col("_low")).otherwise(F.lit(float("-inf"))).alias("_low"),
        F.when(holds, F.col("_high")).otherwise(F.lit(float("inf"))).alias("_high"),
        F.when(holds, F.col("_below")).otherwise(F.lit(0)).alias("_below"),
    )
    brackets = written(brackets, "quantile-brackets")
    ranked = (
        per_value.join(brackets, group)
        .filter(F.col("_v").between(F.col("_low"), F.col("_high")))
        .withColumn(
            "_upto",
            F.col("_below")
            + F.sum("_c").over(
                Window.partitionBy(*group, "_i")
                .orderBy("_v")
                .rowsBetween(Window.unboundedPreceding, 0)
            ),
        )
    )
    # The value at rank r (from 0) is the smallest one with more than r rows up to it.
    picked = ranked.groupBy(*group, "_i", "_h").agg(
        F.min(F.when(F.col("_upto") > F.floor("_h"), F.col("_v"))).alias("_a"),
        F.min(F.when(F.col("_upto") > F.ceil("_h"), F.col("_v"))).alias("_b"),
    )
    share = F.col("_h") - F.floor("_h")
    answer = F.col("_a") + (F.col("_b") - F.col("_a")) * share
    wide = picked.groupBy(*group).agg(
        *[F.max(F.when(F.col("_i") == i, answer)).alias(f"q{i}") for i in range(len(probs))]
    )
    return wide.drop("_all") if not keys else wide
