"""Forecast and usage-mode models, fitted on the pooled series of all households. Only fitted parameters and one-row metrics come to the driver."""

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.operators.clusters import ANCHORS, KMeansModel, fit_kmeans, silhouettes
from meterspan.operators.quantiles import exact_quantiles
from meterspan.operators.trees import fit_boosting, fit_forest

PARTITIONS = 8


def stable_rows(df, order, partitions=PARTITIONS):
    """The same rows in the same partitions and order on every run, so that a
    seeded fit repeats on any cluster. Hash placement does not depend on sampling.
    The number of partitions decides what MLlib samples, so it is a parameter and
    does not follow the data."""
    return df.repartition(partitions, *order).sortWithinPartitions(*order)


def assembler(columns, output="features"):
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip")


def hourly_forest(trees=50, depth=8, seed=42):
    """Next-hour regressor over the hourly feature table."""
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="target_next_hour_kwh",
        predictionCol="prediction",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
    )
    return Pipeline(stages=[assembler(fixed.HOURLY_FEATURES), forest])


class TreeEstimator:
    """A regressor over feature columns with the sizes of its fit, kept for ``fit``."""

    def __init__(self, grow, output, **sizes):
        self.grow, self.output, self.sizes = grow, output, sizes

    def fit(self, rows, keys=("household_id", "date")):
        return self.grow(rows, fixed.DAILY_FEATURES, "energy_kwh", list(keys), output=self.output, **self.sizes)


def daily_forest(trees=400, depth=20, seed=42, column="random_forest_kwh"):
    """Next-day regressor over the 26 daily features: bags and nodes as in ``trees``."""
    return TreeEstimator(fit_forest, column, trees=trees, depth=depth, least_rows=2, seed=seed)


def daily_boosting(rounds=700, depth=6, step=0.03, seed=42, column="boosting_kwh"):
    """Second-order boosting with L1 and L2 leaf penalties."""
    return TreeEstimator(
        fit_boosting, column, rounds=rounds, depth=depth, step=step, least_weight=3, row_share=0.8, column_share=0.8, l1=0.05, l2=1.0, seed=seed
    )


def regression_metrics(predictions, actual, columns):
    """MAE, RMSE and R2 per prediction column, one row per model.

    All models are measured in one pass over the predictions."""
    y = F.col(actual)
    spread = F.var_pop(y) * F.count(y)
    wide = predictions.agg(
        *[
            F.struct(
                F.avg(F.abs(y - F.col(c))).alias("MAE"),
                F.sqrt(F.avg((y - F.col(c)) ** 2)).alias("RMSE"),
                (1.0 - F.try_divide(F.sum((y - F.col(c)) ** 2), spread)).alias("R2"),
            ).alias(c)
            for c in columns
        ]
    )
    rows = [wide.select(F.lit(c).alias("Model"), f"{c}.*") for c in columns]
    return reduce(lambda a, b: a.unionByName(b), rows)


def prediction_errors(predictions, actual, predicted):
    return predictions.withColumn("prediction_error", F.col(actual) - F.col(predicted))


def feature_importances(spark, models, names):
    """Importances per feature, one column per model, summing to 1: the mean gain of a
    feature's cuts for boosting, impurity for a forest."""
    columns = [model.importances("gain" if "oosting" in label else "impurity").tolist() for label, model in models.items()]
    rows = [(name, *map(float, values)) for name, *values in zip(names, *columns)]
    layout = ", ".join(["feature string", *[f"{label} double" for label in models]])
    return spark.createDataFrame(rows, layout)


def top_importances(importances, column=None, n=15):
    """The n largest values of the first importance column, rounded to 8 places;
    text that is not a number is skipped."""
    if column is None:
        named = [c for c in importances.columns if "importance" in c.lower()]
        column = named[0] if named else importances.columns[1]
    name = importances.columns[0]
    return (
        importances.select(
            F.col(name).alias("feature"),
            F.round(F.col(column).try_cast("double"), 8).alias("importance"),
        )
        .filter("importance is not null")
        .orderBy(F.col("importance").desc(), "feature")
        .limit(n)
    )


def fit_daily_models(split, estimators, keys=("household_id", "date")):
    """Fits the given regressors by name on the training rows."""
    train = split.filter("split = 'training'")
    return {name: estimator.fit(train, keys) for name, estimator in estimators.items()}


def predict_test(split, models, order=("household_id", "date")):
    """Test rows with the naive prediction and one column per model."""
    out = split.filter("split = 'test'")
    for model in models.values():
        out = model.transform(out)
    return out.select(
        *order,
        F.col("energy_kwh").alias("actual_kwh"),
        F.col("lag_1").alias("naive_prediction_kwh"),
        *[model.output for model in models.values()],
    )


# --- usage modes ---------------------------------------------------------------


def scaled_clusters(features, columns=tuple(fixed.CLUSTER_FEATURES)):
    """Standardised feature vector in ``scaled``."""
    scaler = StandardScaler(inputCol="_raw", outputCol="scaled", withMean=True, withStd=True)
    raw = assembler(columns, "_raw").transform(features)
    return scaler.fit(raw).transform(raw).drop("_raw")


def search_clusters(spark, scaled, ks=range(2, 7), restarts=20, seed=42, keys=("household_id", "date"), anchors=ANCHORS):
    """Silhouette per k, the best k and its model: the best of the restarts for every k,
    found in the same passes; silhouettes are of plain distances."""
    found = fit_kmeans(scaled, ks, restarts, seed, keys=keys)
    values = silhouettes(scaled, {k: c for k, (c, _) in found.items()}, keys=keys, anchors=anchors)
    best = max(values, key=lambda k: (values[k], -k))
    scores = spark.createDataFrame([(k, v) for k, v in values.items()], "K int, Silhouette_Score double")
    return scores, best, KMeansModel(found[best][0])


def cluster_summary(labelled, value="energy_kwh"):
    """Size, share, mean, exact median, range and label per cluster.

    Clusters pool all households, so the median is found by distributed ranks."""
    total = F.sum("days").over(_whole())
    base = labelled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("days"),
        F.avg(value).alias("mean_kwh"),
        F.min(value).alias("min_kwh"),
        F.max(value).alias("max_kwh"),
    )
    median = exact_quantiles(labelled, value, [0.5], ["cluster"]).withColumnRenamed("q0", "median_kwh")
    many = F.count(F.lit(1)).over(_whole())
    top = F.max("mean_kwh").over(_whole())
    behaviour = F.when(
        F.col("_k") == 2,
        F.when(F.col("mean_kwh") == F.col("_top"), "higher_consumption").otherwise("lower_consumption"),
    )
    return (
        base.join(median, "cluster")
        .withColumns({"_total": total, "_k": many, "_top": top})
        .select(
            F.col("cluster").alias("cluster_id"),
            F.concat(F.lit("Cluster "), F.col("cluster").cast("string")).alias("label"),
            "days",
            F.round(F.col("days") / F.col("_total"), 4).alias("share_of_days"),
            "mean_kwh",
            "median_kwh",
            "min_kwh",
            "max_kwh",
            behaviour.alias("behaviour"),
        )
    )


def _whole():
    """Over one row per cluster only."""
    return Window.partitionBy(F.lit(0))


def stored_summary_gaps(stored, computed, tolerance=1e-6):
    """Clusters whose stored summary differs from the computed one."""
    pairs = {"count": "days", "mean": "mean_kwh", "median": "median_kwh", "min": "min_kwh", "max": "max_kwh"}
    both = stored.alias("s").join(
        computed.alias("c"), F.col("s.cluster") == F.col("c.cluster_id"), "inner"
    )
    off = reduce(
        lambda a, b: a | b,
        [F.abs(F.col(f"s.{a}") - F.col(f"c.{b}")) > tolerance for a, b in pairs.items()],
    )
    return both.filter(off).select("c.cluster_id")
