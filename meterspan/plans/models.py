"""Model fits and forecasts at the published sizes. A model is fitted once per application
and table folder and saved in the shared folder, from which every query loads it."""

import time
from functools import lru_cache

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.operators import anomalies, features, forecast, iforest, models, stats
from meterspan.operators.trees import TreeModel
from meterspan.plans.energy import SPLIT_DATE, hourly_features
from meterspan.plans.registry import day, query, r, report
from meterspan.plans.series import PLAIN, split_table
from meterspan.plans.statistics import histogram_sql
from meterspan.plans.vectors import requests
from meterspan.session import scratch_folder
from meterspan.sources import tables as t

HORIZON = 30

_TEST = f"""{PLAIN}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY date) AS i,
    count(*) OVER (PARTITION BY household_id) AS n FROM features WHERE lag_30 IS NOT NULL
), test AS (
  SELECT household_id, date, energy_kwh AS actual_kwh, lag_1 AS naive_prediction_kwh,
    energy_kwh - lag_1 AS prediction_error FROM ranked WHERE i > floor(n * CAST(0.85 AS DOUBLE))
)"""


def naive_predictions(spark, folder):
    test = split_table(spark, folder).filter("split = 'test'")
    return test.select(
        "household_id",
        "date",
        F.col("energy_kwh").alias("actual_kwh"),
        F.col("lag_1").alias("naive_prediction_kwh"),
    )


@query(
    "naive_metrics",
    f"""WITH {_TEST} SELECT 'naive_prediction_kwh' AS "Model", {r('avg(abs(prediction_error)) AS MAE',
  'sqrt(avg(prediction_error * prediction_error)) AS RMSE',
  '1 - sum(prediction_error * prediction_error) / (var_pop(actual_kwh) * count(*)) AS R2')} FROM test""",
)
def naive_metrics(spark, folder):
    predictions = naive_predictions(spark, folder)
    return report(models.regression_metrics(predictions, "actual_kwh", ["naive_prediction_kwh"]))


@query("error_histogram", f"WITH {_TEST}, {histogram_sql('test', 'prediction_error', 30)}")
def error_histogram(spark, folder):
    errors = models.prediction_errors(
        naive_predictions(spark, folder), "actual_kwh", "naive_prediction_kwh"
    )
    return report(stats.histogram(errors, "prediction_error", 30))


@query(
    "prediction_band",
    f"""WITH {_TEST}, m AS (SELECT household_id, avg(abs(prediction_error)) AS mae FROM test GROUP BY 1)
SELECT household_id, strftime(date, '%Y-%m-%d') AS date, {r('greatest(0, naive_prediction_kwh - mae) AS lower_kwh',
  'naive_prediction_kwh + mae AS upper_kwh',
  'naive_prediction_kwh + mae - greatest(0, naive_prediction_kwh - mae) AS width_kwh')}
FROM test JOIN m USING (household_id)""",
)
def prediction_band(spark, folder):
    predictions = naive_predictions(spark, folder)
    mae = predictions.groupBy("household_id").agg(
        F.avg(F.abs(F.col("actual_kwh") - F.col("naive_prediction_kwh"))).alias("_mae")
    )
    band = forecast.prediction_band(F.col("naive_prediction_kwh"), F.col("_mae"))
    banded = predictions.join(mae, "household_id")
    return report(banded.select("household_id", "date", *[c.alias(n) for n, c in band.items()]))


@lru_cache(maxsize=16)
def _saved(application, folder, name):
    """Where a fitted model is, and the seconds of its fit."""
    spark = SparkSession.getActiveSession()
    path = scratch_folder(spark, f"model-{name}")
    if name == "hourly":
        train, _ = features.date_split(hourly_features(spark, folder), SPLIT_DATE)
        rows, build = models.stable_rows(train, ["household_id", "datetime"]), models.hourly_forest().fit
    elif name == "isolation":
        rows, build = forest_rows(spark, folder), iforest.fit_isolation_forest
    else:
        estimator = {"random_forest": models.daily_forest, "boosting": models.daily_boosting}[name]()
        rows, build = split_table(spark, folder, households=1).filter("split = 'training'"), estimator.fit
    start = time.perf_counter()
    model = build(rows)
    seconds = time.perf_counter() - start
    if name == "hourly":
        model.write().overwrite().save(path)
    else:
        model.save(spark, path)
    return path, seconds


def _path(spark, folder, name):
    return _saved(spark.sparkContext.applicationId, folder, name)[0]


def fitted(spark, folder, names=("random_forest", "boosting")):
    return {name: TreeModel.load(spark, _path(spark, folder, name)) for name in names}


def predicted(spark, folder, names=("random_forest", "boosting")):
    return models.predict_test(split_table(spark, folder, households=1), fitted(spark, folder, names))


PREDICTIONS = ["naive_prediction_kwh", "random_forest_kwh", "boosting_kwh"]


def hourly_predictions(spark, folder):
    _, test = features.date_split(hourly_features(spark, folder), SPLIT_DATE)
    return PipelineModel.load(_path(spark, folder, "hourly")).transform(test)


@query("hourly_rf")
def hourly_rf(spark, folder):
    """Test metrics of the next-hour forest."""
    return models.regression_metrics(hourly_predictions(spark, folder), "target_next_hour_kwh", ["prediction"])


@query("hourly_prediction_sample")
def hourly_prediction_sample(spark, folder):
    """The first 300 test hours with their predictions."""
    sample = hourly_predictions(spark, folder).select("household_id", "datetime", "target_next_hour_kwh", "prediction")
    return report(sample.orderBy("household_id", "datetime").limit(300))


@query("daily_model_comparison")
def daily_model_comparison(spark, folder):
    """Test metrics and the seconds of each model's own fit; the naive one has none."""
    metrics = models.regression_metrics(predicted(spark, folder), "actual_kwh", PREDICTIONS)
    seconds = F.lit(0.0)
    for name in ("random_forest", "boosting"):
        own = _saved(spark.sparkContext.applicationId, folder, name)[1]
        seconds = F.when(F.col("Model") == f"{name}_kwh", F.lit(own)).otherwise(seconds)
    return metrics.withColumn("Training_Time", seconds)


@query("test_predictions")
def test_predictions(spark, folder):
    return report(predicted(spark, folder))


@query(
    "test_actuals",
    f"""WITH {_TEST} SELECT household_id, {day('date')}, {r('actual_kwh', 'naive_prediction_kwh')},
  TRUE AS predicted FROM test WHERE household_id = 0""".replace(t.daily_sql(), t.daily_sql(1)),
)
def test_actuals(spark, folder):
    """What SQL can say of the prediction table: its rows, their actual and naive values,
    and that both models predict every one of them."""
    table = predicted(spark, folder)
    both = F.col("random_forest_kwh").isNotNull() & F.col("boosting_kwh").isNotNull()
    return report(table.select("household_id", "date", "actual_kwh", "naive_prediction_kwh", both.alias("predicted")))


@query(
    "model_tallies",
    f"""WITH {_TEST}, f AS (SELECT count(*) AS n FROM features WHERE lag_30 IS NOT NULL), m AS (
  SELECT avg(abs(actual_kwh - naive_prediction_kwh)) AS mae FROM test)
SELECT tally, rows, TRUE AS holds FROM (
  SELECT 'anomalies: flagged and others are all days' AS tally, n AS rows FROM f
  UNION ALL SELECT 'clusters: days of all clusters', n FROM f
  UNION ALL SELECT 'importances: features, sum 1', {len(fixed.DAILY_FEATURES)}
  UNION ALL SELECT 'models: better than the naive one', 2
  UNION ALL SELECT 'splits: training, validation and test', n FROM f)""".replace(t.daily_sql(), t.daily_sql(1)),
)
def model_tallies(spark, folder):
    """Counts that the model tables must agree on, measured on the fitted models."""
    context = forest_context(spark, folder).first()
    days = [r["days"] for r in cluster_summary(spark, folder).collect()]
    shares = importances(spark, folder).agg(
        F.count(F.lit(1)).alias("n"), F.sum("RandomForest_Importance").alias("a"), F.sum("Boosting_Importance").alias("b")
    ).first()
    metrics = {r["Model"]: r["MAE"] for r in daily_model_comparison(spark, folder).collect()}
    naive = metrics.pop("naive_prediction_kwh")
    parts = {r["split"]: r["count"] for r in split_table(spark, folder, households=1).groupBy("split").count().collect()}
    share = context.flagged_rows / context.evaluated_rows
    rows = [
        ("anomalies: flagged and others are all days", context.flagged_rows + context.inliers, abs(share - fixed.CONTAMINATION) < 0.002),
        ("clusters: days of all clusters", sum(days), len(days) >= 2),
        ("importances: features, sum 1", shares["n"], abs(shares["a"] - 1) < 1e-9 and abs(shares["b"] - 1) < 1e-9),
        ("models: better than the naive one", len(metrics), all(v < naive for v in metrics.values())),
        ("splits: training, validation and test", sum(parts.values()), sorted(parts) == ["test", "training", "validation"]),
    ]
    return spark.createDataFrame([(a, int(n), bool(ok)) for a, n, ok in rows], "tally string, rows long, holds boolean")


def importances(spark, folder):
    labels = {"random_forest": "RandomForest_Importance", "boosting": "Boosting_Importance"}
    named = {labels[name]: model for name, model in fitted(spark, folder).items()}
    return models.feature_importances(spark, named, fixed.DAILY_FEATURES)


@query("feature_importance")
def feature_importance(spark, folder):
    return importances(spark, folder)


@query("top_importances")
def top_importances(spark, folder):
    return models.top_importances(importances(spark, folder))


def scaled_days(spark, folder):
    table = features.complete_features(t.daily(spark, folder, households=1))
    return models.scaled_clusters(table).select("household_id", "date", "energy_kwh", "scaled")


@lru_cache(maxsize=4)
def _clusters(application, folder):
    """Scores, best k and its model, searched once per application and folder."""
    spark = SparkSession.getActiveSession()
    return models.search_clusters(spark, scaled_days(spark, folder))


def clustered(spark, folder):
    scores, best, model = _clusters(spark.sparkContext.applicationId, folder)
    return scores, best, model.transform(scaled_days(spark, folder)).drop("scaled")


@query("cluster_search")
def cluster_search(spark, folder):
    scores, best, _ = clustered(spark, folder)
    return scores.withColumn("selected", F.col("K") == best)


@query("cluster_summary")
def cluster_summary(spark, folder):
    return models.cluster_summary(clustered(spark, folder)[2])


@query(
    "cluster_statistics",
    f"""WITH {t.DAILY}, labelled AS (
  SELECT CAST(CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS cluster, energy_kwh FROM daily
), s AS (SELECT cluster, count(*) AS days, avg(energy_kwh) AS mean, median(energy_kwh) AS median,
  min(energy_kwh) AS lo, max(energy_kwh) AS hi FROM labelled GROUP BY cluster)
SELECT cluster AS cluster_id, 'Cluster ' || cluster AS label, days,
  {r('days / CAST(sum(days) OVER () AS DOUBLE) AS share_of_days', digits=4)},
  {r('mean AS mean_kwh', 'median AS median_kwh', 'lo AS min_kwh', 'hi AS max_kwh')},
  CASE WHEN mean = max(mean) OVER () THEN 'higher_consumption' ELSE 'lower_consumption' END AS behaviour FROM s""",
)
def cluster_statistics(spark, folder):
    """The cluster summary over a given label, so that SQL can follow."""
    weekend = (F.weekday("date") >= 5).cast("int")
    return report(models.cluster_summary(t.daily(spark, folder).withColumn("cluster", weekend)))


def forest_rows(spark, folder):
    return features.complete_features(t.daily(spark, folder, households=1))


def forest_scores(spark, folder):
    model = iforest.IsolationForestModel.load(spark, _path(spark, folder, "isolation"))
    return model.score(forest_rows(spark, folder).select("household_id", "date", *fixed.ANOMALY_FEATURES))


@query("isolation_forest")
def isolation_forest(spark, folder):
    return report(forest_scores(spark, folder))


@query("forest_context")
def forest_context(spark, folder):
    return anomalies.anomaly_context(forest_scores(spark, folder))


def forecasts(spark, folder, horizon):
    daily = t.daily(spark, folder, households=1)
    predictions = predicted(spark, folder, ("random_forest",))
    mae = models.regression_metrics(predictions, "actual_kwh", ["random_forest_kwh"]).first()["MAE"]
    asked = requests(spark, folder, horizon, households=1)
    planned = forecast.plan_requests(asked, daily)
    return forecast.roll_forward(planned, fitted(spark, folder, ("random_forest",))["random_forest"], mae)


@query("forecast_next_day")
def forecast_next_day(spark, folder):
    return report(forecasts(spark, folder, 1), 3)


@query("forecast_horizon")
def forecast_horizon(spark, folder):
    return report(forecasts(spark, folder, HORIZON), 3)


@query("horizon_totals")
def horizon_totals(spark, folder):
    return report(forecast.horizon_totals(forecasts(spark, folder, HORIZON)), 3)
