import numpy as np
import pytest
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.operators import anomalies, features, iforest, models, quality
from meterspan.plans import models as plans
from meterspan.sources import tables as t


@pytest.fixture(scope="module")
def daily(spark, middle):
    return features.complete_features(t.daily(spark, middle, households=1)).persist()


@pytest.fixture(scope="module")
def split(daily):
    return features.chronological_split(daily)


@pytest.fixture(scope="module")
def fitted(split):
    estimators = {"forest": models.daily_forest(20, 6), "boosting": models.daily_boosting(8, 4)}
    return models.fit_daily_models(split, estimators)


def test_forest_beats_the_naive_prediction(split, fitted):
    predictions = models.predict_test(split, fitted)
    table = {r.Model: r for r in models.regression_metrics(predictions, "actual_kwh", plans.PREDICTIONS).collect()}
    assert table["random_forest_kwh"].MAE < table["naive_prediction_kwh"].MAE
    assert set(table) == set(plans.PREDICTIONS)


def test_partitions_do_not_follow_the_rows(spark):
    assert {models.stable_rows(spark.range(n), ["id"]).rdd.getNumPartitions() for n in (0, 982, 34_000)} == {models.PARTITIONS}


def test_metrics_match_numpy(spark):
    y, p = np.array([3.0, 5.0, 9.0]), np.array([2.0, 5.0, 11.0])
    frame = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double")
    row = models.regression_metrics(frame, "y", ["p"]).first()
    assert row.MAE == pytest.approx(1.0)
    assert row.RMSE == pytest.approx(np.sqrt(5 / 3))
    assert row.R2 == pytest.approx(1 - 5 / ((y - y.mean()) ** 2).sum())


def test_importances_cover_all_features(spark, fitted):
    named = {"A_Importance": fitted["forest"], "Boosting_Importance": fitted["boosting"]}
    table = models.feature_importances(spark, named, fixed.DAILY_FEATURES)
    for column in named:
        row = quality.importance_gaps(table, fixed.DAILY_FEATURES, column).first()
        assert row.importance_sum == pytest.approx(1.0) and row.missing_features == 0
    top = models.top_importances(table, n=15).collect()
    assert len(top) == 15
    assert [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)


def test_a_fit_repeats_on_other_partitions(split, fitted):
    again = models.fit_daily_models(split.repartition(7), {"forest": models.daily_forest(20, 6), "boosting": models.daily_boosting(8, 4)})
    for name, model in again.items():
        assert model.threshold.tolist() == fitted[name].threshold.tolist() and model.value.tolist() == fitted[name].value.tolist()


def test_clusters(spark, daily):
    scaled = models.scaled_clusters(daily)
    scores, best, model = models.search_clusters(spark, scaled, ks=[2, 3], restarts=1)
    by_k = {r.K: r.Silhouette_Score for r in scores.collect()}
    assert by_k[best] == max(by_k.values())
    summary = models.cluster_summary(model.transform(scaled)).collect()
    assert sum(r.days for r in summary) == daily.count()
    assert sum(r.share_of_days for r in summary) == pytest.approx(1.0, abs=1e-3)
    local = model.transform(scaled).select("cluster", "energy_kwh").toPandas()
    for r in summary:
        values = local.loc[local.cluster == r.cluster_id, "energy_kwh"]
        assert r.median_kwh == pytest.approx(values.median())


def test_stored_summary_is_compared(spark):
    stored = spark.createDataFrame(
        [(0, 2, 1.0, 1.0, 0.0, 2.0), (1, 1, 5.0, 5.0, 5.0, 5.0)],
        "cluster int, count long, mean double, median double, min double, max double",
    )
    rows = spark.createDataFrame([(0, 0.0), (0, 2.0), (1, 5.5)], "cluster int, energy_kwh double")
    gaps = models.stored_summary_gaps(stored, models.cluster_summary(rows)).collect()
    assert [r.cluster_id for r in gaps] == [1]


# --- isolation forest ------------------------------------------------------------


def test_mean_path():
    assert iforest.mean_path([0, 1, 2]).tolist() == [0.0, 0.0, 1.0]
    assert float(iforest.mean_path(256)) == pytest.approx(10.2448, abs=1e-3)


def test_share_of_flagged_days(daily):
    model = iforest.fit_isolation_forest(daily, trees=40)
    scored = model.score(daily)
    context = anomalies.anomaly_context(scored).first()
    assert context.flagged_rows + context.inliers == context.evaluated_rows == daily.count()
    assert context.flagged_rate == pytest.approx(0.02, abs=0.002)
    labels = {r[0] for r in scored.filter("flagged").select("anomaly_prediction").distinct().collect()}
    assert labels == {-1}


def test_outliers_are_the_most_isolated(spark):
    rng = np.random.default_rng(0)
    points = rng.normal(0, 1, (600, 3))
    points[:5] += 12
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "id int, a double, b double, c double")
    model = iforest.fit_isolation_forest(frame, ["a", "b", "c"], ["id"], trees=60)
    lowest = model.score(frame).orderBy("anomaly_score").limit(5).collect()
    assert {r.id for r in lowest} == {0, 1, 2, 3, 4}


def test_a_forest_repeats_on_other_partitions(daily):
    a = iforest.fit_isolation_forest(daily, trees=10)
    b = iforest.fit_isolation_forest(daily.repartition(9, F.rand()), trees=10)
    assert a.offset == b.offset


def test_a_saved_forest_scores_alike(spark, daily, tmp_path):
    model = iforest.fit_isolation_forest(daily, trees=10)
    model.save(spark, str(tmp_path))
    again = iforest.IsolationForestModel.load(spark, str(tmp_path))
    scores = [[r[0] for r in m.score(daily).orderBy("date").select("anomaly_score").collect()] for m in (model, again)]
    assert scores[0] == scores[1]


def test_samples_of_a_small_table_are_whole(spark):
    frame = spark.range(300).select("id", F.rand(1).alias("x"))
    for size, want in ((256, 256), (300, 300)):
        samples = iforest.tree_samples(frame, ["x"], ["id"], 20, size, 300, 1)
        assert [r[1] for r in samples.groupBy("tree").agg(F.countDistinct("x")).collect()] == [want] * 20


def test_samples_on_a_large_table(spark):
    frame = spark.range(20_000).select("id", F.rand(1).alias("x"))
    samples = iforest.tree_samples(frame, ["x"], ["id"], 8, 64, 20_000, 1)
    sizes = [r[1] for r in samples.groupBy("tree").count().collect()]
    assert sizes == [64] * 8
    assert samples.select("x").distinct().count() == 8 * 64
