"""Batched k-means against single fits, silhouettes against all pairs."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from meterspan.operators import clusters


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(8)
    return np.concatenate([rng.normal(c, s, (n, 2)) for c, s, n in (((0, 0), 1, 150), ((6, 1), 0.7, 90), ((2, 7), 1.2, 60))])


@pytest.fixture(scope="module")
def scaled(spark, points):
    frame = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, a double, b double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="scaled").transform(frame).persist()


@pytest.fixture(scope="module")
def fitted(scaled):
    return clusters.fit_kmeans(scaled, ks=[2, 3, 4], restarts=6, keys=["id"])


def brute_silhouette(x, labels):
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i, own in enumerate(labels):
        mean = {k: far[i, labels == k].sum() / max(1, (labels == k).sum() - (k == own)) for k in set(labels)}
        a, b = mean.pop(own), min(mean.values())
        out.append(0 if (labels == own).sum() == 1 else (b - a) / max(a, b))
    return np.mean(out)


def labels_of(x, c):
    return ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)


def test_every_k_is_as_good_as_its_best_single_fit(scaled, points, fitted):
    for k, (centroids, inertia) in fitted.items():
        direct = ((points - centroids[labels_of(points, centroids)]) ** 2).sum()
        assert inertia == pytest.approx(direct, rel=1e-5)
        single = min(KMeans(featuresCol="scaled", k=k, seed=s).fit(scaled).summary.trainingCost for s in range(4))
        assert inertia <= single * 1.001


def test_clusters_do_not_depend_on_the_layout(scaled, fitted):
    again = clusters.fit_kmeans(scaled.repartition(11, F.rand(2)), ks=[2, 3, 4], restarts=6, keys=["id"])
    assert all(again[k][0].tolist() == fitted[k][0].tolist() for k in fitted)


def test_silhouettes_are_exact_where_all_points_are_anchors(scaled, points, fitted):
    found = clusters.silhouettes(scaled, {k: c for k, (c, _) in fitted.items()}, keys=["id"])
    for k, (c, _) in fitted.items():
        assert found[k] == pytest.approx(brute_silhouette(points, labels_of(points, c)), abs=1e-9)
    some = clusters.silhouettes(scaled, {3: fitted[3][0]}, keys=["id"], anchors=40)
    assert some[3] == pytest.approx(found[3], abs=0.05)


def test_labels_and_odd_tables(spark, scaled, points, fitted):
    model = clusters.KMeansModel(fitted[3][0])
    got = [r.cluster for r in model.transform(scaled).orderBy("id").collect()]
    assert got == labels_of(points, fitted[3][0]).tolist()
    assert clusters.fit_kmeans(scaled.limit(0), ks=[2]) == {} == clusters.silhouettes(scaled.limit(0), {2: fitted[2][0]})
    same = spark.createDataFrame([([1.0, 1.0],)] * 5 + [(None,)], "scaled array<double>")
    centroids, inertia = clusters.fit_kmeans(same, ks=[2], restarts=2)[2]
    assert inertia == 0 and clusters.silhouettes(same, {2: centroids}) == {2: 0.0}
