"""Trees from histograms against a grower that looks at all rows of a node directly."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterspan.operators import trees

COLUMNS = ["a", "b", "c", "d"]


def table(n, seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)
    y = 3 * x[:, 0] + np.abs(x[:, 1]) * 2 + (x[:, 2] > 0) + rng.normal(0, 0.1, n)
    return x, np.round(y, 3)


@pytest.fixture(scope="module")
def rows(spark):
    x, y = table(400, 1)
    return spark.createDataFrame([(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))], "id int, a double, b double, c double, d double, y double").persist()


def brute_tree(x, g, h, n, depth, allowed, rule):
    """A tree as nested tuples: cuts between neighbouring values, all tried."""

    def shrunk(v):
        return np.sign(v) * max(abs(v) - rule["l1"], 0)

    def score(rows):
        return shrunk(g[rows].sum()) ** 2 / max(h[rows].sum() + rule["l2"], 1e-300)

    def grow(rows, level, number):
        leaf = -shrunk(g[rows].sum()) / (h[rows].sum() + rule["l2"])
        best = (rule["least_gain"], None)
        for f in allowed(number) if level < depth else ():
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(n[left].sum(), n[right].sum()) < rule["least_rows"] or min(h[left].sum(), h[right].sum()) < rule["least_weight"]:
                    continue
                gain = score(left) + score(right) - score(rows)
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, (f, cut, left, right))
        return (leaf, None) if best[1] is None else (leaf, best[1])

    return grow


def brute_predictions(x, g, h, n, depth, allowed, rule):
    """The prediction of every row by one tree that is grown on rows of weight."""
    grow = brute_tree(x, g, h, n, depth, allowed, rule)
    out = np.zeros(len(x))
    todo = [(np.flatnonzero(n > 0), np.arange(len(x)), 0)]
    while todo:
        rows, every, level = todo.pop()
        leaf, cut = grow(rows, level, None)
        if cut is None:
            out[every] = leaf
            continue
        f, at, left, right = cut
        todo.append((left, every[x[every, f] <= at], level + 1))
        todo.append((right, every[x[every, f] > at], level + 1))
    return out


def ids_of(rows):
    return np.array([r[0] for r in rows.orderBy("id").select(F.xxhash64("id")).collect()])


def predicted(model, rows):
    return np.array([r[0] for r in model.transform(rows).orderBy("id").select(model.output).collect()])


def test_boosting_equals_a_direct_grower(spark, rows):
    model = trees.fit_boosting(rows, COLUMNS, "y", ["id"], rounds=6, depth=3, column_share=1.0, step=0.3, keep=4)
    by_jobs = trees.fit_boosting(rows, COLUMNS, "y", ["id"], rounds=6, depth=3, column_share=1.0, step=0.3, keep=4, in_task=0)
    assert by_jobs.value.tolist() == model.value.tolist()
    x, y = table(400, 1)
    rule = {"l1": 0.05, "l2": 1.0, "least_rows": 1, "least_weight": 3, "least_gain": 1e-9}
    ids, margin = ids_of(rows), np.full(400, model.base)
    assert model.base == pytest.approx(y.mean())
    for number in range(6):
        drawn = trees.draws(ids, np.array([number]), 42)[:, 0] < 0.8
        one = drawn.astype(float)
        margin = margin + 0.3 * brute_predictions(x, (margin - y) * one, one, one, 3, lambda _: range(4), rule)
    assert np.allclose(predicted(model, rows), margin, atol=1e-6)


def test_forest_equals_a_direct_grower(spark, rows):
    model = trees.fit_forest(rows, COLUMNS, "y", ["id"], trees=5, depth=6, per_node=4)
    x, y = table(400, 1)
    rule = {"l1": 0.0, "l2": 0.0, "least_rows": 2, "least_weight": 0, "least_gain": 1e-9}
    by_passes = trees.fit_forest(rows, COLUMNS, "y", ["id"], trees=5, depth=6, per_node=2, in_task=0)
    by_tasks = trees.fit_forest(rows, COLUMNS, "y", ["id"], trees=5, depth=6, per_node=2)
    assert predicted(by_passes, rows).tolist() == predicted(by_tasks, rows).tolist() and len(by_passes.feature) == len(by_tasks.feature)
    bags = trees.bags(ids_of(rows), np.arange(5), 42)
    assert bags.mean() == pytest.approx(1, abs=0.1) and bags.var() == pytest.approx(1, abs=0.2)
    every = []
    for k in range(5):
        w = bags[:, k].astype(float)
        every.append(model.base + brute_predictions(x, -(y - model.base) * w, w, (w > 0) * 1.0, 6, lambda _: range(4), rule))
    assert np.allclose(predicted(model, rows), np.mean(every, 0), atol=1e-6)


@pytest.mark.parametrize("fit", [
    lambda rows: trees.fit_forest(rows, COLUMNS, "y", ["id"], trees=12, depth=8, in_task=0),
    lambda rows: trees.fit_boosting(rows, COLUMNS, "y", ["id"], rounds=5, depth=4, keep=2, in_task=0),
])
def test_a_fit_does_not_depend_on_the_layout(spark, rows, fit):
    few, many = fit(rows.repartition(3)), fit(rows.repartition(17, F.rand(4)))
    assert few.threshold.tolist() == many.threshold.tolist() and few.feature.tolist() == many.feature.tolist()
    assert few.value.tolist() == many.value.tolist()
    assert predicted(few, rows).tolist() == predicted(many, rows).tolist()


def test_save_and_load(spark, rows, tmp_path):
    for fit in (trees.fit_forest, trees.fit_boosting):
        size = {"trees": 4} if fit is trees.fit_forest else {"rounds": 4}
        model = fit(rows, COLUMNS, "y", ["id"], depth=4, **size)
        model.save(spark, f"{tmp_path}/{fit.__name__}")
        again = trees.TreeModel.load(spark, f"{tmp_path}/{fit.__name__}")
        assert predicted(model, rows).tolist() == predicted(again, rows).tolist()
        assert again.importances("gain").tolist() == model.importances("gain").tolist()
        assert sum(again.importances("impurity")) == pytest.approx(1) and again.importances("impurity").argmax() == 0


def test_nulls_constants_and_nothing(spark):
    layout = "id int, a double, y double"
    some = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 9.0), (3, 3.0, None), (4, float("nan"), 1.0), (5, 1.0, 4.0), (5, 1.0, 4.0)], layout)
    model = trees.fit_forest(some, ["a"], "y", ["id"], trees=3, depth=3)
    assert (model.feature == -1).all()  # one value has no cut
    got = {r.id: r.prediction for r in model.transform(some).collect()}
    assert got[2] is None and got[4] is None and got[1] is not None
    for empty in (trees.fit_forest(some.limit(0), ["a"], "y", ["id"], trees=2), trees.fit_boosting(some.limit(0), ["a"], "y", ["id"], rounds=2)):
        assert {r.prediction for r in empty.transform(some).collect()} <= {0.0, None}


def test_many_values_share_bins(spark):
    frame = spark.range(3000).select("id", (F.col("id") / 7).alias("a"), F.sqrt("id").alias("y"))
    model = trees.fit_boosting(frame, ["a"], "y", ["id"], rounds=30, depth=4, step=0.3, bins=16)
    assert len(set(model.threshold[model.feature >= 0].tolist())) <= 15
    error = model.transform(frame).agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert error < 2
