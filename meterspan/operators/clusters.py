"""K-means with every number of clusters and every restart in the same passes, and
silhouettes of plain Euclidean distances.

The centroids of all models are one stack. A pass over the points assigns each point in
every model that still moves and sums counts, coordinates and squared distances per
(model, cluster); the sums are of fixed-point integers, so that the result does not
depend on how the rows are laid out. The driver holds the stack and these sums, whose
size does not follow the table."""

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterspan.session import written

#: Rows of the hash sample on which first centroids are chosen (k-means++).
SAMPLE = 4096
#: Anchors of a cluster for silhouettes; a cluster of at most so many points is exact.
ANCHORS = 2048
TOLERANCE = 1e-4
_ONE = float(1 << 24)


def _points(scaled, column, keys):
    """Points once written: x, and h, a hash that orders them (of ``keys``, or of x)."""
    x = vector_to_array(column) if scaled.schema[column].dataType.typeName() == "vectorudt" else F.col(column)
    named = [F.col(k) for k in keys] or [x]
    return written(scaled.where(F.col(column).isNotNull()).select(x.alias("x"), F.xxhash64(*named).alias("h")), "cluster-points")


def _matrix(column):
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _squares(x, c):
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0.0)


def plus_plus(x, k, dice):
    """First centroids among the rows of x: each is drawn by its squared distance to those
    before it."""
    chosen = [int(dice.integers(len(x)))]
    near = _squares(x, x[chosen])[:, 0]
    while len(chosen) < k:
        total = near.sum()
        at = int(np.searchsorted(np.cumsum(near), dice.random() * total, "right")) if total > 0 else int(dice.integers(len(x)))
        chosen.append(min(at, len(x) - 1))
        near = np.minimum(near, _squares(x, x[chosen[-1:]])[:, 0])
    return x[chosen].copy()


def _sums(stack):
    """Sums by (model, cluster, item): item -1 counts, -2 is the squared distance."""

    def run(batches):
        total = {name: np.zeros((len(c), c.shape[1] + 2), np.int64) for name, c in stack.items()}
        for batch in batches:
            x = _matrix(batch.column(0))
            for name, c in stack.items():
                far = _squares(x, c)
                own = far.argmin(1)
                parts = total[name]
                parts[:, -2] += np.bincount(own, minlength=len(c))
                whole = np.rint(np.column_stack([x, far[np.arange(len(x)), own]]) * _ONE).astype(np.int64)
                order = np.argsort(own, kind="stable")
                some, first = np.unique(own[order], return_index=True)
                added = np.add.reduceat(whole[order], first, axis=0)
                parts[some, :-2] += added[:, :-1]
                parts[some, -1] += added[:, -1]
        rows = [(name, j, i, int(v)) for name, parts in total.items() for j, line in enumerate(parts) for i, v in enumerate(line) if v]
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["model", "cluster", "item", "value"])

    return run


def _pass(points, stack):
    """{model: (counts, coordinate sums, inertia)}."""
    cells = points.select("x").mapInArrow(_sums(stack), "model int, cluster int, item int, value long")
    out = {name: np.zeros((len(c), c.shape[1] + 2), object) for name, c in stack.items()}
    for model, cluster, item, value in cells.groupBy("model", "cluster", "item").agg(F.sum("value")).collect():
        out[model][cluster, item] = int(value)
    return {n: (v[:, -2].astype(float), v[:, :-2].astype(float) / _ONE, float(v[:, -1].sum()) / _ONE) for n, v in out.items()}


def fit_kmeans(scaled, ks=range(2, 7), restarts=20, seed=42, rounds=300, column="scaled", keys=(), sample=SAMPLE):
    """{k: (centroids, inertia)}: the best of ``restarts`` for every k, all found together.

    First centroids come from about ``sample`` points by the hash of ``keys`` (all
    points of a smaller table). A model stands still when its centroids move by less
    than a tolerance in the square, or after ``rounds``. An empty cluster keeps its
    centroid; with fewer points than k some centroids are equal. No points, no models."""
    points = _points(scaled, column, keys).persist()
    try:
        n, spread = points.count(), None
        if not n:
            return {}
        share = min(1 << 30, (sample << 30) // n)
        chosen = points.where(F.pmod(F.xxhash64("h", F.lit(seed)), F.lit(1 << 30)) < share)
        x = np.array(sorted(tuple(r["x"]) for r in chosen.collect()) or [tuple(points.orderBy("h").first()["x"])], float)
        spread = TOLERANCE * x.var(0).mean()
        names = [(k, r) for k in ks for r in range(restarts)]
        centres = {i: plus_plus(x, k, np.random.default_rng([seed, k, r])) for i, (k, r) in enumerate(names)}
        moving = dict(centres)
        for _ in range(rounds):
            if not moving:
                break
            for i, (counts, sums, _) in _pass(points, moving).items():
                fresh = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres[i])
                shift, centres[i] = ((fresh - centres[i]) ** 2).sum(), fresh
                if shift <= spread:
                    del moving[i]
                else:
                    moving[i] = fresh
        inertia = {i: found[2] for i, found in _pass(points, centres).items()}
        best = {k: min((i for i, (own, _) in enumerate(names) if own == k), key=lambda i: (inertia[i], i)) for k in ks}
        return {k: (centres[i], inertia[i]) for k, i in best.items()}
    finally:
        points.unpersist()


def nearest(x, centroids):
    """Column: the number of the nearest centroid of an array column, first on ties."""
    far = [
        F.struct(F.aggregate(F.zip_with(x, F.array(*map(F.lit, map(float, c))), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v).alias("d"), F.lit(j).alias("j"))
        for j, c in enumerate(centroids)
    ]
    return F.array_min(F.array(*far))["j"]


class KMeansModel:
    """Centroids that label rows by a column of vectors or arrays."""

    def __init__(self, centroids, column="scaled", output="cluster"):
        self.centroids, self.column, self.output = np.asarray(centroids, float), column, output

    def transform(self, df):
        x = vector_to_array(self.column) if df.schema[self.column].dataType.typeName() == "vectorudt" else F.col(self.column)
        return df.withColumn(self.output, nearest(x, self.centroids))


def _shapes(anchors):
    """Sums of silhouettes by k, from points and the anchors {k: [(points, cut)]} of every
    cluster. A point is an anchor itself where its hash is up to the cut."""

    def run(batches):
        total = {k: [0, 0] for k in anchors}
        for batch in batches:
            x, h = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            for at in range(0, len(x), 512):
                part, hashes = x[at : at + 512], h[at : at + 512]
                for k, clusters in anchors.items():
                    own = _squares(part, np.stack([c[2] for c in clusters])).argmin(1)
                    mean, alone = np.full((len(part), len(clusters)), np.inf), np.zeros(len(part), bool)
                    for j, (some, cut, _) in enumerate(clusters):
                        if not len(some):
                            continue
                        far = np.sqrt(((part[:, None, :] - some[None, :, :]) ** 2).sum(2)).sum(1)
                        others = len(some) - ((own == j) & (hashes <= cut))
                        alone |= (own == j) & (others == 0)
                        mean[:, j] = far / np.maximum(others, 1)
                    a = mean[np.arange(len(part)), own]
                    mean[np.arange(len(part)), own] = np.inf
                    b = mean.min(1)
                    top = np.maximum(a, b)
                    s = np.where(alone | ~np.isfinite(b) | (top <= 0), 0.0, (b - a) / np.where(top > 0, top, 1))
                    total[k][0] += int(np.rint(np.where(np.isfinite(s), s, 0.0) * float(1 << 40)).astype(np.int64).sum())
                    total[k][1] += len(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v[0] for v in total.values()], pa.int64()), pa.array([v[1] for v in total.values()], pa.int64())],
            ["k", "sum", "n"],
        )

    return run


def silhouettes(scaled, models, column="scaled", keys=(), anchors=ANCHORS):
    """{k: silhouette} of {k: centroids}, over all points.

    A point's mean distances are to up to ``anchors`` points of every cluster, those with
    the lowest hash of ``keys``; where a cluster has no more points they are exact. A
    point alone in its cluster counts 0. No pairs of rows are made."""
    points = _points(scaled, column, keys)
    each = F.array(*[F.struct(F.lit(k).alias("k"), nearest(F.col("x"), c).alias("cluster")) for k, c in models.items()])
    lowest = Window.partitionBy("k", "cluster").orderBy("h", "x")
    rows = points.select("x", "h", F.explode(each).alias("e")).select("x", "h", "e.k", "e.cluster")
    rows = rows.withColumn("r", F.row_number().over(lowest)).where(F.col("r") <= anchors).orderBy("k", "cluster", "r").collect()
    if not rows:
        return {}
    chosen = {}
    for k, centroids in models.items():
        chosen[k] = []
        for j, c in enumerate(centroids):
            own = [r for r in rows if (r["k"], r["cluster"]) == (k, j)]
            some = np.array([r["x"] for r in own], float).reshape(-1, len(c))
            chosen[k].append((some, own[-1]["h"] if own else 0, np.asarray(c, float)))
    sums = points.mapInArrow(_shapes(chosen), "k int, sum long, n long").groupBy("k").agg(F.sum("sum").alias("s"), F.sum("n").alias("n"))
    return {r["k"]: r["s"] / float(1 << 40) / r["n"] for r in sums.orderBy("k").collect()}
