"""Isolation forest (Liu, Ting and Zhou, 2008) over pooled daily rows.

Every tree sees a sample of at most 256 rows, so fitting works on
trees x 256 rows whatever the table holds. Samples are chosen by hashing row
keys, which repeats on any partitioning. Trees are built one per group on the
executors; their nodes (at most trees x 511 short rows) form the model that is
sent to the scoring tasks."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterspan import fixed
from meterspan.operators.quantiles import exact_quantiles
from meterspan.session import written

NODE = "tree int, node int, left int, right int, feature int, threshold double, path double"


def mean_path(n):
    """Average path length of an unsuccessful search in a tree of n rows."""
    n = np.asarray(n, dtype=float)
    grown = np.maximum(n, 3.0)
    long = 2.0 * (np.log(grown - 1.0) + np.euler_gamma) - 2.0 * (grown - 1.0) / grown
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def tree_samples(df, columns, keys, trees, size, rows, seed):
    """``size`` rows per tree without replacement; all rows if there are fewer.

    A row has as many turns as the table needs to offer every tree about four times
    its sample: one turn on a large table, a turn for each tree on a small one. A hash
    of the key names the tree of the first turn and the others follow, so a tree is
    offered a row once at most; another hash decides whether it is. A tree takes the
    rows with the lowest hash."""
    unit = F.lit(float(2**53))

    def uniform(*parts):
        return F.pmod(F.xxhash64(*parts), F.lit(2**53)) / unit

    offered = 4 * trees * size
    turns = min(trees, max(1, math.ceil(offered / rows))) if rows else 1
    first = F.pmod(F.xxhash64(*keys, F.lit(seed + 1)), F.lit(trees))
    dealt = (
        df.select(*keys, *columns, F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("_turn"))
        .withColumn("_draw", uniform(*keys, "_turn", F.lit(seed)))
        .filter(F.col("_draw") < offered / max(1, rows * turns))
        .withColumn("tree", F.pmod(first + F.col("_turn"), F.lit(trees)).cast("int"))
    )
    lowest = Window.partitionBy("tree").orderBy("_draw", *keys)
    return (
        dealt.withColumn("_rank", F.row_number().over(lowest))
        .filter(F.col("_rank") <= size)
        .select("tree", "_rank", *columns)
    )


def _grow(sample, columns, seed):
    """Nodes of one tree: random feature, random cut between its extremes."""
    tree = int(sample["tree"].iloc[0])
    x = sample.sort_values("_rank")[list(columns)].to_numpy(dtype=float)
    dice = np.random.default_rng([seed, tree])
    deepest = int(np.ceil(np.log2(max(len(x), 2))))
    nodes, pending = [], [(0, x, 0)]
    count = 1
    while pending:
        node, part, depth = pending.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= deepest or len(part) <= 1 or len(usable) == 0:
            nodes.append((tree, node, -1, -1, -1, 0.0, depth + float(mean_path(len(part)))))
            continue
        feature = int(dice.choice(usable))
        cut = float(dice.uniform(low[feature], high[feature]))
        if cut >= high[feature]:  # the extremes are neighbouring doubles
            cut = float(low[feature])
        below = part[:, feature] <= cut
        nodes.append((tree, node, count, count + 1, feature, cut, 0.0))
        pending.append((count, part[below], depth + 1))
        pending.append((count + 1, part[~below], depth + 1))
        count += 2
    names = ["tree", "node", "left", "right", "feature", "threshold", "path"]
    return pd.DataFrame(nodes, columns=names)


class IsolationForestModel:
    """Fitted trees with the score offset that flags the wanted share of rows."""

    def __init__(self, spark, nodes, size, columns, trees, offset=None):
        width = int(nodes["node"].max()) + 1
        parts = {}
        for name in ("left", "right", "feature", "threshold", "path"):
            grid = np.zeros((trees, width), dtype=float if name in ("threshold", "path") else np.int32)
            grid[nodes["tree"], nodes["node"]] = nodes[name]
            parts[name] = grid
        self.columns, self.size, self.trees, self.offset = list(columns), size, trees, offset
        self.nodes = nodes
        self._shared = spark.sparkContext.broadcast(parts)

    def save(self, spark, path):
        """Nodes, columns, sizes and offset as tables below ``path``, for other sessions."""
        spark.createDataFrame(self.nodes, NODE).write.mode("overwrite").parquet(f"{path}/nodes")
        row = (self.columns, int(self.size), int(self.trees), self.offset)
        spark.createDataFrame([row], "columns array<string>, size int, trees int, offset double").write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark, path):
        meta = spark.read.parquet(f"{path}/meta").first()
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        return IsolationForestModel(spark, nodes, meta["size"], meta["columns"], meta["trees"], meta["offset"])

    def raw_score(self):
        """Column: minus the anomaly score, so lower means more isolated."""
        shared, scale, trees = self._shared, float(mean_path(self.size)), self.trees

        @F.pandas_udf("double")
        def score(*series: pd.Series) -> pd.Series:
            parts = shared.value
            x = np.column_stack([s.to_numpy(dtype=float) for s in series])
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for t in range(trees):
                at = np.zeros(len(x), dtype=np.int32)
                feature, cut = parts["feature"][t], parts["threshold"][t]
                left, right = parts["left"][t], parts["right"][t]
                while True:
                    split = feature[at]
                    inner = split >= 0
                    if not inner.any():
                        break
                    go_left = x[rows, np.maximum(split, 0)] <= cut[at]
                    at = np.where(inner, np.where(go_left, left[at], right[at]), at)
                total += parts["path"][t][at]
            return pd.Series(-(2.0 ** (-total / trees / scale)))

        return score(*[F.col(c) for c in self.columns])

    def score(self, df):
        """Adds ``anomaly_score`` (below zero means flagged), ``flagged`` and the
        -1 / 1 label."""
        return (
            df.withColumn("anomaly_score", self.raw_score() - F.lit(self.offset))
            .withColumn("flagged", F.col("anomaly_score") < 0)
            .withColumn("anomaly_prediction", F.when(F.col("flagged"), -1).otherwise(1))
        )


def fit_isolation_forest(
    df,
    columns=tuple(fixed.ANOMALY_FEATURES),
    keys=("household_id", "date"),
    trees=300,
    contamination=fixed.CONTAMINATION,
    sample_size=256,
    seed=42,
):
    spark = df.sparkSession
    complete = df.na.drop(subset=list(columns))
    rows = complete.count()
    size = min(sample_size, rows)
    samples = tree_samples(complete, columns, keys, trees, size, rows, seed)
    nodes = (
        samples.groupBy("tree")
        .applyInPandas(lambda sample: _grow(sample, columns, seed), NODE)
        .toPandas()
    )
    model = IsolationForestModel(spark, nodes, size, columns, trees)
    scores = written(complete.select(model.raw_score().alias("_score")), "forest-scores")
    model.offset = exact_quantiles(scores, "_score", [contamination]).first()["q0"]
    return model
