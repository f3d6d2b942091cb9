"""Regression trees grown from histograms, as a bagged forest or by boosting.

Features become at most 256 quantile bins once. A level of all open nodes is one pass
over the binned rows: every task sums gradient, weight and count per (node, feature, bin),
Spark adds the sums up, and each node takes the cut with the greatest gain

    T(GL)^2 / (HL + l2) + T(GR)^2 / (HR + l2) - T(G)^2 / (H + l2),  leaf = -T(G) / (H + l2),

where T moves a gradient sum towards zero by l1. A forest grows all of its trees in the
same passes (as many as the trees are deep); boosting grows one tree after the other on
the gradients that the trees before have left.

Fits do not depend on the layout of the rows: bags, row draws and column draws are
hashes of row keys and node numbers, and sums are of integers (fixed-point gradients),
so that any order of addition gives the same tree. Rows are never gathered; the driver
holds the model, whose size is bounded by its parameters (trees x 2^(depth + 1))."""

import io
import json
import math
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterspan.session import written

BINS = 256
#: Rows of the hash sample that quantile bins come from; tables up to this size are taken whole.
SAMPLE = 1 << 16
#: Rows of boosting that one task may hold.
IN_TASK = 1 << 16
#: Chances that a row is drawn more than 0, 1, 2, ... times, for a bag as large as the table.
_POISSON = 1 - np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NODE = "tree int, node int, feature int, bin int, threshold double, left int, value double, gain double, weight double"
_CELLS = "unit long, cell int, g long, h long, n long"
_SPLITS = "unit long, feature int, bin int, gain double, gl long, hl long, nl long, g long, h long, n long"


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(rows, units, seed):
    """Uniform numbers in [0, 1) for every pair of a row id and a unit."""
    with np.errstate(over="ignore"):
        base = _mix(units.astype(np.uint64) * _ODD + np.uint64(seed))
        return (_mix(rows.astype(np.int64).view(np.uint64)[:, None] ^ base[None, :]) >> np.uint64(11)) / float(1 << 53)


def chosen_columns(units, columns, m, seed):
    """The ``m`` columns, in order, that every unit may split."""
    if m >= columns:
        return np.tile(np.arange(columns), (len(units), 1))
    score = draws(np.arange(columns), np.asarray(units), seed).T
    return np.sort(np.argsort(score, 1, kind="stable")[:, :m], 1)


# --- binning -------------------------------------------------------------------


def quantile_cuts(rows, columns, key, bins=BINS, sample=SAMPLE):
    """Ascending cuts per column, so that a value's bin is the number of cuts below it.
    ``key`` is a column of row ids, whose hash decides the sample."""
    n = rows.count()
    share = F.pmod(F.xxhash64(key, F.lit(5)), F.lit(1 << 30)) < F.lit(min(1 << 30, (sample << 30) // max(1, n)))
    table = rows.where(share).select(*columns).toPandas()
    cuts = []
    for c in columns:
        values = np.unique(table[c].to_numpy(dtype=float))
        if len(values) > bins:
            ordered = np.sort(table[c].to_numpy(dtype=float))
            values = np.unique(ordered[(np.arange(bins) * len(ordered)) // bins])
        cuts.append((values[1:] + values[:-1]) / 2)
    return n, cuts


def _binning(cuts):
    def run(batches):
        for batch in batches:
            x = [np.asarray(c.to_numpy(zero_copy_only=False), float) for c in batch.columns[2:]]
            bins = np.stack([np.searchsorted(edges, v, "left") for edges, v in zip(cuts, x)], 1).astype(np.uint8)
            binary = pa.array([r.tobytes() for r in np.ascontiguousarray(bins)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), binary], ["id", "label", "bins"])

    return run


def binned_rows(df, columns, label, keys, bins=BINS, sample=SAMPLE):
    """Rows (id, label, bins) written once, their number, and the cuts. Rows with a
    null or NaN feature or label are left out."""
    good = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in (*columns, label)]
    rows = df.where(reduce(and_, good)).select(
        F.xxhash64(*keys).alias("id"), F.col(label).cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in columns]
    )
    rows = written(rows, "tree-rows")
    n, cuts = quantile_cuts(rows, columns, "id", bins, sample)
    return rows.mapInArrow(_binning(cuts), "id long, label double, bins binary"), n, cuts


# --- sums and cuts -------------------------------------------------------------


def _summed(unit, cell, sums):
    """Rows of equal (unit, cell) added up, ordered."""
    order = np.lexsort((cell, unit))
    unit, cell = unit[order], cell[order]
    first = np.flatnonzero(np.concatenate(([True], (unit[1:] != unit[:-1]) | (cell[1:] != cell[:-1])))) if len(unit) else np.zeros(0, np.int64)
    return unit[first], cell[first], [np.add.reduceat(s[order], first) if len(first) else s[:0] for s in sums]


def cells_of(unit, row, sums, bins, choice, first):
    """Sums per (unit, feature, bin) for pairs of a unit and a row. ``choice`` has the
    columns of unit ``first`` and the following."""
    features = choice[unit - first]
    cell = features * BINS + bins[row[:, None], features]
    m = features.shape[1]
    return _summed(np.repeat(unit, m), cell.ravel(), [np.repeat(s, m) for s in sums])


def _shrunk(g, l1):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_value(g, h, rule):
    scale = rule["scale"]
    return -_shrunk(g / scale, rule["l1"]) / (h + rule["l2"])


def best_cuts(unit, cell, sums, rule):
    """The best cut of every unit, from ordered cells: unit, feature, bin, gain, the sums
    of its left side and of the unit. Units without a cut that leaves ``least_rows`` and
    ``least_weight`` on both sides have gain 0. Ties go to the first feature and bin."""
    feature = cell // BINS
    new = np.concatenate(([True], (unit[1:] != unit[:-1]) | (feature[1:] != feature[:-1])))
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    left, total = [], []
    for s in sums:
        run = np.cumsum(s)
        left.append(run - (run[starts] - s[starts])[group])
        total.append(np.add.reduceat(s, starts)[group])
    (gl, hl, nl), (g, h, n) = left, total

    def score(g, h):
        return _shrunk(g / rule["scale"], rule["l1"]) ** 2 / np.maximum(h + rule["l2"], 1e-300)

    gain = score(gl, hl) + score(g - gl, h - hl) - score(g, h)
    fits = (nl >= rule["least_rows"]) & (n - nl >= rule["least_rows"]) & (hl >= rule["least_weight"]) & (h - hl >= rule["least_weight"])
    gain = np.where(fits & (gain > rule["least_gain"]), gain, 0.0)
    edges = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
    top = np.maximum.reduceat(gain, edges)
    owner = np.cumsum(np.concatenate(([True], unit[1:] != unit[:-1]))) - 1
    places = np.flatnonzero(gain == top[owner])
    best = places[np.unique(owner[places], return_index=True)[1]]
    return unit[best], feature[best], cell[best] % BINS, gain[best], gl[best], hl[best], nl[best], g[best], h[best], n[best]


def _cutting(rule):
    """Best cuts from cells in order of their unit, streamed: a unit's cells meet here."""

    def cut(parts):
        unit, cell, *sums = (np.concatenate([p[k] for p in parts]) for k in range(5))
        unit, cell, sums = _summed(unit, cell, sums)
        return pa.RecordBatch.from_arrays(
            [pa.array(x.astype(k)) for x, k in zip(best_cuts(unit, cell, sums, rule), [np.int64, np.int32, np.int32, float, *[np.int64] * 6])],
            ["unit", "feature", "bin", "gain", "gl", "hl", "nl", "g", "h", "n"],
        )

    def run(batches):
        held = []
        for batch in batches:
            held.append([np.asarray(c.to_numpy(zero_copy_only=False)) for c in batch.columns])
            unit = held[-1][0]
            if len(unit) and unit[0] != unit[-1]:
                last = int(np.searchsorted(unit, unit[-1], "left"))
                rest = [x[last:] for x in held[-1]]
                held[-1] = [x[:last] for x in held[-1]]
                yield cut(held)
                held = [rest]
        if sum(len(p[0]) for p in held):
            yield cut(held)

    return run


# --- models --------------------------------------------------------------------

_PARTS = ("roots", "feature", "bin", "left", "threshold", "value", "gain", "weight")


class TreeModel:
    """Trees as one array of nodes. A node with ``feature`` -1 is a leaf; else rows with a
    value up to ``threshold`` go to ``left``, others to the node after it. The prediction
    is ``base`` plus ``factor`` times the sum of the leaves."""

    def __init__(self, columns, output, base, factor):
        self.columns, self.output, self.base, self.factor = list(columns), output, float(base), float(factor)
        self.roots = np.zeros(0, np.int32)
        self.feature, self.bin, self.left = np.zeros(0, np.int16), np.zeros(0, np.int16), np.zeros(0, np.int32)
        self.threshold, self.value = np.zeros(0), np.zeros(0)
        self.gain, self.weight = np.zeros(0), np.zeros(0)
        self._sent = None
        self.name = np.zeros(0, np.uint64)  # of a node, by its tree and the way to it

    def __getstate__(self):
        return {**self.__dict__, "_sent": None}

    def grow(self, values, weights, names=None):
        """New leaves; returns the number of the first."""
        first, n = len(self.feature), len(values)
        self.name = np.concatenate([self.name, np.zeros(n, np.uint64) if names is None else names])
        self.feature = np.concatenate([self.feature, np.full(n, -1, np.int16)])
        self.bin = np.concatenate([self.bin, np.zeros(n, np.int16)])
        self.left = np.concatenate([self.left, np.zeros(n, np.int32)])
        for name, more in (("threshold", np.zeros(n)), ("value", values), ("gain", np.zeros(n)), ("weight", weights)):
            setattr(self, name, np.concatenate([getattr(self, name), np.asarray(more, float)]))
        return first

    def split(self, cut, cuts, rule):
        """Turns the units of ``cut`` (best cuts) into inner nodes; returns their children
        as (node, h, n), left and right in turn."""
        unit, feature, place, gain, gl, hl, nl, g, h, n = cut
        pairs = lambda a, b: np.stack([a, b], 1).ravel()
        gs, hs, ns = pairs(gl, g - gl), pairs(hl, h - hl), pairs(nl, n - nl)
        names = _mix(pairs(self.name[unit], self.name[unit] ^ _ODD))
        first = self.grow(leaf_value(gs, hs, rule), hs, names)
        self.feature[unit], self.bin[unit] = feature, place
        self.left[unit] = first + 2 * np.arange(len(unit))
        self.gain[unit] = gain
        self.threshold[unit] = [cuts[f][b] for f, b in zip(feature, place)]
        return first + np.arange(2 * len(unit)), hs, ns

    def places(self, x, roots, steps, by_bin=False):
        """The node (rows x trees) where every row of ``x`` ends."""
        at = np.tile(roots, (len(x), 1)).astype(np.int64)
        rows = np.arange(len(x))[:, None]
        bound = self.bin if by_bin else self.threshold
        for _ in range(steps):
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                break
            right = x[rows, np.maximum(f, 0)] > bound[at]
            at = np.where(inner, self.left[at] + right, at)
        return at

    def step(self, at, x):
        """The nodes that rows at the nodes ``at`` go to, by bins."""
        f = self.feature[at]
        right = x[np.arange(len(at)), np.maximum(f, 0)] > self.bin[at]
        return np.where(f >= 0, self.left[at] + right, at)

    def to_bytes(self):
        out = io.BytesIO()
        np.savez(out, meta=json.dumps([self.columns, self.output, self.base, self.factor]), **{n: getattr(self, n) for n in _PARTS})
        return out.getvalue()

    @staticmethod
    def from_bytes(data):
        parts = np.load(io.BytesIO(data))
        out = TreeModel(*json.loads(str(parts["meta"])))
        for name in _PARTS:
            setattr(out, name, parts[name])
        out.name = np.zeros(len(out.feature), np.uint64)
        return out

    def append(self, other):
        """Adds the trees of another model."""
        at = len(self.feature)
        for name in _PARTS[1:]:
            more = getattr(other, name) + (at if name == "left" else 0)
            setattr(self, name, np.concatenate([getattr(self, name), more.astype(getattr(self, name).dtype)]))
        self.roots = np.append(self.roots, other.roots + np.int32(at)).astype(np.int32)

    def depth(self):
        level, depth = self.roots, 0
        while True:
            inner = level[self.feature[level] >= 0]
            if not len(inner):
                return depth
            level, depth = np.concatenate([self.left[inner], self.left[inner] + 1]), depth + 1

    def predict(self, x):
        out, deep = np.zeros(len(x)), self.depth()
        for a in range(0, len(x), 4096):
            for b in range(0, len(self.roots), 512):
                at = self.places(x[a : a + 4096], self.roots[b : b + 512], deep)
                out[a : a + 4096] += self.value[at].sum(1)
        return self.base + self.factor * out

    def transform(self, df):
        """``df`` with the prediction, from the feature columns or, where they are not
        there, from the array or vector ``features``; null where a feature is null. A plan
        node of its own, so that steps that follow each other do not grow into one expression."""
        if self._sent is None:
            self._sent = df.sparkSession.sparkContext.broadcast(self)
        shared = self._sent

        def run(batches):
            model = shared.value
            for batch in batches:
                flat = batch.column(batch.num_columns - 1).flatten().fill_null(np.nan)
                x = flat.to_numpy(zero_copy_only=False).reshape(-1, len(model.columns))
                y = pa.array(model.predict(x), mask=np.isnan(x).any(1))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], y], [*batch.schema.names[:-1], model.output])

        here = set(self.columns) <= set(df.columns)
        if here:
            features = F.array(*[F.col(c).cast("double") for c in self.columns])
        else:
            features = vector_to_array("features") if isinstance(df.schema["features"].dataType, VectorUDT) else F.col("features")
        schema = T.StructType([*df.schema.fields, T.StructField(self.output, T.DoubleType())])
        return df.withColumn("_x", features).mapInArrow(run, schema)

    def importances(self, kind):
        """Share of every feature, summing to 1: ``impurity``, the mean over trees of the
        normalised gains, or ``gain``, the mean gain of a feature's cuts."""
        inner = self.feature >= 0
        f, gain, size = self.feature[inner], self.gain[inner], len(self.columns)
        if kind == "gain":
            total = np.bincount(f, gain, minlength=size) / np.maximum(np.bincount(f, minlength=size), 1)
        else:
            by_tree = np.zeros((len(self.roots), size))
            np.add.at(by_tree, (self._owners()[inner], f), gain)
            whole = by_tree.sum(1, keepdims=True)
            total = (by_tree / np.where(whole > 0, whole, 1)).sum(0)
        return total / total.sum() if total.sum() > 0 else total

    def _owners(self):
        tree = np.zeros(len(self.feature), np.int64)
        tree[self.roots] = np.arange(len(self.roots))
        level = self.roots
        while len(inner := level[self.feature[level] >= 0]):
            for side in (0, 1):
                tree[self.left[inner] + side] = tree[inner]
            level = np.concatenate([self.left[inner], self.left[inner] + 1])
        return tree

    def save(self, spark, path):
        """The nodes as a table below ``path``, and what else the model needs."""
        meta = {"columns": self.columns, "output": self.output, "base": self.base, "factor": self.factor}
        table = pd.DataFrame(
            {"tree": self._owners(), "node": np.arange(len(self.feature)), "feature": self.feature, "bin": self.bin, "threshold": self.threshold,
             "left": self.left, "value": self.value, "gain": self.gain, "weight": self.weight}
        )
        table["root"] = table["node"].isin(set(self.roots.tolist()))
        spark.createDataFrame(table, _NODE + ", root boolean").write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark, path):
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        table = spark.read.parquet(f"{path}/nodes").toPandas().sort_values("node")
        out = TreeModel(meta["columns"], meta["output"], meta["base"], meta["factor"])
        out.roots = table.loc[table["root"], ["tree", "node"]].sort_values("tree")["node"].to_numpy(np.int32)
        for name, kind in (("feature", np.int16), ("bin", np.int16), ("left", np.int32), ("threshold", float), ("value", float), ("gain", float), ("weight", float)):
            setattr(out, name, table[name].to_numpy(kind))
        return out


def _fixed_scale(n, top):
    """Units per 1 of a fixed-point gradient, so that n of up to ``top`` fit a long."""
    return float(2 ** max(0, min(40, 60 - math.ceil(math.log2(max(n, 1) * max(top, 1e-9))))))


_ORDER = ["unit", "feature", "bin", "gain", "gl", "hl", "nl", "g", "h", "n"]


def _sorted_cuts(table):
    columns = [table.column(c).to_numpy() for c in _ORDER]
    order = np.argsort(columns[0], kind="stable")
    return [c[order] for c in columns]


def _spread_cuts(rule):
    """Cuts found by tasks: units are dealt out by hash; for levels of many nodes."""

    def found(cells):
        rows = cells.repartition("unit").sortWithinPartitions("unit", "cell")
        return _sorted_cuts(rows.mapInArrow(_cutting(rule), _SPLITS).toArrow())

    return found


def _driver_cuts(rule):
    """Cuts of few nodes: at most nodes x features x bins sums come to the driver."""

    def found(cells):
        table = cells.groupBy("unit", "cell").agg(*[F.sum(c).alias(c) for c in "ghn"]).toArrow()
        unit, cell, *sums = (table.column(c).to_numpy() for c in ("unit", "cell", "g", "h", "n"))
        if not len(unit):
            return [np.zeros(0, np.int64)] * len(_ORDER)
        return best_cuts(*_summed(unit, cell, sums), rule)

    return found


def _arrays(batch):
    ids, label = (np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in (0, 1))
    bins = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(len(ids), -1)
    return ids, label, bins


def _cell_batch(unit, cell, sums):
    return pa.RecordBatch.from_arrays(
        [pa.array(unit.astype(np.int64)), pa.array(cell.astype(np.int32)), *(pa.array(s.astype(np.int64)) for s in sums)],
        ["unit", "cell", "g", "h", "n"],
    )


def bags(ids, trees, seed):
    """How often every row is in the bag of every tree: Poisson counts of mean 1."""
    return np.searchsorted(-_POISSON, -draws(ids, trees, seed), "left").astype(np.int64)


class _Bagging:
    """What all trees of a forest share."""

    def __init__(self, columns, cuts, rule, base, depth, per_node, seed):
        self.columns, self.cuts, self.rule, self.base = columns, cuts, rule, base
        self.depth, self.seed = depth, seed
        self.m = per_node or max(1, int(math.sqrt(len(columns))))

    def roots(self, model, first, trees):
        """Adds the roots of ``trees`` trees from number ``first`` on; returns them."""
        numbers = np.arange(first, first + trees)
        at = model.grow(np.zeros(trees), np.zeros(trees), _mix(numbers.astype(np.uint64) + np.uint64(1)))
        model.roots = np.append(model.roots, np.arange(at, at + trees, dtype=np.int32))
        return numbers

    def fixed(self, y):
        return -np.rint((y - self.base) * self.rule["scale"]).astype(np.int64)

    def cells(self, model, at, weight, y, x, units):
        """Sums of the open ``units``: ``at`` (rows x trees) has the nodes of the rows."""
        first, last = int(units[0]), int(units[-1])
        is_open = np.zeros(last - first + 1, bool)
        is_open[units - first] = True
        choice = chosen_columns(model.name[first : last + 1], len(self.columns), self.m, self.seed + 1)
        live = (weight > 0) & (at >= first) & (at <= last)
        live[live] = is_open[at[live] - first]
        row, tree = np.nonzero(live)
        w = weight[row, tree]
        return cells_of(at[row, tree], row, [self.fixed(y)[row] * w, w, np.ones_like(w)], x, choice, first)

    def open_units(self, nodes, n):
        return nodes[n >= 2 * self.rule["least_rows"]]


def _own_trees(shared, rows, group, output, trees):
    """Trees that a task grows by itself, from rows that it holds."""

    def run(batches):
        ids, y, x = rows
        for batch in batches:
            for first in batch.column(0).to_pylist():
                model = TreeModel(shared.columns, output, shared.base, 1.0)
                numbers = shared.roots(model, first, min(group, trees - first))
                weight = bags(ids, numbers, shared.seed)
                at = np.tile(model.roots, (len(ids), 1)).astype(np.int64)
                units = model.roots.astype(np.int64)
                for _ in range(shared.depth):
                    if not len(units):
                        break
                    cells = shared.cells(model, at, weight, y, x, units)
                    if not len(cells[0]):
                        break
                    found = best_cuts(*cells, shared.rule)
                    nodes, _, n = model.split([v[found[3] > 0] for v in found], shared.cuts, shared.rule)
                    units = shared.open_units(nodes, n)
                    for k in range(at.shape[1]):
                        at[:, k] = model.step(at[:, k], x)
                yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([model.to_bytes()])], ["first", "model"])

    return run


def fit_forest(
    df, columns, label, keys, trees=400, depth=20, least_rows=2, per_node=None, seed=42, bins=BINS, output="prediction", in_task=IN_TASK
):
    """A bagged forest: every tree sees every row as often as a hash of its key says
    (Poisson, mean 1), every node chooses among ``per_node`` columns (the root of their
    number, if not given). ``keys`` name a row; rows of equal keys share their draws.
    An empty table gives a model that predicts 0.

    A level of all trees is one pass over the rows. A table of up to ``in_task`` rows (a
    byte per feature each) is sent to the tasks instead, each of which grows some of the
    trees; they are the same trees."""
    binned, n, cuts = binned_rows(df, columns, label, keys, bins)
    binned = written(binned, "forest-rows")
    base, top = binned.agg(F.avg("label"), F.max(F.abs("label"))).first()
    rule = {"l1": 0.0, "l2": 0.0, "least_rows": least_rows, "least_weight": 0, "least_gain": 1e-9}
    rule["scale"] = _fixed_scale(n, 32 * (top or 1.0))
    base = round((base or 0.0) * rule["scale"]) / rule["scale"]
    shared = _Bagging(list(columns), cuts, rule, base, depth, per_node, seed)
    model = TreeModel(columns, output, base, 1.0 / trees)
    if n <= in_task:
        spark = df.sparkSession
        table = binned.toArrow().sort_by("id").combine_chunks()
        rows = _arrays(table.to_batches()[0]) if n else (np.zeros(0, np.int64), np.zeros(0), np.zeros((0, len(columns)), np.uint8))
        group = max(1, min(16, (1 << 22) // max(n, 1)))
        starts = spark.range(0, trees, group, -(-trees // group))
        grown = starts.mapInArrow(_own_trees(shared, rows, group, output, trees), "first long, model binary").toArrow().to_pylist()
        for part in sorted(grown, key=lambda r: r["first"]):
            model.append(TreeModel.from_bytes(part["model"]))
        return model
    numbers = shared.roots(model, 0, trees)

    def tally(units, level):
        def run(batches):
            for batch in batches:
                ids, y, x = _arrays(batch)
                step = max(1, (1 << 21) // trees)
                for a in range(0, len(ids), step):
                    part = slice(a, a + step)
                    at = model.places(x[part], model.roots, level, by_bin=True)
                    yield _cell_batch(*shared.cells(model, at, bags(ids[part], numbers, seed), y[part], x[part], units))

        return run

    units, spread = model.roots.astype(np.int64), _spread_cuts(rule)
    for level in range(depth):
        found = spread(binned.mapInArrow(tally(units, level), _CELLS))
        nodes, _, rows = model.split([x[found[3] > 0] for x in found], cuts, rule)
        units = shared.open_units(nodes, rows)
        if not len(units):
            break
    return model


class _Boosting:
    """What all rounds of a fit share: the rules, the draws and the base."""

    def __init__(self, columns, cuts, rule, base, depth, step, row_share, column_share, seed):
        self.columns, self.cuts, self.rule, self.base = len(columns), cuts, rule, base
        self.depth, self.step, self.row_share, self.seed = depth, step, row_share, seed
        self.m = max(1, int(column_share * len(columns)))

    def drawn(self, ids, number):
        return draws(ids, np.array([number]), self.seed)[:, 0] < self.row_share

    def cells(self, at, rest, x, units, number):
        """Sums of the open ``units`` over rows that stand at the nodes ``at``."""
        first = int(units[0])
        is_open = np.zeros(int(units[-1]) - first + 1, bool)
        is_open[units - first] = True
        choice = np.tile(chosen_columns(np.array([number]), self.columns, self.m, self.seed + 1), (len(is_open), 1))
        row = np.flatnonzero((at >= first) & (at < first + len(is_open)))
        row = row[is_open[at[row] - first]]
        g, one = -np.rint(rest[row] * self.rule["scale"]).astype(np.int64), np.ones(len(row), np.int64)
        return cells_of(at[row], row, [g, one, one], x, choice, first)

    def grow_tree(self, model, find):
        """One more tree. ``find(level, units)`` returns the best cuts of the open units."""
        root = model.grow(np.zeros(1), np.zeros(1))
        model.roots = np.append(model.roots, np.int32(root))
        units = np.array([root], np.int64)
        for level in range(self.depth):
            found = find(level, units)
            cut = [x[found[3] > 0] for x in found]
            nodes, h, _ = model.split(cut, self.cuts, self.rule)
            units = nodes[h >= 2 * self.rule["least_weight"]]
            if not len(units):
                break


_ROUND = "id long, label double, bins binary, model binary"


def _task_rounds(shared, model, rounds):
    """Several rounds over the rows of one task, which are all rows."""

    def run(batches):
        parts = [_arrays(b) for b in batches]
        ids, rest, x = (np.concatenate([p[k] for p in parts]) for k in range(3))
        for _ in range(rounds):
            number, at = len(model.roots), None
            drawn = shared.drawn(ids, number)
            some, left = x[drawn], rest[drawn]

            def find(level, units):
                nonlocal at
                at = model.places(some, model.roots[number:], 0, True)[:, 0] if level == 0 else model.step(at, some)
                return best_cuts(*shared.cells(at, left, some, units, number), shared.rule)

            shared.grow_tree(model, find)
            end = model.places(x, model.roots[number:], shared.depth, True)[:, 0]
            rest = rest - shared.step * model.value[end]
        binary = pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())
        yield _round_batch(pa.array(ids), pa.array(rest), binary, pa.nulls(len(ids), pa.binary()))
        yield _round_batch(pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64()), pa.nulls(1, pa.binary()), pa.array([model.to_bytes()]))

    return run


def _round_batch(*columns):
    return pa.RecordBatch.from_arrays(list(columns), ["id", "label", "bins", "model"])


def fit_boosting(
    df, columns, label, keys, rounds=700, depth=6, step=0.03, least_weight=3, row_share=0.8, column_share=0.8,
    l1=0.05, l2=1.0, seed=42, bins=BINS, output="prediction", keep=100, in_task=IN_TASK,
):
    """Second-order boosting of squared errors: each tree is grown on the gradients of a
    draw of rows (by a hash of key and round) and of columns, its leaves are shrunk by
    ``l1`` and ``l2`` and added ``step`` times. The base is the mean label. An empty table
    gives a model that predicts 0.

    A level of a tree is one pass over all rows, and every ``keep`` rounds what the trees have
    left of the labels is written, so that a lost executor costs few rounds. Up to
    ``in_task`` rows (a byte per feature each) are held by one task, which takes those
    rounds without a job for every level; the trees are the same."""
    binned, n, cuts = binned_rows(df, columns, label, keys, bins)
    binned = written(binned, "boosting-rows")
    base, low, high = binned.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    rule = {"l1": l1, "l2": l2, "least_rows": 1, "least_weight": least_weight, "least_gain": 1e-9}
    rule["scale"] = _fixed_scale(n, 8 * ((high - low) if n else 1.0))
    base = round((base or 0.0) * rule["scale"]) / rule["scale"]
    model = TreeModel(columns, output, base, step)
    shared = _Boosting(columns, cuts, rule, base, depth, step, row_share, column_share, seed)
    held = binned.select("id", (F.col("label") - F.lit(base)).alias("label"), "bins")
    if not n:
        return model
    if n <= in_task:
        while len(model.roots) < rounds:
            ahead = min(keep, rounds - len(model.roots))
            done = written(held.repartition(1).mapInArrow(_task_rounds(shared, model, ahead), _ROUND), "boosting-rounds")
            model = TreeModel.from_bytes(done.where("model is not null").first()["model"])
            held = done.where("model is null").select("id", "label", "bins")
        return model
    since = 0  # ``held`` has what this many trees leave

    def left_after(rest, x, trees):
        return rest - step * model.value[model.places(x, trees, depth, True)].sum(1) if len(trees) else rest

    def folded(batches):
        for batch in batches:
            _, rest, x = _arrays(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(left_after(rest, x, model.roots[since:])), batch.column(2)], ["id", "label", "bins"]
            )

    def tally(level, units, number):
        def run(batches):
            for batch in batches:
                ids, rest, x = _arrays(batch)
                drawn = shared.drawn(ids, number)
                x, rest = x[drawn], left_after(rest[drawn], x[drawn], model.roots[since:number])
                at = model.places(x, model.roots[number:], level, True)[:, 0]
                yield _cell_batch(*shared.cells(at, rest, x, units, number))

        return run

    find_cuts = _driver_cuts(rule)
    for number in range(rounds):
        if number - since >= keep:
            held, since = written(held.mapInArrow(folded, "id long, label double, bins binary"), "boosting-rest"), number
        shared.grow_tree(model, lambda level, units, k=number: find_cuts(held.mapInArrow(tally(level, units, k), _CELLS)))
    return model
