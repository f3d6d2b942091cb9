"""Whitening of embeddings by an incremental eigendecomposition.

A spectrum is the number of vectors seen, their exact sums, and the eigenvalues and
eigenvectors of their centred scatter. A partition takes its vectors in blocks: the
triangular factor R of a block (R'R is the block's scatter) has at most as many rows as
dimensions, and each row, and then the shift between the means, is a rank-one update
of the spectrum. An update solves the secular equation for the new eigenvalues, after
deflation of what it leaves unchanged, and finds the vectors from the roots. With
``block`` = 1 every single vector is an update of its own.

Spectra are combined by successive rank-one updates, up to ``FAN`` in a task, in rounds.
Two Rayleigh-Ritz passes over all vectors then refine the last spectrum: the covariance
projected on its vectors, summed by Spark, is diagonalised, and measured again."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from meterspan.session import written

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
BLOCK = 1024
FAN = 8
#: Entries beyond are taken as this, so that they fit a long.
FAR = 1 << 61
#: Eigenvalues below this share of the trace are rounding, not variance.
LEAST = 1e-13
_LOW = 1 << 31
_SPECTRUM = "at long, n long, low array<long>, high array<long>, values array<double>, vectors array<double>"


def _matrix(column):
    """(rows, matrix of doubles) for the vectors of the commonest kind: rows of ``column``
    that are not null, hold no null or non-finite entry, by their lengths."""
    lists = column.cast(pa.list_(pa.float64()))
    sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    valid = np.array(lists.is_valid(), bool) if len(lists) else np.zeros(0, bool)
    flat = lists.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.flatnonzero(sizes >= 0), sizes[sizes >= 0])
    valid[owner[~np.isfinite(flat)]] = False
    out = {}
    for size in set(sizes[valid].tolist()) - {0}:
        rows = np.flatnonzero(valid & (sizes == size))
        out[size] = rows, flat[(sizes == size)[owner] & valid[owner]].reshape(-1, size)
    return out


def _whole(matrix):
    """x = floor(64 * c) + 1000000 as longs."""
    floor = np.floor(SCALE * matrix)
    return np.clip(floor, -float(FAR), float(FAR)).astype(np.int64) + SHIFT


def _fit_rows(batches):
    for batch in batches:
        for size, (_, matrix) in _matrix(batch.column(0)).items():
            x = np.ascontiguousarray(_whole(matrix))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(x), size, np.int32)), pa.array([r.tobytes() for r in x], pa.binary())], ["size", "x"]
            )


def _deflated(d, q, z, small, least):
    """Rotates vectors of eigenvalues that hardly differ so that one of them takes the
    whole of z; returns the places where z is still worth an update."""
    live = []
    for i in np.flatnonzero(np.abs(z) > least):
        if live and d[i] - d[live[-1]] <= small:
            k = live[-1]
            r = np.hypot(z[k], z[i])
            c, s = z[i] / r, z[k] / r
            z[i], z[k] = r, 0.0
            q[:, k], q[:, i] = c * q[:, k] - s * q[:, i], s * q[:, k] + c * q[:, i]
            # The rotation leaves an off-diagonal entry below the tolerance.
            d[k], d[i] = c * c * d[k] + s * s * d[i], s * s * d[k] + c * c * d[i]
            live.pop()
        live.append(i)
    return np.array(live, np.int64)


def _step(c, a, b):
    """The root of c x x - a x + b = 0 that lies between the poles."""
    root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))


def _roots(d, z2):
    """Roots of 1 + sum z2 / (d - x) = 0 for ascending poles d: the differences d - x of
    every pole (rows) and root (columns). Every root is sought from its nearer pole, by
    rational steps within a bracket that shrinks."""
    n = len(d)
    ends = np.append(d, d[-1] + z2.sum())
    gap = np.diff(ends)
    poles = d[:, None] - d[None, :]
    middle = 1 + (z2[:, None] / (poles - gap / 2)).sum(0)
    right = middle < 0
    right[-1] = False
    shift = np.where(right, gap, 0.0)
    delta = poles - shift
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, gap / 2)
    low[-1], high[-1] = (gap[-1] / 2, gap[-1]) if middle[-1] < 0 else (0.0, gap[-1] / 2)
    own = np.tri(n, dtype=bool).T  # poles up to the root's own
    first, last = -shift, gap - shift
    # The first guess has the two poles next to the root, and the rest as at the middle.
    one, two = z2, np.append(z2[1:], 0.0)
    c = middle + 2 * (one - two) / gap
    x = _step(c, c * (first + last) + one + two, c * first * last + one * last + two * first)
    x = np.where((x > low) & (x < high), x, (low + high) / 2)
    done = np.zeros(n, bool)
    for _ in range(60):
        rest = delta - x
        share = z2[:, None] / rest
        f = 1 + share.sum(0)
        high, low = np.where(f > 0, x, high), np.where(f <= 0, x, low)
        done |= np.abs(f) <= 2 * np.finfo(float).eps * n * (1 + np.abs(share).sum(0))
        if done.all():
            break
        slope = share / rest
        below, above = (slope * own).sum(0), (slope * ~own).sum(0)
        one, two = np.diagonal(rest), last - x
        c = f - one * below - two * above
        step = _step(c, (one + two) * f - one * two * (below + above), one * two * f)
        # A step below the rounding of x ends the search; one out of the bracket is halved.
        done |= np.abs(step) <= 2 * np.finfo(float).eps * np.abs(x)
        fresh = np.where((x + step >= low) & (x + step <= high), x + step, (low + high) / 2)
        x = np.where(done, x, fresh)
    return delta - x


def update(values, vectors, v):
    """Eigenvalues (ascending) and eigenvectors of the matrix plus v v'."""
    z = v @ vectors
    norm = float(z @ z)
    if norm <= 0:
        return values, vectors
    d, q = values.copy(), vectors.copy()
    small = 1e-15 * max(abs(d[-1]), norm)
    live = _deflated(d, q, z, small, small / np.sqrt(norm))
    if not len(live):
        return values, vectors
    poles, part = d[live], z[live]
    if len(live) == 1:
        d[live] = poles + part * part
    else:
        rest = _roots(poles, part * part)
        diagonal = np.arange(len(live))
        apart = poles[:, None] - poles[None, :]
        apart[diagonal, diagonal] = 1.0
        ratio = rest / apart
        ratio[diagonal, diagonal] = -rest[diagonal, diagonal]
        # z that has exactly these roots: the vectors are orthogonal to rounding.
        exact = np.copysign(np.sqrt(np.abs(np.prod(ratio, 1))), part)
        with np.errstate(divide="ignore", invalid="ignore"):
            w = exact[:, None] / rest
        w /= np.sqrt((w * w).sum(0))
        d[live] = poles - rest[diagonal, diagonal]
        q[:, live] = q[:, live] @ w
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


class Spectrum:
    """n, exact sums, and the eigendecomposition of the centred scatter."""

    def __init__(self, size):
        self.n, self.total = 0, [0] * size
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def mean_from(self, base):
        return np.array([(t - b * self.n) / self.n for t, b in zip(self.total, base)])

    def merge(self, n, total, updates):
        """Adds ``n`` vectors of the sums ``total`` whose centred scatter is that of the
        rows of ``updates``."""
        if self.n:
            base = [t // self.n for t in self.total]
            other = np.array([(t - b * n) / n for t, b in zip(total, base)])
            shift = (other - self.mean_from(base)) * np.sqrt(self.n / (self.n + n) * n)
            updates = np.vstack([updates, shift])
        for row in updates:
            self.values, self.vectors = update(self.values, self.vectors, row)
        self.n += n
        self.total = [a + b for a, b in zip(self.total, total)]

    def add(self, x):
        """A block of vectors (rows of longs)."""
        base = x[0]
        near = x - base
        total = [int(b) * len(x) + int(t) for b, t in zip(base.tolist(), near.astype(object).sum(0) if np.abs(near).max() > 1 << 40 else near.sum(0))]
        centred = near.astype(float)
        centred -= centred.mean(0)
        updates = np.linalg.qr(centred, mode="r") if len(x) > x.shape[1] else centred
        self.merge(len(x), total, updates)

    def row(self, at):
        low, high = zip(*((t % _LOW, t // _LOW) for t in self.total)) if self.total else ((), ())
        cells = [[at], [self.n], [list(low)], [list(high)], [self.values], [self.vectors.ravel()]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], ["at", "n", "low", "high", "values", "vectors"])

    @staticmethod
    def read(row):
        size = len(row["values"])
        out = Spectrum(size)
        out.n, out.total = row["n"], [int(a) + int(b) * _LOW for a, b in zip(row["low"], row["high"])]
        out.values, out.vectors = np.array(row["values"]), np.array(row["vectors"]).reshape(size, size)
        return out


def _spectra(size, block):
    def run(batches):
        own, waiting = Spectrum(size), []
        held = 0
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, size)
            waiting.append(x)
            held += len(x)
            while held >= block:
                every = np.concatenate(waiting)
                own.add(every[:block])
                waiting, held = [every[block:]], held - block
        if held:
            own.add(np.concatenate(waiting))
        if own.n:
            yield own.row(TaskContext.get().partitionId())

    return run


def _combined(table):
    rows = sorted(table.to_pylist(), key=lambda r: r["at"])
    own = Spectrum.read(rows[0])
    for row in rows[1:]:
        other = Spectrum.read(row)
        own.merge(other.n, other.total, (np.sqrt(np.maximum(other.values, 0)) * other.vectors).T)
    return pa.Table.from_batches([own.row(rows[0]["at"] // FAN)])


def spectrum(fit, size, block=BLOCK):
    """The spectrum of all vectors of ``fit`` (column ``x``: longs as bytes), or None
    without any. The driver receives one spectrum."""
    rows = written(fit.select("x").mapInArrow(_spectra(size, block), _SPECTRUM), "whitening-spectra")
    while (top := rows.agg(F.max("at")).first()[0] or 0) > 0:
        rows = rows.groupBy(F.floor(F.col("at") / FAN).alias("group")).applyInArrow(_combined, _SPECTRUM)
        rows = written(rows, f"whitening-combined-{top}")
    found = rows.collect()
    return Spectrum.read(found[0].asDict()) if found else None


def _centred(x, base, rest):
    """x minus the mean, which is ``base`` + ``rest``."""
    return (x - base).astype(float) - rest


def _projected(size, base, rest, vectors):
    """Cells (at, value) of the scatter projected on ``vectors``, summed by task."""

    def run(batches):
        total = np.zeros((vectors.shape[1],) * 2)
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, size)
            p = _centred(x, base, rest) @ vectors
            total += p.T @ p
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "value"])

    return run


def _covariance(fit, size, n, base, rest, vectors):
    cells = fit.select("x").mapInArrow(_projected(size, base, rest, vectors), "at long, value double")
    out = np.zeros(vectors.shape[1] ** 2)
    for at, value in cells.groupBy("at").agg(F.sum("value")).collect():
        out[at] = value
    return out.reshape((vectors.shape[1],) * 2) / n


class Whitening:
    """What ``fit`` found: n, sums, mean, components (columns of ``vectors``) with their
    ``values`` and ``explained`` shares, and the ``error`` of the whitened covariance."""

    def __init__(self, size, n, total, base, rest, vectors, values, explained, error):
        self.size, self.n, self.total, self.base, self.rest = size, n, total, base, rest
        self.vectors, self.values, self.explained, self.error = vectors, values, explained, error


def fit(rows, column="embedding", components=COMPONENTS, block=BLOCK):
    """The whitening of the distinct vectors of ``rows``, or None where there is none.

    Rows whose vector is null, empty or holds a null or non-finite entry are left out; of
    several lengths the one with most distinct vectors counts (then the longest).
    Components without variance are left out, as they can't be scaled to 1: equal
    vectors give none. An entry beyond 2^61 / 64 counts as that."""
    found = rows.select(F.col(f"`{column}`").alias("v")).mapInArrow(_fit_rows, "size int, x binary")
    found = written(found.distinct(), "whitening-fit")
    sizes = sorted((r["count"], r["size"]) for r in found.groupBy("size").count().collect())
    if not sizes:
        return None
    n, size = sizes[-1]
    vectors = found.where(F.col("size") == size)
    first = spectrum(vectors, size, block)
    base = np.array([t // n for t in first.total], np.int64)
    rest = np.array([(t - int(b) * n) / n for t, b in zip(first.total, base)])
    ritz = _covariance(vectors, size, n, base, rest, first.vectors)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    turned = first.vectors @ turn[:, ::-1]
    turned = np.linalg.qr(turned)[0] * np.sign((turned * np.linalg.qr(turned)[0]).sum(0))
    again = _covariance(vectors, size, n, base, rest, turned)
    values, trace = np.diagonal(again), np.trace(again)
    kept = np.flatnonzero(values[:components] > LEAST * max(trace, 0.0))
    values, turned = values[kept], turned[:, kept]
    white = again[np.ix_(kept, kept)] / np.sqrt(np.outer(values, values))
    error = float(np.abs(white - np.eye(len(kept))).max()) if len(kept) else 0.0
    return Whitening(size, n, first.total, base, rest, turned, values, values / trace if trace else values, error)


def _deviation(model, x):
    """Sums of (n * x - S)^2, exact; null beyond the range of a long."""
    parts = [t - int(b) * model.n for t, b in zip(model.total, model.base)]
    near = x - model.base
    widest = max(1, int(np.abs(near).max(initial=0)) * model.n + max(map(abs, parts), default=0))
    if widest * widest * max(1, model.size) < 1 << 63:
        d = near * np.int64(model.n) - np.array(parts, np.int64)
        return pa.array((d * d).sum(1), pa.int64())
    d = near.astype(object) * model.n - np.array(parts, object)
    return pa.array([s if s < 1 << 63 else None for s in (d * d).sum(1).tolist()], pa.int64())


def _whitened(model):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    k = len(model.values)

    def run(batches):
        for batch in batches:
            rows, matrix = _matrix(batch.column(1)).get(model.size, (np.zeros(0, np.int64), None))
            if not len(rows) or not k:
                continue
            x = _whole(matrix)
            p = _centred(x, model.base, model.rest) @ model.vectors / np.sqrt(model.values)
            each = np.repeat(np.arange(len(rows)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(each), model.n)),
                    _deviation(model, x).take(pa.array(each)),
                    pa.array(p.ravel()),
                    pa.array(np.tile(model.explained, len(rows))),
                    pa.array(np.full(len(each), model.error)),
                ],
                names,
            )

    return run


def whitened(rows, model, key="vec_id", column="embedding"):
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error
    for every row that the fit can use and every component. Other rows, and those of
    another length, are left out; repeated rows and null ids are kept. No rows without
    a model."""
    kind = rows.schema[key].dataType.simpleString()
    layout = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], layout)
    return rows.select(F.col(f"`{key}`"), F.col(f"`{column}`")).mapInArrow(_whitened(model), layout)
