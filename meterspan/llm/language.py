"""Language of a text by the nearest of several centroids per language.

A text is a vector of hashed byte trigrams (lower-case, everything that is no
letter as a space): log term counts times inverse document frequency, length 1.
The vectors of a language's sample are clustered into a few centroids; a text has
the language of the centroid with the highest cosine. It is rejected where that
cosine is below ``REACH`` times what nearly all of the language's sample reaches at
the text's length: cosines grow with it, and foreign texts have some too, since they
share trigrams and buckets with the learned ones. What the sample reaches at a length
is found by thinning its counts."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from meterspan.llm import text
from meterspan.llm.samples import per_class

DIMENSIONS = 4096
CENTROIDS = 4
PER_LANGUAGE = 400
REACH = 0.5
#: "Nearly all" of the sample is all but this share of it.
LEAST = 0.01
#: Lengths are taken by their power of two, from 2**2 to 2**11 distinct trigrams.
SHORTEST, LONGEST = 2, 11
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _grams(data):
    """Hashed trigrams of bytes that start and end with a space, by position."""
    b = _FOLD[np.frombuffer(data, np.uint8)].astype(np.uint32)
    code = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    return (code >> np.uint32(20)).astype(np.int64), b[1:-1] != 32


def counts(texts):
    """(first, matrix) with a row of trigram counts for each text."""
    for at, end in text.groups(texts, 256):
        if end == at + 1:
            row = np.zeros(DIMENSIONS, np.int64)
            for part in text.slices(texts[at]):
                grams, real = _grams(b" " + part)
                row += np.bincount(grams[real], minlength=DIMENSIONS)
            yield at, row[None].astype(np.float32)
        else:
            grams, real = _grams(b" " + b" ".join(texts[at:end]) + b" ")
            owner = np.repeat(np.arange(end - at), [len(t) + 1 for t in texts[at:end]])[: len(grams)]
            flat = (owner * DIMENSIONS + grams)[real]
            yield at, np.bincount(flat, minlength=(end - at) * DIMENSIONS).reshape(end - at, DIMENSIONS).astype(np.float32)


def _unit(x):
    length = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(length > 0, length, 1)


def _sparse(batches):
    for batch in batches:
        for at, rows in counts(text.raw(batch.column(1))):
            where = [np.flatnonzero(r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, len(rows)),
                    pa.array([w.astype(np.uint16).tobytes() for w in where], pa.binary()),
                    pa.array([r[w].tobytes() for r, w in zip(rows, where)], pa.binary()),
                ],
                ["lang", "at", "count"],
            )


def _cluster(x, k, rounds=20):
    """Spherical k-means from far-apart rows; the same rows give the same result."""
    chosen = [int(np.argmax(x @ x.mean(0)))]
    near = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    c = x[chosen]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        c = _unit(np.stack([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))]))
    return c


def _length(counts):
    """Which bound a row of trigram counts has: by its distinct trigrams, so that a
    text of one repeated word is a short one."""
    seen = np.maximum((counts > 0).sum(1), 1)
    return np.clip(np.log2(seen).astype(np.int64), SHORTEST, LONGEST) - SHORTEST


def _reach(counts, idf, centroids, rng):
    """The bound at each length, of the sample ``counts`` of one language: its rows are
    thinned to every power of two of trigrams. A length that has fewer rows than a tenth
    of the sample takes the bound of the length before."""
    total, lengths, cosines = counts.sum(1), [], []
    row, column = np.nonzero(counts)
    for power in range(SHORTEST, LONGEST + 2):
        thin = np.zeros_like(counts)
        share = np.minimum(1, (1 << power) / np.maximum(total, 1))
        thin[row, column] = rng.binomial(counts[row, column].astype(np.int64), share[row])
        thin = thin[(total >= 1 << power) & thin.any(1)]
        lengths.append(_length(thin))
        cosines.append((_unit(np.log1p(thin) * idf) @ centroids.T).max(1))
    length, cosine, bounds = np.concatenate(lengths), np.concatenate(cosines), [0.0]
    for k in range(LONGEST - SHORTEST + 1):
        own = cosine[length == k]
        bounds.append(REACH * np.quantile(own, LEAST) if len(own) >= max(1, len(counts) / 10) else bounds[-1])
    return bounds[1:]


def fit(docs, per_language=PER_LANGUAGE):
    """The model of the languages in ``docs`` (doc_id, text, lang): a bounded sample
    of about ``per_language`` rows each, of rows with a letter and a lang. Two jobs
    run here; the driver receives the sample's sparse vectors."""
    text.small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sample = per_class(rows, "lang", "doc_id", per_language).select("lang", "text")
    found = sorted(tuple(r) for r in sample.mapInArrow(_sparse, "lang string, at binary, count binary").collect())
    x = np.zeros((len(found), DIMENSIONS), np.float32)
    for row, (_, at, count) in zip(x, found):
        row[np.frombuffer(at, np.uint16)] = np.frombuffer(count, np.float32)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + np.float32(0.05)
    raw, x, rng = x, _unit(np.log1p(x) * idf), np.random.default_rng(7)
    names = np.array([f[0] for f in found], object)
    owners, centroids, reach = [], [], []
    for name in sorted(set(names)):
        own = x[names == name]
        c = _cluster(own, CENTROIDS)
        owners += [name] * len(c)
        centroids += list(c)
        reach += [_reach(raw[names == name], idf, c, rng)] * len(c)
    return {
        "idf": idf,
        "names": owners,
        "centroids": np.stack(centroids) if centroids else np.zeros((0, DIMENSIONS), np.float32),
        "reach": np.array(reach, np.float32).reshape(len(owners), LONGEST - SHORTEST + 1),
    }


def _predict(model):
    def run(batches):
        for batch in batches:
            for at, rows in counts(text.raw(batch.column(1))):
                n = len(rows)
                letters = np.array(batch.column(2).slice(at, n).to_pylist(), object)
                names, scores, rejected = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
                if len(model["names"]):
                    cosine = _unit(np.log1p(rows) * model["idf"]) @ model["centroids"].T
                    best = np.argmax(cosine, 1)
                    top, length = cosine[np.arange(n), best], _length(rows)
                    for i in np.flatnonzero(letters == True):  # noqa: E712
                        names[i] = model["names"][best[i]]
                        scores[i] = min(1.0, max(0.0, float(top[i])))
                        rejected[i] = top[i] < model["reach"][best[i], length[i]]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, n) for c in batch.columns[3:]), pa.array(names), pa.array(scores), pa.array(rejected)],
                    [*batch.schema.names[3:], "lang_pred", "score", "rejected"],
                )

    return run


def predict(docs, model, keep=("doc_id",)):
    """The columns ``keep``, lang_pred, score (cosine, 0 to 1) and rejected for every
    row of ``docs``. A null text, one without a letter, and every text where no
    language was learned are ``und`` with score 0, and rejected. Ties go to the
    language that comes first by name. Only the text decides."""
    text.small_batches(docs.sparkSession)
    kept = [F.col(c) for c in keep]
    rows = docs.select(F.lit(0).alias("pad"), F.col("text").alias("of"), F.col("text").rlike(r"\p{L}").alias("letters"), *kept)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return rows.mapInArrow(_predict(model), f"{kinds}, lang_pred string, score double, rejected boolean")
