"""Severity of toxic language by a cumulative-link ordinal regression.

A text is the set of its hashed words (runs of letters) and their first bytes, of which
those count that
toxic rows of the sample use far more often than others. One weight per word is shared by
all thresholds: P(grade > k) = sigmoid(x.w - t_k) with t_1 < t_2 < ...; the expected
severity is the sum of these. Labels say only whether a text is toxic. Its grade is
0 if not; a toxic row of the sample has grade 1 to 3 by how densely it uses these
marker words, cut at the thirds of the sample."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from meterspan.llm import text
from meterspan.llm.samples import per_class

GRADES = 3
PER_LABEL = 4000
#: A marker word is so many times likelier in toxic rows, with a standard score of one of
#: CLEAR: the one by which the parts of the sample are judged best from the others.
RATE = 4
CLEAR = (3, 4, 5, 7, 9, 12, 16)
PARTS = 4
STEM = 5


def _features(batches):
    for batch in batches:
        labels = batch.column(0)
        for at, hashes, bounds in text.chunks(text.raw(batch.column(1)), letters=True, stem=STEM):
            words = [np.unique(hashes[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    labels.slice(at, len(words)),
                    pa.array([w.tobytes() for w, _ in words], pa.binary()),
                    pa.array([c.astype(np.int32).tobytes() for _, c in words], pa.binary()),
                ],
                ["toxic", "words", "counts"],
            )


def _markers(toxic, owner, word, n, clear):
    """Words that toxic rows hold ``RATE`` times as often as others, with a standard
    score of ``clear`` for the difference of the two shares.

    They are taken one by one, the highest score first, and a toxic row counts half as
    much with each marker it holds: the other words of a toxic text that was copied
    many times are no markers, since its rows are explained already."""
    size = np.array([max(1, (~toxic).sum()), max(1, toxic.sum())])
    clean = np.bincount(word[~toxic[owner]], minlength=n)
    own = toxic[owner]
    by_row, by_word = np.flatnonzero(own), np.flatnonzero(own)[np.argsort(word[own], kind="stable")]
    row_at = np.searchsorted(owner[by_row], np.arange(len(toxic) + 1))
    word_at = np.searchsorted(word[by_word], np.arange(n + 1))
    weight, seen = np.ones(len(toxic)), np.bincount(word[own], minlength=n).astype(float)
    marker = np.zeros(n, bool)
    while n:
        share, both = (clean / size[0], seen / size[1]), (clean + seen) / size.sum()
        z = (share[1] - share[0]) / np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / size).sum())
        z[marker | (share[1] < RATE * share[0])] = 0
        best = int(np.argmax(z))
        if z[best] < clear:
            break
        marker[best] = True
        for row in owner[by_word[word_at[best] : word_at[best + 1]]]:
            weight[row] /= 2
            seen[word[by_row[row_at[row] : row_at[row + 1]]]] -= weight[row]
    return marker


def _grades(toxic, owner, word, count, total, marker):
    """Grade of every sample row, from the density of marker words."""
    density = np.bincount(owner, count * marker[word], minlength=len(toxic)) / np.maximum(total, 1)
    cuts = np.quantile(density[toxic], [1 / 3, 2 / 3]) if toxic.any() else [0, 0]
    return np.where(toxic, 1 + (density[:, None] > cuts).sum(1), 0)


def _learn(found, clear, rounds, pull):
    """Weights and thresholds from rows (toxic, words, counts of the words). Rows that
    show no marker word teach that nothing is toxic."""
    toxic = np.array([f[0] > 0 for f in found], bool)
    known, word = np.unique(np.concatenate([*(f[1] for f in found), np.zeros(0, np.uint64)]), return_inverse=True)
    count = np.concatenate([*(f[2] for f in found), np.zeros(0, np.int32)])
    owner = np.repeat(np.arange(len(found)), [len(f[1]) for f in found])
    total = np.bincount(owner, count, minlength=len(found))
    marker = _markers(toxic, owner, word, len(known), clear)
    grade = _grades(toxic, owner, word, count, total, marker)
    used = marker[word]
    owner, word = owner[used], (np.cumsum(marker) - 1)[word[used]]
    known = known[marker]
    if toxic.all() and len(toxic):
        return {"words": known, "weights": np.zeros(len(known)), "thresholds": np.full(GRADES, -30.0)}
    if not len(known):
        return {"words": known, "weights": np.zeros(0), "thresholds": np.full(GRADES, 30.0)}
    w, gaps = np.zeros(len(known)), np.array([1.0, 0.0, 0.0])
    state = [np.zeros(len(known)), np.zeros(GRADES)]
    weight = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1))
    over = (grade[:, None] > np.arange(GRADES)).astype(float)
    for _ in range(rounds):
        t = gaps[0] + np.concatenate(([0.0], np.cumsum(np.exp(gaps[1:]))))
        p = 1 / (1 + np.exp(np.clip(t - np.bincount(owner, w[word], minlength=len(found))[:, None], -30, 30)))
        off = (p - over) * weight[:, None]
        slope = np.bincount(word, off.sum(1)[owner], minlength=len(known)) + pull * w
        fall = -off.sum(0)
        turn = np.array([fall.sum(), fall[1:].sum() * np.exp(gaps[1]), fall[2] * np.exp(gaps[2])])
        for s, g, x in ((state[0], slope, w), (state[1], turn, gaps)):
            s += g * g
            x -= 0.3 * g / np.sqrt(s + 1e-12)
    return {"words": known, "weights": w, "thresholds": gaps[0] + np.concatenate(([0.0], np.cumsum(np.exp(gaps[1:]))))}


def _errors(found, clear, rounds, pull):
    """Share of toxic rows missed and of others flagged, where each of ``PARTS`` of the
    rows, by a hash of their words, is judged by a model of the rest."""
    part = [int(np.bitwise_xor.reduce(text.mix(f[1])) % np.uint64(PARTS)) for f in found]
    wrong, seen = np.zeros(2), np.zeros(2)
    for k in range(PARTS):
        model = _learn([f for f, h in zip(found, part) if h != k], clear, rounds, pull)
        for toxic, words, _ in (f for f, h in zip(found, part) if h == k):
            flagged = model["weights"][np.isin(model["words"], words, assume_unique=True)].sum() >= model["thresholds"][0]
            wrong[int(toxic > 0)] += flagged != (toxic > 0)
            seen[int(toxic > 0)] += 1
    return (wrong / np.maximum(seen, 1)).sum()


def fit(docs, labels, per_label=PER_LABEL, rounds=400, pull=1e-5):
    """Weights and thresholds from about ``per_label`` rows of either label (a
    bounded sample of the labelled rows, by the hash of doc_id). The driver receives
    the sample's word buckets. Rows without label or text words teach nothing."""
    text.small_batches(docs.sparkSession)
    known = labels.where("toxic is not null and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    ids = per_class(known, "toxic", "doc_id", per_label, 2)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("toxic", "text")
    found = sorted({tuple(r) for r in rows.mapInArrow(_features, "toxic int, words binary, counts binary").limit(4 * per_label).collect()})
    found = [(f[0], np.frombuffer(f[1], np.uint64), np.frombuffer(f[2], np.int32)) for f in found if f[1]]
    # Of bars that judge alike the highest: fewer words decide.
    clear = min(reversed(CLEAR), key=lambda c: _errors(found, c, rounds // 4, pull))
    return _learn(found, clear, rounds, pull)


def _score(model):
    def run(batches):
        for batch in batches:
            for at, hashes, bounds in text.chunks(text.raw(batch.column(1)), letters=True, stem=STEM):
                n = len(bounds) - 1
                total = np.zeros(n)
                if len(model["words"]):
                    at_word = np.searchsorted(model["words"], hashes) % len(model["words"])
                    hit = np.flatnonzero(model["words"][at_word] == hashes)
                    owner = np.searchsorted(bounds, hit, "right") - 1
                    once = np.unique(owner * len(model["words"]) + at_word[hit])
                    np.add.at(total, once // len(model["words"]), model["weights"][once % len(model["words"])])
                p = 1 / (1 + np.exp(np.clip(model["thresholds"] - total[:, None], -30, 30)))
                p[bounds[1:] == bounds[:-1]] = 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, n),
                        pa.array(p.sum(1)),
                        pa.array((p >= 0.5).sum(1), pa.int32()),
                        pa.array(p[:, 0]),
                        pa.array(p[:, 0] >= 0.5),
                    ],
                    ["doc_id", "severity", "grade", "p_toxic", "toxic"],
                )

    return run


def score(docs, model):
    """doc_id, severity (expected grade, 0 to 3), grade, p_toxic and toxic for every
    row of ``docs``. A text without words (null, empty) has severity 0."""
    text.small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        _score(model), "doc_id long, severity double, grade int, p_toxic double, toxic boolean"
    )
