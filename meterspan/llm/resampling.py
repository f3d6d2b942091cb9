"""Importance resampling of raw texts towards a target.

Words and word pairs are hashed into buckets. A generative model (a multinomial) of
the target and one of all raw texts give every text a log importance weight; adding
Gumbel noise and taking the top k samples k texts without replacement with these
weights. The noise is a hash of doc_id, so a sample can be repeated."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from meterspan.llm import text
from meterspan.llm.ranks import cuts
from meterspan.llm.samples import good_rows, sized
from meterspan.session import written

BUCKETS = 1 << 16
PRIOR = 1.0
SEED = 17


def _grams(hashes, bounds):
    """Buckets of the words and the pairs, and the text that each belongs to."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    pair = text.mix(hashes[:-1] * np.uint64(3) + hashes[1:])
    inside = owner[:-1] == owner[1:]
    both = np.concatenate([hashes, pair[inside]])
    return (both >> np.uint64(48)).astype(np.int64), np.concatenate([owner, owner[:-1][inside]])


def _count(batches):
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        flag = np.array(batch.column(1).is_valid())
        for at, hashes, bounds in text.chunks(text.raw(batch.column(0))):
            grams, owner = _grams(hashes, bounds)
            raw += np.bincount(grams, minlength=BUCKETS)
            target += np.bincount(grams[flag[at:][owner]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(some.astype(np.int32)), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"]
    )


def ratios(docs, target_ids):
    """Log ratio of the target's to the raw model for every bucket, from all texts.
    ``target_ids`` (doc_id, each once) are sent to the tasks up to the size that
    ``sized`` allows, and joined by shuffle beyond. The driver gets a row per bucket."""
    text.small_batches(docs.sparkSession)
    flagged = docs.select("doc_id", "text").join(sized(target_ids.select("doc_id", F.lit(1).alias("target"))), "doc_id", "left")
    partial = flagged.select("text", "target").mapInArrow(_count, "bucket int, raw long, target long")
    sums = np.zeros((2, BUCKETS))
    for b, r, t in partial.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():
        sums[:, b] = r, t
    raw, target = (s + PRIOR for s in sums)
    return (np.log(target / target.sum()) - np.log(raw / raw.sum())).astype(np.float64)


def target_rows(labels):
    """The target: every doc_id with quality 1."""
    return good_rows(labels)


def _weigh(table):
    def run(batches):
        for batch in batches:
            for at, hashes, bounds in text.chunks(text.raw(batch.column(1))):
                grams, owner = _grams(hashes, bounds)
                n = len(bounds) - 1
                total = np.bincount(owner, table[grams], minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), pa.array(np.bincount(owner, minlength=n).astype(np.int64)), pa.array(total)],
                    ["doc_id", "n_grams", "log_weight"],
                )

    return run


def resampled(docs, table, share):
    """doc_id, n_grams, log_weight, key and kept for every row of ``docs``; the rows
    with the ``share`` of highest keys are kept (at least the exact number, rounded).

    log_weight is the log ratio of the text's likelihoods, the sum over its n-grams; key
    adds the Gumbel noise. Texts
    without words (null, empty) have weight 0 and are never kept. Rows with equal
    doc_id and text have equal keys; where the threshold falls among equal keys, all
    of them are kept."""
    rows = docs.select("doc_id", "text").mapInArrow(_weigh(table), "doc_id long, n_grams long, log_weight double")
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    weight = F.when(F.col("n_grams") > 0, F.col("log_weight")).otherwise(F.lit(0.0))
    rows = rows.withColumn("log_weight", weight).withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))
    rows = written(rows, "importance")
    # Keys as integers in falling order: a millionth decides.
    place = F.greatest(F.lit(0), F.least(F.lit(1 << 51), F.floor((F.lit(1e9) - F.col("key")) * 1e6)))
    worded = rows.where("n_grams > 0").select(F.lit(0).alias("g"), place.cast("long").alias("place"))
    wanted = round(share * worded.count())
    edge, _, _ = cuts(worded, F.col("g"), F.col("place"), F.lit(1), {0: wanted}, 0, 1 << 51, 0)[0]
    return rows.withColumn("kept", (F.col("n_grams") > 0) & (place <= edge))
