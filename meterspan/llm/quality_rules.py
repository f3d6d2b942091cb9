"""Quality rules: plain counts of a text, and a hashed n-gram log-likelihood ratio.

Pairs of neighbouring words are hashed into buckets. Two multinomials over the buckets, one of trusted texts and one of the
whole raw corpus, give every pair a log-likelihood ratio; a text scores their mean.
One threshold decides for all texts: a low rank among trusted texts that the model was
not fitted on, since scores move with the size of the corpus. DataFrame functions only:
the pairs are counted by partial sums, the score is an expression over a literal table
of ratios, and texts are shuffled only where the trusted ids outgrow a broadcast."""

import json
import math

from pyspark.sql import functions as F

from meterspan.llm.ranks import cuts
from meterspan.llm.samples import good_rows, sized
from meterspan.session import written

GAP = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 18
PRIOR = 1.0
#: One in HELD trusted texts is held out; the share LOSS of these falls below the threshold.
HELD = 5
LOSS = 0.02
WINDOW = 5


def words(body):
    return F.array_remove(F.split(body, GAP), "")


def _bucket(pair):
    return F.pmod(pair, F.lit(BUCKETS)).cast("int")


def ratios(docs, trusted):
    """Log-likelihood ratio of each bucket, over all texts of ``docs``; ``trusted`` has
    the doc_ids of the target, each once. The driver gets a number for each bucket."""
    flagged = docs.select("doc_id", "text").join(sized(trusted.select("doc_id", F.lit(1).alias("target"))), "doc_id", "left")
    listed = flagged.select("target", words(F.col("text")).alias("words"))
    zipped = F.arrays_zip(F.col("words").alias("a"), F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(0))).alias("b"))
    pairs = listed.select("target", F.explode(zipped).alias("p"))
    counted = (
        pairs.where("p.b is not null")
        .groupBy(_bucket(F.xxhash64(F.xxhash64("p.a"), F.xxhash64("p.b"))).alias("bucket"))
        .agg(F.count("*").alias("raw"), F.count("target").alias("target"))
        .collect()
    )
    sums = {r[0]: (r[1], r[2]) for r in counted}
    raw, target = (sum(s[k] for s in sums.values()) + PRIOR * BUCKETS for k in (0, 1))
    return [
        round(math.log((t + PRIOR) / target) - math.log((r + PRIOR) / raw), 6)
        for r, t in (sums.get(b, (0, 0)) for b in range(BUCKETS))
    ]


def trusted_rows(labels):
    """Every doc_id with quality 1."""
    return good_rows(labels)


def parted(trusted):
    """The trusted doc_ids in two: those to fit on, and those held out, by hash."""
    held = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(HELD)) == 0
    return trusted.where(~held), trusted.where(held)


def judged(docs, trusted, loss=LOSS):
    """The columns of ``rated``, where ``kept`` follows from the ``trusted`` doc_ids: a
    text goes if it fails the base rules, or scores below all but the share ``loss`` of
    the held-out trusted texts that pass them (below all, where these are few). Without
    such a text only the base rules decide. Scores count to a millionth."""
    fitted, held = parted(trusted)
    rows = written(rated(docs, ratios(docs, fitted)), "rated")
    place = F.floor(F.col("score") * 1e6)
    own = rows.where("not base_failed").join(sized(held), "doc_id", "left_semi").select(F.lit(0).alias("g"), place.alias("place"))
    n = own.count()
    if not n:
        return rows
    edge, _, _ = cuts(own, F.col("g"), F.col("place"), F.lit(1), {0: int(loss * n)}, -(1 << 30), 1 << 30, 0)[0]
    return rows.withColumn("kept", F.col("kept") & (place > edge))


def rated(docs, table, threshold=float("-inf")):
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score,
    base_failed and kept (base rules, and a score of ``threshold``) for every row of ``docs``.

    A null text has no words; a text without words fails the base
    rules; one without a pair scores 0. Repeated rows
    are rated alike."""
    body = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    one = docs.select(
        "doc_id",
        F.length(F.translate(body, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        words(body).alias("words"),
    )
    two = one.select(
        "doc_id",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    names = ["doc_id", "word_chars", "n_symbols", "n_dup_lines", "n_words"]
    n = F.col("n_words").cast("int")

    def joined(left, right, less, gap):
        """Hashes of the elements of two arrays, the right one taken ``gap`` later."""
        rest = F.greatest(n - less, F.lit(0))
        return F.zip_with(F.slice(left, F.lit(1), rest), F.slice(right, F.lit(1 + gap), rest), lambda a, b: F.xxhash64(a, b))

    three = two.select(*names, "hashes", joined("hashes", "hashes", 1, 1).alias("pairs"))
    four_words = joined("pairs", "pairs", 3, 2)
    table = F.from_json(F.lit(json.dumps(table)), "array<double>")
    three = three.select(
        *names,
        joined(four_words, "hashes", 4, 4).alias("windows"),
        F.aggregate("pairs", F.lit(0.0), lambda s, p: s + F.get(table, _bucket(p))).alias("total"),
    )
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    four = three.select(
        *names,
        "total",
        F.when(repeated, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("sorted"),
    )
    twice = F.filter("sorted", lambda e, k: (e["h"] == F.get("sorted", k - 1)["h"]) | (e["h"] == F.get("sorted", k + 1)["h"]))
    five = four.select(*names, "total", F.sort_array(F.transform(twice, lambda e: e["i"])).alias("places"))
    covered = F.transform("places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("places", k + 1) - p, F.lit(WINDOW))))
    six = five.select(
        *names,
        F.coalesce(F.aggregate(covered, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.when(n > 1, F.col("total") / (n - 1)).otherwise(F.lit(0.0)).alias("score"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return six.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
