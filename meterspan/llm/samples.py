"""Bounded samples of labelled rows, and broadcasts of a checked size."""

from pyspark.sql import functions as F

from meterspan.session import written

SCALE = 1 << 30


def per_class(rows, label, key, size, most_classes=10_000):
    """About ``size`` rows of each value of ``label``, for its ``most_classes``
    commonest values, by the hash of ``key``: at most ``2 * size * most_classes``
    rows, whatever repeats. Rows without a label are not taken. The shares are counted
    and written here; a task is sent at most ``most_classes`` of them."""
    counts = rows.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("sample_of")).count()
    counts = counts.orderBy(F.desc("count"), "sample_of").limit(most_classes)
    share = F.least(F.lit(SCALE), F.call_function("div", F.lit(SCALE * size), F.col("count")))
    shares = written(counts.select("sample_of", share.alias("sample_share")), "sample-shares")
    chosen = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(SCALE)) < F.col("sample_share")
    found = rows.join(F.broadcast(shares), F.col(label) == F.col("sample_of")).where(chosen)
    return found.drop("sample_of", "sample_share").limit(2 * size * max(1, shares.count()))


def good_rows(labels):
    """Every doc_id with quality 1, once; a written table."""
    return written(labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct(), "good-ids")


def sized(table, rows=1_000_000):
    """A written table of narrow rows, to be sent to every task if it has at most
    ``rows`` of them; beyond that the join is left to shuffle. One count."""
    return F.broadcast(table) if table.count() <= rows else table
