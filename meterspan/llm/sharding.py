"""Shards of near equal bytes by a k-d tree over document metadata.

A node is split along its widest dimension, at the weighted median of the bytes
when its shards divide evenly and at the matching quantile when they don't, until
every leaf holds one shard. All nodes of a level are split together. The medians
are found by histograms of partial sums over the whole table; the driver keeps the
tree (one cut per shard) and bounded histograms, never rows.

Only DataFrame functions; rows are never grouped by shard in one task."""

from pyspark.sql import functions as F
from pyspark.sql import Window

from meterspan.llm.ranks import cuts
from meterspan.session import written

#: Bits of a dimension's value in its sort key; equal values are ordered by content.
BITS = 30
TOP = (1 << (BITS + 32)) - 1
#: Cuts may miss their quantile by this share of a shard, to keep equal texts together.
SLACK = 0.004
DIMENSIONS = ("size", "text_crc32", "lines")
ROWS_PER_FILE = 100_000


def measured(docs, *columns):
    """``columns`` and the metadata of each row: size (UTF-8 bytes of the text plus
    16), text_crc32 and lines, and a number of its own. A null text has no bytes and
    the checksum of none."""
    return docs.select(*(F.col(c) for c in columns), *(x.alias(c) for c, x in _metadata().items()))


def _metadata():
    body = F.coalesce(F.col("text"), F.lit(""))
    return {
        "size": F.octet_length(body).cast("long") + 16,
        "text_crc32": F.crc32(body.cast("binary")),
        "lines": (F.length(body) - F.length(F.translate(body, "\n", ""))).cast("long"),
        "row": F.monotonically_increasing_id(),
    }


def _key(name, tops):
    """Sort key of a dimension: the scaled value, then the text's checksum."""
    scaled = F.call_function("div", F.col(name) * ((1 << BITS) - 1), F.lit(max(1, tops[name]))).cast("long")
    return scaled * (1 << 32) + F.col("text_crc32")


def _own():
    """Order of rows with equal texts, where a cut has to part them."""
    return F.xxhash64("row").bitwiseAND(F.lit(TOP))


class Tree:
    """The cuts: each node has its first shard, its number of shards, and when it is
    split a dimension with a key and a second key for rows on the first."""

    def __init__(self, tops, shards):
        self.tops, self.leaves, self.splits = tops, {0: shards}, {}

    def shard(self):
        """The shard, as a column of a measured table."""
        return self._column(0, max(a + n for a, n in self.leaves.items()))

    def _column(self, first, end):
        cut = self.splits.get((first, end - first))
        if cut is None:
            return F.lit(first)
        name, key, own, middle = cut
        by = _key(name, self.tops)
        return F.when(_left(by, key, own), self._column(first, middle)).otherwise(self._column(middle, end))

    def split(self, first, name, key, own, middle):
        n = self.leaves[first]
        self.splits[first, n] = (name, key, own, middle)
        self.leaves[first], self.leaves[middle] = middle - first, n - (middle - first)


def _by_node(values, otherwise):
    """A column that depends on the row's node."""
    for node, value in values.items():
        otherwise = F.when(F.col("node") == node, value).otherwise(otherwise)
    return otherwise


def grow(rows, shards=None, target_bytes=None):
    """(tree, table) of a measured table, for a number of shards or for leaves of
    ``target_bytes``; the table is the measured one with its ``node``, which is the
    shard. Runs some jobs a level, each with partial sums only, and writes the
    measured table once a level."""
    ends = rows.agg(F.sum("size"), *(F.max(d) for d in DIMENSIONS)).first()
    total, tops = ends[0] or 0, {d: m or 1 for d, m in zip(DIMENSIONS, ends[1:])}
    shards = shards or max(1, -(-total // target_bytes))
    tree, slack, columns = Tree(tops, shards), SLACK * total / shards, rows.columns
    rows = rows.withColumn("node", F.lit(0))
    while max(tree.leaves.values()) > 1:
        open_ = {f: n for f, n in tree.leaves.items() if n > 1}
        spread = [(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]
        about = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("w"), *spread).collect()}
        for f in [f for f in open_ if f not in about]:
            tree.split(f, DIMENSIONS[0], -1, None, f + open_.pop(f) // 2)
        if not open_:
            continue
        widest = {f: max(DIMENSIONS, key=lambda d, f=f: about[f][d] / max(1, tops[d])) for f in open_}
        wanted = {f: about[f]["w"] * (n // 2) / n for f, n in open_.items()}
        by = _by_node({f: _key(d, tops) for f, d in widest.items()}, F.lit(0).cast("long"))
        rows = written(rows.withColumn("key", by), "shard-level")
        found = _settled(rows, cuts(rows, F.col("node"), F.col("key"), F.col("size"), wanted, 0, TOP, slack), wanted, slack)
        fresh = {}
        for f, n in open_.items():
            key, own = found[f]
            tree.split(f, widest[f], key, own, f + n // 2)
            fresh[f] = F.when(_left(F.col("key"), key, own), f).otherwise(f + n // 2)
        rows = rows.select(*columns, _by_node(fresh, F.col("node")).alias("node"))
    return tree, rows


def _left(by, key, own):
    return by <= F.lit(key) if own is None else (by < F.lit(key)) | ((by == F.lit(key)) & (_own() <= F.lit(own)))


def _settled(rows, found, wanted, slack):
    """Cut keys, with a second key where one text's copies weigh more than the slack
    and the cut falls among them."""
    off = {f: (k if w > wanted[f] else k + 1) for f, (k, w, n) in found.items() if n > 1 and abs(w - wanted[f]) > slack}
    out = {f: (k, None) for f, (k, *_) in found.items()}
    if not off:
        return out
    heavy = _by_node({f: F.lit(k) for f, k in off.items()}, F.lit(None).cast("long"))
    sums = rows.groupBy("node").agg(F.sum(F.when(F.col("key") < heavy, F.col("size"))).alias("below"))
    below = {r["node"]: r["below"] or 0 for r in sums.collect()}
    rest = {f: wanted[f] - below.get(f, 0) for f in off}
    part = cuts(rows.where(F.col("key") == heavy), F.col("node"), _own(), F.col("size"), rest, 0, TOP, slack)
    return out | {f: (off[f], part[f][0]) for f in off}


def sharded(docs, shards=None, target_bytes=None):
    """Every row of ``docs`` with size, text_crc32, shard and slot; the other columns
    of ``docs`` but text are kept (a clashing name is the row's metadata here).

    Shards hold near equal bytes. Equal texts stay together unless their copies
    weigh more than the slack (``SLACK`` of a shard), then they are dealt out by a
    hash of the row. Slots number a shard's rows from 0 without gaps, by the file
    and row of the measured table, so no shard is sorted in one task. Empty tables
    give no rows; null texts are rows of 16 bytes; repeated rows are rows of their own."""
    spark = docs.sparkSession
    extra = [c for c in docs.columns if c not in {"text", "size", "text_crc32", "lines", "row", "node", "key", "shard", "slot"}]
    old = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", str(ROWS_PER_FILE))
    try:
        _, rows = grow(written(measured(docs, *extra), "measured"), shards, target_bytes)
        rows = written(rows.withColumnRenamed("node", "shard"), "shards")
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", old)
    placed = rows.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("index"))
    filled = placed.groupBy("shard", "file").count()
    before = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    filled = filled.select("shard", "file", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("shard", "file").orderBy("index")
    numbered = placed.withColumn("rank", F.row_number().over(own))
    return numbered.join(filled, ["shard", "file"]).select(
        *extra, "size", "text_crc32", "shard", (F.col("before") + F.col("rank") - 1).alias("slot")
    )


def write_shards(docs, path, shards=None, target_bytes=None):
    """Write ``docs`` as ``path/shard=N/*.parquet``. A shard is written by as many
    tasks as the input has, so none has to hold it."""
    tree, _ = grow(written(measured(docs), "measured"), shards, target_bytes)
    # Read again in the same partitions, rows have the same numbers.
    names = [c for c in docs.columns if c != "shard"]
    own = [F.col(f"`{c}`").alias(f"column_{i}") for i, c in enumerate(names)]
    placed = docs.select(*own, *(x.alias(c) for c, x in _metadata().items())).withColumn("shard", tree.shard())
    out = placed.select(*(F.col(f"column_{i}").alias(c) for i, c in enumerate(names)), "shard")
    out.write.partitionBy("shard").parquet(path)
