"""Near duplicates by SimHash fingerprints and a grid over their bit counts.

A fingerprint is mapped to the bit counts of its 32 segments of two bits, a point of
a grid. The Manhattan distance of two points is at most the number of bits in which the
fingerprints differ, so fingerprints that differ in ``BITS`` = 4 lie within 4 of each
other, and in one half of the segments within 2. Each fingerprint is therefore put
into the cells within 1 of its point, for either half: two that are within 2 of each
other share the cell half way. What shares a cell is verified on the fingerprints.

A cell of over ``CROWD`` members is not compared but dealt to finer cells of its own:
first by the bit counts of the other half's quarters, then by the bits themselves
(segments of one bit, where the distance is exact), half by half. A cell of the last
level holds at most 33 * 17 * 9 * 256 fingerprints by its construction, so no task
ever holds an unbounded group. Equal fingerprints are one member. Of the links in a
cell only as many as connect its members are handed on."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from meterspan.llm import text
from meterspan.llm.near_dedup import components
from meterspan.session import written

BITS = 4
SHINGLE = 4
SEED = 42
CROWD = 4096
#: Cells of at most so many members are compared with each other in one go.
SMALL = 48
#: What a level looks at: bit counts or bits, and the width of what the levels before
#: have left open.
LEVELS = (("counts", 64), ("counts", 32), ("bits", 64), ("bits", 32), ("bits", 16))
_PAIRS = np.uint64(0x5555555555555555)
_ONE = np.uint64(1)


def _counted(words, tally):
    """Adds the bits of the hashes of all shingles of ``words`` to ``tally``; returns
    their number."""
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE, len(words))
    spans = zip(starts[: len(starts) - width + 1].tolist(), ends[width - 1 :].tolist())
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in spans])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
    tally += bits.sum(0, dtype=np.int64)
    return len(bits)


def fingerprint(data):
    """The fingerprint of a UTF-8 text as an unsigned integer. A long text is taken in
    slices, each with the last words of the one before."""
    tally, n, kept = np.zeros(64, np.int64), 0, []
    for part in text.slices(data):
        words = kept + part.lower().split()
        if len(words) < SHINGLE:
            kept = words
            continue
        n += _counted(words, tally)
        kept = words[1 - SHINGLE :]
    if not n and kept:
        n = _counted(kept, tally)
    return int.from_bytes(np.packbits(2 * tally > n).tobytes(), "big")


def _sign(batches):
    for batch in batches:
        prints = [fingerprint(t) for t in text.raw(batch.column(1))]
        prints = pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), prints], ["doc_id", "print"])


def _balls(points, width, field):
    """For each point, itself and the points within 1 of it: (row, point). A point has
    ``width`` bits in fields of ``field`` bits; a field of two bits counts 0 to 2."""
    rows, out = [np.arange(len(points))], [points]
    for at in range(0, width, field):
        step = _ONE << np.uint64(at)
        value = (points >> np.uint64(at)) & np.uint64((1 << field) - 1)
        up, down = np.flatnonzero(value < field), np.flatnonzero(value > 0)
        rows += [up, down]
        out += [points[up] + step, points[down] - step]
    return np.concatenate(rows), np.concatenate(out)


def _cells(level):
    """Rows (cell, print, open) of a level: from (cell, print, open) of the one before,
    the two halves of the bits from ``open`` on, with what the other half leaves open."""
    kind, width = LEVELS[level]
    half = np.uint64(width // 2)
    mask = (_ONE << half) - _ONE
    again = level + 1 < len(LEVELS) and LEVELS[level + 1][1] == 64

    def run(batches):
        for batch in batches:
            cell, prints, left = (np.asarray(c.to_numpy(zero_copy_only=False)) for c in batch.columns)
            cell, prints = cell.view(np.uint64), prints.view(np.uint64)
            seen = (prints & _PAIRS) + ((prints >> _ONE) & _PAIRS) if kind == "counts" else prints
            for side in (0, 1):
                at = left.astype(np.uint64) + np.uint64(side) * half
                row, point = _balls((seen >> at) & mask, width // 2, 2 if kind == "counts" else 1)
                key = text.mix(text.mix(cell[row] + np.uint64(2 * level + side + 1)) ^ (at[row] << np.uint64(48)) ^ point)
                rest = np.zeros(len(row), np.int8) if again else (left + (1 - side) * (width // 2))[row].astype(np.int8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(prints[row].view(np.int64)), pa.array(rest)], ["cell", "print", "open"]
                )

    return run


def _forest(x):
    """Links (i, j) that connect what all links among ``x`` connect: a walk over the
    members, each compared with those that are not reached yet."""
    left = np.arange(len(x))
    a, b = [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            i = front.pop()
            near = np.bitwise_count(x[left] ^ x[i]) <= BITS
            reached = left[near]
            if len(reached):
                left = left[~near]
                a.append(np.full(len(reached), i))
                b.append(reached)
                front.extend(reached)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _linked(x):
    """Members of a cell that have a link in it, in blocks of bounded size."""
    out = np.zeros(len(x), bool)
    step = max(1, (1 << 21) // max(1, len(x)))
    for at in range(0, len(x), step):
        out[at : at + step] = (np.bitwise_count(x[at : at + step, None] ^ x[None, :]) <= BITS).sum(1) > 1
    return np.flatnonzero(out)


def _within(cell, prints):
    """Links (a, b) of whole cells, rows ordered by cell: as many as connect them."""
    starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(cell)))
    size = np.repeat(sizes, sizes)
    found, by = [], 1
    at = np.flatnonzero((size > 1) & (size <= SMALL))
    a, b = [], []
    while True:
        at = at[at + by < len(cell)]
        at = at[cell[at + by] == cell[at]]
        if not len(at):
            break
        near = at[np.bitwise_count(prints[at] ^ prints[at + by]) <= BITS]
        a.append(near)
        b.append(near + by)
        by += 1
    if a:
        a, b = np.concatenate(a), np.concatenate(b)
        links = np.bincount(np.searchsorted(starts, a, "right") - 1, minlength=len(starts))
        dense = links > sizes
        few = ~dense[np.searchsorted(starts, a, "right") - 1]
        found.append((a[few], b[few]))
    else:
        dense = np.zeros(len(starts), bool)
    for k in np.flatnonzero(dense | (sizes > SMALL)):
        own = prints[starts[k] : starts[k] + sizes[k]]
        some = _linked(own)
        i, j = _forest(own[some])
        found.append((starts[k] + some[i], starts[k] + some[j]))
    none = np.zeros(0, np.int64)
    a = np.concatenate([none, *(x for x, _ in found)])
    b = np.concatenate([none, *(x for _, x in found)])
    return prints[a], prints[b]


def _meet(crowd):
    """Links (a, b) from rows ordered by cell. The members of a cell of over ``crowd``
    go on to the next level as (cell, print, open); none does where ``crowd`` is None."""

    def links(cell, prints):
        a, b = _within(cell, prints)
        n = len(a)
        low, high = np.minimum(a, b).view(np.int64), np.maximum(a, b).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(low), pa.array(high), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int8())], names
        )

    def passed_on(cell, prints, left):
        n = len(cell)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(cell), pa.array(prints.view(np.int64)), pa.array(left)], names
        )

    names = ["a", "b", "cell", "print", "open"]

    def run(batches):
        cell, prints, left = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int8)
        crowded = None
        for batch in batches:
            c, p, o = (np.asarray(x.to_numpy(zero_copy_only=False)) for x in batch.columns)
            cell, prints, left = np.concatenate([cell, c]), np.concatenate([prints, p.view(np.uint64)]), np.concatenate([left, o])
            if crowded is not None:
                more = int(np.searchsorted(cell, crowded, "right"))
                if more:
                    yield passed_on(cell[:more], prints[:more], left[:more])
                    cell, prints, left = cell[more:], prints[more:], left[more:]
                if len(cell):
                    crowded = None
            if not len(cell):
                continue
            last = int(np.searchsorted(cell, cell[-1], "left"))
            if crowd is not None and len(cell) - last > crowd:
                crowded, last = cell[-1], len(cell)
            yield from finished(cell[:last], prints[:last], left[:last])
            cell, prints, left = cell[last:], prints[last:], left[last:]
        yield from finished(cell, prints, left)

    def finished(cell, prints, left):
        if crowd is not None and len(cell):
            starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
            sizes = np.diff(np.append(starts, len(cell)))
            large = np.repeat(sizes > crowd, sizes)
            if large.any():
                yield passed_on(cell[large], prints[large], left[large])
                cell, prints = cell[~large], prints[~large]
        if len(cell):
            yield links(cell, prints)

    return run


def links(prints, crowd=CROWD):
    """Links (a < b) between distinct fingerprints (``print``) that differ in at most
    ``BITS`` bits: not all of them, but enough to connect whatever they connect."""
    open_cells = prints.select(F.lit(0).cast("long").alias("cell"), "print", F.lit(0).cast("tinyint").alias("open"))
    found = []
    for level in range(len(LEVELS)):
        cells = open_cells.mapInArrow(_cells(level), "cell long, print long, open tinyint")
        cells = cells.repartition("cell").sortWithinPartitions("cell", "print")
        last = level + 1 == len(LEVELS)
        met = cells.mapInArrow(_meet(None if last else crowd), "a long, b long, cell long, print long, open tinyint")
        met = written(met, f"simhash-level-{level}")
        found.append(met.where("a is not null").select("a", "b"))
        open_cells = met.where("a is null").select("cell", "print", "open")
        if last or open_cells.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def near_duplicates(docs, crowd=CROWD):
    """doc_id, fingerprint (16 hex digits) and component_id for every row of ``docs``
    (doc_id, text; other columns are ignored).

    A bit of the fingerprint is set if it is in over half of the XXH64 hashes (seed 42) of
    a text's 4-word shingles, repeats included; a shorter text is one shingle. A
    null text, and one without words, has fingerprint zero and is linked like any
    other. component_id is the smallest doc_id that links reach. Repeated rows share
    a fingerprint. A null doc_id is larger than any other; where a component has no
    other, component_id is null."""
    text.small_batches(docs.sparkSession)
    signed = written(docs.select("doc_id", "text").mapInArrow(_sign, "doc_id long, print long"), "simhash-signed")
    classes = written(signed.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-classes")
    edges = links(classes.select("print"), crowd)
    roots = components(edges).select(F.col("class").alias("print"), "root")
    roots = classes.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    lowest = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    roots = written(roots.join(lowest, "root").select("print", "component_id"), "simhash-roots")
    return signed.join(roots, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )
