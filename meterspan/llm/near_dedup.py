"""Near duplicates by a chosen-path set similarity join.

Texts with equal shingle sets form a class; classes are joined. In each of
``trees`` independent trees a class walks a path: at every level it branches by
one selected minwise token of its set. Classes that share a node of at most
``small`` members are compared with each other. A larger node compares each
member with one leader and branches again, and its members are linked through
leaders. Candidates are confirmed on full shingle sets; connected classes form a
component. The trees are grown in turns: a later turn pairs only classes that the links of
the earlier leave apart. Leaders do not reach every link of a large group: classes of nodes still
large at level ``EXACT`` whose components are still apart form crowds, and in each crowd all
classes that are not connected yet are compared on full sets, in blocks of bounded size. In a
wide crowd, where many are apart, only classes that share a rare shingle are compared: of two
linked sets each holds the rarest common shingle among its own rarest few, whatever the order
of rareness, so none of the links is lost.

A pair of similarity s meets in a tree that branches d times with probability
s^d; at 0.75 and two levels, 16 trees miss two pairs in a million. A pair that meets
there is compared, in a small node or in its crowd."""

import hashlib
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meterspan.llm import text
from meterspan.llm.samples import sized
from meterspan.session import written

TOKENS = 64
TREES = 16
#: The trees that are grown together; the later ones leave out what the earlier connected.
TURNS = (range(0, 3), range(3, TREES))
SMALL = 12
LEVELS = 6
EXACT = 2
#: Classes and shingles in a block of a crowd, about.
CROWD_ROWS = 4096
CROWD_SHINGLES = 1 << 20
#: A crowd of fewer rows is dealt into this many blocks a side, of at least as many rows.
CROWD_BLOCKS, CROWD_LEAST = 12, 128
#: A crowd with more classes apart from its commonest root is wide.
WIDE = 1024
#: Shingles of wide crowds whose counts tell how rare they are; others count as rarest.
COMMON = 1 << 17
#: Shingles that a task of rare ones holds, about.
RARE_SHINGLES = 1 << 18
#: Narrow rows that are worth a task of their own.
TASK_ROWS = 1 << 14
#: Links of which one task finds the components.
FOREST = 1 << 17
SIMILARITY = 75
#: Of 64 minwise tokens, pairs of similarity 0.75 share fewer with probability 2e-7.
#: The sketch has the last byte of each, which other texts share by chance once in 256.
SHARED = 29

_rng = np.random.default_rng(11)
_TIMES = _rng.integers(1, 1 << 63, TOKENS, dtype=np.uint64) | np.uint64(1)
_FLIP = _rng.integers(0, 1 << 63, TOKENS, dtype=np.uint64)


def _print(s):
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _minwise(sets):
    sizes = np.array([len(s) for s in sets])
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    every = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    out = np.zeros((len(sets), TOKENS), np.int32)
    for k in range(TOKENS):
        low = text.per_text((every ^ _FLIP[k]) * _TIMES[k], bounds, np.minimum)
        out[:, k] = (low >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _sign(batches):
    for batch in batches:
        texts, ids = text.raw(batch.column(1)), batch.column(0)
        for at, hashes, bounds in text.chunks(texts):
            sets = text.shingles(hashes, bounds)
            tokens = _minwise(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(at, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_print(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1) * TOKENS, pa.int32()), pa.array(tokens.ravel())
                    ),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1) * TOKENS, pa.int32()), pa.array(tokens.astype(np.int8).ravel())
                    ),
                ],
                ["doc_id", "n_shingles", "class", "tokens", "sketch"],
            )


def _sets(batches):
    for batch in batches:
        for _, hashes, bounds in text.chunks(text.raw(batch.column(0))):
            sets = text.shingles(hashes, bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_print(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                ["class", "set"],
            )


def _classed(batches):
    for batch in batches:
        for at, hashes, bounds in text.chunks(text.raw(batch.column(0))):
            sets = text.shingles(hashes, bounds)
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(at, len(sets)) for c in batch.columns[1:]), pa.array([_print(s) for s in sets], pa.binary())],
                [*batch.schema.names[1:], "class"],
            )


def with_class(rows, body="text"):
    """``rows`` with the class of the text in ``body``; null where it has no words. A
    column named class is not allowed."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.select(F.col(body).alias("class_body"), *rows.columns).mapInArrow(_classed, f"{kinds}, class binary")


def _few(df, rows, weight=1):
    """``df``, which is made of about ``rows`` rows, in no more tasks than these are worth:
    many tasks and files of a few rows each take longer than the rows. ``weight`` tells how
    many narrow rows one of them stands for."""
    return df.coalesce(max(1, math.ceil(rows * weight / TASK_ROWS)))


def _branch(tree, level, tokens):
    """The token that a path of this tree selects at this level: every tree starts
    with tokens of its own, deeper levels walk on through the others."""
    at = (tree + level * TREES + (level // (TOKENS // TREES)) * (2 * tree + 1)) % TOKENS
    return F.get(tokens, at.cast("int"))


def candidates(classes, trees, known=None, many=None):
    """(pairs, crowded) of some trees. pairs has the classes (a < b in a small node) that
    meet in a small node, or as leader and member of a large one; crowded has ``class``,
    ``node`` of the nodes still large at level ``EXACT`` (None without any). ``classes``
    has ``class`` and ``tokens``; ``known`` the ``class`` and ``root`` of what is already
    connected: pairs of one root are left out, and so are nodes of one root. ``many`` is the
    number of classes, if the caller has counted them."""
    many = classes.count() if many is None else many
    tree = F.explode(F.array(*(F.lit(t) for t in trees))).alias("tree")
    rows = classes.select("class", "tokens")
    rows = rows.withColumn("root", F.col("class")) if known is None else _rooted(rows, known)
    rows = rows.select("class", "root", "tokens", tree).select(
        "class", "root", "tree", F.xxhash64("tree", _branch(F.col("tree"), 0, F.col("tokens"))).alias("node")
    )
    found, small, crowded, n, total = [], [], None, many * len(trees), 0
    for level in range(1, LEVELS + 1):
        nodes = rows.groupBy("node").agg(
            F.count("*").alias("members"), F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.struct("class", "root")).alias("leader")
        )
        nodes = written(_few(nodes.where("low != high").select("node", "members", "leader"), n), "near-dedup-nodes")
        met = written(_few(rows.join(nodes, "node"), n), "near-dedup-met")
        small.append(met.where(F.col("members") <= SMALL).select(F.lit(level).alias("level"), "node", "class", "root"))
        large = met.where(F.col("members") > SMALL)
        found.append(large.where("root != leader.root").select(F.col("leader.class").alias("a"), F.col("class").alias("b")))
        more, n = met.agg(F.count("*"), F.count_if(F.col("members") > SMALL)).first()
        total += more
        if not n:
            break
        if level == EXACT:
            crowded = large.select("class", "node")
        if level == LEVELS:
            break
        if level == 1:
            # Later levels walk on with some of these classes.
            deep = classes.join(large.select("class").distinct(), "class", "left_semi").select("class", "tokens")
            deep = written(_few(deep, many), "near-dedup-deep")
        rows = large.join(deep, "class").select(
            "class", "root", "tree", F.xxhash64("node", _branch(F.col("tree"), level, F.col("tokens"))).alias("node")
        )
        rows = written(_few(rows, n), "near-dedup-rows")
    lists = reduce(DataFrame.unionByName, small).groupBy("level", "node")
    lists = lists.agg(F.array_sort(F.collect_set(F.struct("class", "root"))).alias("m"))
    pairs = F.flatten(
        F.transform(
            "m",
            lambda x, i: F.transform(
                F.filter(F.slice("m", i + 2, F.lit(SMALL)), lambda y: x["root"] != y["root"]),
                lambda y: F.struct(x["class"].alias("a"), y["class"].alias("b")),
            ),
        )
    )
    met = _few(lists.select(F.explode(pairs).alias("p")).select("p.a", "p.b"), total)
    return _few(reduce(DataFrame.unionByName, found, met).distinct(), total), crowded


def _rooted(rows, known):
    """``rows`` with the root of their class, which is the class itself where nothing is known."""
    return rows.join(known, "class", "left").withColumn("root", F.coalesce("root", "class"))


def _pairs_with(pairs, table, *columns):
    """``pairs`` with the columns of both ends."""
    for end in "ab":
        side = table.select(F.col("class").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns))
        pairs = pairs.join(side, end)
    return pairs


def _stars(kind):
    """The components of the links that a task holds: every class and the smallest of its component."""

    def run(batches):
        up = {}

        def top(x):
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = top(a), top(b)
                up[max(a, b)] = min(a, b)
        classes = list(up)
        yield pa.RecordBatch.from_arrays([pa.array(classes, kind), pa.array([top(x) for x in classes], kind)], ["class", "root"])

    return run


def components(edges, block=FOREST):
    """``class``, ``root`` for every class with an edge (a, b): classes that edges
    connect have one root. Blocks of about ``block`` edges become stars first, one task
    each; of a single block these are the components. Beyond, labels sink to the smallest
    neighbour's and then skip to their label's label, so the number of rounds follows the
    logarithm of a component's width. Runs two jobs a round."""
    kind = edges.schema["a"].dataType
    links = written(edges.where("a is not null and b is not null").select("a", "b"), "links")
    blocks = max(1, math.ceil(links.count() / block))
    stars = links.coalesce(blocks).mapInArrow(_stars(to_arrow_type(kind)), f"class {kind.simpleString()}, root {kind.simpleString()}")
    stars = written(stars, "labels")
    if blocks == 1:
        return stars
    down, up = stars.select(F.col("class").alias("a"), F.col("root").alias("b")), stars.select(F.col("root").alias("a"), F.col("class").alias("b"))
    both = written(down.union(up), "links")
    labels = both.groupBy(F.col("a").alias("class")).agg(F.least(F.col("class"), F.min("b")).alias("root"))
    labels = written(labels, "labels")
    while True:
        near = both.join(labels.select(F.col("class").alias("b"), "root"), "b").groupBy(F.col("a").alias("class")).agg(F.min("root").alias("low"))
        sunk = labels.join(near, "class").select("class", F.col("root").alias("old"), F.least("root", "low").alias("mid"))
        up = labels.select(F.col("class").alias("mid"), F.col("root").alias("top"))
        fresh = written(sunk.join(up, "mid").select("class", "old", F.least("mid", "top").alias("root")), "labels")
        labels = fresh.select("class", "root")
        if fresh.where("root != old").isEmpty():
            return labels


def _full_sets(slim, classes, needed, name):
    """``class``, ``set`` for the classes in ``needed``, a written table, from one text of each."""
    n = needed.count()
    owners = sized(written(_few(classes.join(needed, "class", "left_semi").select("first").distinct(), n), f"{name}-owners"))
    texts = slim.join(owners, F.col("doc_id").eqNullSafe(F.col("first")), "left_semi").select("text")
    sets = texts.mapInArrow(_sets, "class binary, set array<long>").where("class is not null")
    sets = sets.join(sized(needed), "class", "left_semi").groupBy("class").agg(F.first("set").alias("set"))
    return written(_few(sets, n, 8), f"{name}-sets")


def _buckets(words, count):
    """Which of ``count`` buckets each shingle belongs to."""
    return (text.mix(words.view(np.uint64)) % np.uint64(count)).astype(np.int64)


def _flat(column):
    """The values and the lengths of a column of lists."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _lists(values, bounds, kind):
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _parts(batches):
    """Batches whose last column has sets, in slices of about ``RARE_SHINGLES`` shingles."""
    for batch in batches:
        part = np.cumsum(_flat(batch.column(batch.num_columns - 1))[1]) // RARE_SHINGLES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for at, end in zip(cuts[:-1], cuts[1:]):
            if end > at:
                yield batch.slice(at, end - at)


def _counts(buckets):
    """The shingles of some sets and how many of the sets hold each, a row a bucket."""

    def run(batches):
        for batch in _parts(batches):
            words, n = np.unique(_flat(batch.column(0))[0], return_counts=True)
            bucket = _buckets(words, buckets)
            order = np.argsort(bucket, kind="stable")
            names, starts = np.unique(bucket[order], return_index=True)
            bounds = np.append(starts, len(order))
            columns = [pa.array(names, pa.int64()), _lists(words[order], bounds, pa.int64()), _lists(n[order], bounds, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "words", "n"])

    return run


def _commonest(most):
    """The ``most`` commonest shingles of a bucket that more than one set holds."""

    def run(table):
        words, place = np.unique(_flat(table.column("words"))[0], return_inverse=True)
        n = np.bincount(place, _flat(table.column("n"))[0]).astype(np.int64)
        top = np.lexsort((words, -n))[:most]
        top = top[n[top] > 1]
        return pa.table({"word": pa.array(words[top], pa.int64()), "n": pa.array(n[top], pa.int64())})

    return run


def _rarest(common, counts, similarity, buckets):
    """The rarest shingles of every set (class, root, set), as many as one of them
    must be shared with any set linked to it. A row for each bucket of shingles holds the sets
    (names, roots, sizes) and, for each shingle, whose it is, its count and what of
    the set is no rarer (reach). ``common`` is sorted and has ``counts``."""

    def run(batches):
        for batch in _parts(batches):
            names, roots = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words, sizes = _flat(batch.column(2))
            n = np.zeros(len(words), np.int64)
            if len(common):
                at = np.minimum(np.searchsorted(common, words), len(common) - 1)
                n = np.where(common[at] == words, counts[at], 0)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((words, n, owner))
            words, n = words[order], n[order]
            reach = sizes[owner] - (np.arange(len(words)) - (np.cumsum(sizes) - sizes)[owner])
            first = 100 * reach >= similarity * sizes[owner]
            words, n, reach, owner = words[first], n[first], reach[first], owner[first]
            bucket = _buckets(words, buckets)
            order = np.argsort(bucket, kind="stable")
            marks, starts = np.unique(bucket[order], return_index=True)
            rows = []
            for mark, part in zip(marks.tolist(), np.split(order, starts[1:])):
                held, mine = np.unique(owner[part], return_inverse=True)
                rows.append(
                    {
                        "bucket": mark, "words": words[part], "n": n[part], "reach": reach[part], "owner": mine,
                        "names": [names[i] for i in held], "roots": [roots[i] for i in held], "sizes": sizes[held],
                    }
                )
            longs, blobs = pa.list_(pa.int64()), pa.list_(pa.binary())
            kinds = {"bucket": pa.int64()} | dict.fromkeys(("words", "n", "reach", "owner"), longs) | {"names": blobs, "roots": blobs, "sizes": longs}
            yield pa.RecordBatch.from_pydict({k: pa.array([r[k] for r in rows], kind) for k, kind in kinds.items()}, pa.schema(kinds))

    return run


def _meetings(similarity):
    """The sets of a bucket that share a shingle with one of another root: a row for each
    such shingle and set, with the sizes between which a linked set may lie if this is the
    rarest shingle they share. Sets that are too large for all others there are left out.
    members and the marks tell which sets hold the shingle."""

    def run(table):
        words, lengths = _flat(table.column("words"))
        n, reach, owner = (_flat(table.column(c))[0] for c in ("n", "reach", "owner"))
        sizes, held = _flat(table.column("sizes"))
        owner = owner + np.repeat(np.cumsum(held) - held, lengths)
        names, roots = (table.column(c).combine_chunks().flatten() for c in ("names", "roots"))
        root = roots.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        marks = np.frombuffer(b"".join(names.to_pylist()), np.int64).reshape(-1, 2)
        high = np.minimum(100 * sizes[owner] // similarity, (100 + similarity) * reach // similarity - sizes[owner])
        order = np.argsort(words, kind="stable")

        def grouped():
            starts = np.flatnonzero(np.concatenate(([True], np.diff(words[order]) != 0)))
            return starts, np.diff(np.append(starts, len(order)))

        starts, members = grouped()
        order = order[high[order] >= np.repeat(np.minimum.reduceat(sizes[owner[order]], starts), members)]
        if len(order):
            starts, members = grouped()
            of = root[owner[order]]
            apart = np.minimum.reduceat(of, starts) != np.maximum.reduceat(of, starts)
            low_mark, high_mark = (np.bitwise_xor.reduceat(marks[owner[order], k], starts) for k in (0, 1))
            keep = np.repeat(apart, members)
            members, low_mark, high_mark = (np.repeat(x, members)[keep] for x in (members, low_mark, high_mark))
            order = order[keep]
        else:
            members = low_mark = high_mark = order
        own = owner[order]
        numbers = {"word": words[order], "n": n[order], "members": members, "low_mark": low_mark, "high_mark": high_mark}
        numbers |= {"size": sizes[own], "low": -(-similarity * sizes[own] // 100), "high": high[order]}
        found = {k: pa.array(x, pa.int64()) for k, x in numbers.items()}
        return pa.table(found | {"class": names.take(pa.array(own)), "root": roots.take(pa.array(own))})

    return run


def _sizes(similarity):
    """The sizes between which a set linked with one of ``size`` lies."""
    return F.ceil(similarity * F.col("size") / 100).alias("low"), F.floor(100 * F.col("size") / similarity).alias("high")


def _meeting(wide, sets, similarity):
    """``crowd``, ``class``, ``root``, ``size``, ``low``, ``high`` of the classes of ``wide``
    crowds that share a rare shingle, which is their crowd, with a class of another root. Two
    classes that are linked meet in the crowd of the rarest shingle they share, and each
    has its size between low and high of the other there. Of shingles held by the same classes
    the rarest is taken; where classes share so many that all pairs of those they connect
    are fewer, these are one crowd."""
    words = wide.agg(F.sum("size")).first()[0]
    full = wide.join(sets, "class").select("class", "root", "set")
    buckets = math.ceil(words / CROWD_SHINGLES)
    counted = full.select("set").mapInArrow(_counts(buckets), "bucket long, words array<long>, n array<long>")
    common = counted.groupBy("bucket").applyInArrow(_commonest(math.ceil(COMMON / buckets)), "word long, n long")
    common = common.toArrow().sort_by("word")
    common, counts = common.column("word").to_numpy(), common.column("n").to_numpy()
    buckets = max(1, math.ceil(words * (100 - similarity) / 100 / RARE_SHINGLES))
    rare = full.mapInArrow(
        _rarest(common, counts, similarity, buckets),
        "bucket long, words array<long>, n array<long>, reach array<long>, owner array<long>, names array<binary>, roots array<binary>, sizes array<long>",
    )
    found = rare.groupBy("bucket").applyInArrow(
        _meetings(similarity),
        "word long, n long, members long, low_mark long, high_mark long, size long, low long, high long, class binary, root binary",
    )
    found = written(found, "near-dedup-rare")
    same = found.groupBy("members", "low_mark", "high_mark").agg(F.min(F.struct("n", "word")).alias("rarest"))
    same = same.select(F.col("rarest.word").alias("word"))
    crowd = F.concat(F.lit("shingle "), F.col("word").cast("string")).alias("crowd")
    found = written(found.join(same, "word").select(crowd, "class", "root", "size", "low", "high"), "near-dedup-rarest")
    tally = written(_tally(found), "near-dedup-rarest-tally")
    links = found.join(tally.select("crowd", "most"), "crowd").where("root != most").select(F.col("most").alias("a"), F.col("root").alias("b"))
    if links.isEmpty():
        return found
    whole = components(links.distinct()).select(F.col("class").alias("root"), F.hex("root").alias("whole"))
    cost = tally.join(whole, F.col("most") == F.col("root")).groupBy("whole").agg(F.sum(F.col("left_n") * F.col("n")).alias("cost"))
    connected = written(found.select("class", "root", "size").distinct().join(whole, "root"), "near-dedup-rare-whole")
    close = _tally(connected.withColumnRenamed("whole", "crowd")).join(cost.withColumnRenamed("whole", "crowd"), "crowd")
    close = written(close.where("left_n * n <= cost").select(F.col("crowd").alias("whole")), "near-dedup-rare-close")
    connected = connected.join(close, "whole")
    loose = found.join(connected.select("class"), "class", "left_anti")
    return loose.unionByName(connected.select(F.col("whole").alias("crowd"), "class", "root", "size", *_sizes(similarity)))


def _block_links(similarity):
    """Links of one block between classes of different roots, but those that others of
    the block imply: in each crowd of it every class of the left side is compared with
    those of the right whose size allows a link."""

    def run(table):
        left = np.array(table.column("left").to_pylist(), bool)
        names = table.column("class").to_pylist()
        crowd = np.unique(np.array(table.column("crowd").to_pylist()), return_inverse=True)[1]
        root = np.unique(np.array([r.hex() for r in table.column("root").to_pylist()]), return_inverse=True)[1]
        low, high = (table.column(c).to_numpy() for c in ("low", "high"))
        words, sizes = _flat(table.column("set"))
        word = np.unique(words, return_inverse=True)[1]
        ends = np.cumsum(sizes)
        mask = np.zeros(int(word.max()) + 1, np.int32)
        a, b = [], []

        def spelt(rows):
            """The shingles of some classes, and where those of each start."""
            n = sizes[rows]
            starts = np.cumsum(n) - n
            return word[np.repeat(ends[rows] - n - starts, n) + np.arange(int(n.sum()))], starts

        order = np.lexsort((sizes, crowd))
        for own in np.split(order, np.flatnonzero(np.diff(crowd[order])) + 1):
            right = own[~left[own]]
            wide, least, most = sizes[right], low[right], high[right]
            every, starts = spelt(right)
            for i in own[left[own]]:
                at, end = np.searchsorted(wide, low[i]), np.searchsorted(wide, high[i], "right")
                fits = (least[at:end] <= sizes[i]) & (most[at:end] >= sizes[i]) & (root[right[at:end]] != root[i])
                near = right[at:end][fits]
                if not len(near):
                    continue
                marked = word[ends[i] - sizes[i] : ends[i]]
                mask[marked] = 1
                if 3 * len(near) < end - at:
                    some, first = spelt(near)
                    both = np.add.reduceat(mask[some], first)
                else:
                    last = starts[end] if end < len(starts) else len(every)
                    both = np.add.reduceat(mask[every[starts[at] : last]], starts[at:end] - starts[at])[fits]
                mask[marked] = 0
                linked = near[100 * both >= similarity * (sizes[i] + sizes[near] - both)]
                for j in linked[np.unique(root[linked], return_index=True)[1]]:
                    if root[j] != root[i]:
                        a.append(names[i])
                        b.append(names[j])
                        root[root == root[j]] = root[i]
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _tally(members):
    """For each ``crowd`` of several roots its commonest root, its classes and shingles, and
    those outside that root (left_n, left_w)."""
    tally = members.groupBy("crowd", "root").agg(F.count("*").alias("n"), F.sum("size").alias("w"))
    tally = tally.groupBy("crowd").agg(
        F.count("*").alias("roots"), F.max(F.struct("n", "w", "root")).alias("most"), F.sum("n").alias("n"), F.sum("w").alias("w")
    )
    return tally.where("roots > 1").select(
        "crowd", F.col("most.root").alias("most"), "n", "w", (F.col("n") - F.col("most.n")).alias("left_n"), (F.col("w") - F.col("most.w")).alias("left_w")
    )


def crowd_links(slim, classes, crowded, known, similarity):
    """Links (a, b) that connect what is apart in ``known`` (class, root) within each
    crowd. Crowds are components of roots that share a node of ``crowded`` (class, node):
    a node of one root says nothing new, so a group that is one component makes no crowd.
    All classes outside a crowd's commonest root are compared with all of the crowd, on
    full sets; a wide crowd becomes smaller ones first, by rare shingles. Crowds of a single
    block share tasks. None where nothing is apart."""
    n = crowded.count()
    held = written(_few(_rooted(crowded, known).groupBy("node", "root").agg(F.count("*").alias("n")), n), "near-dedup-held")
    low = held.groupBy("node").agg(F.min("root").alias("a"), F.max("root").alias("high")).where("a != high").select("node", "a")
    apart = held.join(low, "node").where("root != a").select("a", F.col("root").alias("b")).distinct()
    apart = written(_few(apart, n), "near-dedup-apart-pairs")
    if apart.isEmpty():
        return None
    crowds = components(apart).select(F.col("class").alias("root"), F.col("root").alias("crowd"))
    members = _rooted(classes.select("class", "size"), known)
    members = written(members.join(crowds, "root"), "near-dedup-crowds")
    n = members.count()
    members = members.withColumn("crowd", F.hex("crowd"))
    tally = _tally(members).select("crowd", (F.col("left_n") > WIDE).alias("wide"))
    members = written(_few(members.join(tally, "crowd"), n), "near-dedup-apart")
    sets = _full_sets(slim, classes, members.select("class"), "near-dedup-apart")
    wide, members = members.where("wide"), members.where("not wide").select("crowd", "class", "root", "size", *_sizes(similarity))
    if not wide.isEmpty():
        members = members.unionByName(_meeting(wide, sets, similarity))

    def blocks(n, w):
        spread = F.least(F.lit(CROWD_BLOCKS), F.ceil(n / CROWD_LEAST))
        return F.greatest(F.ceil(n / CROWD_ROWS), F.ceil(w / CROWD_SHINGLES), spread).cast("int")

    members = written(members, "near-dedup-meeting")
    lefts, rights = blocks(F.col("left_n"), F.col("left_w")).alias("lefts"), blocks(F.col("n"), F.col("w")).alias("rights")
    tally = written(_tally(members).select("crowd", "most", "n", "w", lefts, rights), "near-dedup-tally")
    one = F.col("rights") == 1
    n, w = tally.where(one).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    packs = max(1, math.ceil(n / CROWD_ROWS), math.ceil(w / CROWD_SHINGLES))
    pack = F.when(one, F.concat(F.lit("pack "), F.pmod(F.xxhash64("crowd"), F.lit(packs)).cast("string"))).otherwise(F.col("crowd"))
    members = members.join(tally.withColumn("pack", pack), "crowd")

    def dealt(blocks):
        return F.pmod(F.xxhash64("class"), F.col(blocks).cast("long")).cast("int")

    def each(blocks):
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    columns = ["pack", "crowd", "class", "root", "low", "high"]
    left = members.where("root != most").select(*columns, F.lit(True).alias("left"), dealt("lefts").alias("i"), each("rights").alias("j"))
    right = members.select(*columns, F.lit(False).alias("left"), each("lefts").alias("i"), dealt("rights").alias("j"))
    rows = left.unionByName(right).join(sets, "class")
    return written(rows.groupBy("pack", "i", "j").applyInArrow(_block_links(similarity), "a binary, b binary"), "near-dedup-apart-edges")


def _confirmed(slim, classes, pairs, similarity):
    """The pairs that are links by their full sets."""
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    shared = F.size(F.filter(F.zip_with("sketch_a", "sketch_b", lambda x, y: x == y), lambda x: x))
    pairs = written(pairs, "near-dedup-pairs")
    alike = (
        _pairs_with(pairs, classes, "size", "sketch")
        .where((100 * small >= similarity * large) & (shared >= SHARED))
        .select("a", "b", "size_a", "size_b")
    )
    alike = written(_few(alike, pairs.count(), 2), "near-dedup-alike")
    n = alike.count()
    needed = written(_few(alike.select(F.col("a").alias("class")).union(alike.select("b")).distinct(), 2 * n), "near-dedup-needed")
    sets = _full_sets(slim, classes, needed, "near-dedup")
    both = F.size(F.array_intersect("set_a", "set_b"))
    links = _pairs_with(alike, sets, "set").where(100 * both >= similarity * (F.col("size_a") + F.col("size_b") - both))
    return written(_few(links.select("a", "b"), n, 8), "near-dedup-edges")


def near_duplicates(docs, similarity=SIMILARITY):
    """doc_id, n_shingles, class, component_id, kept for every row of ``docs``
    (doc_id, text; other columns are ignored).

    Two texts are linked when 100 * intersection >= similarity * union of their
    sets of distinct 5-word shingles. component_id is the smallest doc_id that
    links reach, kept says that it is the row's own. A text without words (null,
    empty, white space) is linked with nothing and kept. Repeated rows share a
    class; rows of the same doc_id as the smallest are all kept. A null doc_id is
    larger than any other; it is kept where nothing smaller is reached."""
    text.small_batches(docs.sparkSession)
    slim = docs.select("doc_id", "text")
    signed = written(
        slim.mapInArrow(_sign, "doc_id long, n_shingles long, class binary, tokens array<int>, sketch array<tinyint>"), "near-dedup-signed"
    )
    worded = signed.where("class is not null")
    classes = worded.groupBy("class").agg(
        F.min("doc_id").alias("first"), F.first("n_shingles").alias("size"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch")
    )
    classes = written(_few(classes, signed.count(), 4), "near-dedup-classes")
    many = classes.count()
    edges, crowds = None, []
    for trees in TURNS:
        known = components(edges) if edges is not None else None
        pairs, crowded = candidates(classes, trees, known, many)
        confirmed = _confirmed(slim, classes, pairs, similarity)
        edges = confirmed if edges is None else edges.unionByName(confirmed)
        crowds += [crowded] if crowded is not None else []
    known = components(edges)
    if crowds:
        more = crowd_links(slim, classes, reduce(DataFrame.unionByName, crowds), known, similarity)
        if more is not None:
            known = components(edges.unionByName(more))
    roots = _rooted(classes.select("class", "first"), known)
    lowest = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    roots = written(_few(roots.join(lowest, "root").select("class", "component_id"), many), "near-dedup-roots")
    plain = signed.where("class is null").withColumn("component_id", F.col("doc_id"))
    return (
        worded.join(roots, "class")
        .unionByName(plain, allowMissingColumns=True)
        .select(
            "doc_id",
            "n_shingles",
            "class",
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
