"""Byte-level BPE encoding and decoding.

A text is split into words by the tokenizer's pattern. The commonest ``WORDS`` distinct
words of the corpus are encoded by Spark higher-order functions, which fold ranked
merges over the word's byte array, with the rank map in a broadcast row. Every task gets
these words; a word outside them is folded where it stands, by the same merges on
arrays of such words, some thousands at a time. Decoding concatenates the byte pieces of the ids.

Bytes are carried as Latin-1 characters in Spark SQL. The vocabulary file is a parameter."""

import base64
import hashlib
import heapq
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from meterspan.llm import text

WORDS = 1 << 16
#: Buckets of the rank map: an array of small maps.
BUCKETS = 1 << 16
#: Groups of words that Spark SQL folds, each a row with the rank map.
GROUPS = 64
LONG = 48
#: Words outside the commonest that a task holds as Python objects at once.
AT_ONCE = 4096
#: Texts that a task holds at once, with their words.
ROWS = 250
_NONE = np.int64(1 << 40)


def ranks(path):
    """Byte pieces by rank, from a file of lines of base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def java_pattern(pattern):
    """The pattern for Java, whose white space is ASCII unless told otherwise."""
    return pattern.replace(r"\S", r"\P{IsWhite_Space}").replace(r"\s", r"\p{IsWhite_Space}")


def _words(body, pattern):
    return F.regexp_extract_all(body, F.lit(java_pattern(pattern)), F.lit(0))


# --- the fold in Spark SQL -------------------------------------------------------


def rank_map(spark, table):
    """The rank map as column ``ranks`` of one row: array<map<string,int>> by hash of the
    piece. As a literal it would be spelt out in every description of a plan, and the
    driver makes several for each run and keeps them."""
    pieces = spark.createDataFrame([(p.decode("latin-1"), r) for p, r in table.items()], "key string, value int")
    bucket = F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int").alias("b")
    full = pieces.groupBy(bucket).agg(F.collect_list(F.struct("key", "value")).alias("m"))
    every = spark.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(full, "b", "left")
    rows = every.agg(F.sort_array(F.collect_list(F.struct("b", "m"))).alias("t"))
    none = F.array().cast("array<struct<key:string,value:int>>")
    return rows.select(F.transform("t", lambda x: F.map_from_entries(F.coalesce(x["m"], none))).alias("ranks"))


def _let(value, body):
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _rank(table, piece):
    return F.get(table, F.pmod(F.xxhash64(piece), F.lit(BUCKETS)).cast("int"))[piece]


def _folded(word, table):
    """The pieces of a word: again and again the pair of lowest rank is joined, the
    leftmost first. The state has the pieces and the rank of each pair."""
    size = F.length(word)
    single = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(word, i, F.lit(1)))
    none = F.array().cast("array<int>")

    def pair(pieces, i):
        return _let(F.concat(F.get(pieces, i), F.get(pieces, i + 1)), lambda x: _rank(table, x))

    def first(pieces):
        return F.struct(pieces.alias("p"), F.transform(F.sequence(F.lit(0), F.size(pieces) - 2), lambda i: pair(pieces, i)).alias("r"))

    def step(state, _):
        def join(i):
            p, r = state["p"], state["r"]
            joined = F.concat(F.slice(p, F.lit(1), i - 1), F.array(F.concat(F.get(p, i - 1), F.get(p, i))), F.slice(p, i + 2, F.size(p)))

            def reranked(q):
                left = F.when(i > 1, F.concat(F.slice(r, F.lit(1), i - 2), F.array(pair(q, i - 2)))).otherwise(none)
                right = F.when(i < F.size(r), F.concat(F.array(pair(q, i - 1)), F.slice(r, i + 2, F.size(r)))).otherwise(none)
                return F.struct(q.alias("p"), F.concat(left, right).alias("r"))

            return F.when(i.isNull(), state).otherwise(_let(joined, reranked))

        return _let(F.array_position(state["r"], F.array_min(state["r"])), join)

    merged = F.aggregate(F.sequence(F.lit(1), size - 1), _let(single, first), step, lambda s: s["p"])
    return F.when(size < 2, single).otherwise(merged)


def encode_words(words, table):
    """``word`` (not empty) and ``ids`` for a column of distinct words, in Spark SQL."""
    group = F.pmod(F.xxhash64("word"), F.lit(GROUPS))
    groups = words.groupBy(group.alias("g")).agg(F.collect_list("word").alias("words")).repartition(GROUPS)
    rows = groups.crossJoin(F.broadcast(rank_map(words.sparkSession, table)))

    def coded(word, t):
        latin = F.decode(word.cast("binary"), "ISO-8859-1")
        return F.struct(word.alias("word"), F.transform(_folded(latin, t), lambda p: _rank(t, p)).alias("ids"))

    return rows.select(F.inline(_let(F.col("ranks"), lambda t: F.transform("words", lambda w: coded(w, t)))))


def commonest(docs, pattern, n=WORDS):
    """The ``n`` commonest distinct words of all texts (ties by the word)."""
    words = docs.select(F.explode(_words(F.col("text"), pattern)).alias("word"))
    return words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(n).select("word")


# --- the fold on arrays ----------------------------------------------------------


class Merges:
    """Rank of every pair of pieces, by their ids."""

    def __init__(self, table):
        self.table = table
        keys, values = array("q"), array("q")
        for piece, rank in table.items():
            for i in range(1, len(piece)):
                a, b = table.get(piece[:i]), table.get(piece[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        keys, values = np.frombuffer(keys, np.int64), np.frombuffer(values, np.int64)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        slot = self._slot(self.keys)
        self.first_key = np.full(1 << 20, -1, np.int64)
        self.first_value = np.zeros(1 << 20, np.int32)
        self.first_key[slot[::-1]], self.first_value[slot[::-1]] = self.keys[::-1], self.values[::-1]
        # Slots that several keys share need a search when the first key differs.
        self.shared = np.zeros(1 << 20, bool)
        slot.sort()
        self.shared[slot[1:][slot[1:] == slot[:-1]]] = True
        self.byte = np.array([table[bytes([i])] for i in range(256)], np.int64)

    @staticmethod
    def _slot(keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def rank(self, a, b):
        keys = a << np.int64(32) | b
        slot = self._slot(keys)
        out = np.where(self.first_key[slot] == keys, self.first_value[slot], _NONE)
        rest = np.nonzero((out == _NONE) & self.shared[slot])
        if len(rest[0]):
            at = np.searchsorted(self.keys, keys[rest])
            at[at == len(self.keys)] = 0
            out[rest] = np.where(self.keys[at] == keys[rest], self.values[at], _NONE)
        return out

    def _equal(self, words, size):
        """Ids of words of ``size`` bytes each, all merged together."""
        ids = self.byte[np.frombuffer(b"".join(words), np.uint8).reshape(-1, size)]
        out = [None] * len(words)
        live = np.arange(len(words))
        while ids.shape[1] > 1:
            rank = self.rank(ids[:, :-1], ids[:, 1:])
            at = rank.argmin(1)
            low = rank[np.arange(len(rank)), at]
            ended = low == _NONE
            for i, row in zip(live[ended], ids[ended]):
                out[i] = row
            ids, live, at, low = ids[~ended], live[~ended], at[~ended, None], low[~ended]
            if not len(live):
                return out
            column = np.arange(ids.shape[1] - 1)[None]
            shorter = np.where(column <= at, ids[:, :-1], ids[:, 1:])
            np.put_along_axis(shorter, at, low[:, None], 1)
            ids = shorter
        for i, row in zip(live, ids):
            out[i] = row
        return out

    def _long(self, word):
        """The same merges with a heap, for a word of any length."""
        ids = [int(self.byte[b]) for b in word]
        after, before, end = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1)), len(ids)
        piece = [word[i : i + 1] for i in range(end)]
        heap = []

        def offer(i):
            j = after[i]
            if j < end:
                rank = self.table.get(piece[i] + piece[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, len(piece[i]), len(piece[j])))

        for i in range(end):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if piece[i] is None or j >= end or len(piece[i]) != a or len(piece[j]) != b:
                continue
            piece[i], piece[j], ids[i] = piece[i] + piece[j], None, rank
            after[i] = after[j]
            if after[j] < end:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([ids[i] for i in range(end) if piece[i] is not None], np.int64)

    def encode(self, words):
        """Ids of each word (bytes, not empty)."""
        out, sizes = [None] * len(words), {}
        for i, w in enumerate(words):
            sizes.setdefault(len(w), []).append(i)
        for size, at in sizes.items():
            own = [words[i] for i in at]
            for i, ids in zip(at, map(self._long, own) if size > LONG else self._equal(own, size)):
                out[i] = ids
        return out

    def encode_array(self, words):
        """For an Arrow array of words: their ids in one array, and where each word's
        begin and how many they are. Taken by length, ``AT_ONCE`` words at a time."""
        order = np.argsort(pc.binary_length(words).to_numpy(zero_copy_only=False), kind="stable")
        sizes, starts, flat = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [np.zeros(0, np.uint32)]
        for at in range(0, len(order), AT_ONCE):
            some = order[at : at + AT_ONCE]
            ids = self.encode([w.encode() for w in words.take(pa.array(some)).to_pylist()])
            sizes[some] = [len(x) for x in ids]
            flat.append(np.concatenate(ids).astype(np.uint32))
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate(flat), starts, sizes


def _gather(flat, starts, sizes, index):
    """Concatenation of ``flat[starts[i]:starts[i] + sizes[i]]`` for i in ``index``."""
    size = sizes[index]
    ends = np.cumsum(size)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[index] - ends + size, size)], ends


def _encoder(table, known, pattern):
    words, flat_ids, ends = known

    def run(batches):
        import regex

        split, merges = regex.compile(pattern), Merges(table)
        # The last place, which -1 finds, is that of words outside the known.
        known_sizes = np.append(np.diff(ends, prepend=0), 0)
        known_starts = np.append(ends - known_sizes[:-1], 0)
        pieces = [b""] * (max(table.values()) + 1)
        for piece, rank in table.items():
            pieces[rank] = piece
        for batch in batches:
            column = batch.column(2)
            if column.null_count:
                texts = batch.column(1).to_pylist()
                column = pa.array([split.findall(t or "") if p is None else p for t, p in zip(texts, column.to_pylist())], pa.list_(pa.string()))
            flat = pc.dictionary_encode(column.flatten())
            found = pc.fill_null(pc.index_in(flat.dictionary, value_set=words.cast(flat.dictionary.type)), -1).to_numpy(zero_copy_only=False)
            sizes, starts, rare = known_sizes[found], known_starts[found], np.flatnonzero(found < 0)
            rare_ids, rare_starts, sizes[rare] = merges.encode_array(flat.dictionary.take(pa.array(rare)))
            starts[rare] = rare_starts + len(flat_ids)
            every = np.concatenate([flat_ids, rare_ids])
            bounds = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
            index = flat.indices.to_numpy(zero_copy_only=False)
            out, digests = [], []
            for a, b in zip(bounds[:-1], bounds[1:]):
                ids = _gather(every, starts, sizes, index[a:b])[0].astype("<u4").tobytes()
                out.append(ids)
                digests.append((hashlib.sha256(ids).hexdigest(), hashlib.sha256(decode(ids, pieces)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[3:],
                    pa.array([len(x) // 4 for x in out], pa.int64()),
                    *(pa.array([x[k] for x in digests], pa.string()) for k in range(2)),
                    pa.array(out, pa.large_binary()),
                ],
                [*batch.schema.names[3:], "n_tokens", "ids_sha256", "decoded_sha256", "ids"],
            )

    return run


def decode(ids, pieces):
    """Bytes of ids (little-endian unsigned 32-bit) by the list of pieces."""
    return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encoded(docs, path, pattern, keep=("doc_id",), words=WORDS):
    """The columns ``keep``, n_tokens, ids (binary, little-endian unsigned 32-bit),
    ids_sha256 and decoded_sha256 for every row of ``docs``.

    A null text is empty and has no tokens. Texts with characters that Java's Unicode
    tables lack are split in Python. Special tokens are ordinary text."""
    text.small_batches(docs.sparkSession, ROWS)
    table = ranks(path)
    common = encode_words(commonest(docs, pattern, words), table).toArrow().combine_chunks()
    lists = common.column("ids").combine_chunks()
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    known = (common.column("word").combine_chunks(), lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint32), ends)
    rows = docs.select(
        F.lit(0).alias("pad"),
        F.when(F.col("text").rlike(r"\p{Cn}"), F.col("text")).alias("odd"),
        F.when(~F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{Cn}"), _words(F.coalesce(F.col("text"), F.lit("")), pattern)).alias("pieces"),
        *(F.col(c) for c in keep),
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    head = f"{kinds}, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary"
    return rows.mapInArrow(_encoder(table, known, pattern), head)
