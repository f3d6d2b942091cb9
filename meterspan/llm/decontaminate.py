"""Benchmark decontamination by latent semantic retrieval.

Texts are read as sequences of the benchmark's words (others can match nothing) in
segments of ``SEGMENT`` words; a passage is two or three neighbouring segments.
Segments are vectors over these words, weighted by term frequency
and squared log inverse frequency. A distributed randomised SVD of the
segments of all texts, together with the benchmark's passages at equal weight, gives
a latent space. Every passage is compared there with every benchmark passage, in
blocks; a cosine of ``COSINE`` makes a candidate. A candidate is confirmed by the
longest common subsequence of words, and by the answer (the last words of the
benchmark passage) where the subsequence alone leaves doubt, so paraphrases count.

The benchmark is the stated query set: it is taken ``BLOCK`` items at a time, which
bounds what tasks are sent. Nothing of the documents reaches the driver but sums."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from meterspan.llm import text
from meterspan.session import written

SEGMENT = 32
WIDTHS = (2, 3)
PASSAGE = 64
RANK = 64
COSINE = 0.5
SURE = 0.8
LIKELY = 0.7
ANSWER = 6
ANSWER_SHARE = 0.65
#: Words in a larger share of all segments have no weight in the latent space, but for
#: the RARE rarest words of each benchmark passage.
COMMON = 0.08
RARE = 6
BLOCK = 5_000


def _passages(items):
    """Word hash lists of the benchmark, an item of more than ``PASSAGE`` words in
    parts of near equal length."""
    ids, lists = [], []
    for at, hashes, bounds in text.chunks([t.encode() for _, t in items], letters=True):
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            parts = -(-int(b - a) // PASSAGE)
            for part in np.array_split(hashes[a:b], parts) if parts else []:
                ids.append(items[at + i][0])
                lists.append(part)
    return ids, lists


def _known(vocabulary):
    """Index of each known word by its hash; a table of the first bits lets most
    unknown words go without a search."""
    first = np.zeros(1 << 20, bool)
    first[(vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def find(hashes):
        at = np.flatnonzero(first[(hashes >> np.uint64(44)).astype(np.int64)])
        index = np.searchsorted(vocabulary, hashes[at])
        index[index == len(vocabulary)] = 0
        hit = vocabulary[index] == hashes[at]
        return at[hit], index[hit].astype(np.int32)

    return find


def _reduce(vocabulary):
    """Texts as the places and indexes of the benchmark's words."""

    def run(batches):
        find = _known(vocabulary)
        for batch in batches:
            for at, hashes, bounds in text.chunks(text.raw(batch.column(1)), letters=True):
                place, index = find(hashes)
                cuts = np.searchsorted(place, bounds).astype(np.int32)
                place = (place - np.repeat(bounds[:-1], np.diff(cuts))).astype(np.int32)
                n = len(bounds) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), pa.ListArray.from_arrays(cuts, pa.array(place)), pa.ListArray.from_arrays(cuts, pa.array(index))],
                    ["doc_id", "place", "word"],
                )

    return run


def _segments(batch, most=1 << 17):
    """(rows, segment number of each word, words, segments of each row) for runs of rows."""
    places, words = batch.column(1), batch.column(2)
    ends = np.concatenate(([0], np.cumsum(places.value_lengths().to_numpy(zero_copy_only=False))))
    place, word = places.flatten().to_numpy(), words.flatten().to_numpy()
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        own, of = slice(ends[at], ends[end]), ends[at : end + 1] - ends[at]
        last = np.array([place[ends[i + 1] - 1] // SEGMENT + 1 if ends[i + 1] > ends[i] else 0 for i in range(at, end)], np.int64)
        base = np.concatenate(([0], np.cumsum(last)))
        yield at, end, place[own] // SEGMENT + np.repeat(base[:-1], np.diff(of)), place[own], word[own], base, of
        at = end


def _spread(n):
    """Partial document counts of the words over segments, one row a task."""

    def run(batches):
        seen, total = np.zeros(n, np.int64), 0
        for batch in batches:
            for _, _, segment, _, word, base, _ in _segments(batch):
                pairs = np.unique(segment * n + word)
                seen += np.bincount(pairs % n, minlength=n)
                total += int(base[-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n + 1, dtype=np.int32)), pa.array(np.append(seen, total))], ["word", "n"])

    return run


def _sketch(idf, omega):
    """Partial sums of A'A Omega over the segments, one row a word and task."""

    def run(batches):
        total = np.zeros(omega.shape)
        weighted = (idf[:, None] * omega).astype(np.float32)
        for batch in batches:
            for _, _, segment, _, word, base, _ in _segments(batch):
                weighs = idf[word] > 0
                segment, word = segment[weighs], word[weighs]
                if len(word):
                    cuts = np.flatnonzero(np.diff(segment, prepend=-1))
                    y = np.add.reduceat(weighted[word], cuts)
                    row = np.repeat(np.arange(len(cuts)), np.diff(np.append(cuts, len(word))))
                    order = np.argsort(word, kind="stable")
                    first = np.flatnonzero(np.diff(word[order], prepend=-1))
                    total[word[order][first]] += np.add.reduceat(y[row[order]], first)
        total *= idf[:, None]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(idf), dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], ["word", "sums"]
        )

    return run


def _common(masks, words, n):
    """Matched places of the longest common subsequence of a pattern of n words (a bit
    mask of places for each word) and ``words``, as a bit mask."""
    row, full = (1 << n) - 1, (1 << n) - 1
    for w in words:
        m = masks.get(w, 0)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return full & ~row


def _search(model):
    ids, patterns, base, vectors = model["ids"], model["patterns"], model["base"], model["vectors"]

    strong = base.any(1)

    def run(batches):
        masks = []
        for p in patterns:
            m = {}
            for i, w in enumerate(p.tolist()):
                m[w] = m.get(w, 0) | 1 << i
            masks.append(m)
        for batch in batches:
            docs, found = batch.column(0), {}
            for at, _, segment, place, word, bounds, of in _segments(batch):
                if not len(word):
                    continue
                every = np.zeros((int(bounds[-1]), base.shape[1]), np.float32)
                weighs = np.flatnonzero(strong[word])
                cuts = np.flatnonzero(np.diff(segment[weighs], prepend=-1))
                if len(cuts):
                    every[segment[weighs][cuts]] = np.add.reduceat(base[word[weighs]], cuts)
                owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                for width in WIDTHS:
                    total = every.copy()
                    for j in range(1, width):
                        total[:-j] += every[j:] * (owner[:-j] == owner[j:])[:, None]
                    length = np.sqrt((total * total).sum(1))
                    total /= np.where(length > 0, length, 1)[:, None]
                    for a in range(0, len(total), 8192):
                        for s, q in zip(*np.nonzero(total[a : a + 8192] @ vectors.T >= COSINE)):
                            s += a
                            doc = int(owner[s])
                            lo, hi = np.searchsorted(segment, (s, min(s + width, bounds[doc + 1])))
                            n = len(patterns[q])
                            hit = _common(masks[q], word[lo:hi].tolist(), n)
                            share = hit.bit_count() / n
                            if share < LIKELY:
                                continue
                            tail = min(ANSWER, n)
                            own = {w: m >> (n - tail) for w, m in masks[q].items() if m >> (n - tail)}
                            answer = _common(own, word[lo:hi].tolist(), tail).bit_count() / tail
                            if share >= SURE or answer >= ANSWER_SHARE:
                                key = (at + doc, ids[q])
                                found[key] = max(found.get(key, (0, 0)), (share, answer))
            keys = sorted(found)
            yield pa.RecordBatch.from_arrays(
                [
                    docs.take(pa.array([k[0] for k in keys], pa.int64())),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([found[k][0] for k in keys], pa.float64()),
                    pa.array([found[k][1] for k in keys], pa.float64()),
                ],
                ["doc_id", "item_id", "share", "answer_share"],
            )

    return run


def _block(docs, items):
    ids, lists = _passages(items)
    if not ids:
        return None
    vocabulary = np.unique(np.concatenate(lists))
    n = len(vocabulary)
    texts = written(docs.select("doc_id", "text").mapInArrow(_reduce(vocabulary), "doc_id long, place array<int>, word array<int>"), "decontaminate")
    seen = np.zeros(n + 1)
    for w, count in texts.mapInArrow(_spread(n), "word int, n long").groupBy("word").agg(F.sum("n")).collect():
        seen[w] = count
    patterns = [np.searchsorted(vocabulary, p) for p in lists]
    weighs = seen[:n] <= COMMON * (seen[n] + 2)
    for p in patterns:
        own = np.unique(p)
        weighs[own[np.argsort(seen[own], kind="stable")[:RARE]]] = True
    idf = np.where(weighs, np.log((seen[n] + 2) / (seen[:n] + 1)) ** 2 + 1e-3, 0)
    tf = np.stack([np.bincount(p, minlength=n) for p in patterns]) * idf
    omega = np.random.default_rng(5).standard_normal((n, RANK))
    partial = texts.mapInArrow(_sketch(idf, omega), "word int, sums array<double>")
    sums = partial.groupBy("word").agg(*(F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(RANK)))
    corpus = np.zeros((n, RANK))
    for row in sums.collect():
        corpus[row[0]] = row[1:]
    bench = tf.T @ (tf @ omega)
    size = [np.linalg.norm(x) or 1.0 for x in (corpus, bench)]
    basis, _ = np.linalg.qr(corpus / size[0] + bench / size[1])
    vectors = tf @ basis
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    model = {
        "ids": ids,
        "patterns": patterns,
        "base": (idf[:, None] * basis).astype(np.float32),
        "vectors": (vectors / np.where(length > 0, length, 1)).astype(np.float32),
    }
    return texts.mapInArrow(_search(model), "doc_id long, item_id long, share double, answer_share double")


def contaminated(docs, benchmark, block=BLOCK):
    """doc_id, item_id, share, answer_share: the rows of ``docs`` (doc_id, text) that
    hold an item of ``benchmark`` (item_id, text), by the best passage.

    Whole texts are searched. Null or wordless texts and items match nothing. Repeated
    rows give repeated rows. Runs jobs for each block of items."""
    text.small_batches(docs.sparkSession)
    spark = docs.sparkSession
    items = benchmark.where("text is not null").select("item_id", "text")
    out = spark.createDataFrame([], "doc_id long, item_id long, share double, answer_share double")
    blocks = 1 if block is None else max(1, -(-items.count() // block))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        found = _block(docs, [(i, t) for i, t in sorted(own.collect(), key=lambda r: (r[0] is None, r[0], r[1]))])
        if found is not None:
            out = out.unionByName(found)
    return out
