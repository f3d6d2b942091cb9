"""What a Python worker holds besides its JVM: a few words and texts at a time."""

import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from meterspan.llm import bpe, text

LETTERS = "abcdefghijklmnop"


def vocabulary():
    pieces = [bytes([i]) for i in range(256)]
    return {p: i for i, p in enumerate(pieces + [(a + b).encode() for a in LETTERS for b in LETTERS])}


def peak(f):
    tracemalloc.start()
    try:
        f()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_known_and_rare_words_are_not_all_objects_at_once():
    rng = random.Random(1)
    table = vocabulary()
    words = ["".join(rng.choices(LETTERS, k=rng.randrange(1, 12))) for _ in range(90_000)]
    plain = bpe.Merges(table)
    known = sorted(set(words[:40_000]))
    ids = plain.encode([w.encode() for w in known])
    flat, ends = np.concatenate(ids).astype(np.uint32), np.cumsum([len(x) for x in ids]).astype(np.int64)
    # Row 0 has no words, row 1 is split in Python, and the others have all words, known and rare.
    texts = [[], None] + [words[i : i + 900] for i in range(0, 90_000, 900)]
    odd = [None, "ab cd " + words[0]] + [None] * 100
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * 102, pa.int32()), pa.array(odd), pa.array(texts, pa.list_(pa.string())), pa.array(range(102))], ["pad", "odd", "pieces", "doc_id"]
    )
    got = []

    def run():
        got.extend(bpe._encoder(table, (pa.array(known), flat, ends), public_tokenizers.PATTERN)([batch]))

    most = peak(run)
    want = [b"".join(w.encode() for w in t or []) for t in texts]
    want[1] = odd[1].encode()
    rows = pa.Table.from_batches(got).to_pylist()
    assert [r["decoded_sha256"] for r in rows] == [hashlib.sha256(w).hexdigest() for w in want]
    asked = [[], ["ab", " ", "cd", " ", words[0]], *texts[2:]]
    for r, t in list(zip(rows, asked))[2:]:
        assert np.frombuffer(r["ids"], "<u4").tolist() == [int(i) for x in plain.encode([w.encode() for w in t]) for i in x]
        assert r["n_tokens"] * 4 == len(r["ids"])
    assert most < 32 << 20


def test_no_known_words_and_no_words():
    table = vocabulary()
    none = (pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(0, np.int64))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0, 0], pa.int32()), pa.nulls(2, pa.string()), pa.array([["abc", "é", "abc"], []], pa.list_(pa.string())), pa.array([1, 2])],
        ["pad", "odd", "pieces", "doc_id"],
    )
    (out,) = bpe._encoder(table, none, public_tokenizers.PATTERN)([batch])
    assert out.column(1).to_pylist() == [6, 0]
    (out,) = bpe._encoder(table, none, public_tokenizers.PATTERN)([batch.slice(1)])
    assert out.column(1).to_pylist() == [0]


def test_words_of_many_texts_are_hashed_in_small_parts():
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices(LETTERS, k=6)) for _ in range(400)).encode() for _ in range(1000)]
    most = peak(lambda: [len(hashes) for _, hashes, _ in text.chunks(texts)])
    assert most < 16 << 20
