"""Words of UTF-8 texts as 64-bit hashes, computed on whole byte buffers with numpy.

A word is a run of bytes other than space and TAB..CR; A-Z count as a-z. A null
text has no words. Memory follows ``CHUNK``, not the batch: texts are taken in
groups of about that many bytes, and a longer text in slices cut at white space."""

import re

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes outside letters: all of ASCII but A-Z and a-z.
_OTHER = np.ones(256, bool)
_OTHER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_CUT = re.compile(rb"[\x20\x09-\x0D]")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_VALUE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def small_batches(spark, rows=1000):
    """Hand texts to Python in batches of at most ``rows`` rows, in this session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def mix(x):
    """Bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n):
    if len(_powers[0]) < n:
        for k, base in enumerate((int(_ODD), pow(int(_ODD), -1, 1 << 64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1]


def _words(data, gaps, stem=0):
    """Starts and hashes of the words of a buffer that ends in white space. With
    ``stem``, each word is followed by the hash of its first ``stem`` bytes."""
    b = np.frombuffer(data, np.uint8)
    inside = ~gaps[b]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(b) and inside[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    up, down = _power(len(b))
    sums = np.cumsum(_VALUE[b] * up)
    if stem:
        starts, ends = np.repeat(starts, 2), np.repeat(ends, 2)
        ends[1::2] = np.minimum(ends[1::2], starts[1::2] + stem)
    total = sums[ends - 1] - np.where(starts > 0, sums[starts - 1], np.uint64(0))
    return starts, mix(total * down[starts] + (ends - starts).astype(np.uint64))


def slices(data):
    """A long text in parts of about ``CHUNK`` bytes that end in white space."""
    at = 0
    while len(data) - at > CHUNK:
        found = _CUT.search(data, at + CHUNK)
        if not found:
            break
        yield data[at : found.end()]
        at = found.end()
    yield data[at:] + b" "


def groups(texts, most=4096):
    """(first, end) of runs of consecutive texts of about ``CHUNK`` bytes, and of
    ``most`` texts at most; a longer text is a run of its own."""
    at = 0
    while at < len(texts):
        end, room = at, CHUNK
        while end < len(texts) and end - at < most and (end == at or len(texts[end]) <= room):
            room -= len(texts[end]) + 1
            end += 1
        yield at, end
        at = end


def chunks(texts, most=4096, letters=False, stem=0):
    """(first, hashes, bounds) for runs of consecutive texts: the words of text
    ``first + i`` are ``hashes[bounds[i]:bounds[i + 1]]``. With ``letters``, all that is
    no letter parts words; ``stem`` adds the hash of each word's first bytes."""
    gaps = _OTHER if letters else _SPACE
    for at, end in groups(texts, most):
        if end == at + 1 and len(texts[at]) > CHUNK:
            hashes = np.concatenate([_words(s, gaps, stem)[1] for s in slices(texts[at])])
            bounds = np.array([0, len(hashes)])
        else:
            starts, hashes = _words(b" ".join(texts[at:end]) + b" ", gaps, stem)
            cuts = np.cumsum([0] + [len(t) + 1 for t in texts[at:end]])
            bounds = np.searchsorted(starts, cuts)
        yield at, hashes, bounds


def raw(column):
    """The texts of an Arrow string column as bytes; null as no bytes."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def per_text(values, bounds, reduce=np.add):
    """Reduce ``values`` within each text; 0 for a text without values."""
    out = np.zeros(len(bounds) - 1, values.dtype)
    some = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(some):
        out[some] = reduce.reduceat(values, bounds[some])
    return out


def shingles(hashes, bounds, width=5):
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    salt = mix(np.arange(1, width + 2, dtype=np.uint64))
    n = len(hashes) - width + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for j in range(width if n > 0 else 0):
        rolled += hashes[j : j + n] * (salt[j] | np.uint64(1))
    rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            short = np.sum(hashes[a:b] * (salt[: b - a] | np.uint64(1)), dtype=np.uint64, keepdims=True)
            out.append(mix(short + salt[width:] * np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
