"""Wide crowds: only classes that share a rare shingle are compared, and no link is lost."""

import hashlib
import itertools
import random

import corpus_pipeline
import pyarrow as pa
import pytest

from meterspan.llm import near_dedup


def name(i):
    return hashlib.blake2b(str(i).encode(), digest_size=16).digest()


def linked(a, b):
    return 100 * len(a & b) >= 75 * len(a | b)


def some_sets(rnd):
    """Sets of a common line and an own body, variants of some of them, and sets of few words."""
    lines = [set(rnd.sample(range(1 << 40), 12)) for _ in range(3)]
    sets = [rnd.choice(lines) | set(rnd.sample(range(1 << 40), rnd.randint(1, 30))) for _ in range(60)]
    for s in sets[:40]:
        gone = rnd.sample(sorted(s), len(s) * rnd.randint(0, 14) // 100)
        sets.append(s - set(gone) | set(rnd.sample(range(1 << 40), rnd.randint(0, len(s) // 8))))
    sets += [set(rnd.sample(range(20), rnd.randint(1, 12))) for _ in range(60)]
    return [set(s) for s in {frozenset(s) for s in sets}]


@pytest.mark.parametrize("common, bucket", [(1 << 17, 1 << 18), (8, 40)])
def test_linked_sets_meet_in_a_crowd(spark, monkeypatch, common, bucket):
    monkeypatch.setattr(near_dedup, "COMMON", common)
    monkeypatch.setattr(near_dedup, "RARE_SHINGLES", bucket)
    monkeypatch.setattr(near_dedup, "CROWD_SHINGLES", 4 * bucket)
    sets = some_sets(random.Random(3))
    roots = [name(i // 2) for i in range(len(sets))]
    wide = spark.createDataFrame([(name(i), r, len(s)) for i, (s, r) in enumerate(zip(sets, roots))], "class binary, root binary, size long")
    full = spark.createDataFrame([(name(i), sorted(s)) for i, s in enumerate(sets)], "class binary, set array<long>").repartition(3)
    rows = near_dedup._meeting(wide, full, 75).collect()
    at = {}
    for r in rows:
        at.setdefault(bytes(r["class"]), {})[r.crowd] = (r["size"], r.low, r.high)
    pairs = 0
    for i, j in itertools.combinations(range(len(sets)), 2):
        if linked(sets[i], sets[j]) and roots[i] != roots[j]:
            a, b = at.get(name(i), {}), at.get(name(j), {})
            assert any(a[c][1] <= b[c][0] <= a[c][2] and b[c][1] <= a[c][0] <= b[c][2] for c in a.keys() & b.keys())
            pairs += 1
    assert pairs > 30


def joined(rnd, words):
    return " ".join(rnd.choices(words, k=24))


def texts_of_a_line(n):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    line = joined(rnd, words)
    bodies = [joined(rnd, words) for _ in range(n)]
    return [f"{line} {body}" for body in bodies]


@pytest.fixture
def compared(monkeypatch):
    """The rows that were sent to be compared in crowds; nothing is compared."""
    monkeypatch.setattr(near_dedup, "WIDE", 64, raising=False)
    seen, real = [], near_dedup.written

    def count(similarity):
        return lambda table: pa.table({"a": [str(table.num_rows).encode()], "b": [b""]})

    def spy(df, name):
        out = real(df, name)
        if name == "near-dedup-apart-edges":
            seen.append(sum(int(r.a) for r in out.collect()))
            return out.limit(0)
        return out

    monkeypatch.setattr(near_dedup, "_block_links", count)
    monkeypatch.setattr(near_dedup, "written", spy)
    return seen


def test_a_common_line_costs_no_comparison_of_all_pairs(spark, compared):
    """Before, all of the crowd met in blocks, every class once a block of the other side."""
    docs = spark.createDataFrame(list(enumerate(texts_of_a_line(400))), "doc_id long, text string")
    assert near_dedup.near_duplicates(docs).count() == 400
    assert len(compared) == 1 and compared[0] <= 400


def test_the_pipeline_stage_compares_no_more(spark, compared):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts_of_a_line(400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.near_dedup_stage(spark, docs, None).count() == 400
    assert len(compared) == 1 and compared[0] <= 400


@pytest.mark.parametrize("wide", [4, 1024])
def test_wide_crowds_are_joined_as_all_pairs_join_them(spark, monkeypatch, wide):
    monkeypatch.setattr(near_dedup, "WIDE", wide)
    monkeypatch.setattr(near_dedup, "COMMON", 50)
    rnd = random.Random(8)
    texts = texts_of_a_line(120)
    for t in texts[:30]:
        words = t.split()
        words[rnd.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (None, texts[0])], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect() if r.doc_id is not None and r.doc_id < 900}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    up = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if linked(sets[i], sets[j]):
            low, high = sorted((up[i], up[j]))
            up = [low if u == high else u for u in up]
    assert got == dict(enumerate(up)) and len(set(up)) < len(up)
