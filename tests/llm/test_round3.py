"""SimHash links, whitening and conversation repair against brute force, on small
fixtures with nulls, empty and long texts, ties, repeated rows and empty tables."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from meterspan.llm import conversations, language, queries, simhash, whitening

WORDS = "ant bee cat dog elk fox gnu hen ibex jay koi lynx mole newt owl pig quail rat seal toad".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


# --- SimHash -------------------------------------------------------------------


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_classes(prints):
    """Root of every place, all pairs compared."""
    x = np.array(prints, np.uint64)
    root = np.arange(len(x))
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[:i] ^ x[i]) <= 4):
            if root[j] != root[i]:
                root[root == root[i]] = root[j]
    return root


def shared_classes(groups):
    """Sets of places, whatever the labels."""
    out = {}
    for place, label in enumerate(groups):
        out.setdefault(label, set()).add(place)
    return {frozenset(v) for v in out.values()}


@pytest.fixture(scope="module")
def docs(spark):
    base = prose(1, 400)
    near = [" ".join(["x" + str(i) if j == i else w for j, w in enumerate(base.split())]) for i in range(0, 400, 40)]
    texts = [base, base.upper(), *near, None, "", " \t\n", "one", "one two", "One  tWo", "a b c d", "ünï çødé 漢字 \U0001f600 \x85 x",
             prose(2, 30_000), "a" * 3000, *(prose(i, 40) for i in range(10, 60))]
    rows = [(i, t, "s", 7) for i, t in enumerate(texts)]
    rows += [rows[0], (None, prose(10, 40), None, None), (None, None, None, None), (None, "alone in the world", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, first string, print int")


def test_simhash_against_all_pairs(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [brute_print(t) for _, t in rows]
    root = brute_classes(prints)
    want = []
    for k, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in np.flatnonzero(root == root[k])]
        ids = [i for i in ids if i is not None]
        want.append((d, f"{prints[k]:016x}", min(ids) if ids else None))
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_fingerprint_of_slices_is_that_of_the_whole(monkeypatch):
    from meterspan.llm import text

    data = prose(3, 500).encode() + b" \n" + b"z" * 300 + b" end of it"
    whole = simhash.fingerprint(data)
    assert whole == brute_print(data.decode())
    for chunk in (1, 7, 100, 1000):
        monkeypatch.setattr(text, "CHUNK", chunk)
        assert simhash.fingerprint(data) == whole


def planted(n, seed):
    """Fingerprints: scattered ones, and chains and clusters of few changed bits."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    for base in (rng.getrandbits(64) for _ in range(20)):
        x = base
        for _ in range(15):
            for k in rng.sample(range(64), rng.randrange(1, 6)):
                x ^= 1 << k
            out.add(x)
    hot = rng.getrandbits(64)
    for _ in range(n):
        x = hot
        for k in rng.sample(range(64), rng.randrange(0, 5)):
            x ^= 1 << k
        out.add(x)
    return sorted(out | {0, (1 << 64) - 1, 15, 31})


@pytest.mark.parametrize("crowd", [4096, 60])
def test_links_connect_what_all_pairs_connect(spark, crowd):
    prints = planted(700, 5)
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "print long")
    place = {x: i for i, x in enumerate(prints)}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(frame, crowd).collect()]
    for a, b in links:
        assert (a ^ b).bit_count() <= 4
        root[find(place[a])] = find(place[b])
    assert shared_classes([find(i) for i in range(len(prints))]) == shared_classes(brute_classes(prints).tolist())
    # A cluster of n gives links in proportion to n, not to its square.
    assert len(links) < 60 * len(prints)


# --- whitening -----------------------------------------------------------------


def vectors(n, size, seed):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, size)) * np.linspace(0.2, 2, size)).astype(np.float32)


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, n int")


@pytest.mark.parametrize("block", [1, 50, 1024])
def test_spectrum_equals_a_direct_decomposition(block):
    x = np.random.default_rng(2).integers(-40, 40, (300, 12)).astype(np.int64)
    x[:, 5], x[:, 7] = x[:, 4], 3
    own = whitening.Spectrum(12)
    for at in range(0, 300, block):
        own.add(x[at : at + block])
    scatter = (x - x.mean(0)).T @ (x - x.mean(0))
    top = np.linalg.eigvalsh(scatter)
    assert own.total == x.sum(0).tolist() and np.allclose(own.values, top, atol=1e-11 * top[-1], rtol=0)
    assert np.allclose(own.vectors * own.values @ own.vectors.T, scatter, atol=1e-11 * top[-1], rtol=0)
    assert np.allclose(own.vectors.T @ own.vectors, np.eye(12), atol=1e-13)


def test_whitening_against_a_direct_one(spark):
    size, own = 20, vectors(400, 20, 3)
    rows = [(i, v.tolist(), "q", 1) for i, v in enumerate(own)]
    rows += [(500 + i, own[0].tolist(), None, None) for i in range(200)]  # one hot vector
    rows += [(None, own[1].tolist(), None, None), (900, None, "", 0), (901, [math.nan] * size, "", 0), (902, [math.inf] + [0.0] * (size - 1), "", 0),
             (903, [None] + [0.0] * (size - 1), "", 0), (904, [], "", 0), (905, [1.0, 2.0], "", 0)]
    frame = frame_of(spark, rows).repartition(7)
    got = whitening.whitened(frame, whitening.fit(frame, block=32)).collect()
    good = [(i, v) for i, v, *_ in rows if i is None or i < 900]
    x = np.floor(64 * np.array([v for _, v in good], np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    e, q = np.linalg.eigh((fit - total / n).T @ (fit - total / n) / n)
    e, q = e[::-1], q[:, ::-1]
    white = (x - total / n) @ q / np.sqrt(e)
    assert len(got) == 16 * len(good) and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, 17))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    wanted = {i: (white[k], int(((n * x[k] - total).astype(object) ** 2).sum())) for k, (i, _) in enumerate(good)}
    sign = {}
    for r in got:
        w, deviation = wanted[r.vec_id]
        assert r.deviation == deviation and abs(r.explained - e[r.component - 1] / e.sum()) < 1e-10
        assert abs(abs(r.whitened) - abs(w[r.component - 1])) < 1e-7
        if abs(r.whitened) > 1e-3:
            assert sign.setdefault(r.component, np.sign(r.whitened * w[r.component - 1])) == np.sign(r.whitened * w[r.component - 1])


def test_whitening_of_little(spark):
    empty = frame_of(spark, [])
    assert whitening.whitened(empty, whitening.fit(empty)).collect() == []
    same = frame_of(spark, [(i, [1.0, 2.0], "", 0) for i in range(5)])
    assert whitening.whitened(same, whitening.fit(same)).collect() == []  # no variance, no component
    line = frame_of(spark, [(i, [float(i), float(i)], "", 0) for i in range(5)])
    got = whitening.whitened(line, whitening.fit(line)).collect()
    assert sorted(r.vec_id for r in got) == list(range(5)) and {(r.component, round(r.explained, 9)) for r in got} == {(1, 1.0)}
    wide = frame_of(spark, [(i, [3e38 * (-1) ** i, float(i)], "", 0) for i in range(5)])
    assert {r.deviation for r in whitening.whitened(wide, whitening.fit(wide)).collect()} == {None}  # beyond a long


# --- conversations -------------------------------------------------------------


def brute_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    for kept in out.values():
        kept.sort(key=lambda r: ((r[0] is not None, r[0] or 0), hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()))
    return out


def brute_faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        again = (role, text) in seen
        seen.add((role, text))
        faults.append("b" if not body else "d" if again else "t" if body[-1] not in ".!?" else "")
    return faults


def brute_repair(rows, faults):
    """The least (cost, audit, text) over all edits, by a search over strings."""
    best = {("", 0): (0, "", ())}  # what is read so far -> cost, audit, lines
    ways = {"": "su", "s": "u", "u": "a", "a": "u"}

    def offer(into, state, way):
        if state not in into or way[:2] < into[state][:2]:
            into[state] = way

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for x in ways[state]:
                    if x != "s":
                        offer(best, x, (cost + 2, audit + "I", (*lines, ("user:" if x == "u" else "assistant:"))))
        return best

    best = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, lines) in inserted(best).items():
            offer(after, state, (cost + 3, audit + "D", lines))
            if fault in "bd" and fault:
                continue
            more = fault == "t"
            for x in ways[state]:
                if role[:1] == x:
                    offer(after, x, (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                if x != "s":
                    offer(after, x, (cost + 2 + more, audit + "R", (*lines, f"{'user' if x == 'u' else 'assistant'}:{text}")))
        best = after
    cost, audit, lines = min(way for state, way in inserted(best).items() if state in ("", "a"))
    return cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def exhaustive(initials, must_go, open_ends):
    """The least (cost, audit) over every audit of up to one insertion per gap and two at the end."""
    found = []
    for edits in itertools.product("DKR", repeat=len(initials)):
        for gaps in itertools.product(("", "I", "II"), repeat=len(initials) + 1):
            audit = "".join(g + e for g, e in zip(gaps, (*edits, "")))
            state, cost, row, good = "", 0, 0, True
            for letter in audit:
                turn = "a" if state == "u" else "u"
                if letter == "I":
                    state, cost = turn, cost + 2
                    continue
                if letter == "D":
                    cost += 3
                else:
                    good &= not must_go[row]
                    cost += open_ends[row] + 2 * (letter == "R")
                    if letter == "R":
                        state = turn
                    elif initials[row] == turn or (initials[row] == "s" and state == ""):
                        state = initials[row]
                    else:
                        good = False
                row += 1
            if good and state in ("", "a"):
                found.append((cost, audit))
    return min(found)


@pytest.mark.parametrize("window", [1, 512])
def test_repair_is_the_least_of_all(window):
    rng = random.Random(4)
    for n in (0, 1, 2, 3, 4):
        for _ in range(60):
            initials = [rng.choice("suaax ") for _ in range(n)]
            must_go, ends = [rng.random() < 0.2 for _ in range(n)], [rng.random() < 0.2 for _ in range(n)]
            ends = [e and not m for e, m in zip(ends, must_go)]
            own = conversations.Repair(window)
            for row in zip(initials, must_go, ends):
                own.add(*row)
            assert own.result() == exhaustive(initials, must_go, ends)


def test_windows_do_not_change_a_long_repair():
    rng = random.Random(6)
    rows = [(rng.choice("uauaus"), rng.random() < 0.1, False) for _ in range(1500)]
    results = set()
    for window in (1, 7, 100, 5000):
        own = conversations.Repair(window)
        for row in rows:
            own.add(*row)
        results.add(own.result())
    assert len(results) == 1


def test_conversations_against_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for conv in [*range(150), None]:
        for turn in range(rng.choice([1, 2, 3, 5, 8, 12])):
            role = rng.choice(["user", "assistant", "system", "tool", None, "", "User"]) if rng.random() < 0.2 else ("user", "assistant")[turn % 2]
            text = rng.choice([None, "", " \t\n", "no end", "Ünd!  \n", "same.", "a? \x85", f"text {conv} {turn}."])
            rows.append((conv, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 1, 2]), role, text))
    rows += rows[:20] + [(7000, t, ("user", "assistant")[t % 2], f"long {t}.") for t in range(900)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, gone string, part int")
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repaired(frame.repartition(5)).collect()}
    want = {}
    for conv, kept in brute_damage(rows).items():
        faults = brute_faults(kept)
        turns = [t for t, *_ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, digest = brute_repair(kept, faults)
        want[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)
    assert got == want
    assert conversations.repaired(frame.limit(0)).collect() == []


def test_columns_of_a_repair(spark):
    frame = spark.createDataFrame([(1, 0, "user", "hi.")], "conv_id long, turn int, role string, text string")
    got = conversations.repaired(frame.withColumn("audit", F.lit("q")))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_rows_of_one_doc_id_are_told_apart(spark):
    import corpus_pipeline

    a, b = prose(81, 40), prose(82, 40)
    rows = [(1, a, "x"), (5, b, "x"), (5, a, "x"), (None, a, "x"), (7, None, "y"), (7, None, "y"), (None, None, "z"), (None, b, "x"), (8, prose(83, 40), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    after = corpus_pipeline.near_dedup_stage(spark, docs, None)
    assert after.columns == docs.columns
    want = [rows[0], rows[1], rows[4], rows[5], rows[6], rows[8]]
    assert sorted(map(tuple, after.collect()), key=repr) == sorted(want, key=repr)
    assert corpus_pipeline.near_dedup_stage(spark, docs.limit(0), None).collect() == []


FOREIGN = {
    "polish": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, obdarzeni rozumem i sumieniem",
    "finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan, heille on annettu järki ja omatunto",
    "greek": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα, προικισμένοι με λογική",
    "japanese": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "soup": "xqzv wkjhg pqlmx zzrtv bnmkl qwxcv hjkzq vbnxz mqwpl kxjzv tgbqz plmxw zxqkv jhgwq vkzxm",
}


def test_foreign_texts_are_rejected_by_the_model_of_the_real_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = queries.language_model(docs)
    rows = [(f"{k} {n}", t[:n]) for k, t in FOREIGN.items() for n in (40, 80, 500)]
    rows += [("short", "the"), ("repeated", "que " * 800)]
    got = {r.doc_id: r.rejected for r in language.predict(spark.createDataFrame(rows, "doc_id string, text string"), model).collect()}
    assert all(got[f"{k} {n}"] for k in FOREIGN for n in (40, 80, 500))
    assert not got["short"] and not got["repeated"]
    own = language.predict(docs.where("text is not null and lang is not null"), model)
    assert own.where("rejected").count() <= 0.002 * own.count()
