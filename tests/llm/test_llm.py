"""Corpus operators against brute force, on small fixtures with nulls, empty and long
texts, repeated rows, extra columns with clashing names, and empty tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterspan.llm import (
    archive,
    bpe,
    decontaminate,
    language,
    near_dedup,
    quality_rules,
    queries,
    resampling,
    samples,
    secrets,
    sharding,
    text,
    toxicity,
)
from meterspan.session import scratch_folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, key string, blob string"
WORDS = "ant bee cat dog elk fox gnu hen ibex jay koi lynx mole newt owl pig quail rat seal toad".split()
SECRET = 'x password = "abc_DEF12" y AKIA' + "A1" * 10 + " z " + "0123456789abcdef" * 2


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def texts():
    base = prose(1, 60)
    near = " ".join(["changed", *base.split()[1:]])
    return [
        *(prose(i, 30) for i in range(10, 30)),
        base, base, near, base.upper(), " ".join(reversed(base.split())),
        None, "", " \t\n", "one", "one two", "one  two", "ünï çødé 漢字 \U0001f600 \x85 x", SECRET,
        "password=a token: secret:abcdefg", prose(2, 20_000), "a" * 3000, "1234 !!", "same line\nsame line\n\nother\n",
        " ".join(["again and again it goes"] * 5),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, "s", 1, "q", "k", "b") for i, t in enumerate(texts())]
    rows += [rows[0], (None, prose(10, 30), None, None, None, None, None, None), (None, None, *[None] * 6)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, int(i % 2)) for i in range(20)] + [(None, None, None)], "doc_id long, quality int, toxic int")


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    """Smallest reachable id by row position, all pairs compared."""
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    lowest = {}
    for i, (d, _) in enumerate(rows):
        known = lowest.get(find(i))
        lowest[find(i)] = d if known is None else (known if d is None else min(known, d))
    return sorted(((d, len(sets[i]), lowest[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def test_near_duplicates(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near_dedup.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_dedup.near_duplicates(empty).collect() == []


def test_large_group_of_near_copies_is_one_component(spark):
    base = prose(5, 200).split()
    rows = []
    for i in range(300):
        own = list(base)
        own[i % 200] = f"x{i}"
        rows.append((i, " ".join(own)))
    rows.append((999, prose(6, 200)))
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(300)} == {0} and got[999] == 999


def test_star_of_copies_that_are_linked_with_the_base_only(spark):
    base, rng = [f"w{i}" for i in range(100)], random.Random(3)
    rows = [(0, " ".join(base))]
    for i in range(1, 1001):
        own, first, gap = list(base), rng.randrange(5, 85), rng.randrange(5, 30)
        second = first + gap if first + gap < 95 else first - gap if first - gap >= 5 else 94 if first < 50 else 5
        own[first], own[second] = f"x{i}", f"y{i}"
        rows.append((i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame).collect()}
    sets = [shingle_set(t) for _, t in rows]
    assert all(100 * len(sets[0] & x) >= 75 * len(sets[0] | x) for x in sets)
    assert {i for i, c in got.items() if c != 0} == set()


def test_shards(docs, empty):
    rows = sharding.sharded(docs, shards=4).collect()
    source = sorted(((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect()), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == source
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.sharded(empty, shards=4).collect() == []


def test_shards_are_even_and_copies_of_one_text_are_dealt_out(spark):
    rows = [(i, prose(i, 5 + i % 40)) for i in range(600)] + [(1000 + i, "hot copy " * 20) for i in range(300)]
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).groupBy("shard").agg(F.sum("size")).collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == 8 and max(sizes) < 1.05 * min(sizes)


def test_write_shards(spark, docs):
    path = scratch_folder(spark, "shards")
    sharding.write_shards(docs, path, shards=3)
    back = spark.read.parquet(path)
    assert back.count() == docs.count() and set(back.columns) == set(docs.columns)


def brute_spans(text):
    out = []
    pattern = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, "assign", m.end()) for m in re.finditer(pattern, text, re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def test_secrets_and_ledger(spark, docs, empty):
    ledger = scratch_folder(spark, "ledger")
    rules = secrets.RULES[:3]
    rows = secrets.findings(docs, ledger, rules).withColumn("s", secrets.joined(F.col("spans"))).collect()
    assert sorted((r.s for r in rows)) == sorted(brute_spans(r.text or "") for r in docs.collect())
    assert secrets.read_ledger(spark, ledger).count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    before = secrets.read_ledger(spark, ledger).count()
    assert secrets.findings(docs.limit(5), ledger, rules).count() == 5
    assert secrets.read_ledger(spark, ledger).count() == before
    newer = (*rules[:2], ("hex", 2, r"[0-9a-f]{30,}", 0, 30))
    secrets.findings(docs, ledger, newer).collect()
    assert secrets.read_ledger(spark, ledger).where("scanned = array('hex@2')").count() == before
    assert secrets.findings(empty, scratch_folder(spark, "ledger")).collect() == []


def test_findings_follow_the_versions_of_the_rules(spark):
    texts = ["a " + "0a" * 12, "b " + "1b" * 16, SECRET, None, "password = hunter22 " + "2c" * 13]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assign, _, short = secrets.RULES[:3]
    long = ("hex", 2, r"[0-9a-f]{30,}", 0, 30)
    ledger = scratch_folder(spark, "ledger")

    def found(rules, ledger):
        rows = secrets.findings(docs, ledger, rules).select("doc_id", secrets.joined(F.col("spans")).alias("s"))
        return sorted(tuple(r) for r in rows.collect())

    scanned = []
    # A newer version, a rule that goes, other rules and orders, and rules that return.
    for rules in ([assign, short], [assign, long], [assign], [short], [long, assign], [assign, short], [assign, short]):
        assert found(rules, ledger) == found(rules, scratch_folder(spark, "ledger"))
        scanned.append(secrets.read_ledger(spark, ledger).count())
    assert scanned == [5, 10, 10, 10, 10, 10, 10]  # known rules read no blob again


def test_redaction(spark, docs):
    rows = secrets.findings(docs, scratch_folder(spark, "ledger")).withColumn("clean", secrets.redacted(F.col("text"), F.col("spans")))
    got = {r.text: r.clean for r in rows.collect()}
    assert got[SECRET] == 'x [REDACTED]" y [REDACTED] z [REDACTED]'  # the closing quote is outside the span
    assert got[None] is None and got["one two"] == "one two"


def brute_quality(text):
    w, seen, covered = re.findall(r"[^\x20\x09-\x0D]+", text), {}, set()
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(j for i in places for j in range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(docs, empty, labels):
    table = quality_rules.ratios(docs, quality_rules.trusted_rows(labels))
    got = quality_rules.rated(docs, table).collect()
    key = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    assert sorted(map(key, got)) == sorted(brute_quality(r.text or "") for r in docs.collect())
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.kept and r.base_failed) for r in got)
    assert quality_rules.rated(empty, quality_rules.ratios(empty, quality_rules.trusted_rows(labels))).collect() == []


def test_quality_score_parts_target_from_other_text(spark):
    rows = [(i, prose(i, 50)) for i in range(40)] + [(100 + i, " ".join(f"junk{i}x{j}" for j in range(50))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality_rules.rated(frame, quality_rules.ratios(frame, quality_rules.trusted_rows(known))).collect()}
    assert min(got[i] for i in range(40)) > max(got[100 + i] for i in range(40))


def test_quality_bound_is_the_rank_of_held_out_texts(spark, docs, empty, labels):
    rows = [(i, prose(i % 20, 50)) for i in range(300)] + [(1000 + i, " ".join(f"junk{i}x{j}" for j in range(50))) for i in range(60)]
    frame = spark.createDataFrame([*rows, (5000, None), (None, prose(3, 50)), rows[0]], "doc_id long, text string")
    known = spark.createDataFrame([(i, 1) for i in [*range(300), 1, 2]] + [(None, 1)], "doc_id long, quality int")
    trusted = quality_rules.trusted_rows(known)
    fitted, held = ([r.doc_id for r in part.collect()] for part in quality_rules.parted(trusted))
    assert sorted(fitted + held) == list(range(300)) and 30 < len(held) < 90
    for loss in (0, 0.2):
        got = quality_rules.judged(frame, trusted, loss).collect()
        places = sorted(math.floor(r.score * 1e6) for r in got if r.doc_id in held and not r.base_failed)
        bound = places[int(loss * len(places))]
        # Copies tie: the rank may fall inside a run of equal scores, which goes or stays whole.
        run = {bound, max([p for p in places if p < bound], default=bound), min([p for p in places if p > bound], default=bound)}
        kept = {math.floor(r.score * 1e6) for r in got if r.kept}
        dropped = {math.floor(r.score * 1e6) for r in got if not r.kept and not r.base_failed}
        assert min(kept) > max(dropped) and min(p for p in places if p in kept) in run
        assert len(got) == len(rows) + 3 and not any(r.kept for r in got if r.base_failed)
        assert not loss or not any(r.kept for r in got if (r.doc_id or 0) >= 1000)
    assert quality_rules.judged(empty, trusted).collect() == []
    nobody = quality_rules.judged(docs, quality_rules.trusted_rows(labels.limit(0))).collect()
    assert all(r.kept != r.base_failed for r in nobody)


def test_every_good_row_is_in_the_target(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"a{i % 7} b c{i % 5}") for i in range(500)], "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(500)] * 2, "doc_id long, quality int")
    assert resampling.target_rows(known).count() == quality_rules.trusted_rows(known).count() == sum(i % 3 > 0 for i in range(500))
    sent = quality_rules.ratios(rows, quality_rules.trusted_rows(known)), resampling.ratios(rows, resampling.target_rows(known))
    for module in (quality_rules, resampling):
        monkeypatch.setattr(module, "sized", lambda table: table.hint("merge"))
    joined = quality_rules.ratios(rows, quality_rules.trusted_rows(known)), resampling.ratios(rows, resampling.target_rows(known))
    assert sent[0] == joined[0] and (sent[1] == joined[1]).all()


def test_many_classes_are_all_sampled(spark):
    rows = spark.range(900).selectExpr("id AS doc_id", "concat('lang', id % 300) AS lang", "id AS sample")
    assert samples.per_class(rows, "lang", "doc_id", 50).select("lang").distinct().count() == 300
    assert samples.per_class(rows, "lang", "doc_id", 50, 4).select("lang").distinct().count() == 4
    assert samples.per_class(rows.selectExpr("doc_id", "string(null) AS lang"), "lang", "doc_id", 50).collect() == []


def test_weight_is_the_log_ratio_of_likelihoods(spark, docs, labels):
    table = resampling.ratios(docs, resampling.target_rows(labels))
    rows = {r.doc_id: r for r in resampling.resampled(spark.createDataFrame([(1, "one two"), (2, "one two one two")], "doc_id long, text string"), table, 1.0).collect()}
    one, two = rows[1], rows[2]
    back = {r.doc_id: r for r in resampling.resampled(spark.createDataFrame([(3, "two one")], "doc_id long, text string"), table, 1.0).collect()}[3]
    words = next(text.chunks([b"one two"]))[1]
    pair = table[int(text.mix(words[:1] * np.uint64(3) + words[1:])[0] >> np.uint64(48))]
    singles = one.log_weight - pair
    assert (one.n_grams, two.n_grams) == (3, 7)
    assert two.log_weight == pytest.approx(2 * singles + 2 * pair + (back.log_weight - singles))


def test_resampling(spark, docs, empty, labels):
    table = resampling.ratios(docs, resampling.target_rows(labels))
    got = resampling.resampled(docs, table, 0.5).collect()
    worded = [r for r in got if r.n_grams > 0]
    kept = [r for r in got if r.kept]
    assert len(got) == docs.count() and all(r.n_grams > 0 for r in kept)
    assert abs(len(kept) - len(worded) / 2) <= 2
    assert min(r.key for r in kept) >= max(r.key for r in worded if not r.kept) - 1e-5
    assert resampling.resampled(empty, table, 0.5).collect() == []


def test_archives(spark):
    big = "<p>" + "x" * 2000
    rows = [(1, "http://a.example.com/x?q=1", big), (2, "http://a.example.com/x?q=1", big), (7, "http://b.example.com/", big), (3, None, None),
            (4, "not a url", ""), (5, "http://[bad", "small"), (6, "http://c.example.com:81/ü", "small"), (None, "http://d.example.com", big), (4, "not a url", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archive.archived(pages).collect()), key=repr)
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        again = len(body) >= 1000 and page != 7
        want.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", 7 if again else None))
    assert got == sorted(want, key=repr)
    assert archive.archived(pages.limit(0)).collect() == []


def test_pages_with_malformed_urls_are_found(spark):
    urls = ["a\tb", "a", "x\ny", "x", "x%0Ay", "\t\t7\t\n", "http://[bad\t1\n2", "http://[bad", "http://b:port\t/x", "http://a.example.com/%09", "\n", "%"]
    rows = [(i, u, f"body {i}") for i, u in enumerate(urls)]
    got = archive.archived(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got) == [(i, b) for i, _, b in rows]
    assert len({archive.surt(u) for u in urls}) == len(urls)


def test_index_lookup_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(archive, "LINES", 7)
    rows = [(i, "http://hot.example.com/" if i % 3 == 0 else f"http://h{i % 11}.example.com/{i}", f"body {i}") for i in range(200)]
    folder = scratch_folder(spark, "archives")
    index = archive.build_index(archive.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), folder))
    wanted = ["http://hot.example.com/", "http://h1.example.com/1", "http://none.example.com/"]
    keys = spark.createDataFrame([(archive.surt(u),) for u in wanted], "key string")
    got = sorted((r.page_id, bytes(r.payload).decode()) for r in archive.read_records(archive.lookup(keys, index), folder).collect())
    assert got == [(i, f"body {i}") for i, u, _ in rows if u in wanted]


def test_languages(spark, empty):
    kinds = {"en": "the cat and the dog walk through this house ", "de": "der Hund und die Katze gehen durch das schöne Haus ", "ru": "кошка и собака идут через этот дом "}
    rows = [(i, " ".join(random.Random(i).sample(t.split(), 6)) + f" {i}", k) for j, (k, t) in enumerate(kinds.items()) for i in range(j * 60, j * 60 + 60)]
    docs = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 34", "en"), (902, "ελληνικά μόνο εδώ", None)], "doc_id long, text string, lang string")
    model = queries.language_model(docs)
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    held = {r.doc_id for r in docs.where(queries.held_out()).collect()}
    assert sum(got[i].lang_pred == k for i, _, k in rows if i in held) >= 0.95 * sum(i in held for i, *_ in rows)
    assert all(not got[i].rejected and 0 <= got[i].score <= 1 for i, *_ in rows)
    assert [(got[i].lang_pred, got[i].score, got[i].rejected) for i in (900, 901)] == [("und", 0.0, True)] * 2
    assert got[902].rejected
    assert language.predict(empty, language.fit(empty)).collect() == []
    nothing = language.predict(docs, language.fit(empty)).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_toxicity(spark, empty, labels):
    rows = [(i, prose(i, 30) + (" you awful scoundrel" + " villain" * (i % 5) if i % 4 == 0 else " hello")) for i in range(400)]
    docs = spark.createDataFrame([*rows, (1000, None), (1001, "")], "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, known)).collect()}
    assert all(got[i].toxic == (i % 4 == 0) for i in range(300, 400))
    assert all(0 <= r.severity <= 3 for r in got.values()) and got[1000].severity == got[1001].severity == 0
    assert toxicity.score(empty, toxicity.fit(empty, labels)).collect() == []


@pytest.mark.parametrize("n", [80, 800])
def test_toxic_words_are_found_in_small_and_larger_samples(spark, n):
    rows = [(i, prose(i, 30) + (" scoundrel villain" if i % 8 == 0 else " hello")) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(n // 2)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, known)).collect()}
    assert all(got[i].toxic == (i % 8 == 0) for i in range(n // 2, n))


def test_words_of_a_copied_toxic_text_are_no_markers(spark):
    copied = prose(7000, 60)
    rows = [(i, prose(i, 30) + (" scoundrel villain"[: 10 if i % 16 else 18] if i % 8 == 0 else " hello")) for i in range(800)]
    rows += [(1000 + i, f"{copied} n{'abcdefghij'[i % 10]}{'klmn'[i % 4]} scoundrel") for i in range(20)]
    docs = spark.createDataFrame([*rows, (2000, copied)], "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 8 == 0 or i >= 1000)) for i, _ in rows], "doc_id long, toxic int")
    got = {r.doc_id: r.toxic for r in toxicity.score(docs, toxicity.fit(docs, known)).collect()}
    assert not got[2000] and all(got[i] == (i % 8 == 0 or i >= 1000) for i, _ in rows)


def test_without_a_toxic_word_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(i, prose(i % 10, 30)) for i in range(40)], "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i // 10 == 1)) for i in range(40)], "doc_id long, toxic int")
    assert all(r.severity < 0.001 and not r.toxic for r in toxicity.score(docs, toxicity.fit(docs, known)).collect())


def test_decontamination(spark, empty):
    items = [(i, prose(100 + i, 30)) for i in range(20)] + [(20, prose(300, 150)), (21, None), (22, "")]
    words = items[3][1].split()
    words[4], words[17] = "other", "words"
    docs = [(i, prose(500 + i, 100)) for i in range(60)]
    docs += [(100, f"{prose(1, 40)} {items[2][1].upper()}. {prose(2, 40)}"), (101, f"{prose(3, 200)} {' '.join(words)} {prose(4, 9)}"),
             (102, f"{prose(5, 30)}\n{items[20][1]}"), (103, None), (104, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame, bench).collect()}
    assert got == {(100, 2), (101, 3), (102, 20)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame, bench, block=7).collect()} == got
    common = spark.createDataFrame([(1, "of the and to it")], "item_id long, text string")
    plain = spark.createDataFrame([(i, f"it to and {i}") for i in range(50)] + [(77, "so of the and to it is")], "doc_id long, text string")
    assert {r.doc_id for r in decontaminate.contaminated(plain, common).collect()} == {77}
    assert decontaminate.contaminated(empty, bench).collect() == decontaminate.contaminated(frame, bench.limit(0)).collect() == []


def test_bpe_round_trip(docs, empty):
    import numpy as np
    import tiktoken

    path = public_tokenizers.path(queries.TOKENIZER)
    table = bpe.ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    # With few common words, most are folded on arrays; with all of them, in Spark SQL.
    for words in (5, 100_000):
        part = docs if words == 5 else docs.where("doc_id < 12")
        for r in bpe.encoded(part, path, public_tokenizers.PATTERN, ["doc_id", "text"], words).collect():
            want = library.encode_ordinary(r.text or "")
            assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
            assert r.ids_sha256 == hashlib.sha256(bytes(r.ids)).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.encoded(empty, path, public_tokenizers.PATTERN).collect() == []


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, folder)
        assert after.columns == docs.columns, name
        kept = corpus_pipeline.written(after, name)
    ids = {r.doc_id for r in kept.collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [" ".join(re.findall(r"[^\W\d_]+", r.text.lower())) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    lowest = {d for d, _, c in brute_components(rows) if d == c}
    leaked = {d for d, t in rows if any(i in " ".join(re.findall(r"[^\W\d_]+", (t or "").lower())) for i in items)}
    assert ids == lowest - leaked
    assert all(brute_spans(r.text) == "" for r in kept.collect())
    tokens = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.STAGES[-1][1](spark, kept, folder).collect()}
    assert tokens == {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in kept.collect()}


def test_passages_that_chain_unlinked_texts_make_no_links(spark):
    one, two = prose(71, 60), prose(72, 60)
    rows = [(i, f"{prose(2000 + i, 25)} {(one, two, one + ' ' + two)[i % 3]} {prose(3000 + i, 25)}") for i in range(150)]
    rows += [(900, rows[4][1]), (901, rows[7][1].replace(rows[7][1].split()[0], "changed", 1))]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows)


def test_rows_get_their_own_class(spark, docs):
    got = near_dedup.with_class(docs.select("doc_id", "text")).collect()
    want = {(r.doc_id, r["class"]) for r in near_dedup.near_duplicates(docs).collect()}
    assert {(r.doc_id, r["class"]) for r in got} == want and len(got) == docs.count()
