"""The ranks of a vocabulary are data of the fold in Spark SQL, not a part of its plan."""

from itertools import product

from meterspan.llm import bpe

LETTERS = b"abcdefgh"


def vocabulary():
    pieces = [bytes([i]) for i in range(256)]
    return {p: i for i, p in enumerate(pieces + [bytes(p) for n in (2, 3, 4) for p in product(LETTERS, repeat=n)])}


def test_ranks_are_not_spelt_out_in_the_plan(spark):
    """Before, the plan held them as a literal, and the driver every text of the plan."""
    words = spark.createDataFrame([(w,) for w in ("abcdefgh", "hgfabcde", "x", "añb", "aabbccddz")], "word string")
    table = vocabulary()
    coded = bpe.encode_words(words, table)
    got = {r.word: r.ids for r in coded.collect()}
    asked = list(got)
    assert len(got) == words.count()
    assert [got[w] for w in asked] == [x.tolist() for x in bpe.Merges(table).encode([w.encode() for w in asked])]
    assert len(coded._jdf.queryExecution().toString()) < 50_000


def test_a_corpus_without_words(spark):
    words = spark.createDataFrame([], "word string")
    assert bpe.encode_words(words, vocabulary()).toArrow().num_rows == 0
