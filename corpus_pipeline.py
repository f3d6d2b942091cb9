"""The corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet
and read again as the next stage's docs. All but the last return the columns of docs."""

import public_tokenizers
from pyspark.sql import functions as F

from meterspan.llm import bpe, decontaminate, language, near_dedup, queries, secrets
from meterspan.llm.samples import sized
from meterspan.session import scratch_folder, written


def language_id(spark, docs, sf_dir):
    """Drops texts that are rejected: null, without a letter, or far from every language."""
    model = queries.language_model(docs)
    plain = docs.select("text", *(F.col(f"`{c}`").alias(f"column_{i}") for i, c in enumerate(docs.columns)))
    rows = language.predict(plain, model, [f"column_{i}" for i in range(len(docs.columns))]).where("not rejected")
    return rows.select(*(F.col(f"column_{i}").alias(c) for i, c in enumerate(docs.columns)))


def near_dedup_stage(spark, docs, sf_dir):
    """Keeps the document with the smallest doc_id of each group of near duplicates. Rows
    that share a doc_id and differ in their text are told apart by the text's class."""
    found = near_dedup.near_duplicates(docs).select(F.col("doc_id").alias("kept_id"), "class", "kept")
    found = written(found.groupBy("kept_id", "class").agg(F.max("kept").alias("kept")), "near-dedup-found")
    ids = written(found.groupBy("kept_id").agg(F.min("kept").alias("every"), F.max("kept").alias("some")), "near-dedup-ids")
    whole = sized(ids.where("every").select("kept_id"))
    kept = docs.join(whole, docs["doc_id"].eqNullSafe(whole["kept_id"]), "left_semi")
    mixed = written(ids.where("some and not every").select("kept_id"), "near-dedup-mixed")
    if mixed.isEmpty():
        return kept
    names = docs.columns
    of_mixed = docs.join(sized(mixed), docs["doc_id"].eqNullSafe(mixed["kept_id"]), "left_semi")
    plain = of_mixed.select("doc_id", "text", *(F.col(f"`{c}`").alias(f"column_{i}") for i, c in enumerate(names)))
    right = found.where("kept").select("kept_id", F.col("class").alias("kept_class"))
    classed = near_dedup.with_class(plain)
    same = classed["doc_id"].eqNullSafe(right["kept_id"]) & classed["class"].eqNullSafe(right["kept_class"])
    rest = classed.join(right, same, "left_semi")
    return kept.unionByName(rest.select(*(F.col(f"column_{i}").alias(c) for i, c in enumerate(names))))


def decontamination(spark, docs, sf_dir):
    """Drops documents that hold an item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contaminated(docs, benchmark).select(F.col("doc_id").alias("found_id")).distinct()
    found = sized(written(found, "contaminated-ids"))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["found_id"]), "left_anti")


def secret_scan(spark, docs, sf_dir):
    """Masks secrets in the text; n_chars follows the text."""
    names = docs.columns
    plain = docs.select("text", *(F.col(f"`{c}`").alias(f"column_{i}") for i, c in enumerate(names)))
    rows = secrets.findings(plain, scratch_folder(spark, "secret-ledger"))
    body = secrets.redacted(F.col("text"), F.col("spans"))
    changed = {"text": body, "n_chars": F.when(F.size("spans") > 0, F.length(body).cast("long"))}
    return rows.select(
        *(
            (body if c == "text" else F.coalesce(changed[c], f"column_{i}") if c in changed else F.col(f"column_{i}")).alias(c)
            for i, c in enumerate(names)
        )
    )


def tokens(spark, docs, sf_dir):
    """Token ids of every text: doc_id, n_tokens, ids, and digests of ids and decoded text."""
    return bpe.encoded(docs, public_tokenizers.path(queries.TOKENIZER), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", tokens),
]

#: Shared minwise tokens, centroids and tokens are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
