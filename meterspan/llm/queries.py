"""One query for each operator, over its whole table, and SQL where SQL can say it."""

import public_tokenizers
from pyspark.sql import functions as F

from meterspan.llm import (
    archive,
    bpe,
    conversations,
    decontaminate,
    language,
    near_dedup,
    quality_rules,
    resampling,
    secrets,
    sharding,
    simhash,
    toxicity,
    whitening,
)
from meterspan.session import scratch_folder

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
SHARDS = 40
#: Share of the texts that importance resampling keeps.
SHARE = 0.9


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_kd_tree_shards(spark, folder):
    rows = sharding.sharded(_table(spark, folder, "documents").select("doc_id", "text"), shards=SHARDS)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_chosen_path_dedup(spark, folder):
    rows = near_dedup.near_duplicates(_table(spark, folder, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op3_latent_decontamination(spark, folder):
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op4_blob_ledger_secrets(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    rows = secrets.findings(docs, scratch_folder(spark, "secret-ledger"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *(number(kind) for kind in secrets.BASE),
        F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op5_likelihood_ratio_rules(spark, folder):
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return quality_rules.judged(docs, quality_rules.trusted_rows(labels))


def op6_capture_index(spark, folder):
    return archive.archived(_table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_importance_resampling(spark, folder):
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    table = resampling.ratios(docs, resampling.target_rows(labels))
    return resampling.resampled(docs, table, SHARE)


def held_out():
    """Rows that a language model must not learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_model(docs):
    return language.fit(docs.where(F.col("doc_id").isNotNull() & ~held_out()))


def op8_nearest_centroids(spark, folder):
    docs = _table(spark, folder, "documents")
    rows = language.predict(docs, language_model(docs))
    return rows.withColumn("held_out", held_out())


def op9_ordinal_toxicity(spark, folder):
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return toxicity.score(docs, toxicity.fit(docs, labels))


def op10_byte_bpe(spark, folder):
    docs = _table(spark, folder, "documents")
    rows = bpe.encoded(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)
    return rows.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_segment_popcount_simhash(spark, folder):
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op12_incremental_whitening(spark, folder):
    rows = _table(spark, folder, "embeddings")
    return whitening.whitened(rows, whitening.fit(rows))


def op13_conversation_repair(spark, folder):
    return conversations.repaired(_table(spark, folder, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_kd_tree_shards,
        op2_chosen_path_dedup,
        op3_latent_decontamination,
        op4_blob_ledger_secrets,
        op5_likelihood_ratio_rules,
        op6_capture_index,
        op7_importance_resampling,
        op8_nearest_centroids,
        op9_ordinal_toxicity,
        op10_byte_bpe,
        op11_segment_popcount_simhash,
        op12_incremental_whitening,
        op13_conversation_repair,
    )
}


def _spans_sql(kind, place, pattern, group, least):
    pattern = pattern.replace("'", "''")
    return f"""
      SELECT doc_id, '{kind}' AS kind, {place} AS place, a, a + m AS b FROM (
        SELECT doc_id, unnest(list_transform(range(1, len(ms) + 1), lambda i:
            coalesce(list_sum(list_transform(ps[1:i], lambda x: length(x))), 0)
            + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0))) AS a,
          unnest(list_transform(ms, lambda x: length(x))) AS m,
          unnest(list_transform(gs, lambda x: length(x))) AS g
        FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS gs,
              string_split_regex(t, '{pattern}') AS ps
              FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)))
      WHERE g >= {least}"""


SQL = {
    "op2_chosen_path_dedup": r"""
      WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
      s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS sh FROM w),
      n AS (SELECT doc_id, len(sh) AS n FROM s),
      e AS (SELECT doc_id, unnest(sh) AS g FROM s),
      k AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
      l AS (SELECT x, y FROM k JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
      r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.c = l.x)
      SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, min(c) AS component_id, doc_id = min(c) AS kept
      FROM r JOIN n USING (doc_id) GROUP BY doc_id, n""",
    "op4_blob_ledger_secrets": f"""
      WITH found AS ({" UNION ALL ".join(_spans_sql(r[0], i, *r[2:]) for i, r in enumerate(secrets.RULES))}),
      f AS (SELECT doc_id,
          CAST(count(*) FILTER (kind = 'assign') AS BIGINT) AS n_assign, CAST(count(*) FILTER (kind = 'access') AS BIGINT) AS n_access,
          CAST(count(*) FILTER (kind = 'hex') AS BIGINT) AS n_hex,
          string_agg(concat(kind, ':', a, ':', b), ',' ORDER BY a, place) FILTER (place < 3) AS base,
          string_agg(concat(kind, ':', a, ':', b), ',' ORDER BY a, place) AS spans
        FROM (SELECT doc_id, kind, place, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM found) GROUP BY doc_id)
      SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
      FROM documents LEFT JOIN f USING (doc_id)""",
    "op6_capture_index": f"""
      WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
      m AS (SELECT h, max(page_id) AS largest FROM p WHERE n >= {archive.SHARED} GROUP BY h)
      SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
        CASE WHEN largest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN largest <> page_id THEN largest END AS refers_to
      FROM p LEFT JOIN m ON m.h = p.h AND p.n >= {archive.SHARED}""",
}
