"""The operators of this subpackage as registered queries, with SQL twins where SQL can express them."""

from __future__ import annotations

import secrets

import public_tokenizers

from pyspark.sql import functions as F

from ferret.llm import (decontaminate, id_store, jaccard_join, line_alignment, packing, periodic_runs, piece_codec, pii,
                        quality_rules, secret_scan, suffix_dedup, vector_codes, warc)
from ferret.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
PII_KEY = "ferret.pii.key"  # set it to a secret; else a session draws its own


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


@query
def op7_secret_scan(spark, sf_dir):
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


@query
def op8_token_id_store(spark, sf_dir):
    return id_store.store_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER))


@query
def op10_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE["op10_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
pos AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {quality_rules.WINDOW - 2})) AS i FROM w WHERE len(ws) >= {quality_rules.WINDOW}),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + {quality_rules.WINDOW - 1}], ' ') AS s FROM pos),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range({quality_rules.WINDOW}) r(k) WHERE twice.n > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, host, t, trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g')) AS line
          FROM (SELECT doc_id, host, t, unnest(ls) AS l FROM w)),
hosts AS (SELECT host, count(DISTINCT t) AS host_docs FROM d GROUP BY host),
often AS (SELECT l.host, line, arg_min(t, doc_id) AS holder FROM lines l JOIN hosts h ON l.host IS NOT DISTINCT FROM h.host GROUP BY l.host, line
          HAVING count(DISTINCT t) >= {quality_rules.LEAST_DOCS} AND (count(DISTINCT t) > {quality_rules.LINE_SHARE} * any_value(host_docs)
            OR count(DISTINCT t) > {quality_rules.MOST_DOCS})),
lost AS (SELECT doc_id, sum(len(string_split(l.line, ' '))) AS n FROM lines l JOIN often o
         ON l.host IS NOT DISTINCT FROM o.host AND l.line = o.line AND l.t <> o.holder GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - list_unique(ls) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        len(ws) - coalesce(lost.n, 0) AS n_left
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id LEFT JOIN lost ON lost.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words)
    AND n_left >= {quality_rules.LEAST_WORDS} AND n_left >= {quality_rules.LEAST_KEPT} * n_words AS kept
FROM m
"""


@query
def op4_warc_segments(spark, sf_dir):
    return warc.write_and_read(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")


ORACLE["op4_warc_segments"] = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS f FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= {warc.REVISIT_BYTES} AND page_id < f THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {warc.REVISIT_BYTES} AND page_id < f THEN f END AS refers_to, CAST(NULL AS VARCHAR) AS problem
FROM q
"""


@query
def op3_decontaminate(spark, sf_dir):
    return decontaminate.overlapping_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


@query
def op6_line_alignment(spark, sf_dir):
    out = line_alignment.delete_blocks(table(spark, sf_dir, "documents"), every_run=True)
    return out.select("doc_id", "line_report.*", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op9_jaccard_join(spark, sf_dir):
    return jaccard_join.join_components(table(spark, sf_dir, "documents"))


@query
def op5_feistel_pseudonyms(spark, sf_dir):
    key = spark.conf.get(PII_KEY, None)
    if not key:  # pseudonyms of two sessions are linked only if both are given the same key
        key = secrets.token_hex(32)
        spark.conf.set(PII_KEY, key)
    out = pii.pseudonymise(table(spark, sf_dir, "documents"), key=key)
    return out.select("doc_id", "text", *[F.col("pii_counts")[k].alias(f"n_{k}") for k in pii.KINDS])


@query
def op2_suffix_dedup(spark, sf_dir):
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")


@query
def op11_vector_codes(spark, sf_dir):
    codes = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    out = vector_codes.with_label_error(codes.rows).withColumnRenamed("key", "vec_id")
    return out.select("vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


@query
def op12_piece_codec(spark, sf_dir):
    return piece_codec.describe_codes(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


@query
def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.describe_runs(table(spark, sf_dir, "documents"), plant=True)
