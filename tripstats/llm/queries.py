"""The thin registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dartminhash, debruijn, fingerprint, infilling, kdtree, lattice, linededup, mixing, packing, quality, resampling, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file (the operators take the path as a parameter)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(_table(spark, sf_dir, "pages"))


def op2_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_fingerprints(_table(spark, sf_dir, "documents"))


def op3_pack_by_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"
    )


def op5_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_dartminhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_digests(_table(spark, sf_dir, "documents"))


def op8_mixing_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op9_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = toxicity.held_out_fold(F.col("doc_id"), 7, 2)
    return lattice.score_texts(_table(spark, sf_dir, "documents"), held_out, vocabulary("piece_bpe_32k.model"))


def op10_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.removal_digests(_table(spark, sf_dir, "documents"))


def op11_counted_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infilling.infill_digests(_table(spark, sf_dir, "documents"))


def op12_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.kd_shards(_table(spark, sf_dir, "documents"))


def op13_bracketed_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resampling.draws(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_multiset_fingerprint": op2_multiset_fingerprint,
        "op3_pack_by_histogram": op3_pack_by_histogram,
        "op4_weak_supervision": op4_weak_supervision,
        "op5_toxicity_cnn": op5_toxicity_cnn,
        "op6_dartminhash_classes": op6_dartminhash_classes,
        "op7_line_dedup": op7_line_dedup,
        "op8_mixing_budgets": op8_mixing_budgets,
        "op9_lattice_likelihood": op9_lattice_likelihood,
        "op10_debruijn_dedup": op10_debruijn_dedup,
        "op11_counted_infilling": op11_counted_infilling,
        "op12_kd_tree_shards": op12_kd_tree_shards,
        "op13_bracketed_resampling": op13_bracketed_resampling,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": OP1_SQL,
        "op7_line_dedup": OP7_SQL,
        "op8_mixing_budgets": mixing.mixture_sql(),
        "op11_counted_infilling": infilling.INFILL_SQL,
        "op12_kd_tree_shards": kdtree.kd_shards_sql(),
        "op13_bracketed_resampling": resampling.DRAW_SQL,
    }


OP1_SQL = """
WITH p AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, url, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1
)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first_id <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id <> d.page_id THEN f.first_id END AS refers_to,
       d.url AS target_uri
FROM d LEFT JOIN f USING (payload_digest)
"""

OP7_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(list) AS line, generate_subscripts(list, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS list FROM documents)
), keyed AS (
  SELECT doc_id, line, pos,
         translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.doc_id, k.line, k.pos, c.top IS NOT NULL AND k.doc_id <> c.top AS dropped
  FROM keyed k LEFT JOIN common c ON k.key = c.key AND length(k.key) >= 20
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
