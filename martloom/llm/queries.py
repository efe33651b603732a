"""Named queries of the text operators over whole tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import decontaminate, exact_dedup, hard_negatives, jaccard_join, licenses, merkle, mixing, near_dedup, pii, quality, repeat_dedup, token_files, warc
from martloom.llm.common import table
from martloom.session import new_path

# A public vocabulary of byte pairs for many languages, and the number free for separators.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
SEPARATOR = 50_256


def op1_token_counts(spark: SparkSession, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    from public_tokenizers import PATTERN

    out = new_path(spark, "token-files")
    return token_files.token_counts(table(spark, folder, "documents"), out, vocabulary, PATTERN, SEPARATOR)


def op2_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents")).drop("k1", "k2")


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    out = new_path(spark, "warc")
    warc.write_warc(table(spark, folder, "pages"), out)
    return warc.read_warc(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("k1", "k2")


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.license_scan(table(spark, folder, "documents"), templates=licenses.ALL_TEMPLATES, families=licenses.FAMILIES)
    return found.select(
        "doc_id",
        F.size("found").cast("long").alias("n_licenses"),
        F.array_join(F.transform("found", lambda x: x["license"]), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["part"])), F.lit(0.0)).alias("best_part"),
    )


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.personal_data(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[f"n_{kind}" for kind in pii.KINDS],
        F.sha2(pii.spelled("base_spans"), 256).alias("base_sha256"),
        pii.spelled("all_spans").alias("spans"),
    )


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.classify(docs, table(spark, folder, "labels"))


def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeat_dedup.remove_repeats(table(spark, folder, "documents"))


def op11_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, folder, "documents"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    found = merkle.manifest(table(spark, folder, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"))


OP3_SQL = r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), grouped AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id
  FROM bare
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM grouped
"""

OP4_SQL = """
WITH records AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), named AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM records
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM named
"""

OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), c AS (
  SELECT vec_id, unnest(range(len(embedding))) AS i,
         unnest(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS x
  FROM v
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS cand_id, sum(a.x * b.x) AS score
  FROM c AS a JOIN c AS b ON a.i = b.i
  WHERE a.vec_id % 100 = 0
  GROUP BY a.vec_id, b.vec_id
), labelled AS (
  SELECT s.*, la.label AS anchor_label, lb.label AS cand_label
  FROM s JOIN v AS la ON la.vec_id = s.anchor_id JOIN v AS lb ON lb.vec_id = s.cand_id
), pos AS (
  SELECT anchor_id, cand_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, cand_id) AS k
        FROM labelled WHERE cand_label = anchor_label AND cand_id <> anchor_id)
  WHERE k <= 5
), neg AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, l.cand_id AS negative_id, l.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY l.score DESC, l.cand_id) AS r
  FROM pos AS p JOIN labelled AS l ON l.anchor_id = p.anchor_id
  WHERE l.cand_label <> l.anchor_label
    AND 30 * p.positive_score <= 100 * l.score AND 100 * l.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM neg WHERE r <= 10
"""

QUERIES = {
    "op1_token_counts": (op1_token_counts, None),
    "op2_minhash_near_dedup": (op2_minhash_near_dedup, None),
    "op3_exact_dedup": (op3_exact_dedup, OP3_SQL),
    "op4_warc": (op4_warc, OP4_SQL),
    "op5_benchmark_decontamination": (op5_benchmark_decontamination, None),
    "op6_mixing": (op6_mixing, None),
    "op7_license_scan": (op7_license_scan, None),
    "op8_pii": (op8_pii, None),
    "op9_quality_classifier": (op9_quality_classifier, None),
    "op10_suffix_array_dedup": (op10_suffix_array_dedup, None),
    # components of a similarity join: tested against all pairs
    "op11_ngram_jaccard_join": (op11_ngram_jaccard_join, None),
    # levels of hashes over ordered pairs: tested against a direct computation
    "op12_merkle_manifest": (op12_merkle_manifest, None),
    "op13_hard_negatives": (op13_hard_negatives, OP13_SQL),
}
