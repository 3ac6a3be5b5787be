"""Queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .licenses import oracle as license_sql


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_multi_index_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedindex import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "embeddings"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_read(spark, sf_dir, "documents"))


def op3_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import decontaminate

    out = decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return out.drop("hit_spans", "items")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"))


def op5_paragraph_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .paragraphs import dedup

    return dedup(_read(spark, sf_dir, "documents"))


def op6_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, score

    docs = _read(spark, sf_dir, "documents")
    out = score(docs, fit(docs, _read(spark, sf_dir, "labels")))
    return out.withColumn("n_offending", F.size("offending")).drop("offending")


def op7_forest_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secretscan import fit, scan

    return scan(_read(spark, sf_dir, "documents"), fit())


def op8_suffix_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixdedup import dedup

    return dedup(_read(spark, sf_dir, "documents"))


def op9_canonical_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    return scan(_read(spark, sf_dir, "documents"))


def op10_recurrent_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .htmltext import extract

    return extract(_read(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_multi_index_near_dedup,
        op2_best_fit_packing,
        op3_winnowing_decontamination,
        op4_simhash_near_dedup,
        op5_paragraph_minhash_dedup,
        op6_noisy_or_toxicity,
        op7_forest_secret_scan,
        op8_suffix_sort_dedup,
        op9_canonical_license_scan,
        op10_recurrent_html_extraction,
    )
}

# All pairs of vectors, and the least vector that links reach.
_OP1 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
valid AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS w FROM valid a JOIN valid b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS u, vec_id AS w FROM v UNION SELECT reach.u, links.w FROM reach JOIN links ON links.u = reach.w),
least AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN least ON least.u = vec_id LEFT JOIN counts ON counts.u = vec_id
"""

# Every window of every text, joined by its words.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP3 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i, w FROM b WHERE len(w) > 0),
items AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM bw),
sizes AS (SELECT DISTINCT n FROM items),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, dw.n, i, item FROM dw JOIN items ON items.n = dw.n AND items.k = dw.k),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SQL: dict[str, str] = {"op1_multi_index_near_dedup": _OP1, "op3_winnowing_decontamination": _OP3, "op9_canonical_license_scan": license_sql()}
