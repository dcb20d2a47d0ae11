"""The operators' queries over the given tables, and SQL of the same meaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import (
    compression,
    language,
    lm,
    lsh_forest,
    mixing,
    packing,
    quality,
    spelling,
    toxicity,
    url_templates,
    vafile,
    vectors,
    warc,
)
from tradelake.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_near_vectors(spark, sf_dir):
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_pack_sequences(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_compression_bands(spark, sf_dir):
    found = compression.compression_rules(table(spark, sf_dir, "documents"))
    return found.drop("ratio", "bad_chunks")


def op4_warc_archives(spark, sf_dir):
    return warc.pages_through_archives(table(spark, sf_dir, "pages")).drop("error")


def op5_identify_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


def op6_score_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        "predicted",
    )


def op7_cross_entropy_difference(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = lm.score(docs, table(spark, sf_dir, "labels"))
    return found.select("row.doc_id", "n_words", "target_loss", "background_loss", "difference")


def op8_url_templates(spark, sf_dir):
    found = url_templates.judge(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "host", "path", "rule", "template", "verdict")


def op9_mix_sources(spark, sf_dir):
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(
        "row.doc_id", "size", "source_size", "target", "taken", "first_slot"
    )


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
    CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first < page_id THEN first END AS refers_to FROM f"""


def op10_jaccard_join(spark, sf_dir):
    found = lsh_forest.jaccard_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_text_links")


def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_score_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        F.col("toxic_score").alias("score"),
        "predicted",
    )


def op13_centroid_clusters(spark, sf_dir):
    return vafile.clusters(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_near_vectors": op1_near_vectors,
        "op2_pack_sequences": op2_pack_sequences,
        "op3_compression_bands": op3_compression_bands,
        "op4_warc_archives": op4_warc_archives,
        "op5_identify_language": op5_identify_language,
        "op6_score_quality": op6_score_quality,
        "op7_cross_entropy_difference": op7_cross_entropy_difference,
        "op8_url_templates": op8_url_templates,
        "op9_mix_sources": op9_mix_sources,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_score_toxicity": op12_score_toxicity,
        "op13_centroid_clusters": op13_centroid_clusters,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc_archives": WARC_SQL,
        "op8_url_templates": url_templates.oracle_sql(),
        "op9_mix_sources": mixing.ORACLE_SQL,
        "op13_centroid_clusters": vafile.oracle_sql(),
    }
