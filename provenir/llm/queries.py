"""The operators applied to their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import clusters, embeddings, jaccard, language, licenses, mixing, nearest, packing, pii, quality_model, quality_rules, spelling, warc
from .common import documents, learnable
from .oracles import ORACLES  # noqa: F401


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path(), 2048, 1, payload="crc32")
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(documents(spark, sf_dir, "doc_id", "text", "lang", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    told, _ = mixing.mix(documents(spark, sf_dir, "doc_id", "text", "source"))
    return told.select("doc_id", "size", "source_size", "target", "taken")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(documents(spark, sf_dir, "doc_id", "text", "lang"))
    return found.select("doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(documents(spark, sf_dir, "doc_id", "text"), size=5, percent=80)
    return found.select("doc_id", "n_shingles", "component_id")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(documents(spark, sf_dir, "doc_id", "text"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.93)
    return found.select("vec_id", "n_links", "component_id", "kept")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_model.classify(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, neighbours=20)
    return found.select("query_id", "rank", "vec_id", "score")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), clusters=40, rounds=5)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_packing, op2_quality_rules, op3_mixing, op4_warc, op5_language, op6_jaccard, op7_pii, op8_embeddings, op9_licenses, op10_quality_model, op11_nearest, op12_spelling, op13_clusters)
}
