"""Corpus pipeline: language ID, near-duplicates, personal data, mixing and packing, in that order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provenir.llm import jaccard, language, mixing, packing, pii
from provenir.llm.common import staged
from provenir.llm.queries import tokenizer_path

LEAST_SHARE = 0.5


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that makes up half of the text or more; a missing `lang` is filled in.

    Null texts and texts without a letter go, and so does everything if no row has a `lang` to learn from. Very long texts
    are read whole; equal proportions go to the first language by name; repeated rows and rows without doc_id are judged
    each; other columns pass, whatever their names; an empty table gives no rows.
    """
    rest = F.struct(*(c for c in docs.columns if c != "text")).alias("row")
    found = language.identify(docs.select("doc_id", "text", "lang", rest), carried=["text", "row"])
    kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    named = kept.select("text", F.col("row").withField("lang", F.coalesce("row.lang", "lang_pred")).alias("row"))
    return named.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest doc_id. Texts without a word stay.

    A group is made of rows: those that repeat a doc_id, share one with another text, or have none are members by their
    text like any other. A row without doc_id is taken if no member has one; of repeated rows that with the smallest hash.
    Null texts stay too, repeated ones each. Very long texts are compared whole; ties go by the hash of doc_id and text; other
    columns pass, whatever their names; an empty table gives no rows.
    """
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("id"), F.struct(*docs.columns).alias("row"))
    linked = jaccard.jaccard_components(keyed.select(F.col("id").alias("doc_id"), "row.text"), size=5, percent=80)
    members = staged(linked.filter("n_shingles > 0").groupBy(F.col("doc_id").alias("id")).agg(F.first("component_id").alias("group"), F.count("*").alias("n")), "members")
    named = members.join(keyed.select("id", "row.doc_id").distinct(), "id")
    first = F.min_by("id", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "id")).alias("id")
    picked = staged(named.groupBy("group").agg(first).select("id"), "picked")
    kept = keyed.join(members.join(picked, "id", "left_anti").select("id"), "id", "left_anti")
    repeated = members.filter("n > 1").join(picked, "id", "left_semi").select("id")
    if repeated.isEmpty():
        return kept.select("row.*")
    one = kept.join(repeated, "id", "left_semi").groupBy("id").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return kept.join(repeated, "id", "left_anti").select("row.*").unionByName(one.select("row.*"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates; n_chars follows where a text has changed.

    Every row stays. Null and empty texts stay as they are, very long ones are read whole, repeated rows are changed
    alike, and values that two entities drew go to the first of them; other columns pass, whatever their names; an empty table
    gives no rows.
    """
    made = pii.pseudonymise(docs)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.when(F.col("n_replaced") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return made.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, up to three copies.

    Null and blank texts have no word to take and go, as do texts of which nothing is taken. A null source is a source. Very
    long texts are cut like any other; repeated rows are documents of their own; ties of order go by hash; other columns
    pass, whatever their names; an empty table gives no rows.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens: the columns of the packing query, not of documents.

    Null and empty texts are the end id alone, very long ones as many pieces as they need; repeated rows are packed each, ties
    go by hash; other columns are left out; an empty table gives no rows.
    """
    return packing.pack(docs, tokenizer_path(), 2048, 1, payload="crc32")


STAGES = [
    ("language", keep_known_language),
    ("jaccard", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned models and token ids are beyond SQL; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
