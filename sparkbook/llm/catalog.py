"""The queries of this subpackage, by name, with DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkbook.llm import exact_dedup, filter_audit, langid, line_dedup, lm, merkle, mixing, ordinal, packing, pii, quality_rules, simhash, substring_dedup
from sparkbook.llm.common import documents


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens, one row per piece."""
    return packing.pack(documents(spark, sf_dir)).drop("ids")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.personal_data(documents(spark, sf_dir))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add-0.1 unigram base and trigram trie score of every document."""
    return lm.scores(documents(spark, sf_dir), order=3)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    mixed = mixing.copies(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=4, max_bits=4)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality_rules.quality_report(documents(spark, sf_dir))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document."""
    docs = documents(spark, sf_dir)
    model = ordinal.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ordinal.graded_quality(docs, model)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that occurred before."""
    return line_dedup.line_report(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = documents(spark, sf_dir)
    found = langid.identify(docs, langid.train(docs))
    held_out = F.coalesce(langid.fold() == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 13-word passages of documents with a smaller doc_id."""
    return substring_dedup.substring_report(documents(spark, sf_dir))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes at each step of every order, per source."""
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verdict of every document in the table's Merkle tree."""
    return merkle.manifest_report(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing, op2_pii, op3_lm_scoring, op4_mixing, op5_simhash, op6_quality_rules, op7_quality_classifier,
        op8_exact_dedup, op9_line_dedup, op10_language_id, op11_substring_dedup, op12_filter_audit, op13_merkle_manifest,
    )
}
SQL = {
    "op4_mixing": mixing.SQL, "op6_quality_rules": quality_rules.SQL, "op8_exact_dedup": exact_dedup.SQL, "op9_line_dedup": line_dedup.SQL,
    "op11_substring_dedup": substring_dedup.SQL, "op12_filter_audit": filter_audit.SQL, "op13_merkle_manifest": merkle.SQL,
}
