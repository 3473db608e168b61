"""A training corpus from the table documents, in five stages.

Each stage takes (spark, docs, sf_dir), calls one operator of sparkbook.llm on
all that the stage before it kept, and returns a DataFrame; ``run`` writes it as
Parquet in the shared folder and reads it again for the next stage. All stages but
the last return the columns of documents; the last returns one row per packed
piece. Null texts have no language and go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkbook.llm import langid, line_dedup, mixing, packing, simhash
from sparkbook.llm.common import documents, saved


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected; the model learns from the documents given."""
    return langid.accepted(docs, langid.train(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the three-line windows that occurred before."""
    return line_dedup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: four-word shingles, at most four bits apart."""
    return simhash.one_of_each(docs, shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their target weights."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: document, ids covered, sequence and offset."""
    return packing.pack(docs).drop("ids")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Learned language identification and tokenisation are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
