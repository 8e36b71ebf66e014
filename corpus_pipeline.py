"""The corpus pipeline: documents -> language ID -> exact dedup -> MinHash
near-dedup -> mix -> token ids. Each stage works on all its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm.bpe import bpe_encode, vocabulary_path
from souk.llm.common import materialise, row_struct
from souk.llm.exact_dedup import drop_copies
from souk.llm.language_id import labelled_sample, with_language
from souk.llm.mixing import emit_copies, mix_sources
from souk.llm.near_dedup import drop_near_copies


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the labelled ones: those without a letter
    go, and those beyond the phrases per symbol that the labelled sample
    allows. Without labels only those without a letter go."""
    sample = labelled_sample(docs)
    d = with_language(docs.select(row_struct(docs), F.col("text").alias("_text")), sample, "_text", keep=["_row"])
    return d.where("told").select("_row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays (similarity 0.8)."""
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, a row per copy."""
    d = docs.select(row_struct(docs, alias="document"), "doc_id", "text", "source")
    return emit_copies(mix_sources(d)).select("document.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the whole texts."""
    d = bpe_encode(docs, vocabulary_path(), keep=["doc_id", "lang", "source"])
    return d.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [("language ID", language), ("exact dedup", exact_copies), ("MinHash near-dedup", near_copies),
          ("mixing", mix), ("BPE", tokens)]

#: language ID, near-dedup and BPE are beyond SQL; tests hold the rows against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents; what a stage keeps is written
    below the shared checkpoint folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
