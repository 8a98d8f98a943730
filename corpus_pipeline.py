"""A training corpus in five stages, from documents to packed sequences.

Each stage is (name, function of (spark, docs, sf_dir)); what it returns is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.llm import mixing, neardup, packing, quality, secrets
from textflow.llm._shared import cut
from textflow.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays, by its text: different texts of one doc_id
    are judged by themselves, equal rows are one document."""
    return neardup.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows."""
    clean = secrets.clean(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, up to half as often again; no document goes."""
    return mixing.repeated(docs, max_repeat=1.5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as pieces of sequences: a row for each piece, with its place, and without its ids."""
    return packing.pack(docs, vocabulary(), keep_ids=False).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("temperature_mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: The models and signatures of the stages have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = cut(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
