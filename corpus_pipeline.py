"""The corpus pipeline: five stages of ``vitrine.llm``, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import curriculum, near_dup, packing, quality_fm, secret_scan
from vitrine.llm.common import documents
from vitrine.session import materialize


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject."""
    model = quality_fm.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_fm.keep_good(docs, model)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of smallest id (repeated rows of it stay)."""
    dropped = near_dup.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the curriculum takes, in training order: a document stands there once per pass, the last pass may cut it."""
    pieces = curriculum.training_order(curriculum.assign(docs))
    text = F.when(F.col("mix_words") < F.col("mix_size"), curriculum.first_words(F.col("text"), F.col("mix_words"))).otherwise(F.col("text"))
    return pieces.select(*[
        text.alias("text") if c == "text" else
        F.when(F.col("mix_words") < F.col("mix_size"), F.length(text)).otherwise(F.col("n_chars")).cast("long").alias("n_chars") if c == "n_chars" else c
        for c in docs.columns
    ])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids."""
    return packing.pack_texts(docs, cache=400_000)


STAGES = [
    ("quality classifier", classify),
    ("near-dedup", deduplicate),
    ("secret scan", redact),
    ("mixing", mix),
    ("packing", pack),
]

# A trained model, MinHash candidates and byte-pair ids are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
