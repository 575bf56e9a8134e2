"""A training corpus in five stages: clean, deduplicate, mix, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.llm.line_dedup import dedup_lines
from civicspark.llm.minhash import drop_near_duplicates
from civicspark.llm.mixing import mix
from civicspark.llm.pieces import encode_texts
from civicspark.llm.toxicity import drop_toxic, learn, training_rows
from civicspark.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer, learned from the labelled ones, rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, learn(docs, training_rows(labels)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten documents or more leave every text; n_chars follows the text."""
    out = dedup_lines(docs)
    chars = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", chars).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words a shingle, similarity 0.8 or more."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes, in training order."""
    return mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's ids under merge-dropout, and whether they decode to its text."""
    out = encode_texts(docs, dropout=0.1, seed=7, streams=0, carry=("doc_id", "lang", "source"))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids", "restored")


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing", mixing),
    ("SentencePiece encoding", encoding),
]

#: The scorer is learned and the vocabulary is a file: SQL can't express either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
