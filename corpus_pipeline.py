"""The training-text pipeline: quality rules, line de-duplication, SimHash near-duplicates, benchmark
decontamination, SentencePiece ids. Each stage reads what the one before it wrote."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.llm import decontaminate, line_dedup, pieces, quality_rules, simhash_pivots
from tidemill.llm.catalog import PIECE_MODEL
from tidemill.llm.common import shared_folder, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules (operator 2)."""
    return quality_rules.keep_good(docs)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their host (operator 6); n_chars follows the text.

    Copies of a document are one page here: one of them is to be left by the next stage, with its text."""
    found = line_dedup.drop_boilerplate(docs, distinct_texts=True)
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 4)."""
    return simhash_pivots.keep_one(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage (operator 1)."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and whether they decode to the text (operator 8)."""
    return pieces.encode(docs, pieces.read_model(PIECE_MODEL))


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", without_boilerplate),
    ("near-duplicates", one_of_each),
    ("decontamination", not_in_benchmark),
    ("pieces", encoded),
]

# Alignment, components and merges are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(os.path.abspath(__file__)).parent))
    folder = f"{shared_folder(spark)}/tidemill-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
