"""Corpus pipeline: toxicity filter, SimHash near-dedup, benchmark
decontamination, redaction of personal data, SentencePiece encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept; each result is written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import decontam, pii, sentencepiece, simhash, toxicity
from marketlens.llm.common import table
from marketlens.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become <KIND>; n_chars follows the text."""
    out = pii.redact(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(out.schema["n_chars"].dataType), "n_chars"))
    return out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids, scores and sizes of the n best segmentations, by doc_id; the
    other columns of the documents end here."""
    return sentencepiece.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("sentencepiece", encode),
]

#: No SQL: trained models, hashing and lattice search; tests/llm compare the
#: stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. The stages' results lie in
    a folder of their own under the shared spark.checkpoint.dir."""
    out = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{k}-{name}")
        docs = spark.read.parquet(f"{out}/{k}-{name}")
    return docs
