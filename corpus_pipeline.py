"""Corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``; a lost executor therefore never
repeats earlier stages.  All stages but the last return the columns of ``documents``.

1. quality      documents that the classifier scores under 0.7 go
2. near_dedup   one document of each near-duplicate class (0.8 or more) stays
3. decontaminate documents that hold benchmark passages (contaminated) go
4. pii          personal data in the texts is replaced by <KIND>; n_chars follows
5. tokens       byte-level BPE ids of every text, with the digest of their decoding
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import bpe, minhash, pii, quality, winnow
from stratum.llm.frames import ship_package
from stratum.session import work_path
from stratum.sources.tables import read_table


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))
    return quality.keep_quality(docs, model)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return minhash.drop_near_duplicates(docs, percent=80, by_text=True)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return winnow.decontaminate(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.redact_pii(docs)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))


def stage_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    path, pattern = bpe.standard_ranks()
    return bpe.bpe_tokens(docs, path, pattern)


STAGES = [
    ("quality", stage_quality),
    ("near_dedup", stage_near_dedup),
    ("decontaminate", stage_decontaminate),
    ("pii", stage_pii),
    ("tokens", stage_tokens),
]

# Trained scores and byte-pair merges are not expressible in SQL; the stages are
# tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, "llm", f"pipeline-{name}", unique=True)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
