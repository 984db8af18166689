"""Registered queries of the subpackage: name -> callable(spark, sf_dir) -> DataFrame.

Each query applies its operator, with production parameters, to its whole table
and derives the columns that the contract fixes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.frames import ship_package
from stratum.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.pii import pii_report

    return pii_report(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.bpe import bpe_tokens, standard_ranks

    ship_package(spark)
    path, pattern = standard_ranks()
    return bpe_tokens(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), path, pattern,
                      keep_ids=False)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.url_filter import judge_urls, standard_globs

    ship_package(spark)
    return judge_urls(read_table(spark, sf_dir, "pages", ["page_id", "url"]),
                      standard_globs()).select("page_id", "host", "path", "rule", "verdict")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.topk import top_k, weights

    ship_package(spark)
    vectors = weights(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))
    return top_k(vectors, F.col("vec_id") % 20 == 0)


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.hilbert import hilbert_shards

    return hilbert_shards(read_table(spark, sf_dir, "documents",
                                     ["doc_id", "text", "lang", "source"]))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.toxicity import fit_toxicity, score_toxicity

    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    return score_toxicity(docs, model)


def op7_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.minhash import near_duplicates

    ship_package(spark)
    return near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), percent=85)


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.winnow import contamination

    ship_package(spark)
    return contamination(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                         read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.suffix_dedup import remove_repeats

    ship_package(spark)
    return remove_repeats(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.quality import fit_quality, score_quality

    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    model = fit_quality(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))
    return score_quality(docs, model)


def op11_lloyd_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.lloyd import compress

    ship_package(spark)
    return compress(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))


def op12_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.edit_embedding import edited_fingerprints

    ship_package(spark)
    return edited_fingerprints(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratum.llm.resample import resample

    ship_package(spark)
    return resample(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                    read_table(spark, sf_dir, "benchmark", ["text"]))


def queries() -> dict[str, Query]:
    return {
        "op1_pii": op1_pii,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_url_filter": op3_url_filter,
        "op4_exact_topk": op4_exact_topk,
        "op5_hilbert_shards": op5_hilbert_shards,
        "op6_toxicity": op6_toxicity,
        "op7_bbit_minhash": op7_bbit_minhash,
        "op8_winnowing": op8_winnowing,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_quality": op10_quality,
        "op11_lloyd_codes": op11_lloyd_codes,
        "op12_edit_fingerprints": op12_edit_fingerprints,
        "op13_importance_resampling": op13_importance_resampling,
    }


def oracle_sql() -> dict[str, str]:
    from stratum.llm.sql import SQL

    return dict(SQL)
