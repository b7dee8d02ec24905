"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import documents
from fleetlens.llm.exact_dedup import exact_dedup
from fleetlens.llm.fingerprints import fingerprints
from fleetlens.llm.language import identify
from fleetlens.llm.licenses import scan
from fleetlens.llm.mixing import mix_sources
from fleetlens.llm.near_dedup import near_duplicates
from fleetlens.llm.ngram import score_documents
from fleetlens.llm.packing import pack
from fleetlens.llm.part_enum import shingle_join
from fleetlens.llm.runs import digests, periodic_runs
from fleetlens.llm.search import search
from fleetlens.llm.token_counts import token_counts
from fleetlens.llm.warc import page_records

#: The tokenizer that packing uses and its end id; the unigram vocabulary.
PACK_TOKENIZER, PACK_END = "word_bpe_49k.json", 2
VOCABULARY = "piece_bpe_32k.model"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path(PACK_TOKENIZER), PACK_END)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), listed=1, discount=None)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), size=3, percent=85)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return digests(periodic_runs(docs, F.crc32(F.col("doc_id").cast("string"))))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join(documents(spark, sf_dir), size=4, percent=85).select("doc_id", "n_shingles", "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_license_scan,
        op3_source_mix,
        op4_packing,
        op5_fingerprints,
        op6_lm_scoring,
        op7_near_dedup,
        op8_token_counts,
        op9_language,
        op10_warc,
        op11_periodic_runs,
        op12_ranked_search,
        op13_shingle_join,
    )
}
