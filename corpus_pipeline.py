"""The corpus pipeline: language ID, exact dedup, MinHash near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``run`` writes what a stage
returns as Parquet and rereads it. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import documents, drop_folder, shared_folder, ship, stored, with_locator
from fleetlens.llm.exact_dedup import exact_dedup
from fleetlens.llm.language import UNKNOWN, fit, predictor
from fleetlens.llm.mixing import mixed
from fleetlens.llm.near_dedup import near_duplicates
from fleetlens.llm.packing import pack
from fleetlens.llm.queries import PACK_END, PACK_TOKENIZER

#: The working tables of the stage before, which nothing reads once its result is written.
_scratch: list[str] = []


def _fresh(spark: SparkSession, label: str) -> str:
    while _scratch:
        drop_folder(spark, _scratch.pop())
    _scratch.append(shared_folder(spark, label))
    return _scratch[-1]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language is found: null texts and texts without a letter."""
    _fresh(spark, "stage-language")
    ship(spark)
    predict = predictor(fit(docs))
    return docs.withColumn("_found", predict(F.col("text"))).filter(F.col("_found.lang_pred") != UNKNOWN).drop("_found")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the one with the largest doc_id, one row of it."""
    folder = _fresh(spark, "stage-exact")
    located = with_locator(docs, folder)
    gone = exact_dedup(docs, folder).filter("not kept").select("_file", "_row")
    return located.join(gone, ["_file", "_row"], "left_anti").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates (five words, 0.8) the document with the least doc_id."""
    folder = _fresh(spark, "stage-near")
    gone = near_duplicates(docs, folder=folder).filter("not kept").select("doc_id").distinct()
    return docs.join(stored(gone, f"{folder}/gone"), "doc_id", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; documents that it does not take go."""
    return mixed(docs, _fresh(spark, "stage-mix"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their token ids."""
    folder = _fresh(spark, "stage-pack")
    path = public_tokenizers.path(PACK_TOKENIZER)
    # Executors still hold what earlier stages touched: half the known words, texts in smaller steps.
    return pack(docs, path, PACK_END, with_ids=True, folder=folder, kept_words=200_000, step=300_000)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix),
    ("packing", pack_windows),
]

#: Language ID, minima and tokens are no SQL; tests/llm hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over the documents of ``sf_dir``."""
    folder = shared_folder(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES[:-1]):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
