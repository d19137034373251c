"""The corpus pipeline: documents to a clean, mixed and tokenized corpus.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``; the last writes the token shards and
returns what it reads back of each document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import decontam, minhash, mixing, token_output, toxicity
from cohortlens.llm.common import ship_package, written

TOKENIZER = "byte_bpe_50k.json"


#: Less for a worker of the last stage to remember: the executors' JVMs and workers have grown
#: by the stages before.
TOKEN_MEMORY = {"remembered": 150_000, "slab_chars": 1_000_000, "keep": False}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; fitted on the labels that are not held out."""
    ship_package(spark)
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    ship_package(spark)
    return minhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    ship_package(spark)
    return decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the sources' weights, some repeated, some cut."""
    return mixing.mix_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of all documents; one row per document, read back from them."""
    ship_package(spark)
    return token_output.token_round_trip(docs, public_tokenizers.path(TOKENIZER), **TOKEN_MEMORY)


STAGES = [("toxicity", reject_toxic), ("near_dedup", near_dedup),
          ("decontamination", decontaminate), ("mixing", mix), ("token_output", tokenize)]

#: No SQL: scoring, sampling, alignment and tokenization are not expressible in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the whole table ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
