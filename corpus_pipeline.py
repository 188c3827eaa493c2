"""The corpus pipeline: five stages from raw documents to tokens, each calling one operator of aislewise.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.
Between stages the rows are written to the shared folder and read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import aislewise
from aislewise.llm import bpe, fmindex, minhash, nbsvm, secrets
from aislewise.llm.common import private, set_aside, small_batches
from aislewise.session import shared_dir

# Workers of a session that was started elsewhere can't import the package, so its functions travel by value.
cloudpickle.register_pickle_by_value(aislewise)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier, learned from the labels, rejects."""
    small_batches(spark)
    return nbsvm.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: the one with the smallest id, one row of it."""
    small_batches(spark)
    return minhash.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out of the texts; documents that are nothing else go."""
    small_batches(spark)
    plain, back = set_aside(docs, fmindex.SPANS, fmindex.ITEMS, fmindex.COUNT)
    cleaned = fmindex.remove(plain, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return recounted(docs, cleaned.select(*back))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets, those that only their owner has among them. Owners and repositories are counted in the documents that
    came in, copies included: an example that fifty owners copied is still one when a single copy is left."""
    small_batches(spark)
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return recounted(docs, secrets.redact(docs, corpus=corpus))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids of each text, 4 bytes each, and their number: ``ids`` and ``n_tokens``, with underscores before
    them where the documents have columns of these names, which keep their values."""
    small_batches(spark)
    ids, count = private("ids", docs.columns), private("n_tokens", docs.columns)
    encoded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), into=ids)
    return encoded.withColumn(count, (F.octet_length(ids) / 4).cast("long"))


def recounted(before: DataFrame, after: DataFrame) -> DataFrame:
    """The number of characters of texts that may have changed, where the documents carry it."""
    if "n_chars" not in before.columns:
        return after
    kind = before.schema["n_chars"].dataType
    counted = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
    return after.withColumn("n_chars", counted)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near-duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("secrets", redact),
    ("bpe", tokenize),
]

# Models that are fitted in the run, and token ids, have no SQL form: tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
