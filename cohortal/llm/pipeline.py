"""From raw documents to packed training sequences, one written table after the other."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortal.llm import exact_dedup, mixing, near_dedup, ordinal, packing
from cohortal.llm.columns import shielded
from cohortal.llm.workers import importable
from cohortal.sources.tables import one_folder, remove_folder, stage

TOKENIZER = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
Step = Callable[[SparkSession, DataFrame, str], DataFrame]
# The folder of the last step's intermediate tables, for each application.
_last_folder: dict[str, str] = {}


def tidy(step: Step) -> Step:
    """Stage a step's intermediate tables in a folder of their own, and remove those of the
    step before, whose result is written by now. They stay if ``docs`` still reads them."""

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        application = spark.sparkContext.applicationId
        before = _last_folder.pop(application, None)
        if before and not any(before.rpartition("/")[2] in f for f in docs.inputFiles()):
            remove_folder(spark, before)
        with one_folder(spark) as folder:
            _last_folder[application] = folder
            return step(spark, docs, sf_dir)

    return run


@tidy
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier, fitted on the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = ordinal.train(docs, ordinal.driver_ratings(labels))

    def good(own: DataFrame) -> DataFrame:
        return ordinal.grade(own, model).where("kept").select(*own.columns)

    return shielded(docs, ["doc_id", "text"], good)


@tidy
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_copies(docs)


@tidy
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return near_dedup.drop_near_copies(docs)


@tidy
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the shares of their sources' weights; repeated ones occur again."""
    return mixing.mixed_documents(docs)


@tidy
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2,048 tokens."""
    pieces = packing.pack(docs, *map(public_tokenizers.path, TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]

# Training, sketches and tokenization are beyond SQL; the tests compare each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each reads what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
