"""From raw documents to token ids: five stages, each over all that the one before kept.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir), where
``docs`` is a stored Parquet table, and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes each result as Parquet in the shared folder
and reads it again for the next stage, so a lost executor costs a part of one stage.

A stage knows rows by their place in the files of ``docs``, so it writes no copy of them.
What it writes in between is needed until its result is stored; the next stage removes it
when it begins. Results of stages stay.

Edge cases are those of the operators: null and empty texts go in the first stage,
repeated rows in the second. Extra columns are carried along. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.llm import exact_dedup, mixing, near_dedup, quality_rules, sentence_pieces
from flowsift.llm.common import read_table
from flowsift.storage import materialize, recorded, remove

MODEL = "piece_bpe_32k.model"


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Folders that the latest stage wrote, by application.
_IN_BETWEEN: dict[str, list[str]] = {}


def _tidy(spark: SparkSession) -> None:
    remove(spark, _IN_BETWEEN.pop(spark.sparkContext.applicationId, []))


def stage(fn: Stage) -> Stage:
    """A stage that first removes what the stage before it wrote in between."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _tidy(spark)
        with recorded() as paths:
            out = fn(spark, docs, sf_dir)
        _IN_BETWEEN[spark.sparkContext.applicationId] = paths
        return out

    return run_stage


@stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs, stored=True)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: five-word shingles, 80 %."""
    return near_dedup.drop_near_duplicates(docs, stored=True)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the numbers that bring sources to their targets."""
    mixed = mixing.mixed_documents(docs, stored=True)
    # In place, so that the order of columns and rows stays.
    return mixed.withColumn("n_chars", F.char_length("text").cast("long"))


@stage
def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, in its order, from the piece lattices of its distinct words."""
    encoded = sentence_pieces.encode_by_join(docs, public_tokenizers.path(MODEL), stored=True)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentence_pieces", to_pieces),
]

# The near-duplicate and piece stages have no SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = materialize(step(spark, docs, sf_dir), f"corpus_{name}")
    _tidy(spark)
    return docs
