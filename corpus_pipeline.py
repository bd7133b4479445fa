"""The corpus pipeline: quality, exact copies, near copies, source mix, pieces. Counted as part of phraseloom.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from phraseloom.llm import common, quality
from phraseloom.llm.exact_dedup import drop_exact_copies
from phraseloom.llm.mixing import mixed_documents
from phraseloom.llm.pieces import encode_pieces
from phraseloom.llm.similar import drop_similar


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, trained on the labelled rows of ``sf_dir``, does not reject."""
    model = quality.train(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return drop_similar(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix."""
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_exact_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("sentencepiece", pieces),
]

#: SQL can express neither the trained classifier nor the fingerprints; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next.

    What a stage writes for itself is deleted once its result is written, and that once the next stage's is. The last table stays: the
    returned rows are read from it.
    """
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = common.scratch_path(spark, f"pipeline-{name}")
        with common.cleared(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        if before is not None:
            common.delete(spark, before)
        docs, before = spark.read.schema(made.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
