"""The corpus pipeline: each stage calls one training-data operator and hands its documents on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtable.llm.common import delete, scratch, stage, table
from voxtable.llm.decontaminate import decontaminated
from voxtable.llm.packing import pack
from voxtable.llm.quality_model import scored, train
from voxtable.llm.secrets import without_secrets
from voxtable.llm.near_copies import deduplicated

#: Documents of a lower score are rejected.
LEAST_QUALITY = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; null and empty texts have the score that the model gives no words."""
    weights = train(docs, table(spark, sf_dir, "labels"))
    return scored(docs, weights, out="vx_score").where(F.col("vx_score") >= LEAST_QUALITY).drop("vx_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8), the one with the smallest id.

    Null, empty and wordless texts are one group.
    """
    return deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; null and empty texts stay."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; null and empty texts as they are."""
    return without_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and their places in sequences; a null or empty text is one end token."""
    return pack(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]

#: Models, fingerprints and token ids are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the documents.

    What a stage hands on is written to the shared folder; its own tables are deleted then, and its input too.
    The last stage's tables stay, since the result is read from them: common.drop_stages() deletes them.
    """
    docs, given = table(spark, sf_dir, "documents"), None
    for _, function in STAGES[:-1]:
        with scratch(spark) as kept:
            docs = stage(function(spark, docs, sf_dir), kept)
        if given:
            delete(spark, given)
        given = kept
    return STAGES[-1][1](spark, docs, sf_dir)
