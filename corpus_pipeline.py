"""The corpus pipeline: stages that take documents and hand on what they keep."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import decontamination, packing, pii, simhash, toxicity
from llm.common import held_out, remove_folder, shared_folder, stored_for_now, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of one half or more go.

    Labels are learned from as in the query of that operator; documents without a
    label are judged all the same.
    """
    out = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), out)
    return docs.where(toxicity.score(model) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one of the smallest doc_id."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return docs.where(F.size(decontamination.leaks(docs, table(spark, sf_dir, "benchmark"))) == 0)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars follows the text."""
    masked = pii.found(pii.fit(docs))["masked"]
    hidden = docs.withColumn("text", F.when(F.col("text").isNotNull(), masked))
    if "n_chars" not in docs.columns:
        return hidden
    return hidden.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in sequences: see ``packing.pack``."""
    return packing.pack(docs, packing.vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("pii", mask_pii),
    ("packing", pack),
]

#: SQL can express neither fitted models nor a vocabulary's ids; tests compare the
#: stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread.

    What a stage wrote is removed once the next one is written, and what it stored on
    its way at its end; the last one's rows stay, since the result reads them.
    """
    docs, folder, last = table(spark, sf_dir, "documents"), shared_folder(spark), None
    for name, stage in STAGES:
        path = f"{folder}/pipeline-{uuid.uuid4().hex}-{name}"
        with stored_for_now(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last is not None:
            remove_folder(spark, last)
        last = path
    return docs
