"""A corpus pipeline of five stages; each works on all documents its predecessor kept.

Toxic documents go, one document of each group of near duplicates stays, documents that hold benchmark passages go,
personal data is masked in the texts, and what is left is encoded: the last stage returns a row of digests a document.
Each stage's result is written as Parquet in the shared folder and read again as the next one's documents.

The stages share the executors' Python workers, whose memory keeps the size of the largest batch, so batches hold few texts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from shelfrisk.llm.byte_bpe import encode_digests
from shelfrisk.llm.common import stored, table
from shelfrisk.llm.ngram_join import one_of_each
from shelfrisk.llm.pii import without_personal_data
from shelfrisk.llm.spaced_seeds import decontaminated
from shelfrisk.llm.toxicity import without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Texts in a batch between Spark and Python (Spark's 10,000 of them are some 20 MB here, several times over in a task).
BATCH_ROWS = "1000"


def in_small_batches(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(spark, docs, table(spark, sf_dir, "labels"))


@in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(spark, docs)


@in_small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_personal_data(spark, docs)


@in_small_batches
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Trained scores, masking and byte-level BPE have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
