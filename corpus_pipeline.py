"""A training corpus from `documents`: toxicity filter, line dedup, near-dedup, suffix dedup, packing.

Each stage works on all rows that the one before it kept. All but the last return the columns of `documents`, the last
the packed pieces with their token ids; the rows of one sequence_id in the order of offset are a sequence.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm.common import ready_to_checkpoint
from leadloom.llm.line_dedup import dedup_lines
from leadloom.llm.near_copies import drop_linked_copies
from leadloom.llm.packing import pack_documents
from leadloom.llm.suffix_dedup import remove_passages
from leadloom.llm.toxicity import toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones that aren't held out, scores under 0.5."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity(docs, labels).where("predicted = 0").select(*COLUMNS)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that match an earlier one."""
    return _sized(dedup_lines(docs))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash fingerprints that differ in at most 3 bits, or by sets of five-word
    shingles with a Jaccard similarity of at least 0.8, which reach copies that are further apart in bits."""
    return drop_linked_copies(docs, 0.8, shingle=5, most_bits=3).select(*COLUMNS)


def remove_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages of 50 words (or 400 bytes, if in fewer words) that occur elsewhere too."""
    return _sized(remove_passages(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their place in a sequence of 2048."""
    return pack_documents(docs, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("suffix_dedup", remove_repeated_spans),
    ("best_fit_packing", pack),
]

#: None: SQL can't express the fitted score, the tokenizer or the packing. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. What a stage returns is written to the shared checkpoint folder as Parquet and read
    by the next; it is deleted once the next has been written."""
    ready_to_checkpoint(spark)
    base = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/corpus-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS), None
    for name, stage in STAGES[:-1]:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            folder = spark._jvm.org.apache.hadoop.fs.Path(before)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
