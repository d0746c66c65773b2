"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before has left, written as Parquet and
read again, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assaylake.llm.common import small_batches, table
from assaylake.llm.cuckoo_lines import replace_texts
from assaylake.llm.decontaminate import drop_leaked
from assaylake.llm.importance import keep_selected
from assaylake.llm.packing import pack
from assaylake.llm.simhash import drop_near_copies
from assaylake.session import release, settled


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the labelled good ones selects.

    Null texts are scored as empty ones; rows that repeat an id go if one of them
    is not selected; rows without an id are kept.
    """
    return keep_selected(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in one document only; ``n_chars`` follows the text."""
    small_batches(spark)
    return replace_texts(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, the one of the least id.

    The SimHash groups, found by pigeonring, are compared by their texts; a prefix filter adds the
    near copies whose fingerprints are too far apart.
    Rows without an id stay; of rows that repeat an id one stays; null and empty texts are copies.
    """
    small_batches(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of the benchmark; null and empty texts hold none, null items are in none."""
    return drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences; a null text is an empty one, rows without an id are packed."""
    small_batches(spark)
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The first stage samples by a trained model and the third compares sketches: no SQL for them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, settled(stage(spark, docs, sf_dir), name)
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
