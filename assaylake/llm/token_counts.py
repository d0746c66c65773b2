"""Exact histogram of encoded lengths, with totals for every context limit.

Documents are encoded once and reduced, inside each task, to (length, documents).
What is shuffled and kept is the histogram, which has one row for each length that
occurs. Running sums over it answer every later question: how many documents fit a
limit, how many tokens remain when longer ones are cut, which length is a quantile.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaylake.llm.common import batch_of, texts_of
from assaylake.llm.tokens import document_token_count
from assaylake.session import settled

#: Lengths are summed in blocks of so many, and the blocks among each other, so
#: that no task has more than this many lengths or the number of blocks.
BLOCK = 4096

_COUNTS = pa.schema([("n_tokens", pa.int64()), ("n_docs", pa.int64())])


def length_counts(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``n_tokens, n_docs``: documents for each encoded length.

    A null text is an empty one and has length 0, as has an empty one. Repeated
    rows count each time. Only the text column is read. An empty table has no rows.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = [document_token_count(x, vocabulary) for x in texts_of(batch.column(0))]
            yield batch_of(_COUNTS, np.unique(np.array(lengths, np.int64), return_counts=True))

    counted = docs.select(F.col(text).cast("string")).mapInArrow(count, "n_tokens long, n_docs long")
    return counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def length_table(counts: DataFrame, limits: Sequence[int] = ()) -> DataFrame:
    """The histogram with its running sums, a row for each length.

    ``limits`` get rows of their own even if no document has that length.

    * ``docs_upto``, ``tokens_upto``: documents of at most this length, and their tokens
    * ``docs_longer``: documents beyond it (the suffix sum)
    * ``truncated_tokens``: tokens if every document is cut at this length
    * ``lost_tokens``: tokens that such a cut removes
    * ``share_upto``: share of documents that fit whole
    """
    spark = counts.sparkSession
    if limits:
        extra = spark.createDataFrame([(int(x), 0) for x in limits], "n_tokens long, n_docs long")
        counts = counts.unionByName(extra).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    counts = counts.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    tokens = F.col("n_tokens") * F.col("n_docs")
    blocks = counts.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    # a row for each 4096 lengths, whatever the number of documents
    longer = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(longer), F.lit(0)).alias("docs_beyond"),
        F.coalesce(F.sum("t").over(longer), F.lit(0)).alias("tokens_beyond"),
        F.sum("d").over(every).alias("all_docs"),
        F.sum("t").over(every).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    docs_longer = F.col("docs_beyond") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0))
    tokens_longer = F.col("tokens_beyond") + F.coalesce(F.sum(tokens).over(inside), F.lit(0))
    out = counts.join(blocks, "block").select(
        "n_tokens", "n_docs", "all_docs", "all_tokens",
        docs_longer.alias("docs_longer"), tokens_longer.alias("tokens_longer"),
    )
    cut = F.col("tokens_longer") - F.col("n_tokens") * F.col("docs_longer")
    return out.select(
        "n_tokens",
        "n_docs",
        (F.col("all_docs") - F.col("docs_longer")).alias("docs_upto"),
        "docs_longer",
        (F.col("all_tokens") - F.col("tokens_longer")).alias("tokens_upto"),
        (F.col("all_tokens") - cut).alias("truncated_tokens"),
        cut.alias("lost_tokens"),
        F.try_divide((F.col("all_docs") - F.col("docs_longer")).cast("double"), F.col("all_docs").cast("double"))
        .alias("share_upto"),
    )


def length_quantiles(lengths: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """``quantile, n_tokens``: the least length that this share of documents does not exceed.

    Exact; 0 gives the least length. ``lengths`` comes from ``length_table``.
    """
    all_docs = F.col("docs_upto") + F.col("docs_longer")
    needed = F.greatest(F.lit(1), F.ceil(F.col("quantile") * all_docs))
    asked = F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("quantile")
    return (
        lengths.select("*", asked)
        .filter((needed <= F.col("docs_upto")) & (needed > F.col("docs_upto") - F.col("n_docs")))
        .select("quantile", "n_tokens")
    )


def token_lengths(docs: DataFrame, limits: Sequence[int] = (), vocabulary: str | None = None) -> DataFrame:
    """``length_table`` of documents. The counts are written once, as they are read twice."""
    return length_table(settled(length_counts(docs, vocabulary=vocabulary), "lengths"), limits)
