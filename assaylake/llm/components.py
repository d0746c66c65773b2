"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.session import release, settled

#: Up to so many links a round's work is mostly tasks to be started, each of which the driver
#: keeps account of. The least neighbours (some 2 MB) are then broadcast, so no links are dealt
#: out by a node, and there are as many tasks as cores.
FEW_LINKS = 1 << 16


def _gathered(df: DataFrame) -> DataFrame:
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def _joined(links: DataFrame, on: str, least: DataFrame, few: bool) -> DataFrame:
    """The links with ``m``, the least neighbour ``least`` has for their node ``on``."""
    return links.join(F.broadcast(_gathered(least)) if few else least, F.col(on) == F.col("node"))


def _large_star(links: DataFrame, few: bool) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                                          F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e"))
    least = ends.groupBy("e.node").agg(F.least(F.min("e.other"), F.col("node")).alias("m"))
    moved = _joined(links, "b", least, few).select("a", F.col("m").alias("b"))
    # few links may be there twice until the small star's end
    return moved if few else moved.distinct()


def _small_star(links: DataFrame, few: bool) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the least one."""
    least = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    # the link to the least neighbour is the node's own, each other one becomes the neighbour's
    of = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
    moved = _joined(links, "a", least, few).select(of.alias("a"), F.col("m").alias("b")).distinct()
    return _gathered(moved) if few else moved


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the least node reachable; for nodes with a link only.

    ``links`` has columns ``a`` and ``b``. Nulls and links to itself are ignored.
    The rounds are about the logarithm of the longest path; each is written out,
    so a lost executor costs the current round at the most. Stars are taken by
    aggregation, so a node with a great many links is no group in one task.
    """
    links = settled(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    mark = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003))
    last = None
    while (now := links.agg(mark.alias("m")).first()["m"]) != last:
        last, before = now, links
        few = now[0] <= FEW_LINKS
        links = settled(_small_star(_large_star(links, few), few), "links")
        release(before)
    # stars now: every node has one link, to the least node
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
