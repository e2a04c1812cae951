"""Connected components of a link table, by star contraction; nothing leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import discard, swept


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a AND b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _settled(links: DataFrame) -> bool:
    """Every ``a`` has one link, and no ``b`` is an ``a``: each node points at its label."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    return ends.groupBy("node").agg(F.sum("s").alias("s"), F.max("t").alias("t")).where("s > 1 OR s = 1 AND t = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b: long); the label is the smallest node.

    Rounds of large and small star, each written to the shared folder, until every node is linked with its label alone;
    their number grows with the logarithm of the longest path. Loops and repeated links are allowed.
    """
    now = swept(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while not _settled(now):
        old, now = now, swept(_small_star(_large_star(now)), "links")
        discard(old)
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )


def extended(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts``, a written result of ``components``, after more ``links`` (a, b); only links between parts take rounds."""
    part = lambda c: parts.select(F.col("node").alias(c), F.col("label").alias(f"{c}_part"))
    between = swept(
        links.join(part("a"), "a", "left").join(part("b"), "b", "left")
        .select(F.coalesce("a_part", "a").alias("a"), F.coalesce("b_part", "b").alias("b")).where("a <> b"),
        "links",
    )
    if between.isEmpty():
        return parts
    joined = swept(components(between), "labels")
    roots = joined.select(F.col("node").alias("label"), F.col("label").alias("root"))
    moved = parts.join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("label"))
    grown = swept(moved.unionByName(joined.join(parts.select("node"), "node", "left_anti")), "labels")
    discard(between, joined)
    return grown
