"""Connected components of a table of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtok.llm.shared import table


def _large(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest one."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest one."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    rest = links.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``links``: u, v of any sortable type, in any order, without nulls; a
    link of a node with itself counts for nothing.  Returns node, root, the
    root being the smallest node of the component; nodes without a link and
    the roots themselves don't appear.  Star contraction: the number of
    rounds follows the logarithm of the nodes, each round is a table in the
    shared folder, and a node with very many links is only ever grouped."""
    now = table(links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = lambda t: tuple(t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    was = mark(now)
    while was[0]:
        now = table(_small(_large(now)), "links")
        new = mark(now)
        if new == was:
            break
        was = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
