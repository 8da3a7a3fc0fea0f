"""Connected components as tables: no neighbourhood is ever gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflux.llm.ordered import join_counted
from urbanflux.session import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, class)`` for every node of a link; ``class`` is the smallest node it reaches.

    Alternates two steps until every tree is a star: each larger neighbour of a node, then each
    smaller one, is linked to the smallest neighbour instead. Both take minima per node (combined
    before the shuffle) and join them back; links of a node that has very many are dealt out by their
    other end. Links to itself or null mean nothing; an empty table has
    no classes.
    """
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = materialize(edges.distinct(), "edges")
    while not _only_stars(edges):
        both, total = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), 2 * edges.count()
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
        large = join_counted(both.where("v > u"), least, ["u"], "n", total, {"u": F.col("v")})
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_counted(large, least, ["u"], "n", total, {"u": F.col("v")})
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = materialize(small.where("u != v").distinct(), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("class")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("class")).unionByName(roots)


def _only_stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour, which has none, or none itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"))
    )
    wrong = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return wrong.where("ups > 1 OR (ups = 1 AND least = 0)").isEmpty()
