"""Connected components of a graph that no machine holds: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerly.llm.common import written


def _star(edges: DataFrame, least: DataFrame, label: str) -> DataFrame:
    """Edges with each node's least neighbour beside them; both sides are tables, so that a hot node's join can be split."""
    return edges.join(written(least, label), "u")


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Of edges (u, v): one row (node, root) for each node, root the smallest node it is connected with.

    Each round links every node's larger neighbours to the smallest one, then
    the smaller ones to the smallest of them; the number of edges never grows
    and the rounds are logarithmic in the number of nodes. Each round is a
    table in the shared folder. Only counts reach the driver.
    """
    edges = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = written(_star(both, least, "least").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _star(large, least, "least").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = written(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
