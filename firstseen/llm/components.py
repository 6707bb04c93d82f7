"""Connected components of an edge table, as Spark joins.

Alternates the two star operations: every node's larger neighbours, then every
node's smaller ones, are hung on the smallest node seen from there. Each round is
a grouping with map-side combine and a join, which AQE splits where a node has
very many neighbours. The edge table never grows, and each round is written to
the shared folder, so no lineage builds up and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstseen.llm.frames import staged


def _edges(large: Column, small: Column) -> list[Column]:
    return [large.alias("large"), small.alias("small")]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("large").alias("node"), F.col("small").alias("near")).unionAll(
        edges.select(F.col("small").alias("node"), F.col("large").alias("near"))
    )
    least = both.groupBy("node").agg(F.min(F.least("node", "near")).alias("least"))
    upward = edges.select(F.col("small").alias("node"), F.col("large").alias("near"))
    return upward.join(least, "node").select(*_edges(F.col("near"), F.col("least")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("large").agg(F.min("small").alias("least"))
    moved = edges.join(least, "large").filter("small <> least").select(*_edges(F.col("small"), F.col("least")))
    return moved.unionAll(least.select(*_edges(F.col("large"), F.col("least"))))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("large", "small").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of every linked node; component is its smallest node.

    ``links`` has two columns of node ids, in any direction and number; links of
    a node to itself or to null are left out. No link gives no row.
    """
    a, b = (F.col(name) for name in links.columns[:2])
    edges = links.filter(a != b).select(*_edges(F.greatest(a, b), F.least(a, b))).distinct()
    edges = staged(edges, label)
    mark = _mark(edges)
    while True:
        edges = staged(_small_star(_large_star(edges).distinct()).distinct(), label)
        after = _mark(edges)
        if after == mark:
            return edges.select(F.col("large").alias("node"), F.col("small").alias("component")).unionAll(
                edges.select(F.col("small").alias("node"), F.col("small").alias("component")).distinct()
            )
        mark = after
