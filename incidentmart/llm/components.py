"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every vertex is either a centre or hangs on exactly one centre."""
    ends = edges.selectExpr("a AS v", "1 AS centre", "0 AS leaf").unionByName(edges.selectExpr("b AS v", "0 AS centre", "1 AS leaf"))
    sums = ends.groupBy("v").agg(F.sum("centre").alias("centre"), F.sum("leaf").alias("leaf"))
    return sums.filter("leaf > 1 OR (leaf > 0 AND centre > 0)").isEmpty()


def _with_least(edges: DataFrame) -> DataFrame:
    """Each edge (a, b) with the least neighbour ``m`` of ``a``.

    The minimum is written first, so both join sides are plain scans and a hub
    with very many edges can be split by the planner.
    """
    least = stage(edges.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("m")), "least")
    return edges.join(least, edges["a"] == least["x"]).select("a", "b", "m")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b): ``root`` is the smallest vertex of its component.

    Edges may repeat and stand in either direction; loops are dropped, and a
    vertex with loops only is not returned.  Every round is two joins and two
    aggregates over a staged table that never has more than the edges given, so
    no group of neighbours is ever collected.
    """
    now = stage(edges.filter("a <> b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct(), "edges")
    for _ in range(max_rounds):
        both = now.unionByName(now.selectExpr("b AS a", "a AS b"))
        large = _with_least(both).filter("b > a").selectExpr("least(a, m) AS a", "b").distinct()
        down = stage(large.filter("a <> b").selectExpr("b AS a", "a AS b"), "large-star")
        small = _with_least(down)
        small = small.selectExpr("m AS a", "b").unionByName(small.selectExpr("m AS a", "a AS b")).filter("a <> b").distinct()
        now = stage(small, "small-star")
        if _is_forest_of_stars(now):
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.selectExpr("b AS v", "a AS root")
    return stage(roots.unionByName(roots.selectExpr("root AS v", "root")).distinct(), "roots")
