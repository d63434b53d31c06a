"""Connected components of an edge table, in rounds of joins (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of every node to the smallest of them and the node itself: the
    larger neighbours (large star), or the smaller ones and the node (small star)."""
    both = edges.select(F.col("u").alias("n"), F.col("v").alias("o"))
    if large:
        both = both.union(edges.select(F.col("v").alias("n"), F.col("u").alias("o")))
    least = both.groupBy("n").agg(F.least(F.min("o"), F.col("n")).alias("m"))
    linked = both.join(least, "n")
    if large:
        linked = linked.where("o > n").select(F.col("o").alias("u"), F.col("m").alias("v"))
    else:
        linked = (linked.where("o <> m").select(F.col("o").alias("u"), F.col("m").alias("v"))
                  .union(least.select(F.col("n").alias("u"), F.col("m").alias("v"))))
    return linked.where("u > v")


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge at most and none leads to a node that has one."""
    ends = edges.selectExpr("u as n", "1 as go", "0 as come").union(edges.selectExpr("v as n", "0 as go", "1 as come"))
    return ends.groupBy("n").agg(F.sum("go").alias("go"), F.max("come").alias("come")).where("go > 1 or go = 1 and come = 1").isEmpty()


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of the edge table (a, b): ``component`` is the
    smallest node that can be reached. Nulls and loops are left out. The stars are repeated
    until all components are stars, about log(n) rounds; every round is a table of
    ``scratch``, and the last is read by the result.
    """
    state = scratch.table(edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    while not _settled(state):
        state = scratch.table(_star(_star(state, large=True), large=False).distinct(), "components")
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
