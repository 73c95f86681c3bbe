"""Connected components of an edge table, by contraction.

Each round every vertex hooks to its smallest neighbour (a map-side combined minimum),
hooks are followed twice, and the edges are rewritten to the ends of the hooks; edges
inside a vertex vanish.  Every table is staged in the shared folder, so no lineage grows,
and joins on a hub's key are plain sort-merge joins of two scans that adaptive execution
splits.  Nothing but one row count per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.sources.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every vertex of ``edges`` (columns a, b): the smallest vertex
    it can reach.  Self-loops and repeated edges are allowed; rows with a null end are
    ignored; an empty table gives an empty result."""
    edges = edges.where("a is not null and b is not null").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    loops = edges.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("parent"))
    rest = stage(edges.where("a < b").distinct(), "edges")
    labels = None
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        hooks = stage(hooks.select("node", F.least("node", "parent").alias("parent")), "hooks")
        for _ in range(2):
            hooks = stage(_follow(hooks, hooks), "hooks")
        labels = hooks if labels is None else _follow(labels, hooks)
        for end in ("a", "b"):
            there = hooks.select(F.col("node").alias(end), F.col("parent").alias("to"))
            rest = rest.join(there, end).drop(end).withColumnRenamed("to", end)
        rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        rest = stage(rest.where("a < b").distinct(), "edges")
    if labels is not None:
        loops = loops.join(labels, "node", "left_anti").unionByName(labels)
    return loops.distinct().withColumnRenamed("parent", "component")


def _follow(labels: DataFrame, hooks: DataFrame) -> DataFrame:
    """Replace each parent by the parent's own parent, where it has one."""
    on = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
    return labels.join(on, "parent", "left").select(
        "node", F.coalesce("next", "parent").alias("parent")
    )
