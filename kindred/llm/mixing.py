"""Mixing sources to target weights, by a budget handed down a domain-language-source tree.

Every node of the tree may carry a weight among its siblings.  From the top, a node's budget
of tokens is divided among its children in proportion to their weights.  A child can use no
more than its leaves can give (their tokens times the number of epochs allowed); what it
can't use goes to its siblings, in proportion again, and only what no sibling can use is
left to the ancestors, because a node never gets more than its subtree can give.

A leaf reads its documents in epochs, each in its own seeded order, and takes the documents
from the start until its budget is used: the document that would exceed it and all later ones stay out.

The division among siblings is closed-form: children are ordered by capacity over weight;
those whose capacity is below their share are filled, the rest share by weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.sources.staging import stage

LEVELS = ("domain", "lang", "source")
_SLICES = 256


def _share(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Divide ``budget`` (of the parent) among the rows of each parent: column ``given``.

    Rows have integer ``weight`` and ``capacity``; sums of integers are exact in any order.
    Rows of weight 0 get nothing.
    """
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight"))
    order = Window.partitionBy(*parent).orderBy(F.col("ratio").asc_nulls_last(), *LEVELS)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.where("weight > 0").withColumn("ratio", ratio)
    nodes = nodes.withColumn("filled", F.coalesce(F.sum("capacity").over(before), F.lit(0)))
    nodes = nodes.withColumn("open", F.sum("weight").over(Window.partitionBy(*parent)) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # A row is filled if its capacity is at most its share of what the rows before it leave.  After the
    # first that is not, the level only falls: the largest level of those is the one to share at.
    nodes = nodes.withColumn("level", (F.col("budget") - F.col("filled")) / F.col("open"))
    nodes = nodes.withColumn("full", F.col("ratio") <= F.col("level"))
    first_open = F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy(*parent))
    given = F.when(F.col("full"), F.col("capacity")).otherwise(F.floor(F.col("weight") * first_open))
    return nodes.withColumn("given", F.least(given, F.col("capacity")).cast("long")).drop("ratio", "filled", "open", "level", "full")


def budgets(leaves: DataFrame, total: Column, epochs: int, weight: dict[str, Column]) -> DataFrame:
    """The tokens each leaf gives: domain, lang, source, tokens, budget.

    ``leaves``: one row per leaf with its ``tokens``.  ``total``: tokens wanted, computed from
    ``tokens`` (an aggregate).  ``weight``: for each level an expression over the level's columns, an integer.
    """
    wanted = leaves.agg(total.cast("long")).first()[0] or 0
    given = None
    leaves = leaves.withColumn("capacity", F.col("tokens") * epochs)
    parent: list[str] = []
    for level in LEVELS:
        path = [*parent, level]
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", weight[level].cast("long"))
        for later in LEVELS[len(path):]:
            nodes = nodes.withColumn(later, F.lit(None).cast("string"))
        joined = nodes.join(given, parent) if parent else nodes.withColumn("budget", F.lit(wanted))
        given = _share(joined, parent).select(*path, F.col("given").alias("budget"))
        parent = path
    return leaves.drop("capacity").join(given, list(LEVELS), "left").withColumn("budget", F.coalesce("budget", F.lit(0)))


def mix(
    docs: DataFrame, tokens: Column, total: Column, weight: dict[str, Column], epochs: int = 4, seed: int = 7,
) -> DataFrame:
    """Choose documents so that the leaves of the tree give the tokens of their budgets.

    ``docs`` has the columns domain, lang, source, doc_id and those ``tokens`` needs.  Returns
    domain, lang, source, doc_id, epoch (from 0), n_tokens, one row per document and epoch taken.
    A null in a path is a node of its own (named '').  Documents without tokens are taken with
    those before them.  Rows of one doc_id come one after the other, the smaller first.

    No leaf is gathered in one task: an epoch's order is by md5, its first two hex digits cut
    it in 256 slices, and a slice's place in the leaf is known from the slices' sums.
    """
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in LEVELS], F.col("doc_id").cast("long").alias("doc_id"), tokens.cast("long").alias("n_tokens"))
    rows = stage(rows, "mix-rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    plan = stage(budgets(stage(leaves, "mix-leaves"), total, epochs, weight), "mix-budgets")
    # Epochs a leaf begins, and of each the tokens that are left to it.
    began = plan.where("budget > 0").withColumn("epoch", F.explode(F.expr(f"sequence(0, least({epochs - 1}, cast((budget - 1) div tokens as int)))")))
    began = began.withColumn("left", F.least(F.col("tokens"), F.col("budget") - F.col("epoch") * F.col("tokens"))).drop("tokens", "budget")
    drawn = rows.join(began, list(LEVELS))
    drawn = drawn.withColumn("place", F.md5(F.concat_ws("|", F.lit(str(seed)), "epoch", F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")))
    drawn = drawn.withColumn("slice", F.substring("place", 1, 2))
    node = [*LEVELS, "epoch"]
    sums = drawn.groupBy(*node, "slice").agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy(*node).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = stage(sums.select(*node, "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), "n"), "mix-slices")
    drawn = drawn.join(sums, [*node, "slice"]).where(F.col("before") <= F.col("left"))
    # Slices that fit as a whole are taken as they are; only the slice at the border is ordered.
    whole = drawn.where(F.col("before") + F.col("n") <= F.col("left"))
    border = drawn.where(F.col("before") + F.col("n") > F.col("left"))
    running = Window.partitionBy(*node, "slice").orderBy("place", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    border = border.withColumn("upto", F.col("before") + F.sum("n_tokens").over(running)).where(F.col("upto") <= F.col("left"))
    out = [*LEVELS, "doc_id", F.col("epoch").cast("int").alias("epoch"), "n_tokens"]
    return whole.select(*out).unionByName(border.select(*out))
