"""Connected components of a links table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import discard, saved


def components(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``; a component is its smallest node.

    Each round hooks every node to its smallest neighbour, follows the hooks
    once more, and contracts the links to the hooks' ends; the links that are
    left at least halve, and chains shorten by the doubling. Links and hooks
    live in written tables; nothing is collected. Links of a node to itself
    and repeated links do no harm.
    """
    # both directions from one pass over the links
    both = links.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    edges = saved(both.where("a != b").distinct(), "links")
    of = None  # node -> the node that stands for it so far
    for _ in range(most_rounds):
        if edges.isEmpty():
            break
        first = saved(edges.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("to")), "hooks")
        # a hook's end may be hooked further
        further = first.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
        hooks = saved(first.join(further, "to", "left").select("node", F.coalesce("beyond", "to").alias("to")), "hooks")
        ends = hooks.select(F.col("node").alias("a"), F.col("to").alias("x"))
        other = hooks.select(F.col("node").alias("b"), F.col("to").alias("y"))
        left = saved(edges.join(ends, "a").join(other, "b").where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "links")
        discard(first, edges)
        edges = left
        if of is None:
            of = hooks
        else:
            step = hooks.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
            further = saved(of.join(step, "to", "left").select("node", F.coalesce("beyond", "to").alias("to")), "hooks")
            discard(of, hooks)
            of = further
    else:
        raise RuntimeError("components: too many rounds")
    if of is None:
        of = both.select(F.col("a").alias("node"), F.col("a").alias("to")).distinct()
    return of.select("node", F.col("to").alias("component"))
