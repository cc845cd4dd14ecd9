"""Distributed connected components by minimum-neighbour hooking and contraction.

Every round each node hooks to its smallest neighbour, pointers are doubled twice, and
the edges are contracted to the new labels; at least every node that is not a local
minimum disappears, so rounds grow with the logarithm of the longest path, not with the
size of a component.  Minima are pre-aggregated and tables are written between rounds,
so a hub with any number of neighbours neither gathers in one task nor grows a lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def connected(edges: DataFrame, tmp: Scratch, name: str = "cc") -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); component is the smallest node.

    Null ends and self-loops are left out; repeated edges don't matter.
    """
    once = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))  # noqa: E731  an edge is one row, whichever way it is given
    live = edges.where("a is not null and b is not null and a != b").select(*once("a", "b")).distinct()
    live = tmp.save(live, f"{name}-edges-0")
    labels = tmp.save(live.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("component")), f"{name}-labels-0")
    step = 0
    while not live.isEmpty():
        step += 1
        both = live.union(live.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("up"))
        hook = tmp.save(hook, f"{name}-hook-{step}")
        double = lambda h: h.join(h.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", F.col("top").alias("up"))
        far = tmp.save(double(double(hook)), f"{name}-far-{step}")
        to = lambda c: far.select(F.col("node").alias(c), F.col("up").alias(f"{c}2"))
        labels = tmp.save(labels.join(to("component"), "component", "left").select("node", F.coalesce("component2", "component").alias("component")), f"{name}-labels-{step}")
        live = live.join(to("a"), "a").join(to("b"), "b").where("a2 != b2").select(*once("a2", "b2")).distinct()
        live = tmp.save(live, f"{name}-edges-{step}")
        tmp.drop(f"{name}-edges-{step - 1}", f"{name}-labels-{step - 1}", f"{name}-hook-{step}", f"{name}-far-{step}")
    return labels
