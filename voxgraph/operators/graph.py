"""Connected components by contraction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxgraph.plans.lineage import cut, large


#: Edges up to which a round sends its pointers to every executor, and edges of a partition there.
FEW, FEW_ROWS = 50_000, 8_192


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", write: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """(node, component) of every node that has an edge; a component is named by its least node.

    Each round points every node at its least neighbour (or itself), follows
    the pointers to their ends by doubling and contracts the edges.  Nodes that
    point elsewhere vanish, so that a round halves the nodes at least, and the
    steps that pointers take at once grow threefold with each table.  Groupings are combined
    before the shuffle, and joins on a hub are split by adaptive execution.
    A round of few edges joins without a shuffle and stands in few partitions, as each
    shuffle leaves files for each of its tasks.
    ``write`` cuts the lineage of each step's table.  Null endpoints are ignored, self loops make a node known, no edges give no
    rows.
    """
    pairs = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null")
    loops = pairs.where("u = v").select(F.col("u").alias("node"))
    left = write(pairs.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    first = left
    labels = None
    while n := left.count():

        def side(df: DataFrame, few: bool = n <= FEW) -> DataFrame:
            return F.broadcast(df) if few else large(df)

        def dealt(df: DataFrame, n: int = n) -> DataFrame:
            return df.coalesce(1 + n // FEW_ROWS) if n <= FEW else df

        left = dealt(left)
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = write(dealt(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low")).select("node", F.least("node", "low").alias("to"))))
        while True:
            # Two steps for each table that is written: most pointers end after that.
            ahead = to.select(F.col("node").alias("to"), F.col("to").alias("next"))
            once = to.join(side(ahead), "to").select("node", F.col("next").alias("to"))
            moved = write(once.join(side(ahead), "to").select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")))
            to = moved.select("node", "to")
            if moved.where("moved").isEmpty():
                break
        if labels is None:
            labels = to
        else:
            later = to.select(F.col("node").alias("to"), F.col("to").alias("next"))
            labels = write(labels.join(side(later), "to", "left").select("node", F.coalesce("next", "to").alias("to")))
        a = to.select(F.col("node").alias("u"), F.col("to").alias("a"))
        b = to.select(F.col("node").alias("v"), F.col("to").alias("b"))
        left = write(dealt(left.join(side(a), "u").join(side(b), "v").where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()))
    if labels is None:
        labels = first.select(F.col("u").alias("node"), F.col("v").alias("to"))
    alone = loops.distinct().join(large(labels.select("node")), "node", "left_anti").select("node", F.col("node").alias("to"))
    return labels.unionByName(alone).select("node", F.col("to").alias("component"))


def merged(edges: DataFrame, nodes: DataFrame, cut_flag: str = "is_cut") -> DataFrame:
    """(node, component) of all nodes after merging along edges that are not cut."""
    comp = connected_components(edges.where(F.col(cut_flag) == 0))
    return nodes.select("node").join(comp, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def contract(edges: DataFrame, node_map: DataFrame, old: str = "node", new: str = "component", cost: str = "cost") -> DataFrame:
    """(u, v, cost): edges between merged nodes, parallel ones summed, loops dropped."""
    a = node_map.select(F.col(old).alias("u"), F.col(new).alias("a"))
    b = node_map.select(F.col(old).alias("v"), F.col(new).alias("b"))
    mapped = edges.join(large(a), "u").join(large(b), "v").where("a <> b")
    return mapped.groupBy(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).agg(F.sum(cost).alias(cost))


def compose(first: DataFrame, second: DataFrame) -> DataFrame:
    """(node, component): the second map after the first."""
    later = second.select(F.col("node").alias("component"), F.col("component").alias("last"))
    return first.select("node", "component").join(large(later), "component").select("node", F.col("last").alias("component"))


def members(node_map: DataFrame) -> DataFrame:
    """(component, nodes): the inverse map, with sorted lists."""
    return node_map.groupBy("component").agg(F.array_sort(F.collect_list("node")).alias("nodes"))


def cut_edges(edges: DataFrame, labels: DataFrame, label: str = "component") -> DataFrame:
    """Edges with is_cut: 1 where the ends have different labels."""
    a = labels.select(F.col("node").alias("u"), F.col(label).alias("_a"))
    b = labels.select(F.col("node").alias("v"), F.col(label).alias("_b"))
    return edges.join(a, "u").join(b, "v").withColumn("is_cut", (F.col("_a") != F.col("_b")).cast("int")).select(*edges.columns, "is_cut")


def energy(edges: DataFrame, labels: DataFrame, label: str = "component") -> DataFrame:
    """One row: sum of the costs of cut edges."""
    return cut_edges(edges, labels, label).agg(F.coalesce(F.sum(F.when(F.col("is_cut") == 1, F.col("cost"))), F.lit(0.0)).alias("energy"))
