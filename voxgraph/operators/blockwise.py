"""Block-wise multicut, and the ways of stitching blocks together."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxgraph.functions.ids import prefix_offsets
from voxgraph.operators.blocking import block_graph, blocks, edges_between_blocks, in_blocks, inner_edges, nodes_to_blocks, outer_edges, subproblem_nodes
from voxgraph.operators.costs import bias
from voxgraph.operators.contraction import solve_whole
from voxgraph.operators.graph import compose, connected_components, contract
from voxgraph.operators.kernels import least_of
from voxgraph.operators.solvers import Limits, solve_edges
from voxgraph.plans.lineage import cut, large


def _cuts(rows: pd.DataFrame, key: Sequence[str], name: str, limits: Limits) -> pd.DataFrame:
    """(key, u, v, is_cut) of whole groups, which need not be in order.

    Attracting edges make parts of each group.  Where no edge within a part repels, parts are the group's best partition, which all groups
    get at once; only the others are left to the solver.
    """
    group = rows.groupby(list(key), sort=False).ngroup().to_numpy()
    u, v, cost = (rows[c].to_numpy() for c in ("u", "v", "cost"))
    node, at = np.unique(np.stack([np.tile(group, 2), np.concatenate([u, v])]), axis=1, return_inverse=True)
    a, b = at.reshape(2, -1)
    pull = cost > 0
    part = least_of(node.shape[1], a[pull], b[pull])
    is_cut = (part[a] != part[b]).astype(np.int32)
    hard = np.unique(group[(cost < 0) & (is_cut == 0)])
    left = np.flatnonzero(np.isin(group, hard))
    left = left[np.argsort(group[left], kind="stable")]
    for own in np.split(left, np.flatnonzero(np.diff(group[left])) + 1) if len(left) else []:
        nodes, labels, _ = solve_edges(u[own], v[own], cost[own], name, limits.fresh())
        is_cut[own] = labels[np.searchsorted(nodes, u[own])] != labels[np.searchsorted(nodes, v[own])]
    return rows[[*key, "u", "v"]].assign(is_cut=is_cut)


def solve_groups(edges: DataFrame, key: Sequence[str], name: str = "fm-kl", limits: Limits | None = None) -> DataFrame:
    """(key, u, v, is_cut): every group of edges solved as a problem of its own.

    Groups come in order, many small ones in a batch; a task holds a batch and the group that goes on in the next one.
    """
    kinds, limits = dict(edges.dtypes), limits or Limits()

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # of one group
        for rows in batches:
            if rows.empty:
                continue
            if held and not (held[-1][list(key)].iloc[-1] == rows[list(key)].iloc[0]).all():
                yield _cuts(pd.concat(held), key, name, limits)
                held = []
            last = np.flatnonzero((rows[list(key)] == rows[list(key)].iloc[-1]).all(axis=1).to_numpy())[0]
            if last:
                yield _cuts(pd.concat([*held, rows.iloc[:last]]), key, name, limits)
                held = []
            held.append(rows.iloc[last:])
        if held:
            yield _cuts(pd.concat(held), key, name, limits)

    schema = ", ".join(f"{c} {kinds[c]}" for c in (*key, "u", "v")) + ", is_cut int"
    return edges.select(*key, "u", "v", "cost").repartition(*key).sortWithinPartitions(*key).mapInPandas(solve, schema)


def merge_cuts(edges: DataFrame, cuts: DataFrame) -> DataFrame:
    """Edges with is_cut: cut if any block cuts them, and if no block holds them."""
    any_cut = cuts.groupBy("u", "v").agg(F.max("is_cut").alias("is_cut"))
    return edges.join(large(any_cut), ["u", "v"], "left").withColumn("is_cut", F.coalesce("is_cut", F.lit(1)))


def solve_blocks(edges: DataFrame, block_nodes: DataFrame, name: str = "fm-kl", cut_outer: bool = True, limits: Limits | None = None) -> DataFrame:
    """Edges with is_cut from the sub-problems of all blocks; edges that leave a block are cut too, unless told otherwise."""
    inner = inner_edges(edges.select("u", "v", "cost"), block_nodes)
    cuts = solve_groups(inner, ["block_id"], name, limits).select("u", "v", "is_cut")
    if cut_outer:
        cuts = cuts.unionByName(outer_edges(edges.select("u", "v", "cost"), block_nodes).select("u", "v", F.lit(1).alias("is_cut")))
    return merge_cuts(edges, cuts)


def node_table(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    known = edges.select(F.col("u").alias("node")).union(edges.select("v"))
    return (known if nodes is None else known.union(nodes.select("node"))).distinct()


def reduce_problem(edges: DataFrame, solved: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges of the contracted problem, map of nodes): nodes joined by uncut edges become one, named by the least."""
    comp = connected_components(solved.where("is_cut = 0"))
    node_map = nodes.select("node").join(large(comp), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    node_map = cut(node_map)
    return cut(contract(edges, node_map)), node_map


class Hierarchy:
    """Levels of block-wise solving; blocks double with each level, the halo stays."""

    def __init__(self, voxels: DataFrame, edges: DataFrame, shape: Sequence[int], block: Sequence[int], overlap: Sequence[int], levels: int = 1, name: str = "kl", seg: str = "seg", skip_slices: DataFrame | None = None, limits: Limits | None = None):
        self.voxels, self.shape, self.block, self.overlap, self.seg, self.name, self.skip, self.limits = voxels, shape, block, overlap, seg, name, skip_slices, limits
        edges = cut(edges.select("u", "v", "cost"))
        regions = voxels.select(F.col(seg).alias("node")).distinct()
        self.edges = [edges]
        self.maps = [regions.select("node", F.col("node").alias("component"))]
        self.solved: list[DataFrame] = []
        for level in range(levels):
            solved = cut(solve_blocks(self.edges[-1], self.block_nodes(level), name, limits=limits))
            reduced, to = reduce_problem(self.edges[-1], solved, node_table(self.edges[-1], self.maps[-1].select(F.col("component").alias("node"))))
            self.solved.append(solved)
            self.edges.append(reduced)
            self.maps.append(cut(compose(self.maps[-1], to)))

    def boxes(self, level: int) -> DataFrame:
        return blocks(self.voxels.sparkSession, self.shape, self._block(level), self.overlap)

    def _block(self, level: int) -> list[int]:
        return [b * 2**level for b in self.block]

    def block_nodes(self, level: int) -> DataFrame:
        """(block_id, node) in the numbering of the level's problem."""
        own = nodes_to_blocks(self.voxels, self.shape, self._block(level), self.overlap, self.seg, self.skip)
        return subproblem_nodes(own, self.maps[level])

    def finish(self, partition: DataFrame) -> DataFrame:
        """(node, component) of the original regions from a partition of the last problem; nodes without an edge stay alone."""
        last = self.maps[-1].join(large(partition.select(F.col("node").alias("component"), F.col("component").alias("_p"))), "component", "left")
        return last.select("node", F.coalesce("_p", "component").alias("component"))


def multicut(h: Hierarchy, name: str = "fm-kl", limits: Limits | None = None) -> DataFrame:
    """The reduced problem solved as a whole."""
    return h.finish(solve_whole(h.edges[-1], name, limits))


def no_stitching(h: Hierarchy) -> DataFrame:
    """Blocks as they are."""
    return h.maps[-1].select("node", "component")


def stitch_attractive(h: Hierarchy, boundary_bias: float = 0.5) -> DataFrame:
    """Merge across blocks wherever an edge that leaves a block attracts more than the bias."""
    last = len(h.edges) - 1
    crossing = outer_edges(h.edges[-1], subproblem_nodes(nodes_to_blocks(h.voxels, h.shape, h._block(max(0, last - 1)), h.overlap, h.seg, h.skip), h.maps[-1])).drop("block_id").distinct()
    return h.finish(connected_components(crossing.where(F.col("cost") > bias(boundary_bias))))


def stitch_multicut(h: Hierarchy, name: str = "kl") -> DataFrame:
    """A small multicut for every pair of neighbouring blocks, over the nodes of their common halo and the edges between them; any cut wins and what no pair covers stays cut."""
    level = max(0, len(h.edges) - 2)
    boxes = h.boxes(level)
    pairs = block_graph(boxes)
    own = subproblem_nodes(nodes_to_blocks(h.voxels, h.shape, h._block(level), h.overlap, h.seg, h.skip), h.maps[-1])
    edges = h.edges[-1]
    between = edges_between_blocks(edges, own, pairs)
    # Nodes meet by pairs of blocks, so that a node of many blocks does not make all pairs of them.
    shared = own.withColumnRenamed("block_id", "a").join(large(pairs), "a").join(large(own.withColumnRenamed("block_id", "b")), ["b", "node"]).select("a", "b", "node")
    nodes = shared.unionByName(between.select("a", "b", F.col("u").alias("node"))).unionByName(between.select("a", "b", F.col("v").alias("node"))).distinct()
    held = edges.join(large(nodes.withColumnRenamed("node", "u")), "u").join(large(nodes.withColumnRenamed("node", "v")), ["a", "b", "v"])
    solved = merge_cuts(edges, solve_groups(held.select("a", "b", "u", "v", "cost"), ["a", "b"], name, h.limits))
    return h.finish(connected_components(solved.where("is_cut = 0")))


def block_segmentation(h: Hierarchy) -> DataFrame:
    """(block_id, z, y, x, label): each block's own segmentation of its box with halo."""
    nodes = h.maps[min(1, len(h.maps) - 1)]
    v = in_blocks(h.voxels.select("z", "y", "x", F.col(h.seg).alias("node")), h.shape, h.block, h.overlap)
    return v.join(nodes, "node").select("block_id", "z", "y", "x", F.col("component").alias("label"))


def block_label_offsets(block_voxels: DataFrame) -> DataFrame:
    """(block_id, offset): running sums that keep the blocks' own labels apart."""
    return prefix_offsets(block_voxels.groupBy("block_id").agg((F.max("label") + 1).alias("size")), "block_id", "size").select("block_id", "offset")


def overlaps(block_voxels: DataFrame) -> DataFrame:
    """(a, la, b, lb, n, share): labels of two blocks that meet in voxels; share is the mean of both normalised overlaps.

    Voxels are grouped by position, where only the few blocks of a halo meet, so pairs are made within a voxel.
    """
    per = block_voxels.groupBy("z", "y", "x").agg(F.array_sort(F.collect_list(F.struct("block_id", "label"))).alias("m")).where(F.size("m") > 1)
    two = per.select(F.explode("m").alias("p"), "m").select("p", F.explode("m").alias("q")).where("p.block_id < q.block_id")
    n = two.groupBy(F.col("p.block_id").alias("a"), F.col("p.label").alias("la"), F.col("q.block_id").alias("b"), F.col("q.label").alias("lb")).agg(F.count("*").alias("n"))
    wa, wb = Window.partitionBy("a", "b", "la"), Window.partitionBy("a", "b", "lb")
    return n.withColumn("share", (F.col("n") / F.sum("n").over(wa) + F.col("n") / F.sum("n").over(wb)) / 2)


def best_partners(pairs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """For each label of the first block the partner of greatest share, the smaller of equals, if it exceeds the threshold."""
    best = pairs.groupBy("a", "b", "la").agg(F.max(F.struct("share", (-F.col("lb")).alias("o"), "n")).alias("m"))
    return best.where(F.col("m.share") > threshold).select("a", "la", "b", (-F.col("m.o")).alias("lb"), F.col("m.share").alias("share"))


def stitch_overlap(block_voxels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(block_id, label, component): block labels merged along best partners, on unique numbers."""
    offsets = block_label_offsets(block_voxels)
    links = best_partners(overlaps(block_voxels), threshold)
    for side, label in (("a", "la"), ("b", "lb")):
        links = links.join(offsets.select(F.col("block_id").alias(side), F.col("offset").alias(f"o{side}")), side).withColumn(f"n{side}", F.col(label) + F.col(f"o{side}"))
    comp = connected_components(links, "na", "nb")
    own = block_voxels.select("block_id", "label").distinct().join(offsets, "block_id").withColumn("node", F.col("label") + F.col("offset"))
    return own.join(comp, "node", "left").select("block_id", "label", F.coalesce("component", "node").alias("component"))


def _in_blocks(edges: DataFrame, block_nodes: DataFrame, names: Sequence[str], limits: Limits) -> DataFrame:
    """(block_id, solver, energy, bound, proven, seconds): every block by every solver; bound and proven are null where a solver proves nothing."""
    held = inner_edges(edges.select("u", "v", "cost"), block_nodes)
    runs = held.select("block_id", "u", "v", "cost", F.explode(F.array(*map(F.lit, names))).alias("solver"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = limits.fresh()
        _, _, energy = solve_edges(rows.u.to_numpy(), rows.v.to_numpy(), rows.cost.to_numpy(), rows.solver.iloc[0], own)
        proof = own.proof
        known = {"bound": [proof.bound if proof else None], "proven": [proof.proven if proof else None]}
        return pd.DataFrame({"block_id": rows.block_id.iloc[:1], "solver": rows.solver.iloc[:1], "energy": energy, **{k: pd.Series(v, dtype=object, index=rows.index[:1]) for k, v in known.items()}, "seconds": own.spent()})

    kind = dict(held.dtypes)["block_id"]
    return runs.groupBy("block_id", "solver").applyInPandas(run, f"block_id {kind}, solver string, energy double, bound double, proven boolean, seconds double")


def block_bounds(edges: DataFrame, block_nodes: DataFrame, limits: Limits | None = None) -> DataFrame:
    """(block_id, energy, bound, gap, proven): the exact solver on every block, and how far its partition may be from the best."""
    found = _in_blocks(edges, block_nodes, ["ilp"], limits or Limits())
    return found.select("block_id", "energy", "bound", F.greatest(F.col("energy") - F.col("bound"), F.lit(0.0)).alias("gap"), "proven")


def compare_solvers(edges: DataFrame, block_nodes: DataFrame, names: Sequence[str], n_blocks: int = 5, seconds: float = 36_000.0) -> DataFrame:
    """(solver, blocks, energy, seconds): mean energy and mean time of solvers over some blocks, drawn without replacement.

    Blocks are drawn in the order of a multiplicative generator started from their numbers, so that the draw can be repeated.
    """
    drawn = (F.col("block_id").cast("long") + 1) * 48271 % 2147483647
    chosen = block_nodes.select("block_id").distinct().orderBy(drawn).limit(n_blocks)
    solved = _in_blocks(edges, block_nodes.join(chosen, "block_id"), names, Limits(seconds=seconds))
    return solved.groupBy("solver").agg(F.count("*").alias("blocks"), F.avg("energy").alias("energy"), F.avg("seconds").alias("seconds"))
