"""Multicuts of graphs of any size: parts that attract, contraction in rounds, and proposals that are fused."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxgraph.operators.graph import connected_components, contract
from voxgraph.operators.solvers import Limits, Problem, proposal, prove, solve_edges
from voxgraph.plans.lineage import settled as cut

#: Edges of one problem that a task takes; larger ones are contracted first.
TASK_EDGES = 500_000
#: Rounds of contraction between two looks at the parts.
ROUNDS = 5


def simple(edges: DataFrame) -> DataFrame:
    """(u, v, cost): one row for each pair of nodes, parallel costs summed, loops dropped."""
    return edges.where("u <> v").groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.sum("cost").alias("cost"))


def in_parts(edges: DataFrame) -> DataFrame:
    """(part, u, v, cost) of the edges within parts that attracting edges connect.

    Nothing is lost: whatever lies between such parts repels, and is cut in every best partition, so that the parts are problems
    of their own.
    """
    part = connected_components(edges.where("cost > 0"), write=cut)
    a = part.select(F.col("node").alias("u"), F.col("component").alias("part"))
    b = part.select(F.col("node").alias("v"), F.col("component").alias("_b"))
    return edges.join(a, "u").join(b, "v").where("part = _b").select("part", "u", "v", "cost")


def mutual(edges: DataFrame) -> DataFrame:
    """(u, v): edges that attract and that both ends prefer to all others; equal costs are ordered by a hash, so that chains of them pair up."""
    order = F.struct("cost", F.xxhash64("u", "v").alias("h"), "u", "v")
    ends = edges.where("cost > 0").select(F.explode(F.array("u", "v")).alias("node"), order.alias("e"))
    best = ends.groupBy("node").agg(F.max("e").alias("e"))
    return best.groupBy(F.col("e.u").alias("u"), F.col("e.v").alias("v")).agg(F.count("*").alias("n")).where("n = 2").select("u", "v")


def contract_pairs(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Edges after each pair became its lesser node."""
    to = pairs.select(F.col("v").alias("node"), F.col("u").alias("to"))
    a, b = to.select(F.col("node").alias("u"), F.col("to").alias("_a")), to.select(F.col("node").alias("v"), F.col("to").alias("_b"))
    moved = edges.join(a, "u", "left").join(b, "v", "left").select(F.coalesce("_a", "u").alias("u"), F.coalesce("_b", "v").alias("v"), "cost")
    return simple(moved)


def named(nodes: DataFrame, merges: DataFrame) -> DataFrame:
    """(node, component): nodes joined along merges, named by the least of them; the others alone."""
    comp = connected_components(merges, write=cut)
    return nodes.select("node").join(comp, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()


def sizes(parts: DataFrame) -> DataFrame:
    """(part, n, low, whole): edges of each part, the sum of those that repel, and whether there are none.

    A whole part is solved as it stands, whatever its size: attracting edges connect it, so that every partition but that of one set
    pays for some of them, and none repels.
    """
    return parts.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.least("cost", F.lit(0.0))).alias("low"), (F.min("cost") >= 0).alias("whole"))


def _fitting(edges: DataFrame, task_edges: int) -> tuple[DataFrame, DataFrame | None]:
    """(parts that fit a task, pairs merged to get there).

    Whole parts are merged at once.  Others that are too large are contracted in rounds: every node names the attracting edge of greatest
    cost, edges that both ends name are contracted, and parallel costs are summed.  An edge that is greatest at both ends is what
    contraction one by one comes to as well, unless sums overtake it first.  Parts shrink and fall apart by that, until all of them fit.
    """
    own = cut(in_parts(edges))
    fit, work, merges = None, own, None
    while True:
        size = cut(sizes(work))
        together = cut(work.join(size.where("whole").select("part"), "part", "left_semi").select(F.col("part").alias("u"), F.explode(F.array("u", "v")).alias("v")).distinct())
        if not together.isEmpty():
            merges = together if merges is None else merges.unionByName(together)
        large = size.where((F.col("n") > task_edges) & ~F.col("whole")).select("part")
        small = work.join(size.where((F.col("n") <= task_edges) & ~F.col("whole")).select("part"), "part", "left_semi")
        fit = small if fit is None else fit.unionByName(small)
        work = cut(work.join(large, "part", "left_semi"))
        if work.isEmpty():
            return fit, merges
        left = work.select("u", "v", "cost")
        for _ in range(ROUNDS):
            pairs = cut(mutual(left))
            merges = pairs if merges is None else merges.unionByName(pairs)
            left = cut(contract_pairs(left, pairs))
        work = cut(in_parts(left))


def solve_parts(parts: DataFrame, name: str, limits: Limits, key: str = "part") -> DataFrame:
    """(key, node, component): each part solved in a task of its own; components are named by their least node."""
    kind = dict(parts.dtypes)[key]

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        nodes, labels, _ = solve_edges(rows.u.to_numpy(), rows.v.to_numpy(), rows.cost.to_numpy(), name, limits.fresh())
        least = np.full(labels.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, labels, nodes)
        return pd.DataFrame({key: rows[key].iloc[0], "node": nodes, "component": least[labels]})

    return parts.select(key, "u", "v", "cost").groupBy(key).applyInPandas(solve, f"{key} {kind}, node long, component long")


def solve_whole(edges: DataFrame, name: str = "fm-kl", limits: Limits | None = None, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, component) of a problem of any size; no task gets more than ``task_edges`` edges.

    The solver gets the attracting parts one by one; a part that is too large for a task is contracted before, along edges that both
    ends prefer.
    """
    edges = cut(edges.select("u", "v", "cost"))
    fit, merges = _fitting(simple(edges), task_edges)
    solved = solve_parts(fit, name, limits or Limits()).select(F.col("component").alias("u"), F.col("node").alias("v"))
    links = cut(solved if merges is None else solved.unionByName(merges))
    return named(nodes_of(edges), links)


def bounds(edges: DataFrame, limits: Limits | None = None, task_edges: int = TASK_EDGES) -> DataFrame:
    """One row (parts, energy, bound, gap, proven): what the exact solver finds over all parts, and what no partition can be below.

    Whole parts cost nothing and need no task.  Of other parts that are too large for a task only the trivial bound is known, and the
    energy of contraction.
    """
    limits = limits or Limits()
    every = cut(simple(edges.select("u", "v", "cost")))
    own = cut(in_parts(every))
    outer = every.agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("c")).crossJoin(own.agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("i"))).select((F.col("c") - F.col("i")).alias("outer"))
    size = cut(sizes(own))
    large = cut(size.where((F.col("n") > task_edges) & ~F.col("whole")))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        nodes, at = np.unique(np.concatenate([rows.u, rows.v]), return_inverse=True)
        found = prove(Problem(len(nodes), at.reshape(2, -1).T.copy(), rows.cost.to_numpy()), limits.fresh())
        return pd.DataFrame({"energy": [found.energy], "bound": [found.bound], "proven": [found.proven]})

    fit = size.where((F.col("n") <= task_edges) & ~F.col("whole")).select("part")
    small = own.join(fit, "part", "left_semi").groupBy("part").applyInPandas(run, "energy double, bound double, proven boolean")
    small = small.unionByName(size.where("whole").select(F.lit(0.0).alias("energy"), F.lit(0.0).alias("bound"), F.lit(True).alias("proven")))
    if not large.isEmpty():
        big = own.join(large.select("part"), "part", "left_semi").select("u", "v", "cost")
        label = cut(solve_whole(big, "greedy", limits, task_edges))
        paid = cut(contract(big, label)).agg(F.coalesce(F.sum("cost"), F.lit(0.0)).alias("energy"))
        small = small.unionByName(paid.crossJoin(large.agg(F.sum("low").alias("bound"))).select("energy", "bound", F.lit(False).alias("proven")))
    total = small.agg(F.count("*").alias("parts"), F.coalesce(F.sum("energy"), F.lit(0.0)).alias("e"), F.coalesce(F.sum("bound"), F.lit(0.0)).alias("b"), F.coalesce(F.bool_and("proven"), F.lit(True)).alias("proven"))
    return total.crossJoin(outer).select("parts", (F.col("e") + F.col("outer")).alias("energy"), (F.col("b") + F.col("outer")).alias("bound"), F.greatest(F.col("e") - F.col("b"), F.lit(0.0)).alias("gap"), "proven")


def _propose(parts: DataFrame, limits: Limits, numbers: Sequence[int]) -> DataFrame:
    """(part, k, node, label): one proposal for each part and number, each in a task of its own."""
    runs = parts.select("part", "u", "v", "cost", F.explode(F.array(*map(F.lit, numbers))).alias("k"))

    def make(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["u", "v"])
        part, k = int(rows.part.iloc[0]), int(rows.k.iloc[0])
        nodes, at = np.unique(np.concatenate([rows.u, rows.v]), return_inverse=True)
        p = Problem(len(nodes), at.reshape(2, -1).T.copy(), rows.cost.to_numpy())
        labels = proposal(p, limits, np.random.default_rng([limits.seed, k, zlib.crc32(str(part).encode())]))
        return pd.DataFrame({"part": part, "k": k, "node": nodes, "label": labels})

    return runs.groupBy("part", "k").applyInPandas(make, "part long, k int, node long, label long")


def fused(parts: DataFrame, now: DataFrame, proposals: DataFrame, backend: str, limits: Limits) -> DataFrame:
    """(part, node, component): the best that the backend finds among partitions that keep together what the present one and all proposals keep together.

    Nodes with the same tuple of labels are one node of the fused problem, which is small.
    """
    every = proposals.unionByName(now.select("part", F.lit(-1).alias("k"), "node", F.col("component").alias("label")))
    tuples = every.groupBy("part", "node").agg(F.array_sort(F.collect_list(F.struct("k", "label"))).alias("t"))  # one label for each proposal
    cell = cut(tuples.join(tuples.groupBy("part", "t").agg(F.min("node").alias("cell")), ["part", "t"]).select("part", "node", "cell"))
    a, b = cell.select("part", F.col("node").alias("u"), F.col("cell").alias("_a")), cell.select("part", F.col("node").alias("v"), F.col("cell").alias("_b"))
    small = parts.join(a, ["part", "u"]).join(b, ["part", "v"]).where("_a <> _b").groupBy("part", F.least("_a", "_b").alias("u"), F.greatest("_a", "_b").alias("v")).agg(F.sum("cost").alias("cost"))
    solved = solve_parts(small, backend, limits.of_proof()).select("part", F.col("node").alias("cell"), "component")
    return cell.join(solved, ["part", "cell"], "left").select("part", "node", F.coalesce("component", "cell").alias("component"))


def part_energies(parts: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, energy)."""
    a, b = labels.select("part", F.col("node").alias("u"), F.col("component").alias("_a")), labels.select("part", F.col("node").alias("v"), F.col("component").alias("_b"))
    paid = F.when(F.col("_a") != F.col("_b"), F.col("cost")).otherwise(0.0)
    return parts.join(a, ["part", "u"]).join(b, ["part", "v"]).groupBy("part").agg(F.sum(paid).alias("energy"))


def parallel_fusion(edges: DataFrame, backend: str = "kl", limits: Limits | None = None, n_parallel: int = 4, n_fuse: int = 0, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, component): Kernighan-Lin, then rounds of ``n_parallel`` proposals made side by side.

    ``n_fuse`` proposals at a time are fused with the best partition, all of a round if it is 0.  A part takes the new partition only
    if its energy falls.  Rounds end after ``limits.iterations`` proposals, or once ``limits.stop`` of them in a row help no part.
    """
    limits = limits or Limits()
    edges = cut(edges.select("u", "v", "cost"))
    fit, merges = _fitting(simple(edges), task_edges)
    parts = cut(fit)
    now = cut(solve_parts(parts, "kl", limits))
    energy = cut(part_energies(parts, now))
    made = idle = 0
    while made < limits.iterations and idle < limits.stop and not limits.over():
        numbers = list(range(made, min(made + n_parallel, limits.iterations)))
        proposals = cut(_propose(parts, limits, numbers))
        for at in range(0, len(numbers), n_fuse or len(numbers)):
            some = numbers[at : at + (n_fuse or len(numbers))]
            new = cut(fused(parts, now, proposals.where(F.col("k").isin(some)), backend, limits))
            fresh = cut(part_energies(parts, new))
            better = cut(fresh.join(energy.withColumnRenamed("energy", "_old"), "part").where(F.col("energy") < F.col("_old") - 1e-9).select("part", "energy"))
            if better.isEmpty():
                idle += len(some)
                continue
            idle = 0
            now = cut(now.join(better.select("part"), "part", "left_anti").unionByName(new.join(better.select("part"), "part", "left_semi")))
            energy = cut(energy.join(better.select("part"), "part", "left_anti").unionByName(better))
        made += len(numbers)
    links = now.select(F.col("component").alias("u"), F.col("node").alias("v"))
    return named(nodes_of(edges), cut(links if merges is None else links.unionByName(merges)))
