"""From a segmented volume to a result volume."""

from __future__ import annotations

import functools
import hashlib
import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxgraph.config import Inputs, Params, select_features
from voxgraph.operators import blockwise, contraction, costs, features, kernels, learning, rag, tiles
from voxgraph.operators.defects import bridged, defect_slices, replace_slices, replacement_slices, segments_per_slice, skip_border_values, skip_filter_features
from voxgraph.operators.labels import consecutive
from voxgraph.operators.solvers import Limits
from voxgraph.plans.lineage import cut, large
from voxgraph.sources.volume import AXES, VolumeStore, shift

log = logging.getLogger("voxgraph")
_told: set[str] = set()


def logged(run: Callable) -> Callable:
    """Logs a step's parameters once and its run time always."""

    @functools.wraps(run)
    def wrapper(*args, **kwargs):
        plain = {k: v for k, v in kwargs.items() if isinstance(v, (str, int, float, bool, tuple, list))}
        key = hashlib.md5(f"{run.__name__}{sorted(plain.items())}".encode()).hexdigest()
        if key not in _told:
            _told.add(key)
            log.info("%s with %s", run.__name__, plain)
        began = time.monotonic()
        try:
            return run(*args, **kwargs)
        finally:
            log.info("%s took %.1f s", run.__name__, time.monotonic() - began)

    return wrapper


def config_logger(level: int = logging.INFO, path: str = "workflow.log") -> None:
    handler = logging.FileHandler(path)
    handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    log.addHandler(handler)
    log.setLevel(level)


def project(voxels: DataFrame, partition: DataFrame, seg: str = "seg", ignore_label: int = -1) -> DataFrame:
    """(z, y, x, label): regions of the volume replaced by consecutive numbers of their component from 1; the ignored region is 0.

    The table of regions may be large, and is not sent whole.
    """
    numbers = consecutive(partition, "component", "label", start=1, keep_zeros=False)
    of = partition.join(large(numbers), "component").select("node", F.when(F.col("node") == ignore_label, F.lit(0).cast("long")).otherwise(F.col("label")).alias("label"))
    return voxels.select("z", "y", "x", F.col(seg).alias("node")).join(large(of), "node").select("z", "y", "x", "label")


def finished(voxels: DataFrame, partition: DataFrame, seg: str = "seg", ignore_label: int = -1, defects: DataFrame | None = None, n_slices: int = 0, offset: Sequence[int] | None = None) -> DataFrame:
    """The projected result, with defective slices replaced and moved into a larger frame if asked."""
    out = project(voxels, partition, seg, ignore_label)
    if defects is not None:
        out = replace_slices(out, replacement_slices(defects, n_slices), "label")
    return shift(out, offset) if offset else out


@logged
def multicut_segmentation(voxels: DataFrame, edges: DataFrame, name: str = "fm-kl", limits: Limits | None = None, n_parallel: int = 1, n_fuse: int = 0, **how) -> DataFrame:
    """The whole problem by one solver, or, if several proposals are made side by side, by fusing those with its backend (fm-kl: kl)."""
    if n_parallel > 1 and name.startswith("fm-"):
        part = contraction.parallel_fusion(edges, name.removeprefix("fm-"), limits, n_parallel, n_fuse)
    else:
        part = contraction.solve_whole(edges, name, limits)
    nodes = voxels.select(F.col(how.get("seg", "seg")).alias("node")).distinct()
    whole = nodes.join(part, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    return finished(voxels, whole, **how)


@logged
def blockwise_segmentation(voxels: DataFrame, edges: DataFrame, shape: Sequence[int], block: Sequence[int], overlap: Sequence[int], levels: int = 1, stitching: str = "multicut", sub_solver: str = "kl", solver: str = "fm-kl", boundary_bias: float = 0.5, threshold: float = 0.5, sub_limits: Limits | None = None, limits: Limits | None = None, **how) -> DataFrame:
    """Stitching by a ``multicut`` of the reduced problem, ``attractive`` edges, ``pairs`` of blocks, voxel ``overlap`` or ``none``."""
    h = blockwise.Hierarchy(voxels, edges, shape, block, overlap, levels, sub_solver, how.get("seg", "seg"), limits=sub_limits)
    if stitching == "overlap":
        own = blockwise.block_segmentation(h)
        comp = blockwise.stitch_overlap(own, threshold)
        merged = own.join(comp, ["block_id", "label"]).groupBy("z", "y", "x").agg(F.min("component").alias("node"))
        part = merged.select("node").distinct().select("node", F.col("node").alias("component"))
        return finished(merged, part, **{**how, "seg": "node"})
    ways = {"multicut": lambda: blockwise.multicut(h, solver, limits), "attractive": lambda: blockwise.stitch_attractive(h, boundary_bias), "pairs": lambda: blockwise.stitch_multicut(h, sub_solver), "none": lambda: blockwise.no_stitching(h)}
    if stitching not in ways:
        raise ValueError(f"no way of stitching is named {stitching}")
    return finished(voxels, ways[stitching](), **how)


def subblock_segmentations(h: blockwise.Hierarchy, path: str) -> None:
    """Each block's segmentation as a volume of its own."""
    blockwise.block_segmentation(h).write.mode("overwrite").partitionBy("block_id").parquet(path)


def _column(spark: SparkSession, path: str, key: str, name: str) -> DataFrame:
    """(z, y, x, name) of a volume's table, which has the axes and one column of values."""
    table = VolumeStore(spark, path).open(key)
    (value,) = (c for c in table.columns if c not in AXES)
    return table.select(*AXES, F.col(value).alias(name))


def oversegment(spark: SparkSession, inputs: Inputs, params: Params) -> None:
    """The segmentation of the inputs, by a watershed of every slice of the last data volume, if it does not exist yet."""
    store = VolumeStore(spark, inputs.seg)
    if inputs.seg_key in store:
        return
    if not inputs.data:
        raise ValueError("there is neither a segmentation nor a volume to make one from")
    voxels = _column(spark, inputs.data[-1], inputs.data_keys[-1] if inputs.data_keys else "data", "prob")
    if inputs.mask:
        voxels = voxels.join(_column(spark, inputs.mask, "data", "mask").withColumn("mask", F.col("mask").cast("boolean")), list(AXES))
    made = tiles.wsdt_segmentation(voxels, "prob", params.wsdt_threshold, params.wsdt_sigma_seeds, params.wsdt_min_segment, params.wsdt_invert, "mask" if inputs.mask else None)
    store.write(made, inputs.seg_key)


def read_volumes(spark: SparkSession, inputs: Inputs) -> DataFrame:
    """(z, y, x, seg, d0, d1, ..., and gt and mask if there are): the volumes of a run side by side.

    A volume is a folder of tables by key, with the columns z, y, x and one for its values.  A voxel that one of them lacks is in no
    result; without a mask all are inside.
    """
    named = [("seg", inputs.seg, inputs.seg_key)]
    named += [(f"d{i}", path, inputs.data_keys[i] if inputs.data_keys else "data") for i, path in enumerate(inputs.data)]
    named += [(name, path, "data") for name, path in (("gt", inputs.gt), ("mask", inputs.mask)) if path]
    out = None
    for name, path, key in named:
        one = _column(spark, path, key, name)
        out = one if out is None else out.join(one, list(AXES))
    return out.withColumn("mask", F.col("mask").cast("boolean")) if inputs.mask else out


def inside(voxels: DataFrame) -> DataFrame:
    """The voxels of the mask, which alone have regions, edges and features."""
    return voxels.where("mask") if "mask" in voxels.columns else voxels


@dataclass(frozen=True)
class Problem:
    """The edges of a run, (u, v, edge_type, length), and the defective slices, if there are any: edges are then the modified adjacency."""

    edges: DataFrame
    slices: DataFrame | None = None

    @property
    def kinds(self) -> tuple[str, ...]:
        """Skip edges are a kind of their own where there are any."""
        return ("xy", "z") if self.slices is None or self.edges.where("edge_type = 'skip'").isEmpty() else ("xy", "z", "skip")


def problem_of(voxels: DataFrame, params: Params) -> Problem:
    """The graph of the voxels, bridged over defective slices in defect mode."""
    edges = rag.rag_edges(voxels, ignore_label=params.ignore_seg_label)
    if params.have_defects:
        slices = cut(defect_slices(segments_per_slice(voxels), params.defect_bins, params.defect_bin_threshold))
        if not slices.isEmpty():
            return Problem(cut(bridged(voxels, edges, slices, ignore_label=params.ignore_seg_label)), slices)
    return Problem(cut(edges))


def features_of(voxels: DataFrame, params: Params, n_inputs: int, problem: Problem | None = None) -> dict[str, DataFrame]:
    """By kind of edge: (u, v, edge_type, features) of the chosen features, side by side.

    Filters see whole slices, borders and regions only what is inside the mask; the ignored region, which may be most of a volume, is in
    no group.  With ``ranked_quantiles`` no group of values is held in memory.  Skip edges have the features of edges between slices, from
    the good slices beside the run, and the run's range.
    """
    problem = problem or problem_of(inside(voxels), params)
    own, ranked = inside(voxels).where(F.col("seg") != params.ignore_seg_label), params.ranked_quantiles
    edges = problem.edges.select("u", "v", "edge_type")
    filters: dict[str, DataFrame] = {}
    out: dict[str, DataFrame] = {}
    for kind in problem.kinds:
        skip = kind == "skip"
        tables = []
        for name, number, kinds in select_features(params, n_inputs):
            if ("z" if skip else kind) not in kinds.split(","):
                continue
            value = f"d{number}"
            if name == "reg":
                tables.append(features.region_edge_features(edges, features.region_statistics(own, value, ranked=ranked), (kind,)))
            elif params.use_simple_features and skip:
                tables.append(features.edge_statistics(skip_border_values(own, problem.slices, (value,), z_direction=params.z_affinity_direction), (value,), ranked=ranked))
            elif params.use_simple_features:
                tables.append(features.edge_features(own, value, keep_only_xy=kind == "xy", keep_only_z=kind == "z", z_direction=params.z_affinity_direction, ranked=ranked))
            else:
                if value not in filters:
                    filters[value] = cut(kernels.filtered(voxels, value))
                responses = filters[value]
                channels = [c for c in responses.columns if c not in AXES]
                beside = own.select(*AXES, "seg").join(responses, list(AXES))
                if skip:
                    tables.append(skip_filter_features(beside, problem.slices, channels, z_direction=params.z_affinity_direction, ranked=ranked))
                else:
                    every = features.filter_features(beside, channels, z_direction=params.z_affinity_direction, ranked=ranked)
                    tables.append(every.where(F.col("edge_type") == kind))
        if tables:
            first = problem.edges.select("u", "v", "edge_type", "skip_range") if skip else edges
            out[kind] = cut(features.joined_features(first.where(F.col("edge_type") == kind), *tables))
    return out


def edge_probabilities(spark: SparkSession, voxels: DataFrame, inputs: Inputs, params: Params, problem: Problem | None = None) -> DataFrame:
    """(u, v, edge_type, prob): from the classifier of the inputs, or from one that is learned from the truth (and kept in the cache folder, if there is one).

    Skip edges have a forest of their own, also where the other kinds share one.
    """
    own = inside(voxels)
    problem = problem or problem_of(own, params)
    by_kind = features_of(voxels, params, len(inputs.data), problem)
    separate = [k for k in by_kind if params.separate_edge_classification or k == "skip"]
    shared = [k for k in by_kind if k not in separate]
    if inputs.rf:
        model = learning.EdgeClassifier.load(inputs.rf, [*sorted(separate), *(["joined"] if shared else [])])
    elif inputs.gt:
        truth = cut(costs.edge_truth(problem.edges, costs.node_truth(own), params.ignore_gt_label))
        how = {"n_trees": params.n_trees, "max_depth": params.max_depth}
        models = {k: m for kind in separate for k, m in learning.EdgeClassifier.learn([(by_kind[kind], truth)], **how).models.items()}
        if shared:
            models |= learning.EdgeClassifier.learn([(by_kind[k], truth) for k in shared], separate=False, **how).models
        model = learning.EdgeClassifier(models)
        if inputs.cache:
            model.save(inputs.cache)
    else:
        raise ValueError("the inputs name neither a classifier nor a truth to learn one from")
    made = [learning.EdgeClassifier({k: m for k, m in model.models.items() if k == ("joined" if kind in shared else kind)}).predict(table) for kind, table in by_kind.items()]
    out = made[0]
    for other in made[1:]:
        out = out.unionByName(other)
    return costs.clipped(out)


def limits_of(params: Params) -> tuple[Limits, Limits]:
    """Settings of the solvers of blocks and of the whole or reduced problem."""
    sub = Limits(seconds=params.global_time_limit, iterations=params.fusion_iterations, stop=params.fusion_stop, sigma=params.fusion_sigma, seed_fraction=params.fusion_seed_fraction, visit_nth=params.visit_nth)
    return sub, sub.fresh(stop=params.fusion_stop_global, seed_fraction=params.fusion_seed_fraction_global)


@logged
def segment(spark: SparkSession, inputs: Inputs, params: Params, stitching: str | None = "multicut", levels: int = 1) -> DataFrame:
    """(z, y, x, label): the whole run that inputs and parameters describe, from volumes to the projected result.

    A segmentation that does not exist is made first.  ``stitching`` is a way of ``blockwise_segmentation``; None solves the problem as
    a whole.  Voxels outside the mask have label 0.  Two runs over the same volumes give the same result.  In defect mode, skip edges
    with features, truth and a forest of their own bridge defective slices, whose voxels take the labels of good ones in the end.
    """
    oversegment(spark, inputs, params)
    every = cut(read_volumes(spark, inputs))
    voxels = inside(every)
    graph = problem_of(voxels, params)
    probabilities = edge_probabilities(spark, every, inputs, params, graph)
    problem = cut(costs.multicut_problem(graph.edges, probabilities, params.beta, params.weighting_scheme, params.weight))
    shape = tuple(v + 1 for v in every.agg(*(F.max(a) for a in AXES)).first())
    sub, whole = limits_of(params)
    how: dict = {"ignore_label": params.ignore_seg_label, "n_slices": shape[0]}
    if graph.slices is not None:
        how["defects"] = graph.slices
    if stitching is None:
        made = multicut_segmentation(voxels, problem, name=params.global_solver, limits=whole, n_parallel=params.fusion_parallel, n_fuse=params.fusion_at_once, **how)
    else:
        made = blockwise_segmentation(
            voxels, problem, shape, params.block_shape, params.block_overlap, levels=levels, stitching=stitching, sub_solver=params.sub_solver, solver=params.global_solver,
            boundary_bias=params.beta, threshold=params.overlap_threshold, sub_limits=sub, limits=whole, **how,
        )
    if inputs.mask:
        made = every.select(*AXES).join(made, list(AXES), "left").select(*AXES, F.coalesce("label", F.lit(0)).alias("label"))
    return shift(made, params.offset_front) if any(params.offset_front) else made


def store_result(made: DataFrame, path: str, params: Params, key: str = "data") -> None:
    """A run's result as a volume that knows the margins of the frame in which it lies."""
    store = VolumeStore(made.sparkSession, path)
    store.write(shift(made, [-o for o in params.offset_front]), key)
    store.set_offsets(params.offset_front, params.offset_back, key)
