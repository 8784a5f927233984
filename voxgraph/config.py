"""Parameters of a run, passed explicitly; and the file that names its inputs."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any


@dataclass(frozen=True)
class Params:
    """All settings with their defaults; axis order is (z, y, x)."""

    features: tuple[str, ...] = ("raw", "prob", "reg")
    use_simple_features: bool = False
    ranked_quantiles: bool = False
    z_affinity_direction: int = 2
    ignore_seg_label: int = -1
    ignore_gt_label: int = -1
    separate_edge_classification: bool = True
    n_trees: int = 500
    max_depth: int = 12
    beta: float = 0.5
    weighting_scheme: str = "z"
    weight: float = 16.0
    block_shape: tuple[int, int, int] = (50, 512, 512)
    block_overlap: tuple[int, int, int] = (5, 20, 20)
    global_time_limit: float = 36_000.0
    sub_solver: str = "fm-ilp"
    global_solver: str = "fm-kl"
    fusion_sigma: float = 10.0
    fusion_seed_fraction: float = 0.05
    fusion_seed_fraction_global: float = 1e-5
    fusion_iterations: int = 2500
    fusion_stop: int = 20
    fusion_stop_global: int = 12
    fusion_parallel: int = 1
    fusion_at_once: int = 0
    visit_nth: int = 0
    wsdt_threshold: float = 0.2
    wsdt_min_segment: int = 75
    wsdt_sigma_seeds: float = 2.6
    wsdt_invert: bool = False
    overlap_threshold: float = 0.5
    defect_bins: int = 16
    defect_bin_threshold: int = 2
    have_defects: bool = False
    offset_front: tuple[int, int, int] = (0, 0, 0)
    offset_back: tuple[int, int, int] = (0, 0, 0)

    def with_values(self, **changes: Any) -> Params:
        return replace(self, **changes)


@dataclass(frozen=True)
class Inputs:
    """Where a run's volumes lie: data volumes in order, segmentation, and optionally truth, classifier and mask."""

    seg: str
    data: tuple[str, ...] = ()
    gt: str | None = None
    rf: str | None = None
    mask: str | None = None
    cache: str = ""
    data_keys: tuple[str, ...] = ()
    seg_key: str = "data"
    extra: Mapping[str, Any] = field(default_factory=dict)


def read_inputs(source: str | Mapping[str, Any]) -> Inputs:
    """Inputs from a JSON file or a mapping; a segmentation is required, and keys must match the data volumes."""
    if isinstance(source, str):
        with open(source, encoding="utf-8") as f:
            source = json.load(f)
    known = dict(source)
    if "seg" not in known:
        raise ValueError("the inputs name no segmentation")
    keys = dict(known.pop("keys", {}))
    data = tuple(known.pop("data", ()))
    data_keys = tuple(keys.get("data", ()))
    if data_keys and len(data_keys) != len(data):
        raise ValueError("there must be one key for each data volume")
    inputs = Inputs(seg=known.pop("seg"), data=data, data_keys=data_keys, seg_key=keys.get("seg", "data"), **{k: known.pop(k) for k in ("gt", "rf", "mask", "cache") if k in known}, extra=known)
    if inputs.cache and "://" not in inputs.cache:
        os.makedirs(inputs.cache, exist_ok=True)
    return inputs


def select_features(params: Params, n_inputs: int) -> list[tuple[str, int, str]]:
    """(feature, number of the input it reads, edge types) for the chosen names; unknown names are ignored.

    Input 0 is raw, 1 the probability or the in-slice affinity, 2 the affinity between slices.
    """
    plan = {"raw": (0, "xy,z"), "prob": (1, "xy,z"), "affinitiesXY": (1, "xy"), "affinitiesZ": (2, "z"), "reg": (0, "xy,z")}
    out = []
    for name in params.features:
        if name in plan:
            number, kinds = plan[name]
            if number >= n_inputs:
                raise ValueError(f"feature {name} needs input {number}")
            out.append((name, number, kinds))
    return out
