"""Image kernels on slices, in numpy, and the operators that run one slice in one task."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_SIGMAS = (1.6, 4.2, 8.3)


def distance_squared(mask: np.ndarray) -> np.ndarray:
    """Squared Euclidean distance to the nearest true pixel: along columns by two sweeps, then along rows by parabolas, near ones first, until none can be lower."""
    h, w = mask.shape
    far = float(h + w) ** 2
    g = np.where(mask, 0.0, np.inf)
    for i in range(1, h):
        g[i] = np.minimum(g[i], g[i - 1] + 1)
    for i in range(h - 2, -1, -1):
        g[i] = np.minimum(g[i], g[i + 1] + 1)
    g = np.minimum(g * g, far)
    out = g.copy()
    for d in range(1, w):
        if d * d >= out.max():
            break
        np.minimum(out[:, d:], g[:, :-d] + d * d, out=out[:, d:])
        np.minimum(out[:, :-d], g[:, d:] + d * d, out=out[:, :-d])
    return out


def signed_distance(p: np.ndarray, threshold: float = 0.2, preserve_membrane: bool = True) -> np.ndarray:
    """Distance to the boundary; on it minus the probability, or minus the distance to the inside less one."""
    edge = p >= threshold
    d = np.sqrt(distance_squared(edge)) if edge.any() else np.full(p.shape, float(sum(p.shape)))
    if preserve_membrane:
        return np.where(edge, -p, d)
    inner = np.sqrt(distance_squared(~edge)) if (~edge).any() else np.full(p.shape, float(sum(p.shape)))
    return d - np.where(inner > 0, inner - 1, inner)


def _kernel(sigma: float, order: int, window: float = 3.0) -> np.ndarray:
    r = max(1, int(math.ceil(sigma * (window + 0.5 * order))))
    x = np.arange(-r, r + 1, dtype=float)
    g = np.exp(-x * x / (2 * sigma * sigma))
    g /= g.sum()
    if order == 1:
        g = -x / sigma**2 * g
    elif order == 2:
        g = (x * x / sigma**4 - 1 / sigma**2) * g
        g -= g.mean()
    return g


def _along(a: np.ndarray, k: np.ndarray, axis: int) -> np.ndarray:
    r = len(k) // 2
    pad = [(0, 0)] * a.ndim
    pad[axis] = (r, r)
    mode = "reflect" if a.shape[axis] > r else "symmetric"
    b = np.pad(a, pad, mode=mode)
    out = np.zeros_like(a, dtype=float)
    for i, c in enumerate(k[::-1]):
        out += c * b[(slice(None),) * axis + (slice(i, i + a.shape[axis]),)]
    return out


def gaussian(a: np.ndarray, sigma: float, orders: tuple[int, int] = (0, 0)) -> np.ndarray:
    return _along(_along(a.astype(float), _kernel(sigma, orders[0]), 0), _kernel(sigma, orders[1]), 1)


def laplacian(a: np.ndarray, sigma: float) -> np.ndarray:
    return gaussian(a, sigma, (2, 0)) + gaussian(a, sigma, (0, 2))


def hessian_eigenvalues(a: np.ndarray, sigma: float) -> tuple[np.ndarray, np.ndarray]:
    """The larger and the smaller eigenvalue of the second derivatives."""
    yy, xx, xy = gaussian(a, sigma, (2, 0)), gaussian(a, sigma, (0, 2)), gaussian(a, sigma, (1, 1))
    mid, gap = (yy + xx) / 2, np.sqrt(((yy - xx) / 2) ** 2 + xy**2)
    return mid + gap, mid - gap


def filter_channels(a: np.ndarray, sigmas: tuple[float, ...] = FILTER_SIGMAS) -> dict[str, np.ndarray]:
    """Four channels for each scale."""
    out = {}
    for s in sigmas:
        name = str(s).replace(".", "_")
        big, small = hessian_eigenvalues(a, s)
        out |= {f"gauss_{name}": gaussian(a, s), f"log_{name}": laplacian(a, s), f"hess0_{name}": big, f"hess1_{name}": small}
    return out


def least_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of each node's component, over edges (a, b)."""
    to = np.arange(n)
    while True:
        least = np.minimum(to[a], to[b])
        new = to.copy()
        np.minimum.at(new, to[a], least)
        np.minimum.at(new, to[b], least)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, to):
            return to
        to = new


def components(mask: np.ndarray) -> np.ndarray:
    """Labels 1.. of 8-connected true pixels in scan order, 0 elsewhere.

    Runs of pixels of a row are merged with those of the next row that they touch, by pointing each at the least it meets.
    """
    h, w = mask.shape
    wide = np.zeros((h, w + 2), np.int8)
    wide[:, 1:-1] = mask
    step = np.diff(wide, axis=1)
    row, start = np.nonzero(step == 1)
    _, end = np.nonzero(step == -1)  # one after the last
    n = len(row)
    # In each row runs rise, so that those of the row above that a run touches are a stretch of them.
    place = row * (w + 2)
    lo = np.searchsorted(place + end, place - (w + 2) + start, side="left")  # of the row above, ending at or after the start
    hi = np.searchsorted(place + start, place - (w + 2) + end, side="right")
    count = np.maximum(hi - lo, 0)
    a = np.repeat(np.arange(n), count)
    b = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    label = np.unique(least_of(n, a, b), return_inverse=True)[1] + 1
    size = end - start
    out = np.zeros(h * w, np.int64)
    out[np.repeat(row * w + start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = np.repeat(label, size)
    return out.reshape(h, w)


def local_maxima(a: np.ndarray) -> np.ndarray:
    """Pixels that no neighbour exceeds, at the border too; a flat image has none."""
    b = np.pad(a, 1, constant_values=-np.inf)
    around = np.max([b[1 + i : 1 + i + a.shape[0], 1 + j : 1 + j + a.shape[1]] for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j], axis=0)
    return (a >= around) & (a > a.min())


def seeds(distance: np.ndarray, sigma: float = 2.6) -> np.ndarray:
    """Labelled maxima of the smoothed distance, without those below 0."""
    d = gaussian(distance, sigma) if sigma > 0 else distance
    return components(local_maxima(d) & (d >= 0))


def flood(height: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Seeded watershed over 4 neighbours: lowest first, of equals the earliest reached."""
    h, w = height.shape
    # A border that is never entered spares all tests of the edges.
    out = np.full((h + 2, w + 2), -1, np.int64)
    out[1:-1, 1:-1] = labels
    level = np.zeros((h + 2, w + 2))
    level[1:-1, 1:-1] = height
    wide = w + 2
    own, high = out.ravel().tolist(), level.ravel().tolist()
    seeds_ = np.flatnonzero(out.ravel() > 0)
    order = seeds_[np.argsort(level.ravel()[seeds_], kind="stable")]
    heap = [(high[i], k, i) for k, i in enumerate(order.tolist())]
    n = len(heap)
    push, pop = heapq.heappush, heapq.heappop
    while heap:
        i = pop(heap)[2]
        label = own[i]
        for j in (i - wide, i - 1, i + 1, i + wide):
            if own[j] == 0:
                own[j] = label
                push(heap, (high[j], n, j))
                n += 1
    return np.array(own).reshape(h + 2, wide)[1:-1, 1:-1]


def watershed(height: np.ndarray, start: np.ndarray, min_size: int = 0, first: int = 0) -> np.ndarray:
    """Watershed; segments that are too small go and the others grow into their place; labels are consecutive from ``first``."""
    if not start.any():
        return np.full(height.shape, first, np.int64)
    out = flood(height, start)
    if min_size:
        n = np.bincount(out.ravel())
        small = (n < min_size) & (n > 0)
        if not small[n > 0].all():
            out[small[out]] = 0
            out = flood(height, out)
    known, inverse = np.unique(out, return_inverse=True)
    return inverse.reshape(out.shape).astype(np.int64) + first


def segment_slice(p: np.ndarray, threshold: float = 0.2, sigma: float = 2.6, min_size: int = 75, preserve_membrane: bool = True, first: int = 0) -> np.ndarray:
    """Distance-transform watershed of one slice."""
    return watershed(p, seeds(signed_distance(p, threshold, preserve_membrane), sigma), min_size, first)


def per_slice(voxels: DataFrame, kernel: Callable[[np.ndarray, np.ndarray | None], dict[str, np.ndarray]], value: str, schema: str, mask: str | None = None) -> DataFrame:
    """Rows (z, y, x, outputs of the kernel): slices are grouped by z, one in memory at a time."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        y, x = rows.y.to_numpy(), rows.x.to_numpy()
        image = np.zeros((y.max() + 1, x.max() + 1))
        image[y, x] = rows[value]
        inside = None
        if mask:
            inside = np.zeros(image.shape, bool)
            inside[y, x] = rows[mask]
        out = kernel(image, inside)
        return pd.DataFrame({"z": rows.z.to_numpy(), "y": y, "x": x} | {k: v[y, x] for k, v in out.items()})

    return voxels.select("z", "y", "x", value, *([mask] if mask else [])).groupBy("z").applyInPandas(run, f"z int, y int, x int, {schema}")


def filtered(voxels: DataFrame, value: str = "prob", sigmas: tuple[float, ...] = FILTER_SIGMAS) -> DataFrame:
    """(z, y, x, channels): filter responses of every slice."""
    names = [f"{k}_{str(s).replace('.', '_')}" for s in sigmas for k in ("gauss", "log", "hess0", "hess1")]
    return per_slice(voxels, lambda a, _: filter_channels(a, sigmas), value, ", ".join(f"{n} double" for n in names))
