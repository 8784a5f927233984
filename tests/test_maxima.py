"""Local maxima with plateaus against all members' neighbours."""

import itertools

import numpy as np
import pytest

from voxgraph.operators import maxima


def plain(a, there, three_d):
    steps = [d for d in itertools.product((-1, 0, 1), repeat=3) if any(d) and (three_d or not d[0])]
    near = lambda p: [q for d in steps if (q := tuple(np.add(p, d))) in there]
    out, seen = {}, set()
    for p in sorted(there):
        if p in seen:
            continue
        line = [p]
        members = {p}
        for m in line:
            for q in near(m):
                if a[q] == a[p] and q not in members:
                    members.add(q)
                    line.append(q)
        seen |= members
        least = min(a[q] for q in there if three_d or q[0] == p[0])
        if a[p] > least and all(a[q] <= a[p] for m in members for q in near(m)):
            out |= {m: p for m in members}
    return out


@pytest.mark.parametrize("three_d", [True, False])
@pytest.mark.parametrize("levels", [4, 30])
def test_against_brute_force(spark, levels, three_d):
    rng = np.random.default_rng(levels)
    a = rng.integers(0, levels, (4, 7, 6)).astype(float)
    a[1:3, 2:5, 2:4] = levels  # a plateau across slices
    there = {tuple(map(int, p)) for p in np.argwhere(rng.random(a.shape) < 0.95)}
    v = spark.createDataFrame([(*p, float(a[p])) for p in there] + [(9, 9, 9, None)], "z int, y int, x int, prob double")
    want = plain(a, there, three_d)
    got = {(r.z, r.y, r.x): r for r in maxima.local_maxima(v, three_d=three_d).collect()}
    assert set(got) == set(want) and all(r.value == a[p] for p, r in got.items())
    of = {}
    for p, r in got.items():
        assert of.setdefault(r.plateau, want[p]) == want[p]
    assert len(of) == len(set(want.values()))


def test_flat_and_empty(spark):
    flat = spark.createDataFrame([(0, y, x, 2.0) for y in range(3) for x in range(3)], "z int, y int, x int, prob double")
    assert maxima.local_maxima(flat).count() == 0 and maxima.local_maxima(flat.limit(0)).count() == 0
