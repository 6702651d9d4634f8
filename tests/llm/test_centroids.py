import hashlib
import math

import numpy as np
import pytest

from farelake.llm import centroids as C

DDL = "vec_id long, embedding array<double>, label int, id string, v int, cluster int, distance int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 7, 7, 7) for i, v in rows], DDL)


def brute(rows, k, rounds, dim):
    use = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dim
           and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    cs = [v for _, v in sorted(((digest(f"2:{i}"), v) for i, v in use if i is not None))[:k]]
    if not cs:
        return []
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for r in range(rounds + 1):
        near = [min((square(v, c), j) for j, c in enumerate(cs)) for _, v in use]
        if r == rounds:
            break
        for j in range(len(cs)):
            mine = [v for (_, v), (_, n) in zip(use, near, strict=True) if n == j]
            if mine:
                cs[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    total = sum(d for d, _ in near)
    return sorted([(i, j, d, sum(e for e, n in near if n == j), total, digest(",".join(map(str, cs[j]))))
                   for (i, _), (d, j) in zip(use, near, strict=True)], key=str)


def run(spark, rows, k=40, rounds=5, dim=64):
    return sorted(map(tuple, C.cluster_vectors(spark, frame(spark, rows), k, rounds, dim).collect()), key=str)


def test_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * 0.2).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # copies of one vector: ties
    rows += [(2000 + i, np.round(rng.normal(size=8)).tolist()) for i in range(100)]
    assert run(spark, rows, 12, 3, 8) == brute(rows, 12, 3, 8)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [0.5, -2.0]), (1, None), (2, []), (3, [1.0, None]), (4, [1.0, nan]),
            (5, [-inf, 0.0]), (6, [1.0, 1.0, 1.0]), (7, [-0.001, 0.0]), (7, [-0.001, 0.0]), (8, [3.0, 3.0])]
    for k in (1, 2, 3, 40):
        assert run(spark, rows, k, 4, 2) == brute(rows, k, 4, 2)
    assert run(spark, [], 3, 2, 2) == [] and run(spark, [(None, [1.0, 2.0])], 3, 2, 2) == []
    same = [(i, [0.25, 0.25]) for i in range(30)]  # every centroid equal: all go to number 0, the others stay
    assert run(spark, same, 5, 3, 2) == brute(same, 5, 3, 2) and {r[1] for r in run(spark, same, 5, 3, 2)} == {0}


@pytest.mark.parametrize("size", [2.0 ** 17, 2.0 ** 18 - 1 / 256, 2.0 ** 18, 2.0 ** 19 - 0.25])
def test_large_components_are_exact(spark, size):
    rng = np.random.default_rng(2)
    rows = [(i, [size * s for s in row]) for i, row in enumerate(rng.choice([-1.0, -0.5, 0.25, 1.0], size=(60, 4)).tolist())]
    rows += [(100 + i, (rng.normal(size=4)).tolist()) for i in range(40)]
    assert run(spark, rows, 6, 2, 4) == brute(rows, 6, 2, 4)


def test_an_inertia_beyond_a_long_raises(spark):
    rows = [(i, [2.0 ** 22 * s, 0.0]) for i, s in enumerate([-1.0, 0.5, 1.0] * 9)]
    with pytest.raises(Exception, match="(?i)bounds|overflow|out of range"):
        run(spark, rows, 1, 1, 2)


def test_walk_stops_before_it_has_seen_every_centroid():
    rng = np.random.default_rng(4)
    cs = (rng.normal(size=(200, 4)) * 1000).astype(np.int64)
    x = cs[rng.integers(0, 200, 500)] + rng.integers(-5, 6, (500, 4))
    seen: list[int] = []
    near, d = C.Walk(cs.tolist()).nearest(x, seen)
    full = ((x[:, None, :] - cs[None]) ** 2).sum(2)
    assert np.array_equal(near, full.argmin(1)) and np.array_equal(d, full.min(1))
    assert sum(seen) < 0.2 * full.size


def test_ties_at_the_frontier_go_to_the_smaller_number():
    walk = C.Walk([[4, 0], [0, 4], [-4, 0], [0, -4], [0, 4]])
    assert [int(j) for j in walk.nearest(np.array([[0, 0], [0, 5], [2, 2], [-3, -3]]))[0]] == [0, 1, 0, 2]
