import hashlib
import math

import numpy as np
import pytest

from flowbench.llm.ns_bounds import History, _squared, assign, centroid_digest, ns_kmeans

SCHEMA = "vec_id long, embedding array<float>, id string, cluster int"  # clashes with names used inside


def brute(rows, k, rounds, dims, scale=64):
    kept = [(i, np.array([math.floor(scale * float(x)) for x in v], object)) for i, v, *_ in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), list(r[1])))[:k]
    centres = [c for _, c in first]

    def near(v):
        return min((sum((v - c) ** 2), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for j in range(len(centres)):
            mine = [v for (_, v), a in zip(kept, at) if a == j]
            if mine:
                centres[j] = np.array([sum(c) // len(mine) for c in zip(*mine)], object)
    final = [near(v) for _, v in kept]
    total = sum(d for d, _ in final)
    return sorted([(i, j, d, sum(e for e, m in final if m == j), total, hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(kept, final)], key=str)


def data(n, dims, seed):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(5, dims))
    v = np.float32(centre[r.integers(0, 5, n)] + 0.4 * r.normal(size=(n, dims)))
    rows = [(i, x.tolist(), "x", 9) for i, x in enumerate(v)]
    rows += [(1000 + i, rows[0][1], "x", 9) for i in range(n // 2)]  # a third with one vector
    bad = list(rows[1][1])
    return rows + [(2000, None, "x", 9), (2001, bad[:-1], "x", 9), (2002, [*bad[:-1], None], "x", 9), (2003, [*bad[:-1], float("nan")], "x", 9),
                   (2004, [*bad[:-1], float("-inf")], "x", 9), (None, bad, "x", 9), (5, bad, "x", 9), (5, bad, "x", 9), (2005, [-0.5] * dims, None, None), (2006, [900000.0] * dims, "", 0)]


def result(spark, rows, **args):
    out = ns_kmeans(spark.createDataFrame(rows, SCHEMA), **args)
    cols = out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroid_digest(out["centroid"]).alias("sha"))
    return sorted([tuple(r) for r in cols.collect()], key=str), out


@pytest.mark.parametrize("k, rounds, dims", [(4, 3, 8), (16, 3, 64), (1, 2, 3), (7, 6, 4)])
def test_against_brute_force(spark, k, rounds, dims):
    rows = data(90, dims, k)
    got, out = result(spark, rows, k=k, rounds=rounds, dims=dims)
    assert got == brute(rows, k, rounds, dims)
    if rounds == 6:  # the bounds leave most distances uncomputed
        assert out.agg({"n_distances": "avg"}).first()[0] < 0.7 * k * (rounds + 1)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(x)], "", 0) for i, x in enumerate([0, 0, 2, 2, 4, 4, 1, 3])]
    assert result(spark, rows, k=4, rounds=2, dims=1)[0] == brute(rows, 4, 2, 1)


def test_few_or_no_vectors(spark):
    rows = data(3, 4, 1)[:2]
    assert result(spark, rows, k=16, rounds=3, dims=4)[0] == brute(rows, 16, 3, 4)
    assert result(spark, [(1, None, "", 0)], k=4, rounds=1, dims=4)[0] == []


def test_range_of_components(spark):
    assert [r["vec_id"] for r in ns_kmeans(spark.createDataFrame([(1, [1e30], "", 0), (2, [3.0], "", 0)], SCHEMA), 1, 1, dims=1).collect()] == [2]


def test_norm_of_total_displacement_not_summed_moves():
    """A centroid that goes away and comes back costs nothing: stored bounds are as good as new, and nothing is computed."""
    a, b = np.array([[0, 0], [100, 0]]), np.array([[0, 40], [100, 40]])
    v = np.array([[10, 0], [90, 1]])
    h = History(a)
    state, _ = assign(v, h, None)
    h.rounds += [b, a]
    assert (h.displacement()[0] == 0).all()
    state, work = assign(v, h, state)
    assert state[0].tolist() == [0, 1] and work.tolist() == [0, 0]


def test_random_walks_are_exact():
    r = np.random.default_rng(0)
    v = r.integers(-60, 60, (300, 6))
    h, state = History(v[:9].copy()), None
    for _ in range(12):
        state, _ = assign(v, h, state)
        far = np.stack([_squared(v, c) for c in h.now], axis=1)
        assert (state[0] == far.argmin(axis=1)).all()
        h.rounds.append(h.now + r.integers(-6, 7, h.now.shape))
