import numpy as np
import pytest

from flowbench.operators import cluster, density


def brute(x, eps, m):
    """Core flags and smallest core key of every row's cluster; border rows take the nearest core row's (ties: the smaller key)."""
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = (d <= eps).sum(1) >= m
    label = np.full(len(x), -1)
    for i in np.flatnonzero(core):
        if label[i] < 0:
            todo, label[i] = [i], i
            while todo:
                for k in np.flatnonzero((d[todo.pop()] <= eps) & core):
                    if label[k] < 0:
                        label[k] = i
                        todo.append(k)
    for i in np.flatnonzero(~core):
        near = [(d[i, k], k) for k in np.flatnonzero(core & (d[i] <= eps))]
        if near:
            label[i] = label[min(near)[1]]
    return [(i, bool(core[i]), None if label[i] < 0 else int(label[i])) for i in range(len(x))]


def labels(spark, x, eps, m):
    df = spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "id int, v array<double>")
    return sorted(tuple(r) for r in cluster.dbscan(df, "id", "v", eps, m).collect())


@pytest.mark.parametrize("d, eps", [(1, 0.02), (2, 0.25), (3, 0.5), (4, 0.9)])
def test_against_brute_force(spark, monkeypatch, d, eps):
    monkeypatch.setattr(density, "BLOCK_SITES", 20)
    monkeypatch.setattr(density, "TILE", 3)
    rng = np.random.default_rng(d)
    x = np.concatenate([rng.normal(0, 1, (200, d)), rng.normal(2, 0.05, (60, d)), np.tile(rng.normal(0, 1, (1, d)), (15, 1))])
    assert labels(spark, x, eps, 6) == brute(x, eps, 6)


def test_boxes_leave_open_what_only_sites_can_tell(spark):
    """Whole cells on either side of a gap of just eps, and just more."""
    for gap in (1.0, 1.0001):
        left = np.column_stack([-np.linspace(0, 0.6, 80), np.linspace(0, 0.6, 80)])
        right = np.column_stack([gap + np.linspace(0, 0.6, 80), np.linspace(0, 0.6, 80)])
        x = np.concatenate([left, right])
        got = labels(spark, x, 1.0, 5)
        assert got == brute(x, 1.0, 5) and len({c for *_, c in got}) == (1 if gap == 1.0 else 2)


def test_lattice_ties(spark):
    x = np.array([(i, j) for i in range(8) for j in range(8)], float)
    assert labels(spark, x, 1.0, 5) == brute(x, 1.0, 5)


def test_fifty_thousand_copies(spark):
    rows = spark.range(50_000).selectExpr("id", "array(1.5D, 2.5D) AS v").union(spark.range(60_000, 60_300).selectExpr("id", "array(1.5D + (id - 60000) / 100, 2.5D) AS v"))
    rows = rows.union(spark.createDataFrame([(90_000, None), (90_001, [1.0]), (90_002, [float("nan"), 1.0]), (90_003, [None, 1.0]), (90_004, [50.0, 50.0])], "id long, v array<double>"))
    out = cluster.dbscan(rows, "id", "v", 0.5, 10)
    got = {tuple(r): n for *r, n in (tuple(x) for x in out.groupBy("core", "cluster_key").count().collect())}
    assert got == {(True, 0): 50_300, (False, None): 5}
