import numpy as np
import pytest
from pyspark.sql import functions as F

from flowbench.functions.ordered import sorted_position
from flowbench.operators import cluster, hierarchy


def brute_hac(x, n, linkage):
    """All merges (height, rows of the union) by searching every pair of groups, every time."""
    groups, out = [[i] for i in range(len(x))], []

    def dist(a, b):
        na, nb = n[a].sum(), n[b].sum()
        if linkage == "ward":
            ca, cb = (x[a] * n[a, None]).sum(0) / na, (x[b] * n[b, None]).sum(0) / nb
            return np.sqrt(2 * na * nb / (na + nb) * ((ca - cb) ** 2).sum())
        d = np.sqrt(((x[a][:, None] - x[b][None]) ** 2).sum(-1))
        return {"single": d.min(), "complete": d.max(), "average": (d * n[a][:, None] * n[b][None]).sum() / (na * nb)}[linkage]

    while len(groups) > 1:
        h, i, j = min((dist(a, b), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        groups[i] += groups.pop(j)
        out.append((h, frozenset(groups[i])))
    return out


def frame(spark, x, n=None):
    n = np.ones(len(x)) if n is None else n
    return spark.createDataFrame([(f"k{i:04d}", [float(a) for a in r], float(w)) for i, (r, w) in enumerate(zip(x, n))], "id string, v array<double>, w double")


def members(h):
    """Rows of every union, read from the merge table alone."""
    rows, out = {i: {i} for i in range(h.n_leaves)}, []
    for r in h.merges.orderBy("step").collect():
        rows[h.n_leaves + r["step"]] = rows[r["left"]] | rows[r["right"]]
        out.append((r["distance"], frozenset(rows[h.n_leaves + r["step"]])))
    return out


@pytest.mark.parametrize("linkage", hierarchy.LINKAGES)
def test_rounds_against_brute_force(spark, linkage, monkeypatch):
    monkeypatch.setattr(hierarchy, "BLOCK", 16)  # several blocks of columns
    rng = np.random.default_rng(9)
    x, n = rng.normal(0, 1, (44, 2)), rng.integers(1, 5, 44).astype(float)
    h = hierarchy.hierarchical(frame(spark, x, n), "id", "v", linkage, "w", finish=10)
    want = brute_hac(x, n, linkage)
    got = members(h)
    assert [g for _, g in got] == [g for _, g in want]
    assert [d for d, _ in got] == pytest.approx([d for d, _ in want])
    table = h.merges.orderBy("step").collect()
    assert [r["clusters_left"] for r in table] == list(range(43, 0, -1)) and table[-1]["size"] == n.sum()
    assert h.cut_height(4) == pytest.approx(want[-3][0]) and np.isnan(h.cut_height(1))
    labels = {r["id"]: r["cluster"] for r in h.labels(4).collect()}
    groups = {}
    for i in range(44):
        groups.setdefault(labels[f"k{i:04d}"], set()).add(i)
    left = [g for _, g in want[:40]] + [frozenset([i]) for i in range(44)]
    assert set(map(frozenset, groups.values())) <= set(left) and sorted(groups) == [0, 1, 2, 3]
    assert [min(groups[c]) for c in range(4)] == sorted(min(g) for g in groups.values())


@pytest.mark.parametrize("linkage", ["ward", "average", "single"])
def test_copies_and_ties(spark, linkage):
    """Copies meet at distance 0, ties are settled; rounds and the one-task end agree on all heights."""
    x = np.array([[0, 0]] * 9 + [[i, 0] for i in range(1, 12)] + [[0, 5]] * 4, float)
    both = [hierarchy.hierarchical(frame(spark, x), "id", "v", linkage, finish=f).merges.orderBy("step").collect() for f in (2, 1024)]
    assert all([r["distance"] for r in b][:11] == [0.0] * 11 for b in both)
    if linkage == "single":
        assert [r["distance"] for r in both[0]] == [r["distance"] for r in both[1]] == [0.0] * 11 + [1.0] * 11 + [5.0]
    for b in both:
        assert [r["distance"] for r in b] == sorted(r["distance"] for r in b)
        assert all(max(r["left"], r["right"]) < len(x) + r["step"] for r in b) and len({r["left"] for r in b} | {r["right"] for r in b}) == 2 * (len(x) - 1)


def test_merge_table_and_tiny_tables(spark):
    x = np.random.default_rng(1).normal(size=(60, 3))
    h = hierarchy.hierarchical(frame(spark, x), "id", "v", "average")
    last = hierarchy.merge_table(h, 40).orderBy("step").collect()
    assert [r["clusters_left"] for r in last] == list(range(40, 0, -1)) and last[-1]["size"] == 60
    assert h.labels_at(float(last[-3]["distance"])).select("cluster").distinct().count() == 3
    none = hierarchy.hierarchical(frame(spark, x[:0]), "id", "v")
    assert none.merges.collect() == [] and none.labels(3).collect() == []
    one = hierarchy.hierarchical(frame(spark, x[:1]), "id", "v")
    assert one.merges.collect() == [] and [r["cluster"] for r in one.labels(1).collect()] == [0]
    with pytest.raises(ValueError, match="linkage"):
        hierarchy.hierarchical(frame(spark, x), "id", "v", "median")


def test_micro_clusters(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "GROUP", 64)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.1, (200, 2)) for c in ((0, 0), (3, 3), (-3, 4))] + [np.tile([[3.0, 3.0]], (300, 1))])
    df = frame(spark, x)
    m = hierarchy.micro_clusters(df, "v", 0.5).toPandas()
    assert m["n"].sum() == len(x) and np.allclose(np.stack(m["total"]).sum(0), x.sum(0)) and np.isclose(m["squares"].sum(), (x * x).sum())
    assert (m["squares"] / m["n"] - (np.stack(m["center"]) ** 2).sum(1) <= 0.25 + 1e-9).all()
    assert len(m) < 30 and sorted(m["micro_id"]) == list(range(len(m)))
    fine = hierarchy.micro_clusters(df, "v", 0.0)
    assert fine.count() <= len(x) and fine.agg(F.max("n")).first()[0] > 1  # only copies meet
    h = hierarchy.micro_hierarchy(df, "v", 0.5)
    out = h.predict(df, "id", "v", 3).select("id", "cluster").toPandas().sort_values("id")["cluster"].to_numpy()
    assert all(len(set(out[i:i + 200])) == 1 for i in (0, 200, 400)) and set(out[600:]) == {out[200]} and len(set(out)) == 3
    assert hierarchy.micro_clusters(df.filter("id = ''"), "v").collect() == []


def test_sorted_position(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x"), F.lit("a").alias("__part"))
    got = sorted_position(df.repartition(7).drop("__part"), ["x"])
    assert got.filter("x <> position").count() == 0 and got.count() == 1000


def test_k_sweep_uses_all_rows(spark):
    x = np.concatenate([np.random.default_rng(2).normal(c, 0.2, (30, 2)) for c in ((0, 0), (4, 4))])
    df = frame(spark, x).withColumn("y", (F.substring("id", 2, 4).cast("int") >= 30).cast("int"))
    sweep = cluster.k_sweep(df, "id", "v", "y", [2], cluster.cluster_algorithms("id", "v"))
    assert {r["algorithm"]: r["ari"] for r in sweep.collect()} == dict.fromkeys(["K-Means", "Agglomerative (ward)", "Gaussian Mixture", "Micro-clusters"], 1.0)


@pytest.mark.parametrize("linkage", hierarchy.LINKAGES)
def test_no_table_of_distances(spark, linkage, monkeypatch):
    """Waves and pieces give the merges of the one-task end, and the shared folder holds rows, not pairs of rows."""
    monkeypatch.setattr(hierarchy, "BLOCK", 64)
    monkeypatch.setattr(hierarchy, "WAVE", 8 * 6 * 150)
    monkeypatch.setattr(hierarchy, "PIECE", 16)
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (400, 6)) + rng.integers(0, 3, (400, 1)) * 4 + 100
    x[390:] = x[:10]
    df = frame(spark, x, rng.integers(1, 4, 400).astype(float))
    labels = []
    monkeypatch.setattr(hierarchy, "write_through", lambda d, name, real=hierarchy.write_through: (labels.append(name), real(d, name))[1])
    many = hierarchy.hierarchical(df, "id", "v", linkage, "w", finish=50)
    assert "distances" not in labels
    one = hierarchy.hierarchical(df, "id", "v", linkage, "w")
    a, b = members(many), members(one)
    assert [d for d, _ in a] == pytest.approx([d for d, _ in b], abs=1e-9)
    assert {g for d, g in a if d > 1e-9} == {g for d, g in b if d > 1e-9}


def test_missing_coordinates_join_no_rows(spark):
    x = np.arange(30.0)[:, None]
    df = frame(spark, x).withColumn("v", F.when(F.col("id").isin("k0003", "k0007"), F.array(F.lit(None).cast("double"))).otherwise(F.col("v")))
    h = hierarchy.hierarchical(df, "id", "v", "single", finish=10)
    assert h.log.count() == 29 and h.labels_at(5.0).select("cluster").distinct().count() == 30
