import tracemalloc

import numpy as np

from flowbench.llm.components import union_find
from flowbench.llm.cover_tree import Links, build, embedding_links, unit

SCHEMA = "vec_id long, embedding array<float>, v int, links string"


def cloud(seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, 16))
    tight = centers[rng.integers(0, 6, 400)] + rng.normal(size=(400, 16)) * 0.25
    chain = np.stack([np.cos(np.arange(60) * 0.3), np.sin(np.arange(60) * 0.3)] + [np.zeros(60)] * 14, axis=1)
    return np.concatenate([tight, rng.normal(size=(200, 16)), chain]).astype(np.float32)


def brute(ids, x, cosine):
    u = unit(x)
    s = u @ u.T >= cosine
    np.fill_diagonal(s, False)
    i, j = np.nonzero(s)
    root = union_find([(ids[a], ids[b]) for a, b in zip(i, j)])
    return {k: (int(n), root.get(k, k), root.get(k, k) == k) for k, n in zip(ids, s.sum(axis=1))}


def test_trees_give_the_same_links_as_all_pairs():
    x = unit(cloud())
    want = x @ x.T >= 0.95
    np.fill_diagonal(want, False)
    links = Links(x, x, np.ones(len(x), np.int64), np.ones(len(x), np.int64), 0.95)
    links.find()
    assert (links.counts[0] + links.counts[1] == want.sum(axis=1)).all()
    half = Links(x[:300], x[300:], np.ones(300, np.int64), np.full(len(x) - 300, 2), 0.95)
    half.find()
    assert (half.counts[0] == 2 * want[:300, 300:].sum(axis=1)).all() and (half.counts[1] == want[:300, 300:].sum(axis=0)).all()


def test_radii_cover_and_halve():
    x = unit(cloud(2)).astype(np.float32)

    def check(node, level):
        assert np.linalg.norm(x[node.rows] - x[node.center], axis=1).max() <= node.radius
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
        for c in node.children:
            assert c.radius <= level / 2 + 1e-3
            check(c, level / 2)

    check(build(x, np.arange(len(x)), 0, 2.0), 2.0)


def test_against_brute_force(spark):
    x = cloud(3)
    ids = [int(i) for i in np.random.default_rng(4).permutation(len(x))]
    want = brute(ids, x, 0.95)
    rows = [(i, [float(v) for v in e], 1, "") for i, e in zip(ids, x)]
    for block_rows in (97, 8192):
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_links(spark.createDataFrame(rows, SCHEMA), block_rows=block_rows).collect()}
        assert got == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, []), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]),
            (10, [1.0, 0.0, 0.0]), (11, [3e38, 1e30]), (12, [1e-38, 0.0]), (13, [-1.0, 0.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, "") for r in rows], SCHEMA)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_links(df).collect()}
    assert {k: got[k] for k in (4, 5, 6, 7, 8, 9, 10, 13)} == {k: (0, k) for k in (4, 5, 6, 7, 8, 9, 10, 13)}
    assert {k: got[k] for k in (1, 2, 3, 11, 12)} == {k: (4, 1) for k in (1, 2, 3, 11, 12)}
    assert got[None][1] is None


def test_empty_table(spark):
    assert embedding_links(spark.createDataFrame([], SCHEMA)).collect() == []


def test_dense_group_of_distinct_copies_in_bounded_memory():
    rng = np.random.default_rng(5)
    x = unit(rng.normal(size=64) + 0.2 * rng.normal(size=(3000, 64)))  # mutual cosines of about 0.96, no two rows near each other
    want = x @ x.T >= 0.95
    np.fill_diagonal(want, False)
    for left, right in ((x, x), (x[:1400], x[1400:])):
        links = Links(left, left if left is right else right, np.ones(len(left), np.int64), np.ones(len(right), np.int64), 0.95)
        tracemalloc.start()
        links.find()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        got = links.counts[0] + links.counts[1] if left is right else np.append(*links.counts)
        assert (got == (want.sum(axis=1) if left is right else np.append(want[:1400, 1400:].sum(axis=1), want[:1400, 1400:].sum(axis=0)))).all()
        assert len(set(links.forest.values())) == 1 and peak < 100_000_000
