"""Softmax boosting against a plain version row by row; networks against differences and plain Adam."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowbench.operators import blocks, boosting, classify, network

SCHEMA = T.StructType([T.StructField("row_id", T.IntegerType()), T.StructField("features", VectorUDT()), T.StructField("y", T.IntegerType()),
                       T.StructField("w", T.DoubleType())])


def frame(spark, x, y, w):
    rows = [(i, Vectors.dense(v.tolist()) if v is not None else None, int(c) if c is not None else None, float(u)) for i, (v, c, u) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def levels():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 7, (300, 3)).astype(float)
    y = (x[:, 0] > 3).astype(int) + ((x[:, 1] > 4) & (rng.random(300) < 0.8)).astype(int)
    return x, y, rng.uniform(0.5, 2.0, 300)


def plain_tree(x, r, w, depth):
    """Leaf of every row, found by trying each value of each feature on the rows of a node."""
    best, leaf = (0.0,), np.zeros(len(x), int)
    if depth and len(x):
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[:-1]:
                go = x[:, f] > cut
                a, b = w[~go].sum(), w[go].sum()
                gain = a * b / (a + b) * ((w * r)[~go].sum() / a - (w * r)[go].sum() / b) ** 2
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, go)
    if len(best) == 1:
        return leaf
    go = best[1]
    leaf[~go] = plain_tree(x[~go], r[~go], w[~go], depth - 1)
    leaf[go] = leaf[~go].max() + 1 + plain_tree(x[go], r[go], w[go], depth - 1)
    return leaf


def plain_boosting(x, y, w, k, rounds, depth, step):
    s = np.tile(np.log([w[y == c].sum() / w.sum() for c in range(k)]), (len(x), 1))
    for _ in range(rounds):
        res = (y[:, None] == np.arange(k)) - boosting.softmax(s)
        for c in range(k):
            r = res[:, c]
            leaf = plain_tree(x, r, w, depth)
            for at in np.unique(leaf):
                m = leaf == at
                s[m, c] += step * (k - 1) / k * (w * r)[m].sum() / (w * np.abs(r) * (1 - np.abs(r)))[m].sum()
    return boosting.softmax(s)


def test_boosting_against_plain_version(spark, levels, monkeypatch):
    x, y, w = levels
    df = frame(spark, x, y, w)
    want = plain_boosting(x, y, w, 3, 4, 2, 0.3)
    model = boosting.fit_boosted(df, "features", "y", "w", 3, 4, 0.3, 2)
    assert np.allclose(model.probabilities(x), want, atol=1e-9)
    got = {r["row_id"]: r["p"] for r in model.apply(df, "features").select("row_id", "p").collect()}
    assert np.allclose([got[i] for i in range(len(x))], want, atol=1e-9)
    monkeypatch.setattr(boosting, "DIRECT_BYTES", 0)
    monkeypatch.setattr(boosting, "FEATURES_A_TASK", 1)
    again = boosting.fit_boosted(df, "features", "y", "w", 3, 4, 0.3, 2, cut_every=2)
    assert np.allclose(again.probabilities(x), want, atol=1e-9)


def test_boosting_edges(spark, levels):
    x, y, w = levels
    flat = boosting.fit_boosted(frame(spark, np.ones((20, 2)), y[:20], np.ones(20)), "features", "y", "w", 3, 2)
    assert np.allclose(flat.probabilities(np.ones((1, 2)))[0], [(y[:20] == c).mean() for c in range(3)], atol=1e-9)
    holes = [None if i == 0 else np.array([np.nan, *v[1:]]) if i == 1 else v for i, v in enumerate(x)]
    df = frame(spark, holes, [None if i == 2 else c for i, c in enumerate(y)], w)
    half = [boosting.fit_boosted(df, "features", "y", "w", 3, 2, share=0.5).probabilities(x) for _ in range(2)]
    assert (half[0] == half[1]).all()
    out = classify.fit_gbt(df.filter("y is not null"), "y", 2)
    assert out.apply(df).filter("p is null").count() == 1 and out.apply(df).filter("row_id = 1 and p is not null").count() == 1
    assert classify.fit_gbt(df.filter("y = 1"), "y", 2).apply(df).filter("pred <> 1").count() == 0
    with pytest.raises(ValueError):
        boosting.fit_boosted(df, "features", "y", "w", 3, bins=300)


def test_gradient_by_differences(spark, levels, monkeypatch):
    x, y, w = levels
    net = network.new_network((3, 5, 4, 3), 1)
    loss, grad = net.loss_and_gradient(x, y, w)
    for i in range(0, len(net.theta), 3):
        step = np.zeros(len(net.theta))
        step[i] = 1e-6
        up, down = (network.Network(net.sizes, net.theta + d).loss_and_gradient(x, y, w)[0] for d in (step, -step))
        assert abs((up - down) / 2e-6 - grad[i]) < 1e-3 * max(1.0, abs(grad[i]))
    table = blocks.write_blocks(frame(spark, x, y, w), "features", "y", "w", 16, lambda v: v, 3)
    assert table.select("slice").distinct().count() == 3 and table.agg(F.sum("n")).first()[0] == len(x)
    for direct in (32, 0):
        monkeypatch.setattr(network, "DIRECT", direct)
        mass, total, summed = network.summed_gradient(table.drop("slice"), net)
        assert np.isclose(mass, w.sum()) and np.isclose(total, loss) and np.allclose(summed, grad)


def test_network_against_plain_adam(spark, levels):
    x, y, w = levels
    df = frame(spark, x / 7, y, w)
    net, losses = network.fit_network(df, "features", "y", "w", 3, 3, (6,), epochs=4, slices=1, rate=0.05)
    plain = network.new_network((3, 6, 3))
    m, v, theta = 0.0, 0.0, plain.theta
    for t in range(1, 5):
        g = (network.Network(plain.sizes, theta).loss_and_gradient(x / 7, y, w)[1] + 1e-4 * plain.matrices() * theta) / w.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8 / np.sqrt(1 - 0.999 ** t))
    assert np.allclose(net.theta, theta, atol=1e-9) and losses == sorted(losses, reverse=True)
    _, stopped = network.fit_network(df, "features", "y", "w", 3, 3, (6,), epochs=30, slices=1, tol=10.0, patience=2)
    assert len(stopped) == 4
