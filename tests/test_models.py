"""Invariants of fitted models and checks against closed forms."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowbench.operators import bayes, classify, cluster, encode, metrics, regress, score, split
from flowbench.operators.classify import Config
from flowbench.operators.split import FoldSet


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.7, (120, 4)) for c in (0, 2, 4)])
    y = np.repeat(["a", "b", "c"], 120)
    rows = [(i, [float(v) for v in r], str(t), i % 30) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "row_id int, v array<double>, y string, g int").withColumn("features", array_to_vector("v")).cache()
    return df, x, y


def accuracy(model, df):
    return model.apply(df).agg(F.avg((F.col("y") == F.col("pred")).cast("double"))).first()[0]


FITS = {
    "logistic": lambda d: classify.fit_logistic(d, "y", max_iter=30), "tree": lambda d: classify.fit_tree(d, "y", 6),
    "forest": lambda d: classify.fit_random_forest(d, "y", 10, 5), "gbt": lambda d: classify.fit_gbt(d, "y", 5),
    "svm": lambda d: classify.fit_kernel_svm(d, "y", size=80, max_iter=20), "bagging": lambda d: classify.fit_bagging(d, "y", "row_id", 8, 0.5, 5),
    "adaboost": lambda d: classify.fit_adaboost(d, "y", 6, max_depth=2, cut_every=2), "mlp": lambda d: classify.fit_mlp(d, "y", (8,), 60, slices=1, rate=0.05),
}


@pytest.mark.parametrize("name", FITS)
def test_classifier(blobs, name):
    df, _, _ = blobs
    model = FITS[name](df)
    assert accuracy(model, df) > 0.85
    if name != "svm":
        bad = model.apply(df).filter(F.abs(F.aggregate("p", F.lit(0.0), lambda s, v: s + v) - 1) > 1e-6).count()
        assert bad == 0
    assert "row_id" in model.apply(df).columns


def test_gaussian_nb_against_numpy(blobs):
    df, x, y = blobs
    wide = df.select("row_id", "y", *[F.col("v")[i].alias(f"f{i}") for i in range(4)])
    model = bayes.gaussian_nb(wide, [f"f{i}" for i in range(4)], "y")
    got = {r["row_id"]: r["p"] for r in model.apply(wide).collect()}
    eps = 1e-9 * x.var(axis=0).max()
    j = np.stack([np.log(1 / 3) - 0.5 * (np.log(2 * np.pi * (x[y == c].var(0) + eps)) + (x - x[y == c].mean(0)) ** 2 / (x[y == c].var(0) + eps)).sum(1)
                  for c in "abc"], axis=1)
    p = np.exp(j - j.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    assert np.allclose(np.array([got[i] for i in range(len(x))]), p, atol=1e-9)


def test_two_stage_vote_and_thresholds(blobs):
    df, _, _ = blobs
    out = classify.two_stage(df, "y", "a", lambda d, label: classify.fit_tree(d, label, 5))(df)
    assert out.filter("gate = 0 and pred <> 'a'").count() == 0
    assert out.agg(F.avg((F.col("y") == F.col("pred")).cast("double"))).first()[0] > 0.85


def test_search_and_folds(blobs):
    df, _, _ = blobs
    folded = split.kfold_grouped(df, "y", "g", 3).cache()
    configs = [Config(f"d{d}", lambda t, d=d: classify.fit_tree(t, "y", d)) for d in (1, 5)]
    best, grid = classify.grid_search(configs, FoldSet(folded, 3))
    assert best.name == "d5" and grid.count() == 2
    _, one = classify.random_search(configs, 1, FoldSet(folded, 3))
    assert one.count() == 1
    model, tuned = classify.tune(configs, FoldSet(folded, 3), df, df)
    rows = {r["model"]: r for r in tuned.collect()}
    assert rows["d5"]["chosen"] and not rows["d1"]["chosen"] and rows["d5"]["test"] > rows["d1"]["test"] and model.apply(df).count() == df.count()
    levels = sorted(r["y"] for r in df.select("y").distinct().collect())
    board = classify.fit_all(configs, df, df, levels)
    assert {"fit_s", "predict_s", "f1_w", "auc_macro"} <= set(board.columns)
    assert all(0.5 < r["auc_macro"] <= 1 for r in board.collect())
    cv = classify.cross_validate_top(board, configs, {"grouped": FoldSet(folded, 3)}, 1)
    assert cv.count() == 3 and {r["model"] for r in cv.collect()} == {"d5"}


def test_balanced_weights_sum(blobs):
    df, _, _ = blobs
    part = df.filter("y <> 'a' or row_id < 10")
    w = encode.balanced_weights(part, "y").groupBy("y").agg(F.sum("weight").alias("s")).collect()
    assert [r["s"] for r in w] == pytest.approx([part.count() / 3] * 3)


@pytest.fixture(scope="module")
def line(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 2, (400, 2))
    y = 3 + 2 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(0, 0.1, 400)
    rows = [(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "row_id int, a double, b double, t double")
    return encode.FeaturePlan(["a", "b"]).assemble(df).cache(), x, y


def test_linear_family(line):
    df, x, y = line
    xc, yc = x - x.mean(0), y - y.mean()
    ols = np.linalg.lstsq(xc, yc, rcond=None)[0]
    assert np.allclose(regress.fit_linear(df, "t").model.coefficients.toArray(), ols, atol=1e-8)
    ridge = np.linalg.solve(xc.T @ xc + 50 * np.eye(2), xc.T @ yc)
    assert np.allclose(regress.fit_ridge(df, "t", 50.0).model.coefficients.toArray(), ridge, atol=1e-6)

    def objective(w, l1, l2):
        return ((yc - xc @ w) ** 2).mean() / 2 + l1 * np.abs(w).sum() + l2 / 2 * (w ** 2).sum()

    for model, l1, l2 in ((regress.fit_lasso(df, "t", 0.4), 0.4, 0.0), (regress.fit_elasticnet(df, "t", 0.6, 0.5), 0.3, 0.3)):
        w = model.model.coefficients.toArray()
        for step in (np.array([1e-2, 0]), np.array([0, 1e-2])):
            assert objective(w, l1, l2) <= objective(w + step, l1, l2) and objective(w, l1, l2) <= objective(w - step, l1, l2)
    flat = regress.fit_linear_1d(df, "a", "t").model
    assert flat[1] == pytest.approx(np.polyfit(x[:, 0], y, 1)[0])


def test_other_regressors(line):
    df, _, y = line
    for fit in (lambda: regress.fit_poly_ridge(df, "t"), lambda: regress.fit_tree_reg(df, "t", 8), lambda: regress.fit_forest_reg(df, "t", 5, 8),
                lambda: regress.fit_gbt_reg(df, "t", 20), lambda: regress.fit_kernel_reg(df, "t", size=100)):
        assert metrics.regression_metrics(fit().apply(df), "t", "yhat").first()["r2"] > 0.8
    assert metrics.regression_metrics(regress.mean_baseline(df, "t").apply(df), "t", "yhat").first()["r2"] == pytest.approx(0.0, abs=1e-9)


def test_tree_interval_and_sweep(line):
    df, _, _ = line
    forest = regress.fit_forest_reg(df, "t", 7, 6).model
    one = regress.tree_predictions(df, forest).orderBy("row_id").first()["trees"]
    r = regress.tree_interval(df, forest).orderBy("row_id").first()
    assert r["yhat"] == pytest.approx(np.expm1(np.mean(one)))
    assert r["low"] == pytest.approx(np.expm1(np.percentile(one, 10))) and r["high"] == pytest.approx(np.expm1(np.percentile(one, 90)))
    plan = encode.FeaturePlan(["a", "b"])
    sweep = regress.what_if_sweep(df.drop("features"), "row_id", "a", [-1, 0, 1], plan.assemble, forest)
    assert sweep.count() == 3 * df.count() and sweep.filter("low > high").count() == 0
    assert regress.feature_importance(forest, ["a", "b"], df.sparkSession).first()["feature"] == "a"


def test_shuffled_target_is_a_permutation(line):
    df, _, _ = line
    base = df.select("row_id", "t")
    out = regress.shuffled_target(base, "row_id", "t")
    assert out.select("t").exceptAll(base.select("t")).count() == 0 and out.count() == base.count()
    assert out.join(base.withColumnRenamed("t", "u"), "row_id").filter("t <> u").count() > 350


def test_kmeans_and_mixture(spark, blobs):
    df, x, _ = blobs
    costs = [cluster.fit_kmeans(df, "v", k, 2)[1] for k in (2, 3, 4, 5)]
    assert costs == sorted(costs, reverse=True)
    centers, cost = cluster.fit_kmeans(df, "v", 3, 2)
    step = cluster.kmeans_step(df, "v", centers)
    assert step.agg(F.sum("inertia")).first()[0] == pytest.approx(cost, rel=1e-3)
    mb = cluster.minibatch_kmeans(df, "row_id", "v", 3, 4, 2)
    assert mb.shape == (3, 4)
    gm = cluster.gaussian_mixture(df, "v", 3, 8)
    assert all(b >= a - 1e-6 for a, b in zip(gm.log_likelihood, gm.log_likelihood[1:]))
    assert gm.weight.sum() == pytest.approx(1.0)
    scored = gm.apply(df, "v")
    assert scored.filter(F.abs(F.aggregate("p", F.lit(0.0), lambda s, v: s + v) - 1) > 1e-9).count() == 0


def test_pca(blobs):
    df, x, _ = blobs
    out, share = cluster.pca(df, "v", 2)
    got = np.array([r["pc"] for r in out.orderBy("row_id").collect()])
    xc = x - x.mean(0)
    u, s, vt = np.linalg.svd(xc, full_matrices=False)
    sign = np.array([np.sign(v[np.abs(v).argmax()]) for v in vt[:2]])
    assert np.allclose(got, xc @ vt[:2].T * sign, atol=1e-6)
    assert share == pytest.approx((s ** 2 / (s ** 2).sum())[:2])


def test_score_records(blobs):
    df, _, _ = blobs
    model = classify.fit_tree(df, "y", 4)
    out = score.score_classify(df, "row_id", model, lambda d: d, {"a": "first"}, {"b": "B!"})
    r = out.filter("prediction = 'a'").first()
    assert r["note"] == "first" and r["label"] == "A" and r["confidence"] == r["probabilities"][0]["p"]
    rec = score.scored_records(model.apply(df), "row_id", model.labels, ["g"]).first()
    assert rec["f"]["g"] is not None and all(p["p"] >= 0.005 for p in rec["proba"])
