"""Queries for fits, tuning, clustering, scoring and prepared data sets."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowbench.functions import text
from flowbench.operators import (audit, bayes, blocks, classify, clean, cluster, encode, hierarchy, metrics, neighbors, network, regress, score, split,
                                 summarize)
from flowbench.operators.classify import Config
from flowbench.operators.split import FoldSet
from flowbench.plans.prepare import ablation_sets, prepare_dataset
from flowbench.plans.registry import query, table
from flowbench.plans.views import (CLASSES, FLOW_A, FLOWS, PRED, TIER_FEATURES, TIERS, VECTORS, flow_a, flows, predictions, rounded, tier_vectors, tiers,
                                   vectors)
from flowbench.session import scratch_path
from flowbench.sources import sinks

# ---------------------------------------------------------------- closed-form classifier


def nb_sql(rows: str, feats: list[str], key: str) -> str:
    """CTEs that fit a Gaussian naive Bayes on split = 'train' of ``rows`` and score split = 'test' into ``scored``."""
    stats = ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) + (SELECT e FROM eps) AS v_{f}" for f in feats)
    widest = ", ".join(f"var_pop({f})" for f in feats)
    ll = " ".join(f"- 0.5 * (ln(2 * pi() * v_{f}) + pow({f} - m_{f}, 2) / v_{f})" for f in feats)
    return f"""d AS (SELECT * FROM {rows}), eps AS (SELECT 1e-9 * greatest({widest}) AS e FROM d WHERE split = 'train'),
      s AS (SELECT y AS class, count(*) AS n, {stats} FROM d WHERE split = 'train' GROUP BY y),
      j AS (SELECT {key}, y, class, ln(n / (SELECT sum(n) FROM s)) {ll} AS j FROM d, s WHERE split = 'test'),
      pr AS (SELECT {key}, y, class, exp(j - max(j) OVER (PARTITION BY {key})) / sum(exp(j)) OVER (PARTITION BY {key}) * exp(max(j) OVER (PARTITION BY {key})) AS p, j FROM j),
      scored AS (SELECT {key}, any_value(y) AS y, arg_min(class, (-j, class)) AS pred, max(p) AS confidence FROM pr GROUP BY {key})"""


@query("gaussian_nb", f"WITH {nb_sql(FLOWS, ['qty', 'price', 'disc', 'tax'], 'row_id')} SELECT row_id, y, pred, round(confidence, 6) AS confidence FROM scored")
def gaussian_nb(spark, sf):
    f = flows(spark, sf)
    model = bayes.gaussian_nb(f.filter("split = 'train'"), ["qty", "price", "disc", "tax"], "y")
    out = model.apply(f.filter("split = 'test'"))
    return out.select("row_id", "y", "pred", F.round(F.array_max("p"), 6).alias("confidence"))


def supplier_report(spark, sf):
    """Dedup, hold out suppliers, check the split, clip and scale on train, fit, report per class."""
    f = clean.dedup(flows(spark, sf).drop("split"), ["row_id"])
    f = split.split_by_group(f, "machine", f.select("machine").filter("machine % 5 = 0"))
    if split.check_split(f, "y", "machine").limit(1).count():
        raise ValueError("split shares groups or misses a class")
    train = f.filter("split = 'train'")
    f = clean.clip_quantile(train, ["price"]).apply(f)
    f = encode.standardize(f.filter("split = 'train'"), ["qty", "price", "disc", "tax"]).apply(f)
    model = bayes.gaussian_nb(f.filter("split = 'train'"), ["qty", "price", "disc", "tax"], "y")
    return rounded(metrics.per_class_report(model.apply(f.filter("split = 'test'"))))


_CLIPPED = f"""(WITH u AS (SELECT min(row_id) AS row_id, machine, qty, price, disc, tax, state, y, split FROM {FLOWS} GROUP BY ALL),
    b AS (SELECT quantile_cont(price, 0.01) AS lo, quantile_cont(price, 0.99) AS hi FROM u WHERE split = 'train'),
    c AS (SELECT row_id, y, split, qty, greatest(least(price, hi), lo) AS price, disc, tax FROM u, b),
    z AS (SELECT avg(qty) AS mq, stddev_pop(qty) AS sq, avg(price) AS mp, stddev_pop(price) AS sp, avg(disc) AS md, stddev_pop(disc) AS sd, avg(tax) AS mt, stddev_pop(tax) AS st FROM c WHERE split = 'train')
    SELECT row_id, y, split, (qty - mq) / sq AS qty, (price - mp) / sp AS price, (disc - md) / sd AS disc, (tax - mt) / st AS tax FROM c, z)"""


@query("supplier_report", f"""
    WITH {nb_sql(_CLIPPED, ['qty', 'price', 'disc', 'tax'], 'row_id')}, k AS (SELECT DISTINCT y AS class FROM scored UNION SELECT pred FROM scored),
    r AS (SELECT class, count(*) FILTER (y = class) AS support, count(*) FILTER (pred = class) AS predicted, count(*) FILTER (y = class AND pred = class) AS tp FROM scored, k GROUP BY class)
    SELECT class, round(coalesce(tp / nullif(predicted, 0), 0), 6) AS precision, round(coalesce(tp / nullif(support, 0), 0), 6) AS recall,
      round(coalesce(2 * tp / nullif(support + predicted, 0), 0), 6) AS f1, support::BIGINT AS support, predicted::BIGINT AS predicted, tp::BIGINT AS tp FROM r""")
def supplier_report_query(spark, sf):
    return supplier_report(spark, sf)


# ---------------------------------------------------------------- nearest neighbours

_KNN = f"""v AS (SELECT * FROM {VECTORS}), d AS (SELECT q.vec_id, q.label AS y, t.vec_id AS tid, t.label, list_distance(q.v, t.v) AS d
      FROM v q, v t WHERE q.vec_id % 5 = 0 AND t.vec_id % 5 <> 0), n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, tid) <= 5)"""


@query("nearest_neighbors", f"""
    WITH {_KNN} SELECT vec_id AS query, tid AS neighbor, round(d, 6) AS distance, row_number() OVER (PARTITION BY vec_id ORDER BY d, tid)::INT AS place FROM n""")
def nearest_neighbors(spark, sf):
    v = vectors(spark, sf)
    return rounded(neighbors.nearest_neighbors(v.filter("vec_id % 5 = 0"), v.filter("vec_id % 5 <> 0"), 5, "vec_id", "vec_id", "v"))


@query("knn_classify", f"""
    WITH {_KNN}, w AS (SELECT vec_id, label, sum(1 / d) AS w FROM n GROUP BY vec_id, label)
    SELECT vec_id, arg_min(label, (-w, label)) AS pred, round(max(w) / sum(w), 6) AS confidence FROM w GROUP BY vec_id""")
def knn_classify(spark, sf):
    v = vectors(spark, sf)
    return rounded(neighbors.knn_classify(v.filter("vec_id % 5 <> 0"), v.filter("vec_id % 5 = 0"), "vec_id", "v", "label", 5))


@query("neighbor_visits", f"SELECT count(*)::BIGINT AS queries, true AS few FROM {TIERS} WHERE machine % 5 = 0")
def neighbor_visits(spark, sf):
    """Searches in two rounds look at a small part of the blocks."""
    t = tiers(spark, sf).select("row_id", "machine", F.array("noisy", "k").alias("v"))
    cost = neighbors.neighbor_visits(t.filter("machine % 5 = 0"), t.filter("machine % 5 <> 0"), 10, "row_id", "v", rows_per_cell=20)
    return cost.agg(F.count(F.lit(1)).alias("queries"), (F.avg(F.col("visited") / F.col("blocks")) < 0.25).alias("few"))


@query("knn_regress", f"""
    WITH t AS (SELECT row_id, machine, target, [noisy, k] AS v FROM {TIERS}),
    d AS (SELECT q.row_id, t.row_id AS tid, t.target, list_distance(q.v, t.v) AS d FROM t q, t WHERE q.machine % 5 = 0 AND t.machine % 5 <> 0),
    n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY d, tid) <= 10)
    SELECT row_id, round(CASE WHEN min(d) = 0 THEN avg(target) FILTER (d = 0) ELSE sum(target / d) FILTER (d > 0) / sum(1 / d) FILTER (d > 0) END, 6) AS pred FROM n GROUP BY row_id""")
def knn_regress(spark, sf):
    t = tiers(spark, sf).select("row_id", "machine", "target", F.array("noisy", "k").alias("v"))
    return rounded(neighbors.knn_regress(t.filter("machine % 5 <> 0"), t.filter("machine % 5 = 0"), "row_id", "v", "target", 10))


# ---------------------------------------------------------------- fitted classifiers (rows only)

def _scored(spark, sf, fit):
    train, test = tier_vectors(spark, sf)
    out = fit(train).apply(test)
    return out.select("row_id", "y", "pred", F.transform("p", lambda x: F.round(x, 6)).alias("p"))


@query("fit_logistic")
def fit_logistic(spark, sf):
    return _scored(spark, sf, lambda t: classify.fit_logistic(t, "y"))


@query("fit_tree")
def fit_tree(spark, sf):
    return _scored(spark, sf, lambda t: classify.fit_tree(t, "y"))


@query("fit_kernel_svm")
def fit_kernel_svm(spark, sf):
    return _scored(spark, sf, lambda t: classify.fit_kernel_svm(t, "y"))


@query("fit_random_forest")
def fit_random_forest(spark, sf):
    return _scored(spark, sf, lambda t: classify.fit_random_forest(t, "y"))


@query("fit_adaboost")
def fit_adaboost(spark, sf):
    return _scored(spark, sf, lambda t: classify.fit_adaboost(t, "y", rounds=10))


@query("fit_gbt")
def fit_gbt(spark, sf):
    return _scored(spark, sf, lambda t: classify.fit_gbt(t, "y"))


@query("fit_bagging")
def fit_bagging(spark, sf):
    return _scored(spark, sf, lambda t: classify.fit_bagging(t, "y", "row_id", trees=10, feature_share=0.5, max_depth=10))


@query("fit_mlp")
def fit_mlp(spark, sf):
    return _scored(spark, sf, lambda t: classify.fit_mlp(t, "y", slices=2))


_FLAGS = ["click", "view", "error", "signup"]


@query("boosting_round", f"""
    WITH t AS (SELECT * FROM {TIERS}), n AS (SELECT y, count(*) AS n FROM t WHERE split = 'train' GROUP BY y),
    w AS (SELECT y, (SELECT sum(n) FROM n) / (n * (SELECT count(*) FROM n)) AS w, 1.0 / (SELECT count(*) FROM n) AS q FROM n),
    x AS (SELECT y, w, q, unnest({_FLAGS}) AS f, unnest([click, view, error, signup]) AS v FROM t JOIN w USING (y) WHERE split = 'train'),
    r AS (SELECT c.y AS class, f, v, x.w, (x.y = c.y)::INT - c.q AS r FROM x, w c),
    s AS (SELECT class, f, sum(w) FILTER (v = 0) AS a, sum(w) FILTER (v = 1) AS b, sum(w * r) FILTER (v = 0) AS ga, sum(w * r) FILTER (v = 1) AS gb,
      sum(w * abs(r) * (1 - abs(r))) FILTER (v = 0) AS ha, sum(w * abs(r) * (1 - abs(r))) FILTER (v = 1) AS hb FROM r GROUP BY class, f),
    k AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY class ORDER BY (a * b / (a + b) * pow(ga / a - gb / b, 2))::FLOAT DESC, list_position({_FLAGS}, f)) = 1),
    e AS (SELECT row_id, class, exp(0.1 * (1 - q) * CASE WHEN CASE f WHEN 'click' THEN click WHEN 'view' THEN view WHEN 'error' THEN error ELSE signup END = 1
        THEN gb / hb ELSE ga / ha END) AS e FROM t, k JOIN w ON w.y = k.class WHERE split = 'test')
    SELECT row_id, class, round(e / sum(e) OVER (PARTITION BY row_id), 6) AS p FROM e""")
def boosting_round(spark, sf):
    """One round of stumps on flags, where the best split and the leaves have a closed form."""
    t = VectorAssembler(inputCols=_FLAGS, outputCol="features").transform(tiers(spark, sf))
    model = classify.fit_gbt(t.filter("split = 'train'"), "y", rounds=1, max_depth=1)
    names = F.array(*[F.lit(v) for v in model.labels])
    out = model.apply(t.filter("split = 'test'"))
    return out.select("row_id", F.inline(F.zip_with(names, "p", lambda c, p: F.struct(c.alias("class"), F.round(p, 6).alias("p")))))


@query("network_gradient", f"""
    WITH t AS (SELECT y, noisy / 100 AS a, k / 100 AS b FROM {TIERS} WHERE split = 'train'),
    c AS (SELECT y AS class, row_number() OVER (ORDER BY y) AS c FROM (SELECT DISTINCT y FROM t)),
    h AS (SELECT y, a, b, greatest(a * sin(1) + b * sin(3) + sin(5), 0) AS u, greatest(a * sin(2) + b * sin(4) + sin(6), 0) AS v FROM t),
    o AS (SELECT c.c AS y, a, b, u, v, [exp(u * sin(6 + i) + v * sin(9 + i) + sin(12 + i)) FOR i IN range(1, 4)] AS o FROM h JOIN c ON c.class = h.y),
    p AS (SELECT *, [x / list_sum(o) FOR x IN o] AS p FROM o), e AS (SELECT *, [p[i] - (y = i)::INT FOR i IN range(1, 4)] AS e FROM p),
    d AS (SELECT *, CASE WHEN u > 0 THEN e[1] * sin(7) + e[2] * sin(8) + e[3] * sin(9) ELSE 0 END AS du,
      CASE WHEN v > 0 THEN e[1] * sin(10) + e[2] * sin(11) + e[3] * sin(12) ELSE 0 END AS dv FROM e),
    g AS (SELECT unnest(range(16)) AS place, unnest([-ln(p[y]), a * du, a * dv, b * du, b * dv, du, dv, u * e[1], u * e[2], u * e[3], v * e[1], v * e[2], v * e[3],
      e[1], e[2], e[3]]) AS g FROM d)
    SELECT place::INT AS place, round(avg(g), 6) AS value FROM g GROUP BY place""")
def network_gradient(spark, sf):
    """Mean loss (place 0) and gradient of a small ReLU network with fixed weights, summed over all train rows."""
    t = tiers(spark, sf).filter("split = 'train'").withColumns({"a": F.col("noisy") / 100, "b": F.col("k") / 100, "w": F.lit(1.0)})
    rows = encode.index_labels(t, "y").apply(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(t), "c")
    net = network.Network((2, 2, 3), np.sin(np.arange(1.0, 16.0)))
    n, loss, grad = network.summed_gradient(blocks.write_blocks(rows, "features", "c", "w", network.BLOCK, lambda x: x).drop("slice"), net)
    return spark.createDataFrame([(i, round(v / n, 6)) for i, v in enumerate([loss, *grad.tolist()])], "place int, value double")


@query("soft_vote", f"""
    WITH s AS (SELECT row_id, y, unnest({CLASSES}) AS class, unnest(p) AS p FROM {PRED}), a AS (SELECT row_id, y, class, avg(p) AS p FROM s GROUP BY ALL)
    SELECT row_id, y, arg_min(class, (-p, class)) AS pred, round(max(p), 6) AS confidence FROM a GROUP BY row_id, y""")
def soft_vote(spark, sf):
    v = classify.soft_vote(predictions(spark, sf), CLASSES)
    return v.select("row_id", "y", "pred", F.round(F.array_max("p"), 6).alias("confidence"))


@query("soft_vote_top", f"""
    WITH k AS (SELECT model, y AS class, count(*) AS support, count(*) FILTER (y = pred) AS tp FROM {PRED} GROUP BY ALL),
    g AS (SELECT model, pred AS class, count(*) AS predicted FROM {PRED} GROUP BY ALL),
    b AS (SELECT model, sum(support * coalesce(2.0 * tp / (support + predicted), 0)) / sum(support) AS f1 FROM k LEFT JOIN g USING (model, class) GROUP BY model),
    s AS (SELECT row_id, y, unnest({CLASSES}) AS class, unnest(p) AS p FROM {PRED} WHERE model = (SELECT arg_min(model, (-round(f1, 12), model)) FROM b)),
    a AS (SELECT row_id, y, class, avg(p) AS p FROM s GROUP BY ALL)
    SELECT row_id, y, arg_min(class, (-p, class)) AS pred, round(max(p), 6) AS confidence FROM a GROUP BY row_id, y""")
def soft_vote_top(spark, sf):
    v = classify.soft_vote_top(predictions(spark, sf), CLASSES, 1)
    return v.select("row_id", "y", "pred", F.round(F.array_max("p"), 6).alias("confidence"))


_THRESHOLDS = f"""s AS (SELECT row_id, y, unnest({CLASSES}) AS class, unnest(p) AS p FROM {PRED} WHERE model = 'a'),
    g AS (SELECT class, (i / 20.0)::DOUBLE AS threshold, 2 * count(*) FILTER (p >= (i / 20.0)::DOUBLE AND y = class) / nullif(count(*) FILTER (p >= (i / 20.0)::DOUBLE) + count(*) FILTER (y = class), 0) AS f1
      FROM s, range(1, 20) r(i) WHERE row_id % 4 = 0 GROUP BY class, i),
    t AS (SELECT class, arg_min(threshold, (-round(coalesce(f1, 0), 12), threshold)) AS threshold, max(coalesce(f1, 0)) AS f1 FROM g GROUP BY class)"""


@query("class_thresholds", f"WITH {_THRESHOLDS} SELECT class, threshold, round(f1, 6) AS f1 FROM t")
def class_thresholds(spark, sf):
    return rounded(classify.class_thresholds(predictions(spark, sf).filter("model = 'a' and row_id % 4 = 0"), CLASSES))


@query("apply_thresholds", f"""
    WITH {_THRESHOLDS} SELECT row_id, y, arg_min(class, (-round(p - threshold, 12), class)) AS pred FROM s JOIN t USING (class) WHERE row_id % 4 <> 0 GROUP BY row_id, y""")
def apply_thresholds(spark, sf):
    p = predictions(spark, sf).filter("model = 'a'")
    found = {r["class"]: r["threshold"] for r in classify.class_thresholds(p.filter("row_id % 4 = 0"), CLASSES).collect()}
    return classify.apply_thresholds(p.filter("row_id % 4 <> 0"), CLASSES, found).select("row_id", "y", "pred")


@query("two_stage")
def two_stage(spark, sf):
    train, test = tier_vectors(spark, sf)
    apply = classify.two_stage(train, "y", "act", lambda t, label: classify.fit_tree(t, label, max_depth=6))
    return apply(test).select("row_id", "y", "gate", "sub", "pred")


@query("two_stage_combine", f"""
    WITH p AS (SELECT * FROM {PRED}) SELECT a.row_id, a.y, CASE WHEN a.pred = 'view' THEN 'view' ELSE b.pred END AS pred
    FROM p a JOIN p b USING (row_id) WHERE a.model = 'a' AND b.model = 'b'""")
def two_stage_combine(spark, sf):
    p = predictions(spark, sf).groupBy("row_id", "y").agg(F.max(F.when(F.col("model") == "a", F.col("pred"))).alias("first"),
                                                          F.max(F.when(F.col("model") == "b", F.col("pred"))).alias("sub"))
    gated = p.withColumn("gate", (F.col("first") != "view").cast("int"))
    return classify.combine_two_stage(gated, "gate", "sub", "view").select("row_id", "y", "pred")


def _tree_grid() -> list[Config]:
    return [Config(f"depth={d}, balanced={b}", lambda t, d=d, b=b: classify.fit_tree(t, "y", d, b)) for d in (3, 8) for b in (True, False)]


def _cls_configs() -> list[Config]:
    return [Config("tree", lambda t: classify.fit_tree(t, "y", 8), {"family": "tree"}),
            Config("forest", lambda t: classify.fit_random_forest(t, "y", 10, 8), {"family": "bagging"}),
            Config("logistic", lambda t: classify.fit_logistic(t, "y", max_iter=30), {"family": "linear"})]


@query("grid_search")
def grid_search(spark, sf):
    train, test = tier_vectors(spark, sf)
    folded = split.kfold_grouped(train, "y", "machine", 3).persist()
    _, grid = classify.tune(_tree_grid(), FoldSet(folded, 3), folded, test)
    rows = grid.collect()
    folded.unpersist()
    return rounded(spark.createDataFrame(rows, grid.schema))


@query("random_search")
def random_search(spark, sf):
    train, _ = tier_vectors(spark, sf)
    part = split.sample_stratified(train, "y", ["row_id"], int(train.count() * 0.35))
    folded = split.kfold_stratified(part, "y", ["row_id"], 3).persist()
    best, grid = classify.random_search(_tree_grid(), 2, FoldSet(folded, 3))
    folded.unpersist()
    return rounded(grid.withColumn("chosen", F.col("model") == best.name))


@query("cross_validate_top")
def cross_validate_top(spark, sf):
    train, test = tier_vectors(spark, sf)
    train = train.persist()
    configs = _cls_configs()[:2]
    board = classify.fit_all(configs, train, test, CLASSES)
    sets = {"grouped": FoldSet(split.kfold_grouped(train, "y", "machine", 3), 3), "stratified": FoldSet(split.kfold_stratified(train, "y", ["row_id"], 3), 3)}
    out = classify.cross_validate_top(board, configs, sets, 1)
    rows = out.collect()
    train.unpersist()
    return rounded(spark.createDataFrame(rows, out.schema))


@query("fit_all")
def fit_all(spark, sf):
    train, test = tier_vectors(spark, sf)
    return rounded(classify.fit_all(_cls_configs(), train.persist(), test, CLASSES))


# ---------------------------------------------------------------- regression

@query("fit_linear", """
    WITH t AS (SELECT o_orderkey, ln(1 + o_totalprice) AS y, o_custkey::DOUBLE AS x FROM orders), s AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM t)
    SELECT o_orderkey, round(a + b * x, 6) AS yhat FROM t, s""")
def fit_linear(spark, sf):
    t = table(spark, sf, "orders").select("o_orderkey", F.log1p("o_totalprice").alias("y"), F.col("o_custkey").cast("double").alias("x"))
    plan = encode.FeaturePlan(["x"])
    return rounded(regress.fit_linear(plan.assemble(t), "y").apply(plan.assemble(t)).select("o_orderkey", "yhat"))


@query("fit_linear_1d", f"""
    WITH t AS (SELECT * FROM {TIERS}), s AS (SELECT regr_slope(target, noisy) AS b, regr_intercept(target, noisy) AS a FROM t WHERE split = 'train')
    SELECT row_id, round(a + b * noisy, 6) AS yhat FROM t, s WHERE split = 'test'""")
def fit_linear_1d(spark, sf):
    t = tiers(spark, sf)
    return rounded(regress.fit_linear_1d(t.filter("split = 'train'"), "noisy", "target").apply(t.filter("split = 'test'")).select("row_id", "yhat"))


@query("fit_ridge", f"""
    WITH t AS (SELECT * FROM {TIERS}), s AS (SELECT covar_pop(target, noisy) * count(*) / (var_pop(noisy) * count(*) + 1000) AS b, avg(target) AS my, avg(noisy) AS mx FROM t WHERE split = 'train')
    SELECT row_id, round(my + b * (noisy - mx), 6) AS yhat FROM t, s WHERE split = 'test'""")
def fit_ridge(spark, sf):
    t = encode.FeaturePlan(["noisy"]).assemble(tiers(spark, sf))
    return rounded(regress.fit_ridge(t.filter("split = 'train'"), "target", 1000.0).apply(t.filter("split = 'test'")).select("row_id", "yhat"))


def _yhat(spark, sf, fit):
    train, test = tier_vectors(spark, sf)
    return rounded(fit(train).apply(test).select("row_id", "target", "yhat"))


@query("fit_lasso")
def fit_lasso(spark, sf):
    return _yhat(spark, sf, lambda t: regress.fit_lasso(t, "target"))


@query("fit_elasticnet")
def fit_elasticnet(spark, sf):
    return _yhat(spark, sf, lambda t: regress.fit_elasticnet(t, "target"))


@query("fit_poly_ridge")
def fit_poly_ridge(spark, sf):
    return _yhat(spark, sf, lambda t: regress.fit_poly_ridge(t, "target"))


@query("fit_tree_reg")
def fit_tree_reg(spark, sf):
    return _yhat(spark, sf, lambda t: regress.fit_tree_reg(t, "target"))


@query("fit_forest_reg")
def fit_forest_reg(spark, sf):
    return _yhat(spark, sf, lambda t: regress.fit_forest_reg(t, "target"))


@query("fit_gbt_reg")
def fit_gbt_reg(spark, sf):
    return _yhat(spark, sf, lambda t: regress.fit_gbt_reg(t, "target"))


@query("fit_kernel_reg")
def fit_kernel_reg(spark, sf):
    return _yhat(spark, sf, lambda t: regress.fit_kernel_reg(t, "target"))


@query("mean_baseline", f"""
    SELECT row_id, round((SELECT avg(target) FROM {TIERS} WHERE split = 'train'), 6) AS yhat FROM {TIERS} WHERE split = 'test'""")
def mean_baseline(spark, sf):
    t = tiers(spark, sf)
    return rounded(regress.mean_baseline(t.filter("split = 'train'"), "target").apply(t.filter("split = 'test'")).select("row_id", "yhat"))


def _reg_configs() -> list[Config]:
    return [Config("mean", lambda t: regress.mean_baseline(t, "target")), Config("linear", lambda t: regress.fit_linear(t, "target")),
            Config("tree", lambda t: regress.fit_tree_reg(t, "target", 6))]


@query("regression_leaderboard")
def regression_leaderboard(spark, sf):
    train, test = tier_vectors(spark, sf)
    fitted, valid = train.filter("machine % 5 <> 1"), train.filter("machine % 5 = 1")
    cap = float(np.expm1(train.agg(F.max("target")).first()[0]))
    return rounded(summarize.leaderboard(regress.regression_leaderboard(_reg_configs(), fitted, valid, test, "target", cap), "model", "r2"))


@query("grid_search_reg")
def grid_search_reg(spark, sf):
    train, _ = tier_vectors(spark, sf)
    grid = [Config(f"depth={d}", lambda t, d=d: regress.fit_tree_reg(t, "target", d)) for d in (2, 5, 8)]
    folded = split.kfold_stratified(train, "y", ["row_id"], 3).persist()
    best, rows = regress.grid_search_reg(grid, FoldSet(folded, 3), "target")
    folded.unpersist()
    return rounded(rows.withColumn("chosen", F.col("model") == best.name))


@query("cv_reg")
def cv_reg(spark, sf):
    train, _ = tier_vectors(spark, sf)
    folded = split.kfold(train, "row_id", 5).persist()
    out = regress.cv_reg(_reg_configs()[1:2], FoldSet(folded, 5), "target")
    return rounded(summarize.fold_summary(out, ["model"], "fold", "r2"))


@query("feature_importance")
def feature_importance(spark, sf):
    train, _ = tier_vectors(spark, sf)
    return rounded(regress.feature_importance(regress.fit_forest_reg(train, "target", 20, 8).model, TIER_FEATURES, spark))


@query("tree_interval")
def tree_interval(spark, sf):
    train, test = tier_vectors(spark, sf)
    forest = regress.fit_forest_reg(train, "target", 20, 8).model
    return rounded(regress.tree_interval(test, forest).select("row_id", "yhat", "low", "high"))


@query("array_percentile", f"""
    SELECT row_id, model, round(quantile_cont(x, 0.1), 6) AS low, round(quantile_cont(x, 0.5), 6) AS mid, round(quantile_cont(x, 0.9), 6) AS high
    FROM (SELECT row_id, model, unnest(p) AS x FROM {PRED}) GROUP BY row_id, model""")
def array_percentile(spark, sf):
    p = predictions(spark, sf)
    return rounded(p.select("row_id", "model", *[regress.array_percentile(F.col("p"), q).alias(n) for n, q in (("low", 0.1), ("mid", 0.5), ("high", 0.9))]))


@query("what_if_sweep")
def what_if_sweep(spark, sf):
    t = tiers(spark, sf)
    plan = encode.FeaturePlan(TIER_FEATURES)
    forest = regress.fit_forest_reg(plan.assemble(t.filter("split = 'train'")), "target", 10, 6).model
    # The published sweep counts.
    sweep = [0, 1, 2, 3, 4, 6, 8, 10, 14, 20, 30, 44, 64, 100, 150, 220, 330, 500, 750, 1100, 1700, 2500, 4000]
    return rounded(regress.what_if_sweep(t.filter("split = 'test'"), "row_id", "noisy", sweep, plan.assemble, forest))


@query("shuffled_target")
def shuffled_target(spark, sf):
    train, test = tier_vectors(spark, sf)
    control = regress.fit_tree_reg(regress.shuffled_target(train, "row_id", "target"), "target", 6).apply(test)
    honest = regress.fit_tree_reg(train, "target", 6).apply(test)
    parts = [metrics.regression_metrics(d, "target", "yhat").withColumn("fit", F.lit(n)) for n, d in (("shuffled", control), ("honest", honest))]
    return rounded(parts[0].unionByName(parts[1]))


@query("shuffled_target_rows", f"""
    WITH h AS (SELECT row_id, target, row_number() OVER (ORDER BY ('0x' || substr(md5(concat_ws(':', row_id, '42')), 1, 15))::BIGINT) AS a,
      row_number() OVER (ORDER BY ('0x' || substr(md5(concat_ws(':', row_id, '43')), 1, 15))::BIGINT) AS b FROM {TIERS})
    SELECT x.row_id, round(y.target, 6) AS target FROM h x JOIN h y ON x.a = y.b""")
def shuffled_target_rows(spark, sf):
    return rounded(regress.shuffled_target(tiers(spark, sf).select("row_id", "target"), "row_id", "target").select("row_id", "target"))


# ---------------------------------------------------------------- clustering

_CENTERS = f"c AS (SELECT label, v AS cv FROM {VECTORS} QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1)"
_ASSIGNED = f"""{_CENTERS}, a AS (SELECT vec_id, v, arg_min(c.label, (list_distance(v, cv), c.label)) AS cluster, min(list_distance(v, cv)) AS distance FROM {VECTORS} x, c GROUP BY vec_id, v)"""


def _label_centers(spark, sf) -> np.ndarray:
    first = vectors(spark, sf).groupBy("label").agg(F.min_by("v", "vec_id").alias("v")).orderBy("label").collect()
    return np.array([r["v"] for r in first])


@query("assign_cluster", f"WITH {_ASSIGNED} SELECT vec_id, cluster, round(distance, 6) AS distance FROM a")
def assign_cluster(spark, sf):
    return rounded(cluster.assign_cluster(vectors(spark, sf), "v", _label_centers(spark, sf)).select("vec_id", "cluster", "distance"))


@query("kmeans_step", f"""
    WITH {_ASSIGNED}, u AS (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a), m AS (SELECT cluster, i, round(avg(x), 6) AS m FROM u GROUP BY cluster, i)
    SELECT cluster, any_value(n)::BIGINT AS size, list(m ORDER BY i) AS center, round(any_value(s), 6) AS inertia
    FROM m JOIN (SELECT cluster, count(*) AS n, sum(distance * distance) AS s FROM a GROUP BY cluster) USING (cluster) GROUP BY cluster""")
def kmeans_step(spark, sf):
    return rounded(cluster.kmeans_step(vectors(spark, sf), "v", _label_centers(spark, sf)))


@query("fit_kmeans")
def fit_kmeans(spark, sf):
    v = vectors(spark, sf)
    centers, _ = cluster.fit_kmeans(v, "v", 6, 10)
    return rounded(cluster.assign_cluster(v, "v", centers).select("vec_id", "cluster", "distance"))


def _plane(spark, sf):
    """Events as points in a plane."""
    t = tiers(spark, sf)
    scale = encode.standardize(t, ["noisy", "k"])
    return scale.apply(t).select("row_id", "y", F.array("noisy", "k").alias("v"))


@query("elbow_sweep")
def elbow_sweep(spark, sf):
    return rounded(cluster.elbow_sweep(_plane(spark, sf), "row_id", "v", list(range(2, 13))))


@query("minibatch_kmeans")
def minibatch_kmeans(spark, sf):
    v = _plane(spark, sf)
    centers = cluster.minibatch_kmeans(v, "row_id", "v", 5, batches=5)
    return rounded(cluster.kmeans_step(v, "v", centers))


@query("gaussian_mixture")
def gaussian_mixture(spark, sf):
    v = _plane(spark, sf)
    model = cluster.gaussian_mixture(v, "v", 4, 8)
    return rounded(model.apply(v, "v").select("row_id", "cluster", "p"))


def _trees(df, key, vec) -> dict:
    """A hierarchy of all rows for each linkage, built side by side."""
    with ThreadPoolExecutor(4) as pool:
        return dict(zip(hierarchy.LINKAGES, pool.map(lambda name: hierarchy.hierarchical(df, key, vec, name), hierarchy.LINKAGES)))


@query("hierarchical")
def hierarchical(spark, sf):
    trees = _trees(vectors(spark, sf), "vec_id", "v")
    with ThreadPoolExecutor(4) as pool:
        cut = pool.map(lambda t: t[1].labels(6).groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).withColumn("linkage", F.lit(t[0])), trees.items())
    return reduce(DataFrame.unionByName, cut)


# What the merges of each linkage must add up to: ward's halved squares to the squares about the mean; average's heights, weighted by the
# pairs they stand for, to all distances; complete's highest to the largest distance; single's up to a distance to the links of the forest.
_LINKED = 0.9


@query("hierarchy_identities", f"""
    WITH RECURSIVE v AS (SELECT vec_id, v FROM {VECTORS}), d AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.v, b.v) AS d FROM v a JOIN v b ON a.vec_id < b.vec_id),
    e AS (SELECT a, b FROM d WHERE d <= {_LINKED} UNION ALL SELECT b, a FROM d WHERE d <= {_LINKED}),
    reach(id, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT e.b, r.c FROM reach r JOIN e ON e.a = r.id WHERE r.c < e.b), comp AS (SELECT id, min(c) AS c FROM reach GROUP BY id),
    u AS (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v), s AS (SELECT sum(x * x) - sum(x) * sum(x) / count(*) AS s FROM u GROUP BY i)
    SELECT 'ward' AS linkage, (SELECT round(sum(s), 4) FROM s) AS value UNION ALL SELECT 'average', (SELECT round(sum(d), 3) FROM d)
    UNION ALL SELECT 'complete', (SELECT round(max(d), 6) FROM d) UNION ALL SELECT 'single', (SELECT count(*) - count(DISTINCT c) FROM comp)::DOUBLE""")
def hierarchy_identities(spark, sf):
    of = {"ward": F.round(F.sum(F.col("distance") * F.col("distance") / 2), 4), "average": F.round(F.sum(F.col("distance") * F.col("left_size") * F.col("right_size")), 3),
          "complete": F.round(F.max("distance"), 6), "single": F.count_if(F.col("distance") <= _LINKED).cast("double")}
    parts = [t.merges.agg(of[name].alias("value")).select(F.lit(name).alias("linkage"), "value") for name, t in _trees(vectors(spark, sf), "vec_id", "v").items()]
    return reduce(DataFrame.unionByName, parts)


@query("single_linkage_cut", f"""
    WITH RECURSIVE p AS (SELECT c_custkey AS id, c_acctbal AS x FROM customer), o AS (SELECT id, x, x - lag(x) OVER (ORDER BY x, id) AS gap FROM p),
    g AS (SELECT id, sum(CASE WHEN gap > 8 THEN 1 ELSE 0 END) OVER (ORDER BY x, id ROWS UNBOUNDED PRECEDING) AS g FROM o), f AS (SELECT g, dense_rank() OVER (ORDER BY min(id)) - 1 AS cluster FROM g GROUP BY g)
    SELECT id, CAST(cluster AS INTEGER) AS cluster FROM g JOIN f USING (g)""")
def single_linkage_cut(spark, sf):
    """On a line, single linkage cuts where a gap is wider than the distance."""
    p = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.array("c_acctbal").alias("v"))
    return hierarchy.hierarchical(p, "id", "v", "single").labels_at(8.0)


@query("bisecting")
def bisecting(spark, sf):
    return cluster.bisecting(_plane(spark, sf), "v", 6).select("row_id", "cluster")


@query("micro_clusters")
def micro_clusters(spark, sf):
    v = _plane(spark, sf)
    return hierarchy.micro_hierarchy(v, "v", 0.5).predict(v, "row_id", "v", 6).groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


@query("micro_clusters_mass", f"""
    SELECT count(*)::DOUBLE AS mass, list_value(round(sum(noisy), 2), round(sum(k), 2)) AS total, round(sum(noisy * noisy + k * k), 0) AS squares, true AS within FROM {TIERS}""")
def micro_clusters_mass(spark, sf):
    """Summaries of all rows: nothing is lost, and none is wider than the threshold."""
    m = hierarchy.micro_clusters(tiers(spark, sf).select(F.array("noisy", "k").alias("v")), "v", 5.0)
    width = F.col("squares") / F.col("n") - F.aggregate("center", F.lit(0.0), lambda a, x: a + x * x)
    return m.agg(F.sum("n").alias("mass"), F.array(*[F.round(F.sum(F.col("total")[i]), 2) for i in range(2)]).alias("total"), F.round(F.sum("squares"), 0).alias("squares"),
                 F.max((width <= 25.0 + 1e-6) & (F.size("center") == 2)).alias("within"))


@query("merge_table")
def merge_table(spark, sf):
    h = hierarchy.hierarchical(vectors(spark, sf), "vec_id", "v", "ward")
    return rounded(hierarchy.merge_table(h).withColumn("cut_for_6", F.lit(h.cut_height(6))))


# Density clusters of customers on a line of account balances scaled by market segment: every customer, eps 3, 10 rows.
_BALANCE = "(SELECT c_custkey AS id, c_acctbal / 10.0::DOUBLE AS x, c_nationkey * 100.0::DOUBLE AS z FROM customer)"


@query("dbscan", f"""
    WITH RECURSIVE p AS (SELECT * FROM {_BALANCE}), e AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON sqrt(pow(a.x - b.x, 2) + pow(a.z - b.z, 2)) <= 25),
    core AS (SELECT a AS id FROM e GROUP BY a HAVING count(*) >= 5), ce AS (SELECT a, b FROM e WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    reach(id, c) AS (SELECT id, id FROM core UNION SELECT ce.b, r.c FROM reach r JOIN ce ON ce.a = r.id), comp AS (SELECT id, min(c) AS c FROM reach GROUP BY id),
    border AS (SELECT a.id, arg_min(comp.c, (sqrt(pow(a.x - b.x, 2) + pow(a.z - b.z, 2)), b.id)) AS c FROM p a JOIN e ON e.a = a.id JOIN comp ON comp.id = e.b JOIN p b ON b.id = e.b
      WHERE a.id NOT IN (SELECT id FROM core) GROUP BY a.id)
    SELECT p.id, core.id IS NOT NULL AS core, coalesce(comp.c, border.c) AS cluster_key FROM p LEFT JOIN core ON core.id = p.id LEFT JOIN comp ON comp.id = p.id LEFT JOIN border ON border.id = p.id""")
def dbscan(spark, sf):
    p = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.array(F.col("c_acctbal") / 10.0, F.col("c_nationkey") * 100.0).alias("v"))
    return cluster.dbscan(p, "id", "v", 25.0, 5)


@query("neighbor_radius", f"""
    WITH v AS (SELECT * FROM {VECTORS}), d AS (SELECT a.vec_id, list_distance(a.v, b.v) AS d, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rn FROM v a, v b)
    SELECT round(quantile_cont(d, 0.95), 5) AS eps FROM d WHERE rn = 10""")
def neighbor_radius(spark, sf):
    eps = cluster.neighbor_radius(vectors(spark, sf), "vec_id", "v", 10)
    return spark.createDataFrame([(round(eps, 5),)], "eps double")


@query("pca")
def pca(spark, sf):
    out, share = cluster.pca(vectors(spark, sf), "v", 2)
    return rounded(out.select("vec_id", "pc").withColumn("explained", F.array(*[F.lit(float(s)) for s in share])))


@query("display_scale", """
    WITH a AS (SELECT event_id, asinh(value / (SELECT median(abs(value)) FROM events)) AS x, asinh(user_id::DOUBLE / (SELECT median(abs(user_id)) FROM events)) AS z FROM events),
    q AS (SELECT quantile_cont(x, 0.005) AS xl, quantile_cont(x, 0.995) AS xh, quantile_cont(z, 0.005) AS zl, quantile_cont(z, 0.995) AS zh FROM a),
    s AS (SELECT event_id, (x - xl) / (xh - xl) AS x, (z - zl) / (zh - zl) AS z FROM a, q) SELECT event_id, round(x, 6) AS x, round(z, 6) AS z FROM s WHERE x BETWEEN 0 AND 1 AND z BETWEEN 0 AND 1""")
def display_scale(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("value").alias("x"), F.col("user_id").cast("double").alias("z"))
    return rounded(cluster.display_scale(e, ["x", "z"], asinh=True))


@query("k_sweep")
def k_sweep(spark, sf):
    algorithms = cluster.cluster_algorithms("vec_id", "v")
    sweep = cluster.k_sweep(vectors(spark, sf), "vec_id", "v", "label", [2, 5], algorithms)
    low = {"silhouette": False, "davies_bouldin": True, "calinski_harabasz": False, "ari": False}
    return rounded(summarize.arg_best(sweep, "k", low, ["algorithm"]))


@query("stability")
def stability(spark, sf):
    runs, ari = cluster.stability(_plane(spark, sf), "row_id", "v", 4)
    a = summarize.mean_std(summarize.long_metrics(runs, "run", ["silhouette", "davies_bouldin", "calinski_harabasz"]), ["metric"], ["value"])
    b = summarize.mean_std(ari.select(F.lit("ari").alias("metric"), F.col("ari").alias("value")), ["metric"], ["value"])
    return rounded(a.unionByName(b))


# ---------------------------------------------------------------- scoring

@query("score_classify", f"WITH {nb_sql(FLOWS, ['qty', 'price'], 'row_id')} SELECT row_id, pred AS prediction, lower(pred) AS note, round(confidence, 6) AS confidence FROM scored")
def score_classify(spark, sf):
    f = flows(spark, sf)
    model = bayes.gaussian_nb(f.filter("split = 'train'"), ["qty", "price"], "y")
    out = score.score_classify(f.filter("split = 'test'"), "row_id", model, lambda d: d, {"A": "a", "N": "n", "R": "r"})
    return rounded(out.select("row_id", "prediction", "note", "confidence"))


@query("score_cluster", f"""
    WITH {_ASSIGNED}, z AS (SELECT cluster, count(*)::BIGINT AS size FROM a GROUP BY cluster) SELECT vec_id, cluster + 1 AS cluster, round(distance, 6) AS distance, size FROM a JOIN z USING (cluster)""")
def score_cluster(spark, sf):
    v, centers = vectors(spark, sf), _label_centers(spark, sf)
    profiles = cluster.kmeans_step(v, "v", centers).select("cluster", "size")
    return rounded(score.score_cluster(v, "vec_id", "v", centers, profiles).select("vec_id", "cluster", "distance", "size"))


@query("score_regress")
def score_regress(spark, sf):
    t = tiers(spark, sf)
    train = t.filter("split = 'train'")
    plan = encode.FeaturePlan(TIER_FEATURES)
    forest = regress.fit_forest_reg(plan.assemble(train), "target", 10, 6).model
    template = clean.numeric_template(train.select(*TIER_FEATURES))
    partial = t.filter("split = 'test'").select("row_id", "noisy", "click", F.when(F.col("row_id") % 2 == 0, F.col("k")).alias("k"))
    return rounded(score.score_regress(partial, "row_id", template, plan.assemble, forest))


@query("scored_records", f"""
    WITH s AS (SELECT row_id, model, y, pred, unnest({CLASSES}) AS class, unnest(p) AS p FROM {PRED}),
    r AS (SELECT *, row_number() OVER (PARTITION BY row_id, model ORDER BY p DESC, class) AS rn FROM s)
    SELECT row_id, model, y AS label, pred, string_agg(class, '|' ORDER BY rn) FILTER (rn <= 4 AND p >= 0.005) AS names, max(p) AS top_p FROM r GROUP BY ALL""")
def scored_records(spark, sf):
    p = predictions(spark, sf)
    out = score.scored_records(p.withColumn("rid", F.struct("row_id", "model")), "rid", CLASSES, ["model"])
    return out.select("rid.row_id", "rid.model", "label", "pred", F.array_join(F.transform("proba", lambda x: x["name"]), "|").alias("names"),
                      F.col("proba")[0]["p"].alias("top_p"))


@query("save_bundle")
def save_bundle(spark, sf):
    t = tiers(spark, sf)
    train = t.filter("split = 'train'")
    stages = [StringIndexer(inputCol="y", outputCol="label", stringOrderType="alphabetAsc"), VectorAssembler(inputCols=TIER_FEATURES, outputCol="features"),
              RandomForestClassifier(numTrees=5, maxDepth=6, seed=42)]
    path = scratch_path(spark, "bundle")
    sinks.save_bundle(spark, path, Pipeline(stages=stages).fit(train), {"classes": audit.value_counts(train, "y")}, {"task": "tiers"})
    model, tables, meta = sinks.load_bundle(spark, path)
    scored = model.transform(t.filter("split = 'test'"))
    return scored.select("row_id", "y", F.col("prediction").cast("int").alias("pred"), F.round(vector_to_array("probability")[0], 6).alias("p0")).withColumn(
        "task", F.lit(meta["task"]))


# ---------------------------------------------------------------- prepared data sets

_META_IN = f"(SELECT * EXCLUDE (row_id) FROM {FLOW_A} UNION ALL SELECT * EXCLUDE (row_id) FROM {FLOW_A} WHERE dpkts = 2)"


def _raw(spark, sf):
    a = flow_a(spark, sf).drop("row_id")
    return a.unionByName(a.filter("dpkts = 2"))


@query("prepare_dataset", f"""
    WITH raw AS (SELECT * FROM {_META_IN}), u AS (SELECT DISTINCT * EXCLUDE (id, ct_ftp_cmd) FROM raw),
    c AS (SELECT round(count(*) * 0.2) AS t FROM u GROUP BY CASE WHEN trim(attack_cat) IN ('', 'nan') THEN 'Normal' ELSE trim(attack_cat) END)
    SELECT 'classification' AS task, (SELECT count(*) FROM raw)::BIGINT AS n_rows_before_clean, (SELECT count(*) FROM u)::BIGINT AS n_rows_after_clean,
      ((SELECT count(*) FROM raw) - (SELECT count(*) FROM u))::BIGINT AS duplicates_removed, (SELECT count(*) FROM u)::BIGINT - sum(t)::BIGINT AS n_train, sum(t)::BIGINT AS n_test,
      false AS drop_leaky, false AS subsampled FROM c""")
def prepare_classification(spark, sf):
    b = prepare_dataset(_raw(spark, sf), "classification")
    return b.meta.select("task", "n_rows_before_clean", "n_rows_after_clean", "duplicates_removed", "n_train", "n_test", "drop_leaky", "subsampled")


@query("prepare_dataset_regression")
def prepare_regression(spark, sf):
    b = prepare_dataset(_raw(spark, sf), "regression", drop_leaky=True, log_target=True, subsample=2000)
    return b.meta


@query("prepare_dataset_clustering")
def prepare_clustering(spark, sf):
    b = prepare_dataset(_raw(spark, sf), "clustering")
    return rounded(b.train.select("row_key", vector_to_array("features").alias("features")))


@query("ablation_sets")
def ablation(spark, sf):
    t = tiers(spark, sf)
    return rounded(ablation_sets(t.filter("split = 'train'"), t.filter("split = 'test'"), "target", TIER_FEATURES,
                                 [("- noisy value", ["noisy"]), ("- also counter", ["k"]), ("- also clicks", ["click", "view"])], regress.fit_linear))


@query("text_functions", """
    SELECT o_orderkey, CASE WHEN b < 1000 THEN printf('%.0f B', b) WHEN b < 10000 THEN printf('%.2f KB', b / 1000) WHEN b < 1000000 THEN printf('%.1f KB', b / 1000) ELSE printf('%.2f MB', b / 1000000) END AS size,
      printf('%.1f%%', 100 * s) AS share, upper(substr(o_orderpriority, 1, 1)) || lower(substr(o_orderpriority, 2)) AS label
    FROM (SELECT o_orderkey, o_orderpriority, floor(o_totalprice * (o_orderkey % 7)) + 0.25 AS b, (o_orderkey % 97) / 131.0::DOUBLE AS s FROM orders)""")
def text_functions(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderpriority", "floor(o_totalprice * (o_orderkey % 7)) + 0.25D AS b", "(o_orderkey % 97) / 131.0D AS s")
    return o.select("o_orderkey", text.format_bytes("b").alias("size"), text.format_percent("s", 1).alias("share"), text.display_label("o_orderpriority").alias("label"))
