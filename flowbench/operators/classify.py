"""Classifiers on ``pyspark.ml``. Every fitted model keeps the row key and returns p and pred.

Where Spark has no equal, the method is built on blocks of rows (softmax boosting, ReLU network, trees on bootstraps) or the nearest
distributed method stands in (kernel SVM); the docstring says which.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd

from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowbench.functions.hashing import POISSON1_CDF, count_at_or_below, hash_uniform
from flowbench.functions.small import fit_input, lookup
from flowbench.operators.blocks import numbers
from flowbench.operators.boosting import fit_boosted
from flowbench.operators.encode import IndexModel, balanced_weights, index_labels
from flowbench.operators.metrics import metrics_from_cells, roc_auc_macro
from flowbench.operators.network import fit_network
from flowbench.operators.split import FoldSet
from flowbench.session import checkpoint_root, write_through

FEATURES, LABEL = "features", "__y"


def argmax_label(p: Column, labels: list) -> Column:
    """Label of the largest entry, the first among equals."""
    return F.get(F.array(*[F.lit(v) for v in labels]), F.array_position(p, F.array_max(p)).cast("int") - 1)


@dataclass
class Classifier:
    """A fitted model: adds ``p`` (scores in label order) and ``pred`` to any table with features."""

    index: IndexModel
    model: object
    scores: Callable[[DataFrame], DataFrame]

    @property
    def labels(self) -> list:
        return self.index.levels

    def apply(self, df: DataFrame) -> DataFrame:
        return self.scores(df).withColumn("pred", argmax_label(F.col("p"), self.labels))


def _labelled(train: DataFrame, label: str, balanced: bool) -> tuple[DataFrame, IndexModel]:
    index = index_labels(train, label)
    df = index.apply(train, LABEL).withColumn(LABEL, F.col(LABEL).cast("double"))
    return (balanced_weights(df, label, "__w") if balanced else df.withColumn("__w", F.lit(1.0))), index


def _from_probability(model) -> Callable[[DataFrame], DataFrame]:
    extra = ["rawPrediction", "probability", "prediction"]
    return lambda df: model.transform(df).withColumn("p", vector_to_array("probability")).drop(*extra)


def _fit(est, train: DataFrame, label: str, balanced: bool) -> Classifier:
    df, index = _labelled(train, label, balanced)
    if est.hasParam("weightCol"):
        est = est.copy({est.weightCol: "__w"})
    data = fit_input(df, [FEATURES, LABEL, "__w"])
    model = est.fit(data)
    data.unpersist()
    return Classifier(index, model, _from_probability(model))


def fit_logistic(train: DataFrame, label: str, c: float = 1.0, max_iter: int = 100, balanced: bool = True) -> Classifier:
    """Multinomial logistic regression. The penalty is 1/(C n) because Spark's loss is a mean."""
    est = LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, family="multinomial", regParam=1.0 / (c * max(train.count(), 1)),
                             elasticNetParam=0.0, standardization=False, maxIter=max_iter)
    return _fit(est, train, label, balanced)


def fit_tree(train: DataFrame, label: str, max_depth: int = 30, balanced: bool = True, seed: int = 42) -> Classifier:
    """Decision tree; Spark's depth limit is 30."""
    est = DecisionTreeClassifier(featuresCol=FEATURES, labelCol=LABEL, maxDepth=max_depth, seed=seed)
    return _fit(est, train, label, balanced)


def fit_random_forest(train: DataFrame, label: str, trees: int = 200, max_depth: int = 20, balanced: bool = True, seed: int = 42) -> Classifier:
    """Random forest; balanced weights are those of the whole table, not of each bootstrap."""
    est = RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, numTrees=trees, maxDepth=max_depth, featureSubsetStrategy="sqrt", seed=seed)
    return _fit(est, train, label, balanced)


def fit_mlp(train: DataFrame, label: str, hidden: tuple[int, ...] = (100, 50), max_iter: int = 300, seed: int = 42, **settings) -> Classifier:
    """Feed-forward network of ReLU units, Adam on hash-sliced mini-batches (``network.fit_network``); no class weights."""
    df, index = _labelled(train, label, False)
    width = df.select(F.size(numbers(FEATURES)).alias("d")).agg(F.max("d")).first()[0]
    net, _ = fit_network(df, FEATURES, LABEL, "__w", width, len(index.levels), hidden, max_iter, seed=seed, **settings)
    return Classifier(index, net, lambda d: net.apply(d, FEATURES))


def _one_vs_rest_scores(model, link: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    """Score columns of the binary models, side by side. Each model is one column of the same pass."""

    def score(df: DataFrame) -> DataFrame:
        out, cols = df, []
        for i, m in enumerate(model.models):
            part = m.copy()
            part.setRawPredictionCol(f"__r{i}")
            part.setPredictionCol(f"__p{i}")
            if part.hasParam("probabilityCol"):
                part.setProbabilityCol(f"__q{i}")
            out = part.transform(out)
            cols.append(link(vector_to_array(f"__r{i}")[1]))
        drops = [f"__{a}{i}" for i in range(len(model.models)) for a in ("r", "p", "q")]
        return out.withColumn("p", F.array(*cols)).drop(*drops)

    return score


def fit_gbt(train: DataFrame, label: str, rounds: int = 100, step: float = 0.1, max_depth: int = 3, subsample: float = 1.0, balanced: bool = True,
            seed: int = 42) -> Classifier:
    """Gradient boosting with a softmax over the classes, a tree per class and round (``boosting.fit_boosted``)."""
    df, index = _labelled(train, label, balanced)
    model = fit_boosted(df, FEATURES, LABEL, "__w", len(index.levels), rounds, step, max_depth, subsample, seed=seed)
    return Classifier(index, model, lambda d: model.apply(d, FEATURES))


def fourier_features(df: DataFrame, dims: int, gamma: float, seed: int = 42, size: int = 200, out: str = "__rff") -> DataFrame:
    """Random Fourier features of an RBF kernel (Rahimi and Recht 2007): cos(xW + b), one product per batch."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2.0 * gamma), (dims, size))
    b = rng.uniform(0.0, 2.0 * np.pi, size)
    shared = df.sparkSession.sparkContext.broadcast((w, b))

    @F.pandas_udf("array<double>")
    def project(v: pd.Series) -> pd.Series:
        ww, bb = shared.value
        if not len(v):
            return pd.Series([], dtype=object)
        z = np.sqrt(2.0 / len(bb)) * np.cos(np.stack(v.to_numpy()) @ ww + bb)
        return pd.Series(list(z))

    return df.withColumn(out, array_to_vector(project(vector_to_array(FEATURES))))


def kernel_scale(train: DataFrame) -> tuple[int, float]:
    """Width of the vector and gamma = 1 / (width * variance of all entries)."""
    x = F.explode(vector_to_array(FEATURES)).alias("x")
    width = train.select(F.size(vector_to_array(FEATURES)).alias("d")).first()["d"]
    var = train.select(x).agg(F.var_pop("x")).first()[0] or 1.0
    return width, 1.0 / (width * var)


def fit_kernel_svm(train: DataFrame, label: str, c: float = 1.0, size: int = 200, max_iter: int = 50, balanced: bool = True, seed: int = 42) -> Classifier:
    """RBF support vector machine by random Fourier features and linear SVMs, one per class. An approximation
    that takes all rows; ``p`` holds decision values, not probabilities."""
    width, gamma = kernel_scale(train)
    df, index = _labelled(train, label, balanced)
    mapped = fit_input(fourier_features(df, width, gamma, seed, size), ["__rff", LABEL, "__w"])
    est = LinearSVC(featuresCol="__rff", labelCol=LABEL, regParam=1.0 / (c * max(train.count(), 1)), maxIter=max_iter, standardization=False)
    model = OneVsRest(classifier=est, featuresCol="__rff", labelCol=LABEL, weightCol="__w", parallelism=4).fit(mapped)
    mapped.unpersist()
    raw = _one_vs_rest_scores(model, lambda r: r)
    return Classifier(index, model, lambda d: raw(fourier_features(d, width, gamma, seed, size)).drop("__rff"))


def fit_adaboost(train: DataFrame, label: str, rounds: int = 100, rate: float = 1.0, max_depth: int = 3, balanced: bool = True,
                 seed: int = 42, cut_every: int = 10) -> Classifier:
    """SAMME boosting: each round fits a weighted tree, raises the weights of missed rows and rescales them.
    The growing chain of projections is cut by a checkpoint every few rounds."""
    checkpoint_root(train.sparkSession)
    df, index = _labelled(train, label, balanced)
    k = len(index.levels)
    cur, old = fit_input(df, [FEATURES, LABEL, "__w"]), None
    stages: list[tuple[float, object]] = []
    for t in range(rounds):
        est = DecisionTreeClassifier(featuresCol=FEATURES, labelCol=LABEL, weightCol="__w", maxDepth=max_depth, seed=seed + t)
        tree = est.fit(cur)
        scored = tree.transform(cur).withColumn("__miss", (F.col("prediction") != F.col(LABEL)).cast("double"))
        s = scored.agg(F.sum("__w").alias("w"), F.sum(F.col("__w") * F.col("__miss")).alias("e"), F.count(F.lit(1)).alias("n")).first()
        if old is not None:
            old.unpersist()
        err = s["e"] / s["w"]
        if err <= 0:
            stages.append((1.0, tree))
            break
        if err >= 1 - 1 / k:
            break
        alpha = float(rate * (np.log((1 - err) / err) + np.log(k - 1)))
        stages.append((alpha, tree))
        total = (s["w"] - s["e"]) + s["e"] * np.exp(alpha)
        w = F.col("__w") * F.exp(F.lit(alpha) * F.col("__miss")) * F.lit(float(s["n"] / total))
        old, cur = cur, scored.withColumn("__w", w).select(FEATURES, LABEL, "__w")
        cur = cur.checkpoint() if (t + 1) % cut_every == 0 else cur.persist()
    for held in (old, cur):
        if held is not None:
            held.unpersist()
    total_alpha = sum(a for a, _ in stages) or 1.0

    def scores(d: DataFrame) -> DataFrame:
        out = d
        for i, (_, tree) in enumerate(stages):
            part = tree.copy()
            part.setRawPredictionCol(f"__r{i}")
            part.setProbabilityCol(f"__q{i}")
            part.setPredictionCol(f"__p{i}")
            out = part.transform(out).drop(f"__r{i}", f"__q{i}")
        votes = [reduce(lambda a, b: a + b, [F.when(F.col(f"__p{i}") == j, F.lit(a / total_alpha)).otherwise(0.0) for i, (a, _) in enumerate(stages)],
                        F.lit(0.0)) for j in range(k)]
        return out.withColumn("p", F.array(*votes)).drop(*[f"__p{i}" for i in range(len(stages))])

    return Classifier(index, stages, scores)


def fit_bagging(train: DataFrame, label: str, key: str, trees: int = 100, feature_share: float = 0.3, max_depth: int = 30, balanced: bool = True,
                seed: int = 42, parallelism: int = 4) -> Classifier:
    """Bagged trees, each on a Poisson(1) bootstrap of the rows and its own subset of the features (drawn per
    tree, not per split). Bootstrap weights are a hash of row key and tree, so no copy of the data is made."""
    df, index = _labelled(train, label, balanced)
    width = df.select(F.size(vector_to_array(FEATURES)).alias("d")).first()["d"]
    take = max(1, int(round(feature_share * width)))
    base = fit_input(df, [key, FEATURES, LABEL, "__w"])
    subsets = [sorted(np.random.default_rng([seed, t]).choice(width, take, replace=False).tolist()) for t in range(trees)]

    def one(t: int):
        u = hash_uniform([key, F.lit(f"tree{t}")], seed)
        drawn = base.withColumn("__u", u).withColumn("__b", F.col("__w") * count_at_or_below(F.col("__u"), POISSON1_CDF)).filter("__b > 0")
        sliced = VectorSlicer(inputCol=FEATURES, outputCol="__s", indices=subsets[t]).transform(drawn)
        est = DecisionTreeClassifier(featuresCol="__s", labelCol=LABEL, weightCol="__b", maxDepth=max_depth, seed=seed + t)
        return est.fit(sliced)

    with ThreadPoolExecutor(parallelism) as pool:
        models = list(pool.map(one, range(trees)))
    base.unpersist()

    def scores(d: DataFrame) -> DataFrame:
        out = d
        for t, m in enumerate(models):
            part = m.copy()
            part.setRawPredictionCol(f"__r{t}")
            part.setProbabilityCol(f"__q{t}")
            part.setPredictionCol(f"__p{t}")
            out = VectorSlicer(inputCol=FEATURES, outputCol="__s", indices=subsets[t]).transform(out)
            out = part.transform(out).withColumn(f"__q{t}", vector_to_array(f"__q{t}")).drop("__s", f"__r{t}", f"__p{t}")
        mean = [reduce(lambda a, b: a + b, [F.col(f"__q{t}")[j] for t in range(trees)]) / float(trees) for j in range(len(index.levels))]
        return out.withColumn("p", F.array(*mean)).drop(*[f"__q{t}" for t in range(trees)])

    return Classifier(index, models, scores)


# ---------------------------------------------------------------- combining and tuning

def soft_vote(predictions: DataFrame, classes: list[str], key: str = "row_id") -> DataFrame:
    """Mean of the models' probability arrays per row and the class with the largest mean."""
    k = len(classes)
    agg = predictions.groupBy(key).agg(F.first("y").alias("y"), *[F.avg(F.col("p")[i]).alias(f"__p{i}") for i in range(k)])
    return agg.withColumn("p", F.array(*[F.col(f"__p{i}") for i in range(k)])).drop(*[f"__p{i}" for i in range(k)]).withColumn(
        "pred", argmax_label(F.col("p"), classes))


def soft_vote_top(predictions: DataFrame, classes: list[str], n: int = 3, key: str = "row_id") -> DataFrame:
    """Soft vote of the ``n`` models with the best weighted F1 (by name among equals) of a long prediction table."""
    board = metrics_from_cells(predictions.groupBy("model", "y", "pred").agg(F.count(F.lit(1)).alias("n")), ["model"])
    leaders = board.orderBy(F.desc(F.round("f1_w", 12)), "model").limit(n).select("model")
    return soft_vote(predictions.join(leaders, "model", "left_semi"), classes, key)


def class_thresholds(valid: DataFrame, classes: list[str]) -> DataFrame:
    """Per class the threshold .05 .. .95 with the best one-vs-rest F1 (the first among equals)."""
    from flowbench.operators.metrics import threshold_counts

    names = F.array(*[F.lit(c) for c in classes])
    long = valid.select("y", F.inline(F.zip_with(names, F.col("p"), lambda c, s: F.struct(c.alias("class"), s.alias("s")))))
    counts = threshold_counts(long, "s", F.col("y") == F.col("class"), ["class"])
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return counts.withColumn("f1", F.round(f1, 12)).groupBy("class").agg(
        F.min_by("threshold", F.struct(-F.col("f1"), F.col("threshold"))).alias("threshold"), F.max("f1").alias("f1"))


def apply_thresholds(pred: DataFrame, classes: list[str], thresholds: dict[str, float]) -> DataFrame:
    """Class with the largest margin of probability over its threshold."""
    cut = F.array(*[F.lit(float(thresholds[c])) for c in classes])
    margin = F.zip_with("p", cut, lambda p, t: F.round(p - t, 12))
    return pred.withColumn("pred", argmax_label(margin, classes))


def combine_two_stage(df: DataFrame, gate: str, sub: str, normal: str) -> DataFrame:
    """Normal when the gate says so, else the class of the second model."""
    return df.withColumn("pred", F.when(F.col(gate) == 0, F.lit(normal)).otherwise(F.col(sub)))


def two_stage(train: DataFrame, label: str, normal: str, fit: Callable[[DataFrame, str], Classifier]) -> Callable[[DataFrame], DataFrame]:
    """A gate normal / not normal and a second model fitted on rows that are not normal."""
    gate = fit(train.withColumn("__gate", (F.col(label) != normal).cast("int")), "__gate")
    sub = fit(train.filter(F.col(label) != normal), label)

    def apply(df: DataFrame) -> DataFrame:
        first = gate.apply(df).withColumnRenamed("pred", "gate").drop("p")
        second = sub.apply(first).withColumnRenamed("pred", "sub").drop("p")
        return combine_two_stage(second, "gate", "sub", normal)

    return apply


@dataclass
class Config:
    """A named way to fit: ``fit(train)`` returns a model with ``apply``."""

    name: str
    fit: Callable[[DataFrame], object]
    tags: dict = field(default_factory=dict)


def _cells(pred: DataFrame, **keys) -> DataFrame:
    tagged = pred.select("y", "pred").withColumns({k: F.lit(v) for k, v in keys.items()})
    return tagged.groupBy(*keys, "y", "pred").agg(F.count(F.lit(1)).alias("n"))


def cross_validate(configs: list[Config], folds: FoldSet, kind: str = "", parallelism: int = 3) -> DataFrame:
    """Metrics per configuration and fold. Fits run side by side; only confusion cells are kept."""

    def one(job) -> DataFrame:
        c, i, tr, te = job
        return _cells(c.fit(tr).apply(te), model=c.name, kind=kind, fold=i)

    jobs = [(c, i, tr, te) for c in configs for i, tr, te in folds.pairs()]
    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(one, jobs))
    return metrics_from_cells(reduce(lambda a, b: a.unionByName(b), parts), ["model", "kind", "fold"])


def grid_search(configs: list[Config], folds: FoldSet, parallelism: int = 3) -> tuple[Config, DataFrame]:
    """Cross-validated weighted F1 per setting and the best setting (first by name among equals)."""
    per_fold = cross_validate(configs, folds, "grid", parallelism)
    table = per_fold.groupBy("model").agg(F.avg("f1_w").alias("cv"), F.stddev_pop("f1_w").alias("cv_std"))
    rows = table.collect()
    best = min(rows, key=lambda r: (-round(r["cv"], 12), r["model"]))["model"]
    spark = per_fold.sparkSession
    return next(c for c in configs if c.name == best), spark.createDataFrame(rows, table.schema)


def tune(configs: list[Config], folds: FoldSet, train: DataFrame, test: DataFrame, parallelism: int = 3) -> tuple[object, DataFrame]:
    """Grid search that ends in a model: the best setting refitted on all train rows, and the grid with the
    cross-validated mean and deviation and every setting's score on test after a fit on all train rows."""
    best, grid = grid_search(configs, folds, parallelism)
    with ThreadPoolExecutor(parallelism) as pool:
        models = dict(zip([c.name for c in configs], pool.map(lambda c: c.fit(train), configs)))
    cells = reduce(lambda a, b: a.unionByName(b), [_cells(m.apply(test), model=name) for name, m in models.items()])
    scores = metrics_from_cells(cells, ["model"]).select("model", F.col("f1_w").alias("test"), F.col("accuracy").alias("test_accuracy"))
    return models[best.name], grid.join(scores, "model").withColumn("chosen", F.col("model") == best.name)


def random_search(configs: list[Config], n: int, folds: FoldSet, seed: int = 42, parallelism: int = 3) -> tuple[Config, DataFrame]:
    """Grid search over n settings drawn with a seed."""
    pick = sorted(np.random.default_rng(seed).choice(len(configs), min(n, len(configs)), replace=False).tolist())
    return grid_search([configs[i] for i in pick], folds, parallelism)


def cross_validate_top(leaderboard: DataFrame, configs: list[Config], fold_sets: dict[str, FoldSet], top: int = 2, metric: str = "f1_w") -> DataFrame:
    """Cross-validate the leading configurations with every kind of folds, long form."""
    names = [r["model"] for r in leaderboard.orderBy(F.desc(metric), "model").limit(top).collect()]
    chosen = [c for c in configs if c.name in names]
    parts = [cross_validate(chosen, fs, kind) for kind, fs in fold_sets.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def fit_predictions(configs: list[Config], train: DataFrame, test: DataFrame, key: str = "row_id") -> DataFrame:
    """Fit every configuration one after the other and keep its predictions: one long table in the shared folder with
    the key, model, y, pred, p, the tags, and the seconds of fit and prediction. All comparisons read this table."""
    out = None
    for c in configs:
        t0 = time.perf_counter()
        model = c.fit(train)
        t1 = time.perf_counter()
        pred = write_through(model.apply(test).select(key, F.lit(c.name).alias("model"), "y", "pred", "p"), "predictions")
        t2 = time.perf_counter()
        pred = pred.withColumns({k: F.lit(v) for k, v in {**c.tags, "fit_s": float(t1 - t0), "predict_s": float(t2 - t1)}.items()})
        out = pred if out is None else out.unionByName(pred, allowMissingColumns=True)
    return out


def score_board(predictions: DataFrame, classes: list[str], tags: list[str] | None = None) -> DataFrame:
    """A row per model of a long prediction table: accuracy, precision, recall, F1 and the mean area under the ROC curve."""
    by = ["model", *(tags or [])]
    cells = predictions.groupBy(*by, "y", "pred").agg(F.count(F.lit(1)).alias("n"))
    return lookup(metrics_from_cells(cells, by), roc_auc_macro(predictions, classes, by), by)


def fit_all(configs: list[Config], train: DataFrame, test: DataFrame, classes: list[str], key: str = "row_id") -> DataFrame:
    """Fit and score every configuration; scores with the tags and the seconds of fit and prediction."""
    pred = fit_predictions(configs, train, test, key)
    tags = [c for c in pred.columns if c not in (key, "model", "y", "pred", "p")]
    return score_board(pred, classes, tags)
