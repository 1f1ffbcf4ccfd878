"""Regressors, intervals from trees, what-if sweeps and controls."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowbench.functions.hashing import row_hash
from flowbench.functions.ordered import row_position
from flowbench.functions.small import fit_input
from flowbench.operators.classify import FEATURES, Config, fourier_features, kernel_scale
from flowbench.operators.metrics import regression_metrics
from flowbench.operators.split import FoldSet


@dataclass
class Regressor:
    """A fitted model: ``apply`` adds ``yhat``."""

    model: object
    scores: Callable[[DataFrame], DataFrame]

    def apply(self, df: DataFrame) -> DataFrame:
        return self.scores(df)


def _fit(est, train: DataFrame, target: str) -> Regressor:
    data = fit_input(train, [FEATURES, target])
    model = est.fit(data)
    data.unpersist()
    return Regressor(model, lambda df: model.transform(df).withColumnRenamed("prediction", "yhat").drop("poly"))


def fit_linear(train: DataFrame, target: str) -> Regressor:
    """Least squares by the normal equations: one pass whatever the number of rows."""
    return _fit(LinearRegression(featuresCol=FEATURES, labelCol=target, solver="normal", regParam=0.0), train, target)


def fit_linear_1d(train: DataFrame, x: str, y: str) -> Regressor:
    """Least squares with one predictor, from built-in aggregates."""
    r = train.agg(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a")).first()
    return Regressor((r["a"], r["b"]), lambda df: df.withColumn("yhat", F.lit(r["a"]) + F.lit(r["b"]) * F.col(x)))


def _target_std(train: DataFrame, target: str) -> float:
    return train.agg(F.stddev_pop(target)).first()[0] or 1.0


def fit_ridge(train: DataFrame, target: str, alpha: float = 1.0) -> Regressor:
    """RSS + alpha |w|^2. Spark's loss is a mean and its quadratic penalty is divided by the target's deviation."""
    reg = alpha / max(train.count(), 1) * _target_std(train, target)
    return _fit(LinearRegression(featuresCol=FEATURES, labelCol=target, regParam=reg, elasticNetParam=0.0, standardization=False), train, target)


def fit_lasso(train: DataFrame, target: str, alpha: float = 1.0, max_iter: int = 5000) -> Regressor:
    """RSS / (2 n) + alpha |w|."""
    return _fit(LinearRegression(featuresCol=FEATURES, labelCol=target, regParam=alpha, elasticNetParam=1.0, standardization=False, maxIter=max_iter), train, target)


def fit_elasticnet(train: DataFrame, target: str, alpha: float = 1.0, l1_ratio: float = 0.5, max_iter: int = 5000) -> Regressor:
    """RSS / (2 n) + alpha l1_ratio |w| + alpha (1 - l1_ratio) / 2 |w|^2, with the quadratic part rescaled as in ``fit_ridge``."""
    first, second = alpha * l1_ratio, alpha * (1 - l1_ratio) * _target_std(train, target)
    reg = first + second
    return _fit(LinearRegression(featuresCol=FEATURES, labelCol=target, regParam=reg, elasticNetParam=first / reg if reg else 0.0, standardization=False,
                                 maxIter=max_iter), train, target)


def fit_poly_ridge(train: DataFrame, target: str, degree: int = 2, alpha: float = 1.0) -> Regressor:
    stages = [PolynomialExpansion(degree=degree, inputCol=FEATURES, outputCol="poly"),
              LinearRegression(featuresCol="poly", labelCol=target, regParam=alpha / max(train.count(), 1) * _target_std(train, target),
                               elasticNetParam=0.0, standardization=False)]
    return _fit(Pipeline(stages=stages), train, target)


def fit_tree_reg(train: DataFrame, target: str, max_depth: int = 30, seed: int = 42) -> Regressor:
    return _fit(DecisionTreeRegressor(featuresCol=FEATURES, labelCol=target, maxDepth=max_depth, seed=seed), train, target)


def fit_forest_reg(train: DataFrame, target: str, trees: int = 100, max_depth: int = 20, seed: int = 42) -> Regressor:
    return _fit(RandomForestRegressor(featuresCol=FEATURES, labelCol=target, numTrees=trees, maxDepth=max_depth, featureSubsetStrategy="all", seed=seed), train, target)


def fit_gbt_reg(train: DataFrame, target: str, rounds: int = 150, step: float = 0.1, max_depth: int = 3, subsample: float = 0.8, seed: int = 42) -> Regressor:
    return _fit(GBTRegressor(featuresCol=FEATURES, labelCol=target, maxIter=rounds, stepSize=step, maxDepth=max_depth, subsamplingRate=subsample, seed=seed), train, target)


def fit_kernel_reg(train: DataFrame, target: str, c: float = 10.0, size: int = 200, seed: int = 42) -> Regressor:
    """RBF regression by random Fourier features and a Huber loss: an approximation that takes all rows."""
    width, gamma = kernel_scale(train)
    est = LinearRegression(featuresCol="__rff", labelCol=target, loss="huber", regParam=1.0 / (c * max(train.count(), 1)), maxIter=100, standardization=False)
    data = fit_input(fourier_features(train, width, gamma, seed, size), ["__rff", target])
    model = est.fit(data)
    data.unpersist()
    return Regressor(model, lambda df: model.transform(fourier_features(df, width, gamma, seed, size)).withColumnRenamed("prediction", "yhat").drop("__rff"))


def mean_baseline(train: DataFrame, target: str) -> Regressor:
    m = train.agg(F.avg(target)).first()[0]
    return Regressor(m, lambda df: df.withColumn("yhat", F.lit(m)))


def regression_leaderboard(configs: list[Config], train: DataFrame, valid: DataFrame, test: DataFrame, target: str, cap: float) -> DataFrame:
    """Per model R2 on validation and test, errors on log and original scale, fit seconds."""
    out = None
    for c in configs:
        t0 = time.perf_counter()
        m = c.fit(train)
        seconds = time.perf_counter() - t0
        v = regression_metrics(m.apply(valid), target, "yhat").select(F.col("r2").alias("r2_valid"))
        one = regression_metrics(m.apply(test), target, "yhat", cap).withColumns(
            {"model": F.lit(c.name), "r2_valid": v.scalar(), "fit_s": F.lit(float(seconds))})
        out = one if out is None else out.unionByName(one)
    return out


def cv_reg(configs: list[Config], folds: FoldSet, target: str, parallelism: int = 3) -> DataFrame:
    """R2, RMSE and MAE per configuration and fold."""

    def one(job) -> DataFrame:
        c, i, tr, te = job
        return regression_metrics(c.fit(tr).apply(te), target, "yhat").withColumns({"model": F.lit(c.name), "fold": F.lit(i)})

    jobs = [(c, i, tr, te) for c in configs for i, tr, te in folds.pairs()]
    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(one, jobs))
    return reduce(lambda a, b: a.unionByName(b), parts)


def grid_search_reg(configs: list[Config], folds: FoldSet, target: str, parallelism: int = 3) -> tuple[Config, DataFrame]:
    """Mean R2 over the folds per setting and the best setting."""
    table = cv_reg(configs, folds, target, parallelism).groupBy("model").agg(F.avg("r2").alias("r2"), F.stddev_pop("r2").alias("r2_std"))
    rows = table.collect()
    best = min(rows, key=lambda r: (-round(r["r2"], 12), r["model"]))["model"]
    return next(c for c in configs if c.name == best), folds.df.sparkSession.createDataFrame(rows, table.schema)


def feature_importance(model, names: list[str], spark, k: int = 15) -> DataFrame:
    """Impurity importance or absolute coefficient, the k largest."""
    fitted = model.stages[-1] if hasattr(model, "stages") else model
    values = fitted.featureImportances.toArray() if hasattr(fitted, "featureImportances") else abs(fitted.coefficients.toArray())
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(k)


def array_percentile(values: Column, q: float) -> Column:
    """Linear-interpolated percentile of an array column."""
    s = F.array_sort(values)
    pos = F.lit(q) * (F.size(values) - 1)
    lo = F.element_at(s, F.floor(pos).cast("int") + 1)
    hi = F.element_at(s, F.ceil(pos).cast("int") + 1)
    return F.when(F.size(values) > 0, lo + (pos - F.floor(pos)) * (hi - lo))


def tree_predictions(df: DataFrame, forest, out: str = "trees") -> DataFrame:
    """Prediction of every tree of a forest as one array column, in one pass."""
    cur = df
    for i, tree in enumerate(forest.trees):
        part = tree.copy()
        part.setPredictionCol(f"__t{i}")
        cur = part.transform(cur)
    n = len(forest.trees)
    return cur.withColumn(out, F.array(*[F.col(f"__t{i}") for i in range(n)])).drop(*[f"__t{i}" for i in range(n)])


def tree_interval(df: DataFrame, forest, lo: float = 0.1, hi: float = 0.9) -> DataFrame:
    """Mean over the trees and their 10th and 90th percentile, back in the original unit."""
    t = tree_predictions(df, forest)
    mean = F.aggregate("trees", F.lit(0.0), lambda s, x: s + x) / F.size("trees")
    return t.withColumns({"yhat": F.expm1(mean), "low": F.expm1(array_percentile(F.col("trees"), lo)),
                          "high": F.expm1(array_percentile(F.col("trees"), hi))}).drop("trees")


def what_if_sweep(df: DataFrame, key: str, feature: str, values: list[float], assemble: Callable[[DataFrame], DataFrame], forest) -> DataFrame:
    """Every row with one feature set to each sweep value: predictions and bands in sweep order."""
    points = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(float(v)).alias("value")) for i, v in enumerate(values)])
    swept = df.withColumn("__s", F.explode(points)).withColumn(feature, F.col("__s.value")).withColumn("step", F.col("__s.step")).drop("__s")
    scored = tree_interval(assemble(swept), forest)
    return scored.select(key, "step", F.col(feature).alias("value"), "yhat", "low", "high")


def shuffled_target(df: DataFrame, key: str, target: str, seed: int = 42) -> DataFrame:
    """The table with its target permuted: the row at place i of one hash order gets the target of the row at
    place i of another. Places come from counts per range, so nothing is sorted as a whole."""

    def place(s: int) -> DataFrame:
        h = F.conv(F.substring(row_hash([key], s), 1, 15), 16, 10).cast("bigint")
        return row_position(df.select(key, target).withColumn("__h", h), "__h")

    mine = place(seed).select(key, "position")
    other = place(seed + 1).select("position", F.col(target).alias("__new"))
    permuted = mine.join(other, "position").select(key, F.col("__new").alias(target))
    return df.drop(target).join(permuted, key)
