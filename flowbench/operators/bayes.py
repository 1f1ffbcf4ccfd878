"""Gaussian naive Bayes in closed form: one aggregate to fit, one projection to score."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowbench.functions.small import collect_small

# Fixed value: share of the largest feature variance that is added to every variance.
VAR_SMOOTHING = 1e-9


@dataclass
class GaussianNB:
    """Class priors, means and variances per feature."""

    features: list[str]
    classes: list
    prior: list[float]
    mean: list[list[float]]
    var: list[list[float]]

    def log_joint(self) -> list[Column]:
        out = []
        for k in range(len(self.classes)):
            e: Column = F.lit(math.log(self.prior[k]) - 0.5 * sum(math.log(2 * math.pi * v) for v in self.var[k]))
            for f, m, v in zip(self.features, self.mean[k], self.var[k]):
                d = F.col(f) - F.lit(m)
                e = e - d * d * F.lit(0.5 / v)
            out.append(e)
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        """Add ``p`` (probabilities in class order) and ``pred``."""
        joint = df.withColumn("__j", F.array(*self.log_joint()))
        top = joint.withColumn("__m", F.array_max("__j"))
        e = top.withColumn("__e", F.transform("__j", lambda x: F.exp(x - F.col("__m"))))
        total = F.aggregate("__e", F.lit(0.0), lambda s, x: s + x)
        names = F.array(*[F.lit(c) for c in self.classes])
        pos = F.array_position("__j", F.col("__m")).cast("int") - 1
        return e.withColumn("p", F.transform("__e", lambda x: x / total)).withColumn("pred", F.get(names, pos)).drop("__j", "__m", "__e")


def gaussian_nb(train: DataFrame, features: list[str], label: str, max_classes: int = 1_000) -> GaussianNB:
    """Fit from counts, means and population variances per class."""
    stats = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"m_{f}") for f in features],
                                     *[F.var_pop(f).alias(f"v_{f}") for f in features])
    rows = sorted(collect_small(stats, max_classes, "classes"), key=lambda r: r[label])
    total = sum(r["n"] for r in rows)
    widest = train.agg(*[F.var_pop(f).alias(f) for f in features]).first()
    eps = VAR_SMOOTHING * max(widest[f] for f in features)
    return GaussianNB(features, [r[label] for r in rows], [r["n"] / total for r in rows],
                      [[r[f"m_{f}"] for f in features] for r in rows], [[r[f"v_{f}"] + eps for f in features] for r in rows])
