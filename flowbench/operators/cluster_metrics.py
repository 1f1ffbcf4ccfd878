"""Scores of a clustering: internal ones from vectors, external ones from the contingency table."""

from __future__ import annotations

import numpy as np
import pandas as pd

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowbench.functions.small import collect_small, lookup, pin_small
from flowbench.operators.split import sample_n

MAX_SAMPLE = 20_000


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def centroids(df: DataFrame, cluster: str, vec: str) -> DataFrame:
    """Mean vector and size per cluster; partial sums are combined before the shuffle."""
    v = array_to_vector(F.col(vec))
    return df.groupBy(cluster).agg(vector_to_array(Summarizer.mean(v)).alias("centroid"), F.count(F.lit(1)).alias("size"))


def silhouette_rows(df: DataFrame, key: str, vec: str, cluster: str, sample_size: int = 5_000, seed: int = 42) -> DataFrame:
    """Silhouette of every sampled row against the sample. The sample is
    bounded and broadcast; each task scores its rows with one matrix product and emits one number per row."""
    if sample_size > MAX_SAMPLE:
        raise ValueError(f"sample_size above {MAX_SAMPLE}")
    sample = sample_n(df.select(key, cluster, vec), [key], sample_size, seed).select(key, cluster, vec)
    rows = collect_small(sample, sample_size, "silhouette sample")
    spark = df.sparkSession
    keys = np.array([r[0] for r in rows])
    labels = np.array([r[1] for r in rows])
    names, codes = np.unique(labels, return_inverse=True)
    x = np.array([r[2] for r in rows], dtype=np.float64)
    shared = spark.sparkContext.broadcast((keys, names, codes, x))
    kt, ct = df.schema[key].dataType.simpleString(), df.schema[cluster].dataType.simpleString()

    def score(batches):
        skeys, snames, scodes, sx = shared.value
        member = np.zeros((len(scodes), len(snames)))
        member[np.arange(len(scodes)), scodes] = 1.0
        size = member.sum(axis=0)
        sq = (sx * sx).sum(axis=1)
        at = {k: i for i, k in enumerate(skeys.tolist())}
        for pdf in batches:
            ids = pdf[key].tolist()
            idx = np.array([at[k] for k in ids], dtype=np.int64)
            out = np.zeros(len(ids))
            for lo in range(0, len(ids), 512):
                i = idx[lo:lo + 512]
                d2 = sq[i][:, None] + sq[None, :] - 2.0 * sx[i] @ sx.T
                d = np.sqrt(np.maximum(d2, 0.0))
                d[np.arange(len(i)), i] = 0.0
                sums = d @ member
                own = scodes[i]
                n_own = size[own]
                a = sums[np.arange(len(i)), own] / np.maximum(n_own - 1, 1)
                mean = sums / size
                mean[np.arange(len(i)), own] = np.inf
                b = mean.min(axis=1)
                top = np.maximum(a, b)
                s = np.where((n_own > 1) & (top > 0) & np.isfinite(top), (b - a) / np.where(top > 0, top, 1.0), 0.0)
                out[lo:lo + 512] = s
            yield pd.DataFrame({key: ids, cluster: pdf[cluster].to_numpy(), "silhouette": out})

    parts = max(1, min(len(rows) // 256, spark.sparkContext.defaultParallelism))
    return sample.select(key, cluster).repartition(parts, key).mapInPandas(score, f"`{key}` {kt}, `{cluster}` {ct}, silhouette double")


def silhouette(df: DataFrame, key: str, vec: str, cluster: str, sample_size: int | None = None, seed: int = 42) -> DataFrame:
    """Mean silhouette; null with fewer than two clusters, 0 for a cluster of one row.

    Of all rows with squared distances, which need the sums of each cluster only, or, where the caller names a
    ``sample_size``, of a sample with Euclidean distances between its rows.
    """
    if sample_size is None:
        data = df.select(array_to_vector(F.col(vec)).alias("__v"), F.col(cluster).cast("double").alias("__c"))
        k, n = data.agg(F.count_distinct("__c"), F.count(F.lit(1))).first()
        value = float(ClusteringEvaluator(featuresCol="__v", predictionCol="__c").evaluate(data)) if k > 1 else None
        return df.sparkSession.createDataFrame([(value, n)], "silhouette double, n bigint")
    rows = silhouette_rows(df, key, vec, cluster, sample_size, seed)
    k = F.count_distinct(cluster)
    return rows.agg(F.when(k > 1, F.avg("silhouette")).alias("silhouette"), F.count(F.lit(1)).alias("n"))


def _deviations(df: DataFrame, vec: str, cluster: str) -> tuple[DataFrame, DataFrame]:
    cents = pin_small(centroids(df, cluster, vec), 5_000)
    joined = lookup(df.select(cluster, vec), cents.select(cluster, "centroid"), [cluster])
    return cents, joined.withColumn("__d2", squared_distance(F.col(vec), F.col("centroid")))


def davies_bouldin(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d_ij; rows are read twice, pairs are only clusters."""
    cents, dev = _deviations(df, vec, cluster)
    spread = dev.groupBy(cluster).agg(F.avg(F.sqrt("__d2")).alias("s"))
    c = lookup(cents, spread, [cluster]).select(F.col(cluster).alias("c"), "centroid", "s")
    rows = collect_small(c, 5_000, "cluster table")
    x = np.array([r["centroid"] for r in rows], dtype=np.float64)
    s = np.array([r["s"] for r in rows], dtype=np.float64)
    if len(rows) < 2:
        return df.sparkSession.createDataFrame([(None, len(rows))], "davies_bouldin double, clusters bigint")
    d = np.sqrt(np.maximum(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2), 0.0))
    np.fill_diagonal(d, np.inf)
    ratio = np.where(d > 0, (s[:, None] + s[None, :]) / np.where(d > 0, d, 1.0), 0.0)
    return df.sparkSession.createDataFrame([(float(ratio.max(axis=1).mean()), len(rows))], "davies_bouldin double, clusters bigint")


def calinski_harabasz(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Between to within dispersion, each divided by its degrees of freedom."""
    cents, dev = _deviations(df, vec, cluster)
    whole = df.agg(vector_to_array(Summarizer.mean(array_to_vector(F.col(vec)))).alias("m")).first()["m"]
    middle = F.array(*[F.lit(float(v)) for v in whole])
    between = cents.agg(F.sum(F.col("size") * squared_distance(F.col("centroid"), middle)).alias("b"), F.count(F.lit(1)).alias("k"), F.sum("size").alias("n"))
    within = dev.agg(F.sum("__d2").alias("w"))
    full = between.withColumn("w", within.scalar())
    return full.select(F.when(F.col("k") > 1, F.try_divide(F.col("b") * (F.col("n") - F.col("k")), F.col("w") * (F.col("k") - 1))).alias("calinski_harabasz"),
                       F.col("k").alias("clusters"))


def cluster_scores(df: DataFrame, key: str, vec: str, cluster: str, noise: int = -1) -> DataFrame:
    """One row of internal scores with the noise rows left out; the scores are null below two clusters."""
    kept = df.filter(F.col(cluster) != noise).select(key, vec, cluster).persist()
    counts = df.agg(F.count_if(F.col(cluster) == noise).alias("noise_rows"), F.count_distinct(F.when(F.col(cluster) != noise, F.col(cluster))).alias("clusters")).first()
    scores = [None] * 3
    if counts["clusters"] > 1:
        scores = [silhouette(kept, key, vec, cluster).first()[0], davies_bouldin(kept, vec, cluster).first()[0], calinski_harabasz(kept, vec, cluster).first()[0]]
    kept.unpersist()
    return df.sparkSession.createDataFrame([(*scores, counts["clusters"], counts["noise_rows"])],
                                           "silhouette double, davies_bouldin double, calinski_harabasz double, clusters bigint, noise_rows bigint")


def contingency(df: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or []), F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))


def adjusted_rand(df: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """Adjusted Rand index from the contingency table."""
    by = by or []
    cells = contingency(df, a, b, by)

    def pairs(keys: list[str], name: str) -> DataFrame:
        t = cells.groupBy(*by, *keys).agg(F.sum("n").cast("double").alias("n"))
        return t.groupBy(*by).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias(name))

    out = pairs(["a", "b"], "both")
    for name, part in (("pa", pairs(["a"], "pa")), ("pb", pairs(["b"], "pb")), ("all_pairs", pairs([], "all_pairs"))):
        out = lookup(out, part, by) if by else out.withColumn(name, part.scalar())
    expected = F.col("pa") * F.col("pb") / F.col("all_pairs")
    top = (F.col("pa") + F.col("pb")) / 2
    ari = F.when(top == expected, F.lit(1.0)).otherwise((F.col("both") - expected) / (top - expected))
    return out.select(*by, ari.alias("ari"))


def nmi_homogeneity_completeness(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Entropy scores of a clustering against labels; NMI with the arithmetic mean."""
    cells = contingency(df, truth, cluster)
    n = float(df.count())

    def entropy(keys: list[str]) -> Column:
        t = cells.groupBy(*keys).agg(F.sum("n").alias("n"))
        return t.agg((-F.sum(F.col("n") / n * F.log(F.col("n") / n))).alias("h")).scalar()

    one = cells.agg(F.sum("n").alias("rows")).withColumns({"ha": entropy(["a"]), "hb": entropy(["b"]), "hab": entropy(["a", "b"])})
    mi = F.col("ha") + F.col("hb") - F.col("hab")
    mean = (F.col("ha") + F.col("hb")) / 2
    return one.select(F.when(mean == 0, 1.0).otherwise(mi / mean).alias("nmi"),
                      F.when(F.col("ha") == 0, 1.0).otherwise(mi / F.col("ha")).alias("homogeneity"),
                      F.when(F.col("hb") == 0, 1.0).otherwise(mi / F.col("hb")).alias("completeness"))


def purity(df: DataFrame, truth: str, cluster: str) -> DataFrame:
    """Share of rows that carry their cluster's most common label."""
    best = contingency(df, truth, cluster).groupBy("b").agg(F.max("n").alias("m"), F.sum("n").alias("n"))
    return best.agg((F.sum("m") / F.sum("n")).alias("purity"))


def cluster_balance(df: DataFrame, cluster: str) -> DataFrame:
    """Number of clusters, share of the largest and share of noise (-1); noise is outside the other two."""
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    real = F.col(cluster) >= 0
    kept = F.sum(F.when(real, F.col("n")).otherwise(0))
    return sizes.agg(F.count_if(real).alias("clusters"), F.try_divide(F.max(F.when(real, F.col("n"))), kept).alias("largest_share"),
                     (1 - kept / F.sum("n")).alias("noise_share"))
