"""Clustering and projection: k-means family, diagonal mixture, density, PCA (hierarchies: ``hierarchy``)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowbench.functions.hashing import hash_uniform
from flowbench.functions.ordered import quantile_map
from flowbench.functions.small import collect_small, fit_input, lookup
from flowbench.operators import density
from flowbench.operators.cluster_metrics import adjusted_rand, calinski_harabasz, davies_bouldin, silhouette
from flowbench.operators.hierarchy import hierarchical, micro_hierarchy
from flowbench.operators.neighbors import nearest_neighbors, radius_blocks, stack
from flowbench.operators.split import sample_n
from flowbench.session import checkpoint_root


def _vec(df: DataFrame, vec: str) -> DataFrame:
    return df.withColumn("__v", array_to_vector(F.col(vec)))


# ---------------------------------------------------------------- k-means family

def _kmeans_input(df: DataFrame, vec: str) -> DataFrame:
    data = fit_input(_vec(df, vec), ["__v"])
    data.count()
    return data


def _best_kmeans(data: DataFrame, k: int, runs: int, seed: int, max_iter: int = 100) -> tuple[np.ndarray, float]:
    with ThreadPoolExecutor(4) as pool:
        models = list(pool.map(lambda r: KMeans(featuresCol="__v", k=k, seed=seed + r, maxIter=max_iter).fit(data), range(runs)))
    best = min(models, key=lambda m: m.summary.trainingCost)
    return np.array(best.clusterCenters()), float(best.summary.trainingCost)


def fit_kmeans(df: DataFrame, vec: str, k: int, runs: int = 3, seed: int = 42, max_iter: int = 100) -> tuple[np.ndarray, float]:
    """Centres and inertia of the best of several seeded runs of k-means, side by side on one cached input."""
    data = _kmeans_input(df, vec)
    found = _best_kmeans(data, k, runs, seed, max_iter)
    data.unpersist()
    return found


def assign_cluster(df: DataFrame, vec: str, centers: np.ndarray) -> DataFrame:
    """Add cluster, distance and the distances to all centres. The centres are a bounded broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(np.asarray(centers, dtype=np.float64))

    @F.pandas_udf("cluster int, distance double, distances array<double>")
    def assign(v: pd.Series) -> pd.DataFrame:
        c = shared.value
        if not len(v):
            return pd.DataFrame({"cluster": [], "distance": [], "distances": []})
        x = stack(v)
        d = np.empty((len(x), len(c)))
        for j in range(len(c)):
            d[:, j] = np.sqrt(((x - c[j]) ** 2).sum(axis=1))
        i = d.argmin(axis=1)
        return pd.DataFrame({"cluster": i.astype(np.int32), "distance": d[np.arange(len(x)), i], "distances": list(d)})

    return df.withColumn("__a", assign(vec)).select("*", "__a.cluster", "__a.distance", "__a.distances").drop("__a")


def _nearest_center(df: DataFrame, vec: str, centers: np.ndarray) -> DataFrame:
    """Add the cluster of ``assign_cluster`` without its distances."""
    shared = df.sparkSession.sparkContext.broadcast(np.asarray(centers, dtype=np.float64))

    @F.pandas_udf("int")
    def assign(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=np.int32)
        x = stack(v)
        d = np.stack([np.sqrt(((x - c) ** 2).sum(axis=1)) for c in shared.value], axis=1)
        return pd.Series(d.argmin(axis=1).astype(np.int32))

    return df.withColumn("cluster", assign(vec))


def kmeans_step(df: DataFrame, vec: str, centers: np.ndarray) -> DataFrame:
    """One Lloyd step: per cluster the size, the new centre and the sum of squared distances."""
    a = assign_cluster(df, vec, centers)
    return a.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), vector_to_array(Summarizer.mean(array_to_vector(F.col(vec)))).alias("center"),
        F.sum(F.col("distance") * F.col("distance")).alias("inertia"))


def _update(centers: np.ndarray, counts: np.ndarray, step: DataFrame) -> None:
    """Move each centre toward its batch mean with the weight of the batch in all rows seen so far."""
    for r in step.collect():
        j = r["cluster"]
        counts[j] += r["size"]
        centers[j] += (np.array(r["center"]) - centers[j]) * (r["size"] / counts[j])


def first_centers(df: DataFrame, key: str, vec: str, k: int, seed: int = 42) -> np.ndarray:
    """k rows in hash order as starting centres."""
    rows = collect_small(sample_n(df.select(key, vec), [key], k, seed), k, "centres")
    return np.array([r[vec] for r in sorted(rows, key=lambda r: str(r[key]))], dtype=np.float64)


def minibatch_kmeans(df: DataFrame, key: str, vec: str, k: int, batches: int = 10, epochs: int = 1, seed: int = 42) -> np.ndarray:
    """Mini-batch k-means (Sculley 2010): hash slices of the rows are the batches, each one aggregate."""
    centers = first_centers(df, key, vec, k, seed)
    counts = np.zeros(k)
    slot = F.floor(hash_uniform([key, F.lit("batch")], seed) * batches)
    sliced = df.select(vec, slot.alias("__slot")).persist()
    for e in range(epochs):
        for b in range(batches):
            _update(centers, counts, kmeans_step(sliced.filter(F.col("__slot") == b), vec, centers))
    sliced.unpersist()
    return centers


def elbow_sweep(df: DataFrame, key: str, vec: str, ks: list[int], runs: int = 1, seed: int = 42, sample_size: int | None = None) -> DataFrame:
    """Inertia and silhouette for each k, of all rows unless the caller names a sample."""
    out = []
    data = df.select(key, vec).persist()
    dealt = _kmeans_input(data, vec)  # dealt and sorted once for all k
    for k in ks:
        centers, cost = _best_kmeans(dealt, k, runs, seed)
        labelled = _nearest_center(data, vec, centers).persist()  # the silhouette goes over it three times
        s = silhouette(labelled, key, vec, "cluster", sample_size, seed).first()
        labelled.unpersist()
        out.append((k, cost, s["silhouette"]))
    dealt.unpersist()
    data.unpersist()
    return df.sparkSession.createDataFrame(out, "k int, inertia double, silhouette double")


# ---------------------------------------------------------------- diagonal Gaussian mixture

@dataclass
class DiagonalMixture:
    weight: np.ndarray
    mean: np.ndarray
    var: np.ndarray
    log_likelihood: list[float]

    def log_joint(self, x: np.ndarray) -> np.ndarray:
        return log_joint(x, self.weight, self.mean, self.var)

    def apply(self, df: DataFrame, vec: str) -> DataFrame:
        """Add the component with the largest responsibility and all responsibilities."""
        shared = df.sparkSession.sparkContext.broadcast((self.weight, self.mean, self.var))

        @F.pandas_udf("cluster int, p array<double>")
        def score(v: pd.Series) -> pd.DataFrame:
            if not len(v):
                return pd.DataFrame({"cluster": [], "p": []})
            j = log_joint(stack(v), *shared.value)
            r = np.exp(j - j.max(axis=1, keepdims=True))
            r /= r.sum(axis=1, keepdims=True)
            return pd.DataFrame({"cluster": r.argmax(axis=1).astype(np.int32), "p": list(r)})

        return df.withColumn("__s", score(vec)).select("*", "__s.cluster", "__s.p").drop("__s")


def log_joint(x: np.ndarray, weight: np.ndarray, mean: np.ndarray, var: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(weight)))
    for k in range(len(weight)):
        out[:, k] = np.log(weight[k]) - 0.5 * (np.log(2 * np.pi * var[k]).sum() + ((x - mean[k]) ** 2 / var[k]).sum(axis=1))
    return out


def gaussian_mixture(df: DataFrame, vec: str, k: int, max_iter: int = 20, tol: float = 1e-3, reg: float = 1e-4, seed: int = 42,
                     key: str | None = None) -> DiagonalMixture:
    """Expectation-maximisation with diagonal covariance. A task folds its rows into k partial sums; Spark adds
    the partial sums; the driver sees k rows per iteration."""
    data = df.select(*([key] if key else []), vec).persist()
    centers, _ = fit_kmeans(data, vec, k, 1, seed, 20)
    n_rows, whole = data.count(), data.agg(Summarizer.metrics("variance").summary(array_to_vector(F.col(vec))).alias("s")).first()["s"]
    var0 = np.maximum(np.array(whole["variance"].toArray()), 0.0) + reg
    weight, mean, var = np.full(k, 1.0 / k), centers.astype(np.float64), np.tile(var0, (k, 1))
    trace: list[float] = []
    for _ in range(max_iter):
        shared = df.sparkSession.sparkContext.broadcast((weight, mean, var))

        def fold(batches):
            w, m, v = shared.value
            n, sx, sxx, ll = np.zeros(len(w)), np.zeros_like(m), np.zeros_like(m), 0.0
            for pdf in batches:
                if pdf.empty:
                    continue
                x = stack(pdf[vec])
                j = log_joint(x, w, m, v)
                top = j.max(axis=1, keepdims=True)
                norm = top[:, 0] + np.log(np.exp(j - top).sum(axis=1))
                r = np.exp(j - norm[:, None])
                n += r.sum(axis=0)
                sx += r.T @ x
                sxx += r.T @ (x * x)
                ll += float(norm.sum())
            yield pd.DataFrame({"c": range(len(w)), "n": n, "ll": [ll] + [0.0] * (len(w) - 1), "sx": list(sx), "sxx": list(sxx)})

        part = data.select(vec).mapInPandas(fold, "c int, n double, ll double, sx array<double>, sxx array<double>")
        rows = part.groupBy("c").agg(F.sum("n").alias("n"), F.sum("ll").alias("ll"), Summarizer.sum(array_to_vector("sx")).alias("sx"),
                                     Summarizer.sum(array_to_vector("sxx")).alias("sxx")).orderBy("c").collect()
        n = np.maximum(np.array([r["n"] for r in rows]), 1e-10)
        mean = np.array([r["sx"].toArray() for r in rows]) / n[:, None]
        var = np.maximum(np.array([r["sxx"].toArray() for r in rows]) / n[:, None] - mean ** 2, 0.0) + reg
        weight = n / n.sum()
        trace.append(sum(r["ll"] for r in rows) / n_rows)
        if len(trace) > 1 and abs(trace[-1] - trace[-2]) < tol:
            break
    data.unpersist()
    return DiagonalMixture(weight, mean, var, trace)


def bisecting(df: DataFrame, vec: str, k: int, seed: int = 42) -> DataFrame:
    """Top-down variant on all rows."""
    data = _vec(df, vec)
    cached = fit_input(data, ["__v"])
    model = BisectingKMeans(featuresCol="__v", k=k, seed=seed).fit(cached)
    cached.unpersist()
    return model.transform(data).withColumnRenamed("prediction", "cluster").drop("__v")


# ---------------------------------------------------------------- density

def neighbor_radius(df: DataFrame, key: str, vec: str, min_samples: int = 10, share: float = 0.95) -> float:
    """The 95th percentile of the distance to the ``min_samples``-th neighbour, the row itself being the first."""
    n = nearest_neighbors(df, df, min_samples, key, key, vec)
    kth = n.filter(F.col("place") == min_samples)
    return quantile_map(kth, ["distance"], [share])["distance"][0]


def _block_components(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Connected parts of a chunk x block closeness matrix: part number of each row and column (-1: none)."""
    nq, nt = close.shape
    lq = np.where(close.any(axis=1), np.arange(nq), nq)
    while True:
        lt = np.where(close, lq[:, None], nq).min(axis=0)
        new = np.minimum(lq, np.where(close, lt[None, :], nq).min(axis=1))
        if (new == lq).all():
            break
        lq = new
    return np.where(lq < nq, lq, -1), np.where(lt < nq, lt, -1)


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Smallest node of every component by alternating large and small stars (Kiveris et al. 2014). ``edges``
    has a and b; rows (node, component). Each round is checkpointed, so lineage stays short."""
    checkpoint_root(edges.sparkSession)
    edges = edges.checkpoint()
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()

    def star(sym: DataFrame, large: bool) -> DataFrame:
        low = sym.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        j = sym.join(low, "u")
        if large:
            return j.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pair = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))
        return j.select(F.inline(pair))

    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        big = star(both, True).filter("u <> v").distinct()
        small = star(big.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), False)
        e = small.filter("u <> v").distinct().checkpoint()
        now = e.agg(F.count(F.lit(1)).alias("n"), mark.alias("h")).first()
        if seen == now:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    found = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def dbscan(df: DataFrame, key: str, vec: str, eps: float, min_samples: int = 10, block_rows: int = 2_000) -> DataFrame:
    """Density clusters. Tasks count neighbours per row and block; among core rows they emit only a spanning
    forest of each chunk and block, never the pairs. Border rows join the nearest core row's cluster, others
    are -1. Clusters are numbered by their smallest core key. Up to three coordinates go over a grid (``density``)."""
    if 1 <= (df.select(F.max(F.size(vec))).first()[0] or 0) <= density.MAX_DIMS:
        return density.grid_dbscan(df, key, vec, eps, min_samples, connected_components)
    checkpoint_root(df.sparkSession)
    kt = df.schema[key].dataType.simpleString()
    keys = ["__cell", "__block", "__chunk"]
    limit = eps * (1 + 1e-12)

    def within(lp: pd.DataFrame, rp: pd.DataFrame) -> np.ndarray:
        q, t = stack(lp["__qv"]), stack(rp["__tv"])
        d2 = (q * q).sum(axis=1)[:, None] + (t * t).sum(axis=1)[None, :] - 2.0 * (q @ t.T)
        return np.sqrt(np.maximum(d2, 0.0))

    def count(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        if lp.empty or rp.empty:
            return pd.DataFrame({"key": [], "n": []})
        return pd.DataFrame({"key": lp["__q"].to_numpy(), "n": (within(lp, rp) <= limit).sum(axis=1)})

    rows = df.select(key, vec)
    left, right = radius_blocks(rows, key, vec, eps, None, block_rows, block_rows)
    dense = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(count, f"key {kt}, n bigint")
    core = dense.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_samples).select(F.col("key").alias(key)).checkpoint()
    marked = rows.join(core.withColumn("core", F.lit(True)), key, "left").withColumn("core", F.coalesce("core", F.lit(False))).checkpoint()

    def forest(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        names = ["a", "b"]
        if lp.empty or rp.empty:
            return pd.DataFrame({n: [] for n in names})
        a, b = _block_components(within(lp, rp) <= limit)
        qk, tk = lp["__q"].to_numpy(), rp["__t"].to_numpy()
        qi, ti = np.flatnonzero(a >= 0), np.flatnonzero(b >= 0)
        return pd.DataFrame({"a": np.concatenate([qk[qi], tk[ti]]), "b": np.concatenate([qk[a[qi]], qk[b[ti]]])})

    cores = marked.filter("core")
    cl, cr = radius_blocks(cores, key, vec, eps, None, block_rows, block_rows)
    edges = cl.groupBy(*keys).cogroup(cr.groupBy(*keys)).applyInPandas(forest, f"a {kt}, b {kt}").distinct()
    comp = connected_components(edges).select(F.col("node").alias(key), "component")
    border = nearest_neighbors(marked.filter("not core"), cores, 1, key, key, vec).filter(F.col("distance") <= limit)
    joined = border.select(F.col("query").alias("__q"), F.col("neighbor").alias(key)).join(comp, key).select(F.col("__q").alias(key), "component")
    found = comp.unionByName(joined)
    out = marked.select(key, "core").join(found, key, "left")
    return out.select(key, "core", F.col("component").alias("cluster_key"))


# ---------------------------------------------------------------- projection

def pca(df: DataFrame, vec: str, k: int = 2) -> tuple[DataFrame, np.ndarray]:
    """Centred principal components: adds ``pc`` (array) and returns the explained variance shares. The sign of
    a component makes its largest loading positive."""
    mean = df.agg(vector_to_array(Summarizer.mean(array_to_vector(F.col(vec)))).alias("m")).first()["m"]
    middle = F.array(*[F.lit(float(v)) for v in mean])
    centred = df.withColumn("__c", array_to_vector(F.zip_with(vec, middle, lambda a, b: a - b)))
    model = PCA(k=k, inputCol="__c", outputCol="__pc").fit(centred)
    loads = model.pc.toArray()
    sign = [float(np.sign(loads[np.abs(loads[:, j]).argmax(), j]) or 1.0) for j in range(k)]
    scored = model.transform(centred).withColumn("__a", vector_to_array("__pc"))
    pc = F.array(*[F.col("__a")[j] * F.lit(sign[j]) for j in range(k)])
    return scored.withColumn("pc", pc).drop("__c", "__pc", "__a"), model.explainedVariance.toArray()


def display_scale(df: DataFrame, cols: list[str], lo: float = 0.005, hi: float = 0.995, asinh: bool = False) -> DataFrame:
    """Coordinates scaled to [0, 1] between two percentiles, points outside dropped; ``asinh`` first divides by
    the median absolute value and compresses."""
    cur = df
    if asinh:
        med = quantile_map(cur.select(*[F.abs(c).alias(c) for c in cols]), cols, [0.5])
        cur = cur.withColumns({c: F.asinh(F.col(c) / F.lit(med[c][0])) for c in cols})
    q = quantile_map(cur, cols, [lo, hi])
    cur = cur.withColumns({c: (F.col(c) - F.lit(q[c][0])) / F.lit(q[c][1] - q[c][0]) for c in cols})
    cond: Column = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).between(0.0, 1.0)
    return cur.filter(cond)


# ---------------------------------------------------------------- comparisons

def cluster_algorithms(key: str, vec: str, seed: int = 42, threshold: float = 0.5) -> dict:
    """Name -> function(df) that returns labels(k): the four algorithms of the k sweep. A hierarchy is built
    once per table and cut for every k."""

    def ward(df: DataFrame):
        h = hierarchical(df, key, vec, "ward")
        return lambda k: df.join(h.labels(k), key)

    def birch(df: DataFrame):
        h = micro_hierarchy(df, vec, threshold, "ward", seed=seed)
        return lambda k: h.predict(df, key, vec, k)

    return {
        "K-Means": lambda df: lambda k: assign_cluster(df, vec, fit_kmeans(df, vec, k, 1, seed)[0]).drop("distance", "distances"),
        "Agglomerative (ward)": ward,
        "Gaussian Mixture": lambda df: lambda k: gaussian_mixture(df, vec, k, 10, seed=seed).apply(df, vec).drop("p"),
        "Micro-clusters": birch,
    }


def internal_scores(df: DataFrame, key: str, vec: str, cluster: str, sample_size: int | None = None) -> tuple:
    s = silhouette(df, key, vec, cluster, sample_size).first()["silhouette"]
    return s, davies_bouldin(df, vec, cluster).first()[0], calinski_harabasz(df, vec, cluster).first()[0]


def k_sweep(df: DataFrame, key: str, vec: str, truth: str, ks: list[int], algorithms: dict) -> DataFrame:
    """Four scores for each algorithm and k."""
    rows = []
    data = df.select(key, vec, truth).persist()
    for name, fit in algorithms.items():
        labelled = fit(data)
        for k in ks:
            out = labelled(k).select(key, vec, truth, "cluster").persist()
            rows.append((name, k, *internal_scores(out, key, vec, "cluster"), adjusted_rand(out, truth, "cluster").first()["ari"]))
            out.unpersist()
    data.unpersist()
    return df.sparkSession.createDataFrame(rows, "algorithm string, k int, silhouette double, davies_bouldin double, calinski_harabasz double, ari double")


def stability(df: DataFrame, key: str, vec: str, k: int, fits: int = 5, share: float = 0.67, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Refit on hash samples. Returns the scores of every fit, and the adjusted Rand index of every pair of fits
    on all rows; ``mean_std`` summarises either."""
    spark = df.sparkSession
    data = df.select(key, vec).persist()
    n = data.count()
    out, scores = data, []
    for i in range(fits):
        part = sample_n(data, [key], max(k, int(n * share)), seed + i).persist()
        centers, _ = fit_kmeans(part, vec, k, 1, seed + i)
        scores.append((i, *internal_scores(assign_cluster(part, vec, centers).select(key, vec, "cluster"), key, vec, "cluster")))
        part.unpersist()
        out = assign_cluster(out, vec, centers).drop("distance", "distances").withColumnRenamed("cluster", f"c{i}")
    pairs = F.array(*[F.struct(F.lit(i).alias("run_a"), F.lit(j).alias("run_b"), F.col(f"c{i}").alias("a"), F.col(f"c{j}").alias("b"))
                      for i in range(fits) for j in range(i + 1, fits)])
    ari = adjusted_rand(out.select(F.inline(pairs)), "a", "b", ["run_a", "run_b"])
    runs = spark.createDataFrame(scores, "run int, silhouette double, davies_bouldin double, calinski_harabasz double")
    return runs, ari


def number_clusters(df: DataFrame, cluster_key: str, out: str = "cluster") -> DataFrame:
    """Cluster keys as 0..k-1 in key order, null as -1."""
    names = sorted(r[0] for r in collect_small(df.select(cluster_key).filter(F.col(cluster_key).isNotNull()).distinct(), what="clusters"))
    if not names:
        return df.withColumn(out, F.lit(-1))
    kind = df.schema[cluster_key].dataType.simpleString()
    table = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(names)], f"`{cluster_key}` {kind}, `{out}` int")
    return lookup(df, F.broadcast(table), [cluster_key]).withColumn(out, F.coalesce(out, F.lit(-1)))
