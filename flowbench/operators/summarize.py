"""Summaries, ranks and top-k of result tables (one row per model, fold or class).

Result tables are small, but every step here is a plain aggregate or a window per metric, so a long
history of runs works as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowbench.functions.small import lookup


def long_metrics(df: DataFrame, key: str | list[str], metrics: list[str]) -> DataFrame:
    """One row per key and metric."""
    keys = [key] if isinstance(key, str) else key
    return df.unpivot(keys, metrics, "metric", "value")


def family_summary(results: DataFrame, group: str, name: str, best: str, means: list[str]) -> DataFrame:
    """Per family: names (best first), number of configurations, best and mean scores, best family first."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct((-F.col(best)).alias("o"), F.col(name).alias("name")))), lambda x: x["name"])
    out = results.groupBy(group).agg(
        F.array_join(ordered, ", ").alias("models"), F.count(F.lit(1)).alias("configs"),
        F.max(best).alias(f"best_{best}"), *[F.avg(m).alias(f"mean_{m}") for m in means])
    return out.orderBy(F.desc(f"best_{best}"), group)


def part_means(results: DataFrame, part: str, name: str, metrics: list[str], without: str = "tuned") -> DataFrame:
    """Mean scores per part, configurations whose name contains ``without`` left out."""
    return results.filter(~F.col(name).contains(without)).groupBy(part).agg(*[F.avg(m).alias(m) for m in metrics])


def crosstab_share(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts per pair of levels and the share within the row level."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("__t"))
    return lookup(cells, rows, [a]).withColumn("share", F.col("n") / F.col("__t")).drop("__t")


def crosstab_wide(df: DataFrame, a: str, b: str, levels: list) -> DataFrame:
    """The same shares with one column per listed level of b."""
    return crosstab_share(df, a, b).groupBy(a).pivot(b, levels).agg(F.first("share")).na.fill(0.0)


def cluster_profile(df: DataFrame, cluster: str, label: str, least: float = 0.02) -> DataFrame:
    """Size of each cluster and its mix of labels, shares of at least ``least`` in falling order."""
    cells = crosstab_share(df, cluster, label)
    mix = F.collect_list(F.when(F.col("share") >= least, F.struct((-F.col("share")).alias("o"), F.col(label).alias("name"),
                                                                 F.round("share", 3).alias("share"))))
    ordered = F.transform(F.sort_array(mix), lambda x: F.struct(x["name"].alias("name"), x["share"].alias("share")))
    return cells.groupBy(cluster).agg(F.sum("n").alias("size"), ordered.alias("mix"))


def pivot_table(df: DataFrame, index: str, columns: str, value: str, levels: list) -> DataFrame:
    """Long to wide. Listing the levels spares a pass over the data."""
    return df.groupBy(index).pivot(columns, levels).agg(F.first(value))


def mean_std(df: DataFrame, by: list[str], metrics: list[str]) -> DataFrame:
    """Mean and sample standard deviation of each metric per group."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_std")]
    return df.groupBy(*by).agg(*aggs)


def _better(value: Column, key: str, low: bool) -> Column:
    return F.struct(value if low else -value, F.col(key))


def arg_best(results: DataFrame, key: str, directions: dict[str, bool], by: list[str] | None = None) -> DataFrame:
    """The best row label per metric (True: smaller is better), first name among ties."""
    long = long_metrics(results, [*(by or []), key], list(directions))
    low = F.col("metric").isin([m for m, d in directions.items() if d])
    score = F.when(low, F.col("value")).otherwise(-F.col("value"))
    return long.groupBy(*(by or []), "metric").agg(
        F.min_by(key, F.struct(score, F.col(key))).alias("best"), F.min_by("value", F.struct(score, F.col(key))).alias("value"))


def summary_table(results: DataFrame, key: str, metrics: list[str], time: str) -> DataFrame:
    """Question, model and value: best on each metric, fastest, best mean rank."""
    best = arg_best(results, key, {**{m: False for m in metrics}, time: True})
    asked = best.select(F.when(F.col("metric") == time, F.lit("Fastest to train (s)")).otherwise(F.concat(F.lit("Best "), "metric")).alias("question"),
                        F.col("best").alias("model"), "value")
    ranks = rank_metrics(results, key, {m: False for m in metrics})
    first = ranks.agg(F.min_by(F.struct(F.col(key).alias("model"), F.col("mean_rank").alias("value")), F.struct("mean_rank", key)).alias("r"))
    return asked.unionByName(first.select(F.lit("Best mean rank").alias("question"), "r.model", "r.value"))


def fold_summary(folds: DataFrame, by: list[str], fold: str, value: str) -> DataFrame:
    """Mean, population standard deviation and the values in fold order."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(fold, value))), lambda x: x[value])
    return folds.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), ordered.alias("folds"))


def rank_metrics(results: DataFrame, key: str, directions: dict[str, bool]) -> DataFrame:
    """Rank of each model on each metric (ties share the best rank) and the mean rank."""
    long = long_metrics(results, key, list(directions))
    low = F.col("metric").isin([m for m, d in directions.items() if d])
    signed = long.withColumn("__s", F.when(low, F.col("value")).otherwise(-F.col("value")))
    ranked = signed.withColumn("rank", F.rank().over(Window.partitionBy("metric").orderBy("__s")))
    wide = ranked.groupBy(key).pivot("metric", list(directions)).agg(F.first("rank"))
    mean = sum((F.col(m) for m in directions), F.lit(0)) / F.lit(float(len(directions)))
    return wide.withColumn("mean_rank", mean)


def pareto_front(results: DataFrame, key: str, time: str, score: str) -> DataFrame:
    """Models that no faster model beats. The best score per time is taken first, so the ordered window
    holds one row per distinct time of a result table."""
    w = Window.orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best = results.groupBy(time).agg(F.max(score).alias("__b")).withColumn("__m", F.max("__b").over(w))
    return lookup(results, best.select(time, "__m"), [time]).filter(F.col(score) >= F.col("__m")).drop("__m")


def elbow(curve: DataFrame, k: str, value: str) -> DataFrame:
    """The k whose value lies furthest below the straight line from the first to the last point."""
    ends = F.struct(F.min(k).alias("k0"), F.max(k).alias("k1"), F.min_by(value, k).alias("v0"), F.max_by(value, k).alias("v1"))
    points = curve.agg(ends.alias("e"), F.collect_list(F.struct(F.col(k).alias("k"), F.col(value).alias("v"))).alias("p")).select("e", F.inline("p"))
    line = F.col("e.v0") + (F.col("k") - F.col("e.k0")) * (F.col("e.v1") - F.col("e.v0")) / (F.col("e.k1") - F.col("e.k0"))
    gap = line - F.col("v")
    return points.withColumn("gap", gap).agg(F.max_by("k", F.struct("gap", -F.col("k"))).alias("k"), F.max("gap").alias("gap"))


def leaderboard(results: DataFrame, key: str, metric: str) -> DataFrame:
    """Results with place 1..n by a metric, larger first, then by name."""
    return results.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(metric), F.asc(key))))


def top_k(df: DataFrame, metric: str, key: str, k: int) -> DataFrame:
    return df.orderBy(F.desc(metric), F.asc(key)).limit(k)


def top_k_in_row(names: Column, values: Column, k: int) -> Column:
    """The k largest entries of a row's array with their names, ties by name."""
    pairs = F.zip_with(names, values, lambda n, v: F.struct((-v).alias("o"), n.alias("name"), v.alias("p")))
    return F.transform(F.slice(F.array_sort(pairs), 1, k), lambda x: F.struct(x["name"].alias("name"), x["p"].alias("p")))


def tuning_delta(results: DataFrame, key: str, metrics: list[str], suffix: str = " (tuned)") -> DataFrame:
    """Base and tuned score of every algorithm that has both, per metric. Both are found in one aggregate."""
    long = long_metrics(results, key, metrics)
    base_name = F.regexp_replace(F.col(key), r"\Q" + suffix + r"\E$", "")
    is_tuned = F.col(key).endswith(suffix)
    out = long.groupBy(base_name.alias("algorithm"), "metric").agg(
        F.max(F.when(~is_tuned, F.col("value"))).alias("base"), F.max(F.when(is_tuned, F.col("value"))).alias("tuned"))
    return out.filter("base is not null and tuned is not null").withColumn("change", F.col("tuned") - F.col("base"))


def pick_usable(results: DataFrame, key: str, score: str, guard: Column) -> DataFrame:
    """The best row among those that pass a guard; when none passes, the best of all."""
    order = F.struct(F.coalesce(guard, F.lit(False)).cast("int"), F.col(score))
    tie = F.struct(-F.coalesce(guard, F.lit(False)).cast("int"), -F.col(score), F.col(key))
    return results.agg(F.min_by(key, tie).alias("picked"), F.max(order).alias("o")).select(
        "picked", F.col("o.col1").cast("boolean").alias("usable"), F.col(f"o.{score}").alias("score"))


def hardest_classes(per_class: DataFrame, cls: str, key: str, f1: str, support: str) -> DataFrame:
    """Per class: support, mean F1 over the models, best and worst model; hardest first."""
    return per_class.groupBy(cls).agg(
        F.max(support).alias("support"), F.avg(f1).alias("mean_f1"),
        F.min_by(key, F.struct(-F.col(f1), F.col(key))).alias("best"), F.min_by(key, F.struct(F.col(f1), F.col(key))).alias("worst")
    ).orderBy("mean_f1", cls)


def select_best(base: DataFrame, tuned: DataFrame, key: str, metrics: list[str], score: str) -> DataFrame:
    """Base table with tuned scores where they exist, and its best row marked."""
    t = tuned.select(key, *[F.col(m).alias(f"__t_{m}") for m in metrics])
    merged = base.join(t, key, "left").select(
        key, *[F.coalesce(f"__t_{m}", m).alias(m) for m in metrics], F.col(f"__t_{score}").isNotNull().alias("tuned"))
    return leaderboard(merged, key, score).withColumn("chosen", F.col("rank") == 1)
