"""Model evaluation on a long prediction table: row_id, model, y, pred and p (class probabilities).

Everything that can be is computed from confusion cells: at most classes x classes rows per model, found
by one map-side combined count.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowbench.functions.hashing import count_at_or_below, with_poisson
from flowbench.functions.ordered import running_total
from flowbench.functions.small import lookup
from flowbench.operators.audit import histogram
from flowbench.session import checkpoint_root

THRESHOLDS = [i / 20 for i in range(1, 20)]


def confusion_cells(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    return pred.groupBy(*(by or []), "y", "pred").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(pred: DataFrame, labels: list[str], by: list[str] | None = None) -> DataFrame:
    """All label pairs with counts and the share within the true class (0 for an empty class)."""
    by = by or []
    cells = confusion_cells(pred, by)
    keys = cells.select(*by).distinct() if by else pred.sparkSession.range(1).select()
    table = F.array(*[F.lit(v) for v in labels])
    grid = keys.withColumn("y", F.explode(table)).withColumn("pred", F.explode(table))
    full = lookup(grid, cells, [*by, "y", "pred"]).withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.sum("n").over(Window.partitionBy(*by, "y"))
    return full.withColumn("share", F.coalesce(F.try_divide(F.col("n"), total), F.lit(0.0)))


def class_table(cells: DataFrame, by: list[str]) -> DataFrame:
    """Per class (union of true and predicted): tp, support, predicted. ``cells`` holds y, pred, n."""
    sides = F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(F.lit(0)).cast("long").alias("tp")),
        F.struct(F.col("pred").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")))
    return cells.withColumn("n", F.col("n").cast("long")).select(*by, F.inline(sides)).groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))


def _share(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def per_class_report(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class; a division by zero is 0."""
    return report_from_cells(confusion_cells(pred, by), by or [])


def report_from_cells(cells: DataFrame, by: list[str]) -> DataFrame:
    t = class_table(cells, by)
    return t.select(*by, "class", _share(F.col("tp"), F.col("predicted")).alias("precision"), _share(F.col("tp"), F.col("support")).alias("recall"),
                    _share(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"), "support", "predicted", "tp")


def metrics_from_cells(cells: DataFrame, by: list[str]) -> DataFrame:
    r = report_from_cells(cells, by)

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / F.sum("support")

    return r.groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"), weighted("precision").alias("precision_w"), weighted("recall").alias("recall_w"),
        weighted("f1").alias("f1_w"), F.avg("f1").alias("f1_macro"), F.sum("support").alias("n"))


def classification_metrics(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy, weighted precision, recall and F1, macro F1, all from the confusion cells."""
    return metrics_from_cells(confusion_cells(pred, by), by or [])


def class_scores(pred: DataFrame, classes: list[str], by: list[str]) -> DataFrame:
    """One row per distinct score: by..., class, score, pos, neg. Rows with equal scores meet before the shuffle."""
    table = F.array(*[F.lit(c) for c in classes])
    pairs = F.zip_with(table, F.col("p"), lambda c, s: F.struct(c.alias("class"), s.alias("score")))
    long = pred.select(*by, "y", F.inline(pairs))
    hit = F.col("y") == F.col("class")
    counted = long.groupBy(*by, "class", "score").agg(F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))
    # Later steps read the counts several times; the cut spares them the prediction table.
    checkpoint_root(pred.sparkSession)
    return counted.checkpoint()


def roc_auc_ovr(pred: DataFrame, classes: list[str], by: list[str] | None = None) -> DataFrame:
    """Exact area under the ROC curve per class, ties counted half; null without both sides."""
    by = by or []
    scores = class_scores(pred, classes, by)
    run = running_total(scores, [*by, "class"], "score", ["neg"])
    wins = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2.0))
    return run.groupBy(*by, "class").agg(F.try_divide(wins, F.sum("pos") * F.sum("neg")).alias("auc"), F.sum("pos").alias("support"))


def roc_auc_macro(pred: DataFrame, classes: list[str], by: list[str] | None = None) -> DataFrame:
    """Mean area over the classes that occur."""
    a = roc_auc_ovr(pred, classes, by).filter("support > 0")
    return a.groupBy(*(by or [])).agg(F.avg("auc").alias("auc_macro"))


def roc_points(pred: DataFrame, classes: list[str], by: list[str] | None = None) -> DataFrame:
    """Curve points per class and for all row and class pairs together (class ``micro``)."""
    by = by or []
    scores = class_scores(pred, classes, by)
    micro = scores.groupBy(*by, F.lit("micro").alias("class"), "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    both = scores.unionByName(micro)
    run = running_total(both, [*by, "class"], "score", ["pos", "neg"])
    tp = F.col("all_pos") - F.col("cum_pos") + F.col("pos")
    fp = F.col("all_neg") - F.col("cum_neg") + F.col("neg")
    return run.select(*by, "class", F.col("score").alias("threshold"), F.try_divide(fp.cast("double"), F.col("all_neg")).alias("fpr"),
                         F.try_divide(tp.cast("double"), F.col("all_pos")).alias("tpr"),
                         F.try_divide(F.col("neg").cast("double"), F.col("all_neg")).alias("step"),
                         F.try_divide(F.col("pos").cast("double"), F.col("all_pos")).alias("rise"))


def roc_areas(points: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Trapezoid area per curve. Every point knows its own step and rise, so no neighbour is looked up."""
    return points.groupBy(*(by or []), "class").agg(F.sum(F.col("step") * (F.col("tpr") - F.col("rise") / 2)).alias("auc"))


def worst_classes(areas: DataFrame, by: list[str], k: int = 3) -> DataFrame:
    """The k classes with the smallest area per model."""
    w = Window.partitionBy(*by).orderBy("auc", "class")
    return areas.filter("class <> 'micro'").withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def regression_metrics(pred: DataFrame, y: str, yhat: str, cap: float | None = None, by: list[str] | None = None) -> DataFrame:
    """R2, RMSE and MAE on the log scale and, for a log target, RMSE and MAE in the original unit."""
    e = F.col(y) - F.col(yhat)
    aggs = [(1 - F.sum(e * e) / (F.var_pop(y) * F.count(y))).alias("r2"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae")]
    if cap is not None:
        raw = F.expm1(y) - F.least(F.greatest(F.expm1(yhat), F.lit(0.0)), F.lit(float(cap)))
        aggs += [F.sqrt(F.avg(raw * raw)).alias("rmse_raw"), F.avg(F.abs(raw)).alias("mae_raw")]
    return pred.groupBy(*(by or [])).agg(*aggs)


def residual_report(pred: DataFrame, y: str, yhat: str, bins: int = 50) -> DataFrame:
    """Histogram of the residuals with their mean and standard deviation beside every bin."""
    r = pred.select((F.col(y) - F.col(yhat)).alias("residual"))
    moments = r.agg(F.avg("residual").alias("mean"), F.stddev_samp("residual").alias("std"))
    return histogram(r, "residual", bins).withColumns({
        "mean": moments.select("mean").scalar(), "std": moments.select("std").scalar()})


def bootstrap_cells(pred: DataFrame, key: str, by: list[str], replicates: int, seed: int = 42) -> DataFrame:
    """Confusion cells of every Poisson replicate. Replicates are columns of one aggregate over the rows."""
    w = with_poisson(pred.select(key, *by, "y", "pred"), [key], replicates, seed)
    reps = range(1, replicates + 1)
    agg = w.groupBy(*by, "y", "pred").agg(*[F.sum(f"__w{b}").alias(f"s{b}") for b in reps])
    rows = F.array(*[F.struct(F.lit(b).alias("replicate"), F.col(f"s{b}").alias("n")) for b in reps])
    return agg.select(*by, "y", "pred", F.inline(rows))


def multinomial_cells(pred: DataFrame, by: list[str], replicates: int, seed: int = 42) -> DataFrame:
    """Confusion cells of every replicate, drawn from the cells themselves: n draws with replacement from the
    rows give a multinomial over the cells, whatever the number of rows. One draw per model and replicate."""
    cells = confusion_cells(pred, by)
    packed = cells.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("y", "pred", "n"))).alias("cells"))
    jobs = packed.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).repartition("replicate")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in jobs.schema.fields if f.name in by)
    yt = pred.schema["y"].dataType.simpleString()
    schema = f"{fields}, replicate int, y {yt}, pred {yt}, n bigint" if by else f"replicate int, y {yt}, pred {yt}, n bigint"

    def draw(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                rec = row._asdict()
                n = np.array([c["n"] for c in rec["cells"]], dtype=np.int64)
                got = np.random.default_rng([seed, rec["replicate"]]).multinomial(int(n.sum()), n / n.sum())
                out += [(*[rec[b] for b in by], rec["replicate"], c["y"], c["pred"], int(g)) for c, g in zip(rec["cells"], got)]
            yield pd.DataFrame(out, columns=[*by, "replicate", "y", "pred", "n"])

    return jobs.mapInPandas(draw, schema)


def bootstrap_ci(pred: DataFrame, key: str, by: list[str], replicates: int = 1000, method: str = "multinomial", seed: int = 42) -> DataFrame:
    """Weighted F1 with its 2.5% and 97.5% bootstrap limits and bootstrap standard deviation."""
    cells = bootstrap_cells(pred, key, by, replicates, seed) if method == "poisson" else multinomial_cells(pred, by, replicates, seed)
    f1 = metrics_from_cells(cells, [*by, "replicate"])
    spread = f1.groupBy(*by).agg(F.percentile("f1_w", F.array(F.lit(0.025), F.lit(0.975))).alias("q"), F.stddev_pop("f1_w").alias("std"))
    base = classification_metrics(pred, by).select(*by, "f1_w")
    return lookup(base, spread, by).select(*by, "f1_w", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"), "std")


def exact_binomial(b: int, c: int) -> float:
    """Two-sided exact binomial p-value at one half. Terms fall off fast, so only the largest ones are summed."""
    n, m = b + c, min(b, c)
    if n == 0:
        return 1.0
    log_n = math.lgamma(n + 1) - n * math.log(2.0)
    total, k = 0.0, m
    while k >= 0:
        term = math.exp(log_n - math.lgamma(k + 1) - math.lgamma(n - k + 1))
        total += term
        if term < total * 1e-17 or (term == 0.0 and k < m):
            break
        k -= 1
    return min(1.0, 2.0 * total)


def mcnemar(pred: DataFrame, best: str, others: list[str], key: str = "row_id") -> DataFrame:
    """Discordant counts of the best model against each other one, exact p-value and 5% flag. The models' hits
    meet in one aggregate per row, so no self-join is needed."""
    names = [best, *others]
    ok = (F.col("y") == F.col("pred")).cast("int")
    wide = pred.filter(F.col("model").isin(names)).groupBy(key).agg(*[F.max(F.when(F.col("model") == m, ok)).alias(f"m{i}") for i, m in enumerate(names)])
    counts = wide.agg(*[F.count_if((F.col("m0") == 1) & (F.col(f"m{i}") == 0)).alias(f"b{i}") for i in range(1, len(names))],
                      *[F.count_if((F.col("m0") == 0) & (F.col(f"m{i}") == 1)).alias(f"c{i}") for i in range(1, len(names))])
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"b{i}").alias("only_best"), F.col(f"c{i}").alias("only_other"))
                     for i, m in enumerate(names) if i])

    @F.pandas_udf("double")
    def p_value(b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([exact_binomial(int(x), int(y)) for x, y in zip(b, c)])

    return counts.select(F.inline(rows)).withColumn("p_value", p_value("only_best", "only_other")).withColumn(
        "significant", F.col("p_value") < 0.05)


def threshold_counts(df: DataFrame, p: str, positive: Column, by: list[str] | None = None, thresholds: list[float] | None = None) -> DataFrame:
    """tp, fp, fn, tn of "positive when p >= t" for each threshold. A row is counted once, in the bin of the
    thresholds it reaches; the running sums over the few bins give all thresholds at once."""
    by, ts = by or [], thresholds or THRESHOLDS
    cells = df.select(*by, count_at_or_below(F.col(p), ts).alias("reached"), positive.alias("pos")).groupBy(*by, "reached").agg(
        F.count_if("pos").alias("pos"), F.count_if(~F.col("pos")).alias("neg"))
    sums = []
    for i, _ in enumerate(ts):
        hit = F.col("reached") > i
        sums += [F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias(f"tp{i}"), F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias(f"fp{i}")]
    agg = cells.groupBy(*by).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"), *sums)
    rows = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
                              (F.col("all_pos") - F.col(f"tp{i}")).alias("fn"), (F.col("all_neg") - F.col(f"fp{i}")).alias("tn"))
                     for i, t in enumerate(ts)])
    return agg.select(*by, F.inline(rows))


# Points per decision of the published threshold game.
DECISION_POINTS = {"tp": 10, "tn": 1, "fp": -15, "fn": -25}


def decision_score() -> Column:
    return sum((F.col(k) * v for k, v in DECISION_POINTS.items()), F.lit(0))


def threshold_curve(df: DataFrame, p: str, positive: Column, by: list[str] | None = None) -> DataFrame:
    """Precision, recall and points of "block when p >= t" for t = 0.05 .. 0.95."""
    c = threshold_counts(df, p, positive, by)
    return c.withColumns({
        "precision": F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fp")),
        "recall": F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fn")), "points": decision_score()})


def uncertain_share(df: DataFrame, p: str, by: list[str] | None = None, lo: float = 0.02, hi: float = 0.98) -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.avg(((F.col(p) > lo) & (F.col(p) < hi)).cast("double")).alias("uncertain_share"))


def reproduce_check(a: DataFrame, b: DataFrame, keys: list[str], cols: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Largest absolute difference per column between two tables, rows without partner, and whether it passes."""
    renamed = b.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in cols])
    j = a.select(*keys, *cols, F.lit(1).alias("__a")).join(renamed.withColumn("__b", F.lit(1)), keys, "full_outer")
    lost = F.count_if(F.col("__a").isNull() | F.col("__b").isNull())
    agg = j.agg(lost.alias("unmatched"), *[F.max(F.abs(F.col(c) - F.col(f"__b_{c}"))).alias(f"d{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("max_difference")) for i, c in enumerate(cols)])
    return agg.select("unmatched", F.inline(rows)).withColumn(
        "ok", (F.col("unmatched") == 0) & (F.coalesce("max_difference", F.lit(0.0)) <= tolerance))


def scaling_check(scaled: DataFrame, cols: list[str], split: str = "split") -> DataFrame:
    """Mean and population deviation of scaled columns per split: 0 and 1 on train only."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return scaled.groupBy(split).agg(*aggs)
