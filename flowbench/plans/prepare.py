"""From a raw flow table to train and test features in one call, and ablation over feature sets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowbench.operators import clean, encode, features, split
from flowbench.operators.metrics import regression_metrics
from flowbench.session import write_through
from flowbench.sources.schemas import numeric_columns

TASKS = ("regression", "classification", "clustering")
KEY = "row_key"


@dataclass
class Bundle:
    """Prepared splits, names of the features, the label index and a one-row meta table."""

    train: DataFrame
    test: DataFrame
    names: list[str]
    index: encode.IndexModel | None
    meta: DataFrame


def prepare_dataset(raw: DataFrame, task: str, drop_leaky: bool = False, log_target: bool = False, subsample: int | None = None,
                    seed: int = 42, target: str = "sloss", twin: str = "dloss", label: str = "attack_cat",
                    categorical: tuple[str, ...] = ("proto", "service", "state"), rare: int = 20, test_share: float = 0.2) -> Bundle:
    """Clean, engineer, split, clip, encode and scale a table of flows. All statistics come from train rows."""
    if task not in TASKS:
        raise ValueError(f"task must be one of {TASKS}")
    df = clean.drop_present(raw, features.ALWAYS_DROP)
    df, missing = clean.missing_policy(df)
    df = clean.dedup(df)
    # Without copies the whole row is its own key; it is taken before any column is dropped.
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(i), *df.columns)), 16, "0") for i in (1, 2)]
    df = df.withColumn(KEY, F.concat(*halves))
    df = clean.normalize_label(df, label)
    df = features.feature_pack_ratios(df, drop_leaky)
    if drop_leaky:
        df = clean.drop_leaky(df, {target: features.LEAKY}, target)
    # Writing the table spares every later pass the de-duplication.
    df = write_through(df, "prepared")
    df = split.split_stratified(df, label, [KEY], test_share, seed)
    on_train = F.col("split") == "train"
    for model in encode.fold_rare_columns(df.filter(on_train), list(categorical), rare):
        df = model.apply(df)
    labels = [c for c in features.LABELS if c in df.columns]
    held = [*labels, target, twin] if task == "regression" else labels
    numeric = numeric_columns(df.schema, [*held, KEY])
    clipped = [c for c in numeric if c not in (target, twin)]
    df = clean.clip_quantile(df.filter(on_train), clipped).apply(df)
    index = None
    if task == "regression":
        df = df.withColumn("y", F.log1p(F.greatest(F.col(target).cast("double"), F.lit(0.0))) if log_target else F.col(target).cast("double"))
    elif task == "classification":
        index = encode.index_labels(df.filter(on_train), label)
        df = index.apply(df, "y")
    hot = encode.fit_one_hot(df.filter(on_train), list(categorical), "drop_first")
    scale = encode.standardize(df.filter(on_train), numeric)
    names = [*numeric, *hot.names()]
    ready = encode.FeaturePlan(names).assemble(hot.apply(scale.apply(df)))
    keep = [KEY, "features", label, *([] if task == "clustering" else ["y"])]
    train, test = ready.filter(on_train).select(*keep), ready.filter(~on_train).select(*keep)
    if subsample:
        if task == "classification":
            train = split.sample_stratified(train, label, [KEY], subsample, seed)
        elif task == "regression":
            binned = encode.quantile_bins(train, "y", 10).apply(train, "bin")
            train = split.sample_stratified(binned, "bin", [KEY], subsample, seed).drop("bin")
        else:
            train = split.sample_n(train, [KEY], subsample, seed)
    sizes = train.agg(F.count(F.lit(1)).alias("n_train")).withColumn("n_test", test.agg(F.count(F.lit(1))).scalar())
    after = df.agg(F.count(F.lit(1)))
    meta = sizes.withColumns({
        "task": F.lit(task), "n_rows_before_clean": F.lit(missing["rows"]).cast("long"), "n_rows_after_clean": after.scalar(),
        "n_features": F.lit(len(names)).cast("long"), "drop_leaky": F.lit(drop_leaky), "log_target": F.lit(log_target),
        "subsampled": F.lit(bool(subsample)), "rows_with_missing": F.lit(missing["rows_with_missing"]).cast("long"),
        "missing_action": F.lit(missing["action"])}).withColumn(
        "duplicates_removed", F.col("n_rows_before_clean") - F.col("n_rows_after_clean")
        - (F.col("rows_with_missing") if missing["action"] == "drop" else F.lit(0)))
    return Bundle(train, test, names, index, meta)


def ablation_sets(train: DataFrame, test: DataFrame, target: str, all_features: list[str], removals: list[tuple[str, list[str]]],
                  fit: Callable[[DataFrame, str], object]) -> DataFrame:
    """R2 after removing feature groups one after the other; the first row uses every feature."""
    left, parts = list(all_features), []
    for i, (name, gone) in enumerate([("everything", []), *removals]):
        left = [c for c in left if c not in gone]
        plan = encode.FeaturePlan(left)
        model = fit(plan.assemble(train), target)
        one = regression_metrics(model.apply(plan.assemble(test)), target, "yhat")
        parts.append(one.select(F.lit(i).alias("step"), F.lit(name).alias("removed"), F.lit(len(left)).alias("n_features"), "r2"))
    return reduce(lambda a, b: a.unionByName(b), parts)
