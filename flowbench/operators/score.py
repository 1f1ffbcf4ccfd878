"""Batch scoring: the prepared models applied to a whole table of flows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowbench.functions.small import lookup, pin_small
from flowbench.functions.text import display_label
from flowbench.operators.clean import complete_rows
from flowbench.operators.cluster import assign_cluster
from flowbench.operators.regress import tree_interval


def ranked_probabilities(labels: list[str], p: Column) -> Column:
    """Class names with probabilities, most likely first, ties by name."""
    names = F.array(*[F.lit(c) for c in labels])
    pairs = F.zip_with(names, p, lambda n, v: F.struct((-v).alias("o"), n.alias("name"), v.alias("p")))
    return F.transform(F.array_sort(pairs), lambda x: F.struct(x["name"].alias("name"), x["p"].alias("p")))


def score_classify(df: DataFrame, key: str, model, prepare: Callable[[DataFrame], DataFrame], notes: dict[str, str] | None = None,
                   names: dict[str, str] | None = None) -> DataFrame:
    """Prediction, display label, confidence, note and ranked probabilities of every row."""
    scored = model.apply(prepare(df))
    labels = getattr(model, "labels", None) or model.classes
    ranked = scored.select(key, ranked_probabilities(labels, F.col("p")).alias("probabilities"))
    top = F.col("probabilities")[0]
    out = ranked.withColumns({"prediction": top["name"], "confidence": top["p"]}).withColumn("label", display_label("prediction", names))
    if notes:
        table = F.create_map(*[F.lit(x) for kv in notes.items() for x in kv])
        out = out.withColumn("note", F.try_element_at(table, F.col("prediction")))
    return out


def score_cluster(df: DataFrame, key: str, vec: str, centers, profiles: DataFrame | None = None) -> DataFrame:
    """Nearest centre (numbered from 1), its distance, all distances and the profile of the cluster."""
    out = assign_cluster(df, vec, centers).select(key, "cluster", "distance", "distances")
    if profiles is not None:
        out = lookup(out, pin_small(profiles), ["cluster"])
    return out.withColumn("cluster", F.col("cluster") + 1)


def score_regress(df: DataFrame, key: str, template: dict, prepare: Callable[[DataFrame], DataFrame], forest) -> DataFrame:
    """Partial rows filled from the train template, mean over the trees and 10-90% band in the original unit."""
    return tree_interval(prepare(complete_rows(df, template)), forest).select(key, "yhat", "low", "high")


def scored_records(df: DataFrame, key: str, labels: list[str], fields: list[str], top: int = 4, least: float = 0.005, digits: int = 3) -> DataFrame:
    """Nested records: label, prediction, the leading probabilities of at least ``least``, chosen flow fields."""
    lead = F.filter(F.slice(ranked_probabilities(labels, F.col("p")), 1, top), lambda x: x["p"] >= least)
    proba = F.transform(lead, lambda x: F.struct(x["name"].alias("name"), F.round(x["p"], digits).alias("p")))
    shown = [F.round(F.col(f.name), 4).alias(f.name) if f.dataType.simpleString() in ("double", "float") else F.col(f.name)
             for f in df.schema.fields if f.name in fields]
    return df.select(key, F.col("y").alias("label"), "pred", proba.alias("proba"), F.struct(*shown).alias("f"))
