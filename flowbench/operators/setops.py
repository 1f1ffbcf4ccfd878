"""Joins and set operations between result tables and row tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowbench.functions.small import SMALL_ROWS, collect_small, pin_small


def compare_runs(a: DataFrame, b: DataFrame, key: str, value_a: str, value_b: str) -> DataFrame:
    """Runs found in both tables with the absolute difference of their scores."""
    return a.select(key, value_a).join(b.select(key, value_b), key).withColumn("difference", F.abs(F.col(value_a) - F.col(value_b)))


def semi_filter(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is in the key table (copies of a key do not multiply rows)."""
    return df.join(keys, on, "left_semi")


def anti_filter(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is not in the key table."""
    return df.join(keys, on, "left_anti")


def enrich_lookup(df: DataFrame, table: DataFrame, on: str | list[str]) -> DataFrame:
    """Left lookup: rows without a match keep nulls. The table is broadcast only within the size bound."""
    return df.join(pin_small(table), on, "left")


def outer_align(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Align one-value tables (key, n) on the union of their keys; a missing value is 0."""
    out = None
    for name, df in tables.items():
        one = df.select(key, F.col("n").alias(name))
        out = one if out is None else out.join(one, key, "full_outer")
    return out.na.fill(0, list(tables))


def nearest_value_join(df: DataFrame, value: str, key: str, targets: list[float]) -> DataFrame:
    """For each target the row with the nearest value (smallest key among ties). One aggregate with one
    running best per target: no pair of row and target is ever written."""
    aggs = [F.min_by(F.struct(F.col(key), F.col(value)), F.struct(F.abs(F.col(value) - F.lit(float(t))), F.col(key))).alias(f"b{i}")
            for i, t in enumerate(targets)]
    rows = [F.struct(F.lit(float(t)).alias("target"), F.col(f"b{i}.{key}").alias(key), F.col(f"b{i}.{value}").alias(value))
            for i, t in enumerate(targets)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def row_align_join(raw: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Attach raw columns to processed rows by row key. A processed row without its raw row and a raw key that is
    held twice are errors; one pass over the keys of both finds either."""
    keys = raw.select(key, F.lit(1).alias("r"), F.lit(0).alias("p")).union(processed.select(key, F.lit(0), F.lit(1)))
    wrong = keys.groupBy(key).agg(F.sum("r").alias("r"), F.sum("p").alias("p")).filter("r > 1 or (r = 0 and p > 0)").select("r").limit(1).collect()
    if wrong:
        raise ValueError("a raw key is held twice" if wrong[0]["r"] else "processed rows without a raw row")
    return processed.join(raw, key, "left")


def set_ops(a: DataFrame, b: DataFrame) -> dict[str, DataFrame]:
    """Intersection, differences and union of two key tables."""
    return {"both": a.intersect(b), "only_a": a.subtract(b), "only_b": b.subtract(a), "any": a.union(b).distinct()}


def pairwise_runs(runs: DataFrame, run: str, max_runs: int = 2_000) -> DataFrame:
    """All unordered pairs of runs. The run list is small by its meaning and its size is checked."""
    names = sorted(r[0] for r in collect_small(runs.select(run).distinct(), max_runs, "run list"))
    kind = runs.schema[run].dataType.simpleString()
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    return runs.sparkSession.createDataFrame(pairs, f"run_a {kind}, run_b {kind}")


def cross_grid(df: DataFrame, values: dict[str, list]) -> DataFrame:
    """Every row with every combination of parameter values."""
    size = 1
    for vs in values.values():
        size *= len(vs)
    if size > SMALL_ROWS:
        raise ValueError("parameter grid is too large")
    for name, vs in values.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in vs])))
    return df
