"""Writing splits, result tables, reports and fitted bundles."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_splits(df: DataFrame, path: str, split_col: str = "split", mode: str = "errorifexists") -> None:
    """One parquet table partitioned by split, so that reading one split prunes the others."""
    df.write.mode(mode).partitionBy(split_col).parquet(path)


def upsert_results(runs: DataFrame, key: str = "model", order: str = "run") -> DataFrame:
    """The row of the newest run per key. A max over structs combines map-side; no window is needed."""
    rest = [c for c in runs.columns if c not in (key, order)]
    newest = F.max(F.struct(F.col(order), *[F.col(c) for c in rest]))
    return runs.groupBy(key).agg(newest.alias("r")).select(key, "r.*")


def write_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Headered CSV, a file per partition, or one file where the caller knows the report to be small."""
    (df.coalesce(1) if single_file else df).write.option("header", True).csv(path)


def to_document(df: DataFrame, column: str = "document") -> DataFrame:
    """Each row as one nested JSON document."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(column))


def export_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def save_bundle(spark: SparkSession, path: str, model: PipelineModel, statistics: dict[str, DataFrame], meta: dict) -> None:
    """A fitted pipeline, its statistics tables and a small meta record under one folder."""
    model.write().overwrite().save(f"{path}/model")
    for name, df in statistics.items():
        df.write.mode("overwrite").parquet(f"{path}/statistics/{name}")
    record = json.dumps({"meta": meta, "statistics": sorted(statistics)})
    spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, dict[str, DataFrame], dict]:
    record = json.loads(spark.read.text(f"{path}/meta").first()[0])
    tables = {name: spark.read.parquet(f"{path}/statistics/{name}") for name in record["statistics"]}
    return PipelineModel.load(f"{path}/model"), tables, record["meta"]
