"""Reading flow tables: files with a declared schema, parts, listings, shape checks, synthetic rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowbench.functions.hashing import hash_uniform


def read_flows(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None, fmt: str = "csv") -> DataFrame:
    """Read one or many files. CSV and JSON need a declared schema; parquet and ORC carry their own."""
    reader = spark.read
    if fmt in ("csv", "json"):
        if schema is None:
            raise ValueError(f"declare a schema for {fmt}; inferring it reads the data twice")
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(fmt).load(paths)


def union_parts(parts: list[DataFrame], names: list[str] | None = None, part_col: str = "part") -> DataFrame:
    """Concatenate part tables by column name, keeping which part a row came from."""
    names = names or [str(i) for i in range(len(parts))]
    out = None
    for df, name in zip(parts, names):
        tagged = df.withColumn(part_col, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def discover_files(spark: SparkSession, folder: str, patterns: list[str]) -> DataFrame:
    """Files under a folder whose name matches a pattern, with sizes; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "{" + ",".join(patterns) + "}").load(folder)
            .select(F.element_at(F.split("path", "/"), -1).alias("file"), "path", F.col("length").alias("bytes")))


def verify_shape(tables: dict[str, DataFrame], expected: dict[str, tuple[int | None, int]]) -> DataFrame:
    """One row per table: expected and actual rows and columns, and whether they agree."""
    out = None
    for name, df in tables.items():
        rows, cols = expected[name]
        one = df.agg(F.count(F.lit(1)).alias("actual_rows")).select(
            F.lit(name).alias("file"), F.lit(rows).cast("long").alias("expected_rows"), "actual_rows",
            F.lit(cols).cast("long").alias("expected_columns"), F.lit(len(df.columns)).cast("long").alias("actual_columns"))
        out = one if out is None else out.unionByName(one)
    same_rows = F.col("expected_rows").isNull() | (F.col("expected_rows") == F.col("actual_rows"))
    return out.withColumn("ok", same_rows & (F.col("expected_columns") == F.col("actual_columns")))


def synthetic_features(ids: DataFrame, key: str, n_features: int, classes: int = 2, seed: int = 42) -> DataFrame:
    """Standard normal features and a class for every key, drawn from the key's hash (Box-Muller)."""
    cols = [F.col(key)]
    for i in range(n_features):
        u = hash_uniform([key, F.lit(f"u{i}")], seed)
        v = hash_uniform([key, F.lit(f"v{i}")], seed)
        cols.append((F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * math.pi * v)).alias(f"f{i}"))
    cols.append(F.floor(hash_uniform([key, F.lit("y")], seed) * classes).cast("int").alias("y"))
    return ids.select(*cols)


def synthetic_flows(spark: SparkSession, n: int, n_features: int = 5, classes: int = 2, seed: int = 42) -> DataFrame:
    """A random table of n rows with the shape of a prepared data set."""
    return synthetic_features(spark.range(n), "id", n_features, classes, seed)
