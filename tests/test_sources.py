"""Readers, writers, schemas and the prepared bundle."""

import pytest
from pyspark.sql import functions as F

from flowbench.operators import clean, encode, features
from flowbench.plans.prepare import prepare_dataset
from flowbench.session import checkpoint_root, scratch_path
from flowbench.sources import files, sinks
from flowbench.sources.schemas import FLOWS_A, FLOWS_B, numeric_columns, string_columns


def fake(spark, schema, n):
    cols = []
    for i, f in enumerate(schema.fields):
        t = f.dataType.simpleString()
        value = F.concat(F.lit("s"), F.col("id") % (2 + i % 3)) if t == "string" else ((F.col("id") * (i + 3)) % 17).cast(t)
        cols.append(value.alias(f.name))
    return spark.range(n).select(*cols)


def test_schemas():
    assert len(FLOWS_A.fields) == 45 and len(FLOWS_B.fields) == 44
    kinds = [f.dataType.simpleString() for f in FLOWS_A.fields]
    assert (kinds.count("bigint"), kinds.count("double"), kinds.count("string")) == (30, 11, 4)
    assert "proto" in string_columns(FLOWS_A) and "dur" in numeric_columns(FLOWS_A)


@pytest.mark.parametrize("schema", [FLOWS_A, FLOWS_B])
def test_csv_round_trip(spark, schema):
    df = fake(spark, schema, 50)
    path = scratch_path(spark, "csv")
    df.repartition(2).write.option("header", True).csv(path)
    back = files.read_flows(spark, path, schema)
    assert back.schema == schema and back.exceptAll(df).count() == 0 and back.count() == 50
    with pytest.raises(ValueError):
        files.read_flows(spark, path)


def test_json_and_shapes(spark):
    df = spark.range(7).select("id", F.struct(F.lit("x").alias("name"), (F.col("id") / 7).alias("p")).alias("top"))
    path = scratch_path(spark, "json")
    sinks.export_json(df, path)
    assert files.read_flows(spark, path, df.schema, "json").exceptAll(df).count() == 0
    shape = {r["file"]: r["ok"] for r in files.verify_shape({"a": df, "b": df}, {"a": (7, 2), "b": (8, 2)}).collect()}
    assert shape == {"a": True, "b": False}
    assert files.discover_files(spark, path, ["*.json"]).filter("bytes > 0").count() >= 1
    assert files.synthetic_flows(spark, 100, 3).count() == 100


def test_report_and_upsert(spark):
    runs = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.7), ("b", 1, 0.4)], "model string, run int, f1 double")
    out = sinks.upsert_results(runs)
    assert {(r["model"], r["f1"]) for r in out.collect()} == {("a", 0.7), ("b", 0.4)}
    path = scratch_path(spark, "report")
    sinks.write_report(out, path)
    assert files.read_flows(spark, path, out.schema).count() == 2


def test_checkpoint_folder_comes_from_the_session(spark):
    root = checkpoint_root(spark)
    assert root and scratch_path(spark, "x").startswith(root)


@pytest.mark.parametrize("task", ["classification", "regression", "clustering"])
def test_prepare(spark, task):
    raw = fake(spark, FLOWS_A, 600).withColumn("sbytes", F.monotonically_increasing_id() % 400)
    b = prepare_dataset(raw, task, drop_leaky=task == "regression", log_target=True, rare=5, subsample=100 if task == "regression" else None)
    m = b.meta.first()
    assert m["n_rows_before_clean"] == 600 and m["n_train"] == b.train.count() and m["n_features"] == len(b.names)
    assert b.train.join(b.test, "row_key").count() == 0
    if task == "regression":
        assert m["n_train"] == 100 and not set(features.LEAKY) & set(b.names) and "sloss" not in b.names
    with pytest.raises(ValueError):
        prepare_dataset(raw, "other")


def test_scaling_is_learned_on_train(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), F.when(F.col("id") < 80, "train").otherwise("test").alias("split"))
    model = encode.standardize(df.filter("split = 'train'"), ["x"])
    mean = {r["split"]: r["m"] for r in model.apply(df).groupBy("split").agg(F.avg("x").alias("m")).collect()}
    assert mean["train"] == pytest.approx(0.0, abs=1e-12) and abs(mean["test"]) > 1
    clip = clean.clip_iqr(df.filter("split = 'train'"), ["x"])
    assert clip.bounds["x"] == pytest.approx((19.75 - 59.25, 59.25 + 59.25))
