"""Many columns in one pass, many levels without a cap."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowbench.operators import audit, encode


def test_correlation_with_gaps_large_means_and_constants(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (500, 6))
    x[:, 1] = x[:, 0] * 0.7 + 0.3 * x[:, 1]
    x[:, 2] += 1e9
    x[:, 3] = 7.7
    gaps = rng.random(x.shape) < 0.2
    data = [[None if g and j != 3 else float(v) for j, (v, g) in enumerate(zip(r, m))] for r, m in zip(x, gaps)]
    data[0][4], data[1][4] = float("nan"), float("inf")
    data = [[*r, None] for r in data]
    names = [f"c{i}" for i in range(7)]
    got = {(r["a"], r["b"]): r["r"] for r in audit.correlation_matrix(spark.createDataFrame(data, ", ".join(f"{n} double" for n in names)).repartition(5), names).collect()}
    y = np.array([[np.nan if v is None or not np.isfinite(v) else v for v in r] for r in data])
    assert len(got) == 21
    for i in range(7):
        for j in range(i + 1, 7):
            both = ~np.isnan(y[:, i]) & ~np.isnan(y[:, j])
            if 3 in (i, j) or 6 in (i, j):
                assert got[names[i], names[j]] is None
            else:
                assert got[names[i], names[j]] == pytest.approx(np.corrcoef(y[both, i], y[both, j])[0, 1], abs=1e-9)


def test_a_thousand_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 1000))
    rows = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").coalesce(2)
    names = [f"c{i}" for i in range(1000)]
    wide = rows.select(*[F.col("v")[i].alias(n) for i, n in enumerate(names)])
    r = audit.correlation_matrix(wide, names)
    want = np.corrcoef(x.T)
    got = r.filter("a IN ('c0', 'c500')").collect()
    assert len(got) == 999 + 499 and all(abs(g["r"] - want[int(g["a"][1:]), int(g["b"][1:])]) < 1e-9 for g in got)


def test_equal_columns(spark):
    df = spark.range(200).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b"), F.col("id").alias("c"), F.when(F.col("id") > 0, F.col("id")).alias("d"),
                                 F.lit(None).cast("int").alias("e"), F.lit(None).cast("string").alias("f"), ((F.col("id") + 1) % 200).alias("g"))
    assert {tuple(r) for r in audit.equal_columns(df.repartition(4), df.columns).collect()} == {("c", "a"), ("f", "e")}
    assert audit.equal_columns(df, ["a", "b"]).collect() == [] == audit.equal_columns(df, []).collect()


def test_a_million_levels(spark):
    df = spark.range(1_000_000).select(F.concat(F.lit("v"), F.lpad("id", 7, "0")).alias("x"))
    index = encode.index_labels(df, "x")
    asked = df.filter("x < 'v0000003' OR x >= 'v0999999'").union(spark.createDataFrame([("unseen",), (None,)], "x string"))
    out = index.apply(asked, "i")
    assert {r["x"]: r["i"] for r in out.collect()} == {"v0000000": 0, "v0000001": 1, "v0000002": 2, "v0999999": 999_999, "unseen": -1, None: -1}
    back = index.invert(out, "i", "y").filter("NOT x <=> y").collect()
    assert {r["x"] for r in back} == {"unseen"} and back[0]["y"] is None
    hot = encode.fit_one_hot_vector(df, ["x"])
    rows = {r["x"]: r["onehot"] for r in hot.apply(asked).collect()}
    assert rows["v0999999"].size == 1_000_000 and rows["v0999999"].indices.tolist() == [999_999] and rows["unseen"].indices.tolist() == rows[None].indices.tolist() == []


@pytest.mark.parametrize("policy", ["dummies", "drop_first", "infrequent"])
def test_sparse_vectors_equal_columns(spark, policy):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 3), ("c", 3), (None, 9), ("d", 1)], "s string, n int")
    wide = encode.fit_one_hot(df, ["s", "n"], policy, 2)
    sparse = encode.fit_one_hot_vector(df, ["s", "n"], policy, 2)
    asked = df.union(spark.createDataFrame([("z", None)], "s string, n int"))
    want = sorted((str(r["s"]), str(r["n"]), [r[c] for c in wide.names()]) for r in wide.apply(asked, keep=True).collect())
    got = sorted((str(r["s"]), str(r["n"]), r["v"]) for r in sparse.apply(asked).withColumn("v", vector_to_array("onehot")).collect())
    assert got == want
    with pytest.raises(ValueError, match="policy"):
        encode.fit_one_hot_vector(df, ["s"], "none")
