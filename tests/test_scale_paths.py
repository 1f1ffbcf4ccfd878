"""The distributed paths give the same rows as the plain ones, also with hot keys and tiny blocks."""

import os

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowbench.functions import ordered
from flowbench.functions.hashing import row_hash
from flowbench.functions.small import fit_input
from flowbench.operators import cluster, neighbors, setops, split
from flowbench.operators.metrics import class_scores, roc_auc_ovr
from flowbench.plans import views


@pytest.fixture(scope="module")
def skewed(spark):
    """One class holds a third of the rows and one value is very frequent."""
    return spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 40)).alias("y"),
                                    F.when(F.col("id") % 4 == 0, 7.0).otherwise((F.col("id") * 7919 % 1009) / 10.0).alias("x"))


def test_selected_quantiles_equal_percentile(spark, skewed):
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    a = {(r["y"], r["column"]): r["quantiles"] for r in ordered.selected_quantiles(skewed, ["x"], probs, ["y"]).collect()}
    b = {(r["y"], r["column"]): r["quantiles"] for r in ordered.exact_quantiles(skewed, ["x"], probs, ["y"]).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k])
    assert ordered.exact_quantiles(skewed, ["x"], [0.5], state_values=10).first()["quantiles"] == ordered.exact_quantiles(skewed, ["x"], [0.5]).first()["quantiles"]


def test_running_total_and_position(spark, skewed):
    agg = skewed.groupBy("y", "x").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("y").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r["y"], r["x"]): r["c"] for r in agg.withColumn("c", F.sum("n").over(w)).collect()}
    got = {(r["y"], r["x"]): r["cum_n"] for r in ordered.running_total(agg, ["y"], "x", ["n"], 8).collect()}
    assert got == want
    holes = agg.withColumn("y", F.when(F.col("y") != "hot", F.col("y")))
    null_sum = ordered.running_total(holes.groupBy("y", "x").agg(F.sum("n").alias("n")), ["y"], "x", ["n"], 8).filter("y is null")
    assert null_sum.agg(F.max("cum_n")).first()[0] == 1000 and null_sum.agg(F.max("all_n")).first()[0] == 1000
    assert ordered.running_total(agg.groupBy("x").agg(F.sum("n").alias("n")), [], "x", ["n"], 8).agg(F.max("cum_n")).first()[0] == 3000
    pos = ordered.row_position(skewed.select("id"), "id", 16).collect()
    assert all(r["position"] == r["id"] + 1 for r in pos)


def test_cutoffs_equal_window_ranks(spark, skewed):
    w = Window.partitionBy("y").orderBy(row_hash(["id"], 5))
    ranked = skewed.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("y")))
    want = {r["id"] for r in ranked.filter("rn <= round(n * 0.3)").collect()}
    got = split.split_stratified(skewed, "y", ["id"], 0.3, 5).filter("split = 'test'")
    assert {r["id"] for r in got.collect()} == want
    whole = split.take_in_hash_order(skewed, [], ["id"], 5, F.least(F.lit(500), F.col("n")))
    assert {r["id"] for r in whole.collect()} == {r["id"] for r in split.sample_n(skewed, ["id"], 500, 5).collect()}
    assert split.sample_n(skewed, ["id"], 99999).count() == 3000


def test_splits_do_not_depend_on_partitions(skewed):
    a = split.kfold_stratified(skewed, "y", ["id"]).select("id", "fold")
    b = split.kfold_stratified(skewed.repartition(5, "x"), "y", ["id"]).select("id", "fold")
    assert a.exceptAll(b).count() == 0
    sizes = [r["count"] for r in a.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 41


def test_grouped_folds(spark, skewed):
    df = skewed.withColumn("g", F.col("id") % 50)
    f = split.kfold_grouped(df, "y", "g", 5)
    assert f.groupBy("g").agg(F.count_distinct("fold").alias("k")).filter("k > 1").count() == 0
    assert f.count() == 3000
    many = spark.range(60_000).select("id", (F.col("id") % 25_000).alias("g"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("y"))
    sizes = [r["count"] for r in split.kfold_grouped(many, "y", "g", 5).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 12
    sizes = [r["count"] for r in split.kfold_grouped(df, "y", "g", 5).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) <= 2 * min(sizes)
    v = split.carve_validation(df, "y", "g")
    assert {r["part"] for r in v.select("part").distinct().collect()} == {"valid", "fit"}


def points(spark, n=300, seed=1, copies=100):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.4, (n // 3, 3)) for c in (0, 3, 6)] + [np.full((copies, 3), 1.5)])
    return x, spark.createDataFrame([(i, [float(a) for a in row], int(i % 4)) for i, row in enumerate(x)], "id int, v array<double>, y int")


@pytest.mark.parametrize("cells,block,chunk", [(10_000, 50_000, 50_000), (20, 13, 17)])
def test_neighbors_equal_brute_force(spark, cells, block, chunk):
    x, df = points(spark)
    got = neighbors.nearest_neighbors(df.filter("id % 3 = 0"), df, 4, "id", "id", "v", "y", block_rows=block, chunk_rows=chunk, rows_per_cell=cells)
    found = {}
    for r in got.collect():
        found.setdefault(r["query"], {})[r["place"]] = (r["neighbor"], r["distance"], r["payload"])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for q in range(0, len(x), 3):
        order = np.lexsort((np.arange(len(x)), d[q]))[:4]
        assert [found[q][i + 1][0] for i in range(4)] == order.tolist()
        assert [found[q][i + 1][1] for i in range(4)] == pytest.approx(d[q][order].tolist(), abs=1e-12)


@pytest.mark.parametrize("dims", [2, 64])
def test_two_rounds_visit_few_blocks(spark, dims):
    """Rows in clumps: a query stays in its clump's cells, also in 64 dimensions, and finds what brute force finds."""
    rng = np.random.default_rng(dims)
    x = np.concatenate([rng.normal(c, 1.0, (60, dims)) for c in rng.normal(0, 12, (10, dims))] + [np.tile(rng.normal(0, 12, (1, dims)), (80, 1))])
    df = spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "id int, v array<double>")
    asked = df.filter("id % 4 = 0")
    found = {}
    for r in neighbors.nearest_neighbors(asked, df, 3, "id", "id", "v", rows_per_cell=20, block_rows=30, skip_same=True).collect():
        found.setdefault(r["query"], {})[r["place"]] = r["neighbor"]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for q in range(0, len(x), 4):
        assert [found[q][i + 1] for i in range(3)] == np.lexsort((np.arange(len(x)), d[q]))[:3].tolist()
    cost = neighbors.neighbor_visits(asked, df, 3, "id", "v", rows_per_cell=20, block_rows=30).toPandas()
    assert len(cost) == len(found) and cost["blocks"].iloc[0] >= 30 and cost["visited"].mean() < 0.3 * cost["blocks"].iloc[0]


def test_few_rows_in_the_own_cell(spark):
    """The own cell holds fewer than k rows, so the first round bounds nothing."""
    x = [[0.0, 0.0], [100.0, 0.0], [101.0, 0.0], [102.0, 1.0], [300.0, 0.0]]
    df = spark.createDataFrame(list(enumerate(x)), "id int, v array<double>")
    got = neighbors.nearest_neighbors(df.filter("id = 0"), df, 4, "id", "id", "v", rows_per_cell=1).orderBy("place").collect()
    assert [r["neighbor"] for r in got] == [0, 1, 2, 3]


def test_skip_same(spark):
    _, df = points(spark, 30, copies=0)
    n = neighbors.nearest_neighbors(df, df, 2, "id", "id", "v", skip_same=True)
    assert n.filter("query = neighbor").count() == 0 and n.count() == 60


def brute_dbscan(x, eps, m):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= eps
    core = d.sum(1) >= m
    label = np.full(len(x), -1)
    for i in np.flatnonzero(core):
        if label[i] < 0:
            stack, label[i] = [i], i
            while stack:
                for k in np.flatnonzero(d[stack.pop()] & core):
                    if label[k] < 0:
                        label[k] = i
                        stack.append(k)
    return core, label


def test_dbscan_equals_brute_force(spark):
    x, df = points(spark)
    core, label = brute_dbscan(x, 0.45, 6)
    for block in (2000, 40):
        got = {r["id"]: (r["core"], r["cluster_key"]) for r in cluster.dbscan(df, "id", "v", 0.45, 6, block).collect()}
        assert len(got) == len(x)
        for i in range(len(x)):
            assert got[i][0] == core[i]
            if core[i]:
                assert got[i][1] == label[i]
    numbered = cluster.number_clusters(cluster.dbscan(df, "id", "v", 0.45, 6), "cluster_key")
    assert numbered.select("cluster").distinct().count() == len(set(label[core])) + int(numbered.filter("cluster = -1").count() > 0)


def test_components_of_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 600)]
    df = spark.createDataFrame(chain + star + [(900, 900)], "a int, b int")
    got = {r["node"]: r["component"] for r in cluster.connected_components(df).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 500 for i in range(500, 600)) and got[900] == 900


def test_auc_equals_pairs_on_skewed_scores(spark, skewed):
    df = skewed.select(F.when(F.col("y") == "hot", "a").otherwise("b").alias("y"), F.array(F.col("x") / 101, 1 - F.col("x") / 101).alias("p"))
    auc = roc_auc_ovr(df, ["a", "b"]).filter("class = 'a'").first()["auc"]
    pos = np.array([r["p"][0] for r in df.filter("y = 'a'").collect()])
    neg = np.array([r["p"][0] for r in df.filter("y = 'b'").collect()])
    want = ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))
    assert auc == pytest.approx(want)
    assert class_scores(df, ["a", "b"], []).agg(F.sum(F.col("pos") + F.col("neg"))).first()[0] == 6000


def test_row_align_join_refuses_repeated_and_lost_keys(spark):
    raw = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    rows = spark.createDataFrame([(1, 0.5), (1, 0.6), (2, 0.7)], "k int, z double")
    assert setops.row_align_join(raw, rows, "k").count() == 3
    with pytest.raises(ValueError, match="twice"):
        setops.row_align_join(raw.union(raw.filter("k = 1")), rows, "k")
    with pytest.raises(ValueError, match="without a raw row"):
        setops.row_align_join(raw.filter("k = 1"), rows, "k")


def test_no_train_rows(spark):
    q = spark.createDataFrame([(1, [0.0, 1.0])], "id int, v array<double>")
    none = q.filter("id > 1")
    assert neighbors.nearest_neighbors(q, none, 3, "id", "id", "v").collect() == []
    out = cluster.dbscan(spark.createDataFrame([(i, [float(i), 0.0]) for i in range(20)], "id int, v array<double>"), "id", "v", 0.5, 3)
    assert out.count() == 20 and out.filter("cluster_key is not null or core").count() == 0


def test_fit_input_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("double").alias("x"))
    parts = [fit_input(d, ["id", "x"]).withColumn("p", F.spark_partition_id()).withColumn("i", F.monotonically_increasing_id()) for d in (df.repartition(3), df.repartition(11))]
    assert sorted(map(tuple, parts[0].collect())) == sorted(map(tuple, parts[1].collect()))


def test_row_keys_are_unique(spark):
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        if os.path.isdir(f"/root/testdata/{sf}"):
            keys = spark.read.parquet(f"/root/testdata/{sf}/lineitem.parquet").select(F.expr(views.LINE_KEY).alias("k"))
            assert keys.distinct().count() == keys.count()


def test_cells_are_written_once_and_visits_take_slices(spark, monkeypatch):
    """Train rows meet the pivots once (written, then read), and a batch is held against them a slice at a time."""
    from flowbench.operators import neighbors as nb

    labels, real = [], nb.write_through
    monkeypatch.setattr(nb, "write_through", lambda d, name: (labels.append(name), real(d, name))[1])
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (1300, 2))
    df = spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "id long, v array<double>").coalesce(1)
    cells, celled = nb.fit_cells(df, "id", "v", 3, rows_per_cell=20)
    assert labels == ["cells"] and "__rings" not in celled.columns and cells.size.sum() == 1300
    got = nb.nearest_neighbors(df, df, 3, "id", "id", "v", rows_per_cell=20).toPandas()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = np.sort(d, axis=1)[:, :3]
    assert np.allclose(got.sort_values(["query", "place"])["distance"].to_numpy().reshape(-1, 3), want)


def test_elbow_deals_the_rows_once(spark, monkeypatch):
    from flowbench.operators import cluster

    calls, real = [], cluster.fit_input
    monkeypatch.setattr(cluster, "fit_input", lambda *a: (calls.append(1), real(*a))[1])
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.2, (60, 2)) for c in (0, 3, 6)])
    df = spark.createDataFrame([(i, [float(a) for a in r]) for i, r in enumerate(x)], "id long, v array<double>")
    rows = cluster.elbow_sweep(df, "id", "v", [2, 3]).collect()
    assert len(calls) == 1
    for r in rows:
        centers, cost = cluster.fit_kmeans(df, "v", r["k"], 1)
        s = cluster.silhouette(cluster.assign_cluster(df, "v", centers), "id", "v", "cluster").first()[0]
        assert (r["inertia"], r["silhouette"]) == pytest.approx((cost, s))
