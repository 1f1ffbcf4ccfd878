"""Hand-computed values, one per pitfall."""

import math

import pytest
from pyspark.sql import functions as F

from flowbench.functions import text
from flowbench.operators import audit, clean, cluster_metrics, encode, features, metrics, setops, split, summarize


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_adjusted_skew(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 0, 1, 2, 9, 30)], "x double")
    r = audit.describe_numeric(df, ["x"]).first()
    assert r["skew"] == pytest.approx(2.0540645130, abs=1e-9)
    assert r["zero_share"] == pytest.approx(2 / 6)
    assert r["q50"] == 1.5


def test_scale_uses_population_std_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    assert rows(encode.standardize(df, ["a", "b"]).apply(df), "a", "b") == [(-1.0, 0.0), (1.0, 0.0)]


def test_rare_and_unseen_levels(spark):
    train = spark.createDataFrame([("a",)] * 3 + [("b",)], "c string")
    new = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    folded = encode.fold_rare(train, "c", 2).apply(new)
    assert sorted(r["c"] for r in folded.collect()) == ["a", "other", "other", "other"]
    hot = encode.fit_one_hot(train, ["c"], "infrequent", 2)
    assert rows(hot.apply(new), "c_a", "c_infrequent") == [(0.0, 0.0), (0.0, 0.0), (0.0, 1.0), (1.0, 0.0)]
    assert encode.fit_one_hot(train, ["c"], "drop_first").names() == ["c_b"]
    index = encode.index_labels(train, "c")
    assert sorted(r["i"] for r in index.apply(new, "i").collect()) == [-1, -1, 0, 1]


def test_top_values_tie_and_legacy(spark):
    df = spark.createDataFrame([(5,), (5,), (1,), (1,), (2,)], "p int")
    assert sorted(r["p"] for r in encode.bucket_top_values(df, "p", 1).apply(df).collect()) == [-1, -1, -1, 1, 1]
    legacy = encode.bucket_top_values(df, "p", 10, legacy_counts=True).apply(df)
    assert sorted(r["p"] for r in legacy.collect()) == [-1, -1, 1, 1, 2]


def test_mode_tie_and_impute(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 3.0), (None, None), ("z", float("nan")), ("a", 5.0), ("b", float("inf"))], "s string, x double")
    model = clean.fit_imputer(audit.nonfinite_to_null(df, ["x"]), ["x"], ["s"])
    assert model.modes == {"s": "a"} and model.medians == {"x": 3.0}
    assert rows(model.apply(df).filter("s = 'z'"), "x") == [(3.0,)]
    out, report = clean.missing_policy(df)
    assert report["action"] == "impute" and out.filter("x is null or s is null or isnan(x)").count() == 0


def test_quantile_bins_right_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 1, 1, 1, 2, 3, 4, 5)], "x double")
    b = encode.quantile_bins(df, "x", 4)
    assert b.edges == [1.0, 1.5, 3.25, 5.0]
    assert [r["bin"] for r in b.apply(df).orderBy("x").collect()] == [0, 0, 0, 0, 1, 1, 2, 2]


def test_twin_overlap_matches_nulls(spark):
    train = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    test = spark.createDataFrame([(1, None), (1, None), (2, "y")], "a int, b string")
    r = audit.twin_overlap(train, test, ["a", "b"]).first()
    assert (r["test_rows"], r["twin_rows"]) == (3, 2)


def test_roc_ties_against_pair_count(spark):
    data = [("a", 0.5), ("b", 0.5), ("a", 0.9), ("b", 0.1), ("a", 0.1), ("b", 0.5)]
    df = spark.createDataFrame([(i, y, [s, 1 - s]) for i, (y, s) in enumerate(data)], "row_id int, y string, p array<double>")
    auc = {r["class"]: r["auc"] for r in metrics.roc_auc_ovr(df, ["a", "b"]).collect()}
    pos, neg = [s for y, s in data if y == "a"], [s for y, s in data if y == "b"]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / 9
    assert auc["a"] == pytest.approx(want) and auc["b"] == pytest.approx(want)
    area = {r["class"]: r["auc"] for r in metrics.roc_areas(metrics.roc_points(df, ["a", "b"])).collect()}
    assert area["a"] == pytest.approx(want)


def test_class_never_predicted_and_empty_row(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("b", "a")], "y string, pred string")
    f1 = {r["class"]: r["f1"] for r in metrics.per_class_report(df).collect()}
    assert f1 == {"a": 0.5, "b": 0.0}
    cells = {(r["y"], r["pred"]): r["share"] for r in metrics.confusion_matrix(df, ["a", "b", "c"]).collect()}
    assert cells[("c", "a")] == 0.0 and cells[("b", "a")] == 1.0 and len(cells) == 9


def test_silhouette_singleton_and_one_cluster(spark):
    df = spark.createDataFrame([(0, 0, [0.0]), (1, 0, [1.0]), (2, 1, [10.0])], "id int, c int, v array<double>")
    got = {r["id"]: r["silhouette"] for r in cluster_metrics.silhouette_rows(df, "id", "v", "c").collect()}
    assert got[2] == 0.0 and got[0] == pytest.approx(0.9) and got[1] == pytest.approx(8 / 9)
    assert cluster_metrics.silhouette(df.filter("c = 0"), "id", "v", "c").first()["silhouette"] is None


def test_mcnemar_limits():
    assert metrics.exact_binomial(0, 0) == 1.0
    assert metrics.exact_binomial(5, 5) == 1.0
    assert metrics.exact_binomial(1, 5) == pytest.approx(14 / 64)


def test_elbow_and_pareto(spark):
    c = spark.createDataFrame([(2, 10.0), (3, 4.0), (4, 3.0), (5, 2.5)], "k int, v double")
    assert summarize.elbow(c, "k", "v").first()["k"] == 3
    r = spark.createDataFrame([("a", 1.0, 0.5), ("b", 2.0, 0.4), ("c", 3.0, 0.6), ("d", 1.0, 0.3)], "m string, t double, f double")
    assert rows(summarize.pareto_front(r, "m", "t", "f"), "m") == [("a",), ("c",)]


def test_pick_usable_falls_back(spark):
    r = spark.createDataFrame([("a", 0.95, 0.7), ("b", 0.99, 0.9)], "m string, share double, s double")
    assert summarize.pick_usable(r, "m", "s", F.col("share") < 0.9).first()["picked"] == "b"
    assert summarize.pick_usable(r, "m", "s", F.col("share") < 0.97).first()["picked"] == "a"


def test_leak_list_reaches_children(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "y int, a int, b int, c int")
    assert clean.drop_leaky(df, {"y": ["a"], "a": ["b"]}, "y").columns == ["y", "c"]


def test_zero_packets_and_ports(spark):
    df = spark.createDataFrame([(40000, 0, 0, 5, 2)], "dst_port int, src_pkts int, dst_pkts int, src_bytes int, dst_bytes int")
    out = features.feature_pack_flow_clu(df, encode.LevelModel("dst_port", spark.createDataFrame([(40000,)], "level int"), None)).first()
    assert out["bytes_per_src_pkt"] == 0.0 and out["has_reply"] == 0 and out["dst_port_bucket"] == "40000"


def test_set_helpers(spark):
    runs = spark.createDataFrame([("b",), ("a",), ("c",)], "run string")
    assert rows(setops.pairwise_runs(runs, "run"), "run_a", "run_b") == [("a", "b"), ("a", "c"), ("b", "c")]
    assert setops.cross_grid(runs, {"x": [1, 2], "z": [0.5]}).count() == 6
    with pytest.raises(ValueError):
        setops.row_align_join(runs.filter("run <> 'a'"), runs, "run")


def test_text(spark):
    df = spark.createDataFrame([(999.0, None, "DDOS"), (1234567.0, 0.256, "xss")], "b double, s double, c string")
    got = df.select(text.format_bytes("b"), text.format_percent("s", 1), text.display_label("c", {"xss": "XSS"})).collect()
    assert [tuple(r) for r in got] == [("999 B", "–", "Ddos"), ("1.23 MB", "25.6%", "XSS")]
    assert df.select(text.log_numbers(F.lit("F1=0.91 then F1=0.95"), r"F1=([\d.]+)").alias("x")).first()["x"] == ["0.91", "0.95"]
    assert df.select(text.round_or_null(F.lit(float("nan"))).alias("x")).first()["x"] is None


def test_check_split_and_quota(spark):
    df = spark.createDataFrame([(i, "r" if i < 2 else "n", i % 7) for i in range(100)], "id int, y string, g int")
    part = split.subsample_quota(df, "y", ["id"], 10)
    assert {r["y"]: r["count"] for r in part.groupBy("y").count().collect()} == {"r": 1, "n": 10}
    assert rows(split.check_split(split.split_by_group(df, "g", [0, 1]), "y", "g"), "violation", "value") == [("class on one side", "r")]
    assert split.check_split(split.split_by_group(df, "g", [0]), "y", "g").count() == 0


def test_regression_metrics_cap(spark):
    df = spark.createDataFrame([(math.log1p(10.0), math.log1p(1e6)), (0.0, -5.0)], "y double, h double")
    r = metrics.regression_metrics(df, "y", "h", cap=100.0).first()
    assert r["mae_raw"] == pytest.approx((90 + 0) / 2)


def test_cluster_scores_leave_noise_out(spark):
    rows = [(0, 0, [0.0]), (1, 0, [1.0]), (2, 1, [10.0]), (3, 1, [11.0]), (4, -1, [500.0])]
    df = spark.createDataFrame(rows, "id int, c int, v array<double>")
    got = cluster_metrics.cluster_scores(df, "id", "v", "c").first()
    assert got["clusters"] == 2 and got["noise_rows"] == 1 and got["silhouette"] > 0.98 and got["davies_bouldin"] == pytest.approx(0.1)
    one = cluster_metrics.cluster_scores(df.filter("c <> 1"), "id", "v", "c").first()
    assert one["silhouette"] is None and one["davies_bouldin"] is None and one["calinski_harabasz"] is None and one["clusters"] == 1
