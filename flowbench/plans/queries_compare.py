"""Queries for joins, set operations, summaries, ranks and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowbench.operators import clean, cluster_metrics, encode, metrics, setops, split, summarize
from flowbench.plans.registry import query, table
from flowbench.plans.views import (CLASSES, FLOWS, FOLDS, PRED, RESULTS, VECTORS, flows, folds, predictions, results, rounded, vectors)

# ---------------------------------------------------------------- joins and sets


@query("compare_runs", f"""
    WITH a AS (SELECT concat('m', user_id % 20) AS model, round(avg(value), 4) AS s FROM events GROUP BY 1),
    b AS (SELECT concat('m', event_id % 30) AS model, round(avg(value), 4) AS t FROM events GROUP BY 1)
    SELECT model, s, t, round(abs(s - t), 6) AS difference FROM a JOIN b USING (model)""")
def compare_runs(spark, sf):
    e = table(spark, sf, "events")
    a = e.groupBy(F.expr("concat('m', user_id % 20)").alias("model")).agg(F.round(F.avg("value"), 4).alias("s"))
    b = e.groupBy(F.expr("concat('m', event_id % 30)").alias("model")).agg(F.round(F.avg("value"), 4).alias("t"))
    return rounded(setops.compare_runs(a, b, "model", "s", "t"))


@query("semi_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_filter(spark, sf):
    keys = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return setops.semi_filter(table(spark, sf, "orders"), keys, "o_custkey").select("o_orderkey", "o_totalprice")


@query("anti_filter", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def anti_filter(spark, sf):
    keys = table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return setops.anti_filter(table(spark, sf, "customer"), keys, "c_custkey").select("c_custkey", "c_mktsegment")


@query("enrich_lookup", "SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)")
def enrich_lookup(spark, sf):
    return setops.enrich_lookup(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id")


@query("outer_align", """
    WITH a AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' AND value > 60 GROUP BY user_id),
    b AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'click' AND value > 90 GROUP BY user_id),
    c AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'view' AND value > 120 GROUP BY user_id)
    SELECT coalesce(a.user_id, b.user_id, c.user_id) AS user_id, coalesce(a.n, 0)::BIGINT AS errors, coalesce(b.n, 0)::BIGINT AS clicks, coalesce(c.n, 0)::BIGINT AS views
    FROM a FULL JOIN b ON a.user_id = b.user_id FULL JOIN c ON c.user_id = coalesce(a.user_id, b.user_id)""")
def outer_align(spark, sf):
    e = table(spark, sf, "events")
    count = lambda kind, least: e.filter((F.col("event_type") == kind) & (F.col("value") > least)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return setops.outer_align({"errors": count("error", 60), "clicks": count("click", 90), "views": count("view", 120)}, "user_id")


@query("nearest_value_join", """
    SELECT t::DOUBLE AS target, arg_min(event_id, (abs(value - t), event_id)) AS event_id, arg_min(value, (abs(value - t), event_id)) AS value
    FROM events, (VALUES (0.0::DOUBLE), (1.5), (33.3), (100), (250), (900)) v(t) GROUP BY t""")
def nearest_value_join(spark, sf):
    return setops.nearest_value_join(table(spark, sf, "events"), "value", "event_id", [0, 1.5, 33.3, 100, 250, 900])


@query("row_align_join", f"""
    WITH f AS (SELECT * FROM {FLOWS}), s AS (SELECT avg(qty) AS m, stddev_pop(qty) AS d FROM f)
    SELECT row_id, round((qty - m) / d, 6) AS z, qty, y FROM f, s""")
def row_align_join(spark, sf):
    f = flows(spark, sf)
    processed = encode.standardize(f, ["qty"]).apply(f.select("row_id", "qty")).withColumnRenamed("qty", "z")
    return rounded(setops.row_align_join(f.select("row_id", "qty", "y"), processed, "row_id"))


@query("set_ops", """
    WITH a AS (SELECT DISTINCT user_id FROM events WHERE value > 200), b AS (SELECT DISTINCT user_id FROM events WHERE value < 0.3)
    SELECT 'both' AS op, user_id FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'only_a', user_id FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'only_b', user_id FROM (SELECT * FROM b EXCEPT SELECT * FROM a) UNION ALL SELECT 'any', user_id FROM (SELECT * FROM a UNION SELECT * FROM b)""")
def set_ops(spark, sf):
    e = table(spark, sf, "events")
    parts = setops.set_ops(e.filter("value > 200").select("user_id"), e.filter("value < 0.3").select("user_id"))
    out = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias("op"), "user_id")
        out = one if out is None else out.unionByName(one)
    return out


@query("pairwise_runs", f"""
    WITH r AS (SELECT model, f1 FROM {RESULTS}) SELECT a.model AS run_a, b.model AS run_b, round(abs(a.f1 - b.f1), 6) AS gap FROM r a JOIN r b ON a.model < b.model""")
def pairwise_runs(spark, sf):
    r = results(spark, sf).select("model", "f1")
    pairs = setops.pairwise_runs(r, "model")
    a, b = r.toDF("run_a", "fa"), r.toDF("run_b", "fb")
    return rounded(pairs.join(a, "run_a").join(b, "run_b").select("run_a", "run_b", F.abs(F.col("fa") - F.col("fb")).alias("gap")))


@query("cross_grid", f"""
    SELECT model, depth, share FROM {RESULTS}, (VALUES (3), (5), (9)) d(depth), (VALUES (0.3::DOUBLE), (0.8)) s(share)""")
def cross_grid(spark, sf):
    return setops.cross_grid(results(spark, sf).select("model"), {"depth": [3, 5, 9], "share": [0.3, 0.8]})


# ---------------------------------------------------------------- summaries

@query("family_summary", f"""
    SELECT family, string_agg(model, ', ' ORDER BY f1 DESC, model) AS models, count(*)::BIGINT AS configs, max(f1) AS best_f1, round(avg(f1), 6) AS mean_f1,
           round(avg(accuracy), 6) AS mean_accuracy, round(avg(auc), 6) AS mean_auc, round(avg(train_s), 6) AS mean_train_s FROM {RESULTS} GROUP BY family""")
def family_summary(spark, sf):
    return rounded(summarize.family_summary(results(spark, sf), "family", "model", "f1", ["f1", "accuracy", "auc", "train_s"]))


@query("part_means", f"""
    SELECT family, round(avg(f1), 6) AS f1, round(avg(accuracy), 6) AS accuracy FROM {RESULTS} WHERE NOT contains(model, 'tuned') GROUP BY family""")
def part_means(spark, sf):
    return rounded(summarize.part_means(results(spark, sf), "family", "model", ["f1", "accuracy"]))


@query("crosstab_share", """
    SELECT lang, source, count(*)::BIGINT AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY lang), 6) AS share FROM documents GROUP BY lang, source""")
def crosstab_share(spark, sf):
    return rounded(summarize.crosstab_share(table(spark, sf, "documents"), "lang", "source"))


@query("crosstab_wide", """
    SELECT l_suppkey, round(avg((l_returnflag = 'A')::INT), 6) AS A, round(avg((l_returnflag = 'N')::INT), 6) AS N, round(avg((l_returnflag = 'R')::INT), 6) AS R
    FROM lineitem GROUP BY l_suppkey""")
def crosstab_wide(spark, sf):
    return rounded(summarize.crosstab_wide(table(spark, sf, "lineitem"), "l_suppkey", "l_returnflag", ["A", "N", "R"]))


@query("cluster_profile", """
    WITH c AS (SELECT label, dominant, count(*) AS n FROM (SELECT label, CASE WHEN embedding[1] > 0.1 THEN 'high' WHEN embedding[1] < -0.1 THEN 'low' ELSE 'mid' END AS dominant
      FROM embeddings) GROUP BY ALL), s AS (SELECT *, n / sum(n) OVER (PARTITION BY label) AS share FROM c)
    SELECT label, sum(n)::BIGINT AS size, string_agg(dominant, ',' ORDER BY share DESC, dominant) FILTER (share >= 0.1) AS mix,
           max(round(share, 3)) AS top_share FROM s GROUP BY label""")
def cluster_profile(spark, sf):
    e = table(spark, sf, "embeddings").select("label", F.expr(
        "CASE WHEN embedding[0] > 0.1 THEN 'high' WHEN embedding[0] < -0.1 THEN 'low' ELSE 'mid' END").alias("dominant"))
    prof = summarize.cluster_profile(e, "label", "dominant", 0.1)
    return prof.select("label", "size", F.array_join(F.transform("mix", lambda x: x["name"]), ",").alias("mix"), F.col("mix")[0]["share"].alias("top_share"))


_PIVOT = ", ".join(f"max(f1) FILTER (kind = '{c}') AS {c}" for c in CLASSES)


@query("pivot_table", f"SELECT model, {_PIVOT} FROM (SELECT model, kind, round(avg(f1), 6) AS f1 FROM {FOLDS} GROUP BY model, kind) GROUP BY model")
def pivot_table(spark, sf):
    f = folds(spark, sf).groupBy("model", "kind").agg(F.round(F.avg("f1"), 6).alias("f1"))
    return summarize.pivot_table(f, "model", "kind", "f1", CLASSES)


@query("mean_std", """
    SELECT event_type, round(avg(value), 6) AS value_mean, round(stddev_samp(value), 6) AS value_std FROM events GROUP BY event_type""")
def mean_std(spark, sf):
    return rounded(summarize.mean_std(table(spark, sf, "events"), ["event_type"], ["value"]))


@query("arg_best", f"""
    WITH l AS (SELECT family, model, unnest(['accuracy', 'f1', 'auc', 'train_s']) AS metric, unnest([accuracy, f1, auc, train_s]) AS value FROM {RESULTS}),
    s AS (SELECT *, CASE WHEN metric = 'train_s' THEN value ELSE -value END AS o FROM l)
    SELECT family, metric, model AS best, value FROM s QUALIFY row_number() OVER (PARTITION BY family, metric ORDER BY o, model) = 1""")
def arg_best(spark, sf):
    return summarize.arg_best(results(spark, sf), "model", {"accuracy": False, "f1": False, "auc": False, "train_s": True}, ["family"])


@query("summary_table", f"""
    WITH r AS (SELECT * FROM {RESULTS}), k AS (SELECT model, (rank() OVER (ORDER BY accuracy DESC) + rank() OVER (ORDER BY f1 DESC)) / 2.0 AS mr FROM r)
    SELECT * FROM (SELECT 'Best accuracy' AS question, model, accuracy AS value FROM r ORDER BY accuracy DESC, model LIMIT 1)
    UNION ALL SELECT * FROM (SELECT 'Best f1', model, f1 FROM r ORDER BY f1 DESC, model LIMIT 1)
    UNION ALL SELECT * FROM (SELECT 'Fastest to train (s)', model, train_s FROM r ORDER BY train_s, model LIMIT 1)
    UNION ALL SELECT * FROM (SELECT 'Best mean rank', model, mr FROM k ORDER BY mr, model LIMIT 1)""")
def summary_table(spark, sf):
    return summarize.summary_table(results(spark, sf), "model", ["accuracy", "f1"], "train_s")


@query("fold_summary", f"""
    SELECT model, kind, round(avg(f1), 6) AS mean, round(stddev_pop(f1), 6) AS std, list(round(f1, 6) ORDER BY fold) AS folds FROM {FOLDS} GROUP BY ALL""")
def fold_summary(spark, sf):
    return rounded(summarize.fold_summary(folds(spark, sf), ["model", "kind"], "fold", "f1"))


# ---------------------------------------------------------------- ranks and top-k

@query("rank_metrics", f"""
    WITH k AS (SELECT model, rank() OVER (ORDER BY accuracy DESC)::INT AS accuracy, rank() OVER (ORDER BY f1 DESC)::INT AS f1, rank() OVER (ORDER BY train_s)::INT AS train_s FROM {RESULTS})
    SELECT *, round((accuracy + f1 + train_s) / 3, 6) AS mean_rank FROM k""")
def rank_metrics(spark, sf):
    return rounded(summarize.rank_metrics(results(spark, sf), "model", {"accuracy": False, "f1": False, "train_s": True}))


@query("pareto_front", f"""
    WITH r AS (SELECT model, train_s, f1, max(f1) OVER (ORDER BY train_s RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m FROM {RESULTS})
    SELECT model, train_s, f1 FROM r WHERE f1 >= m""")
def pareto_front(spark, sf):
    return summarize.pareto_front(results(spark, sf).select("model", "train_s", "f1"), "model", "train_s", "f1")


@query("elbow", """
    WITH c AS (SELECT (1 + event_id % 11) AS k, 1000.0::DOUBLE / (1 + event_id % 11) + round(avg(value), 3) / 10 AS v FROM events GROUP BY 1, event_id % 11),
    e AS (SELECT min(k) AS k0, max(k) AS k1, arg_min(v, k) AS v0, arg_max(v, k) AS v1 FROM c)
    SELECT arg_max(k, gap) AS k, round(max(gap), 6) AS gap FROM (SELECT k, v0 + (k - k0) * (v1 - v0) / (k1 - k0) - v AS gap FROM c, e)""")
def elbow(spark, sf):
    c = table(spark, sf, "events").groupBy(F.expr("1 + event_id % 11").alias("k")).agg(F.round(F.avg("value"), 3).alias("a")).withColumn(
        "v", 1000.0 / F.col("k") + F.col("a") / 10)
    return rounded(summarize.elbow(c, "k", "v"))


@query("leaderboard", f"SELECT *, row_number() OVER (ORDER BY f1 DESC, model)::INT AS rank FROM {RESULTS}")
def leaderboard(spark, sf):
    return summarize.leaderboard(results(spark, sf), "model", "f1")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k(spark, sf):
    return summarize.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 25)


@query("top_k_in_row", f"""
    WITH e AS (SELECT row_id, model, unnest({CLASSES}) AS c, unnest(p) AS p FROM {PRED})
    SELECT row_id, model, string_agg(c, ',' ORDER BY p DESC, c) AS best FROM (SELECT *, row_number() OVER (PARTITION BY row_id, model ORDER BY p DESC, c) AS rn FROM e)
    WHERE rn <= 3 GROUP BY row_id, model""")
def top_k_in_row(spark, sf):
    names = F.array(*[F.lit(c) for c in CLASSES])
    return predictions(spark, sf).select("row_id", "model", F.array_join(F.transform(summarize.top_k_in_row(names, F.col("p"), 3), lambda x: x["name"]), ",").alias("best"))


@query("tuning_delta", f"""
    WITH l AS (SELECT model, unnest(['accuracy', 'f1', 'auc']) AS metric, unnest([accuracy, f1, auc]) AS value FROM {RESULTS})
    SELECT b.model AS algorithm, b.metric, b.value AS base, t.value AS tuned, round(t.value - b.value, 6) AS change
    FROM l b JOIN l t ON t.model = b.model || ' (tuned)' AND t.metric = b.metric""")
def tuning_delta(spark, sf):
    return rounded(summarize.tuning_delta(results(spark, sf), "model", ["accuracy", "f1", "auc"]))


@query("pick_usable", f"""
    SELECT model AS picked, accuracy < 0.8 AS usable, f1 AS score FROM {RESULTS} ORDER BY (accuracy < 0.8) DESC, f1 DESC, model LIMIT 1""")
def pick_usable(spark, sf):
    return summarize.pick_usable(results(spark, sf), "model", "f1", F.col("accuracy") < 0.8)


@query("hardest_classes", f"""
    WITH c AS (SELECT kind, model, avg(f1) AS f1, count(*) AS n FROM {FOLDS} GROUP BY ALL)
    SELECT kind, max(n)::BIGINT AS support, round(avg(f1), 6) AS mean_f1, arg_min(model, (-f1, model)) AS best, arg_min(model, (f1, model)) AS worst FROM c GROUP BY kind""")
def hardest_classes(spark, sf):
    c = folds(spark, sf).groupBy("kind", "model").agg(F.avg("f1").alias("f1"), F.count(F.lit(1)).alias("n"))
    return rounded(summarize.hardest_classes(c, "kind", "model", "f1", "n"))


@query("select_best", f"""
    WITH r AS (SELECT * FROM {RESULTS}), m AS (SELECT b.model, coalesce(t.f1, b.f1) AS f1, coalesce(t.auc, b.auc) AS auc, t.f1 IS NOT NULL AS tuned
      FROM (SELECT * FROM r WHERE NOT contains(model, 'tuned')) b LEFT JOIN (SELECT replace(model, ' (tuned)', '') AS model, f1, auc FROM r WHERE contains(model, 'tuned') AND f1 > 0.6) t USING (model))
    SELECT *, row_number() OVER (ORDER BY f1 DESC, model)::INT AS rank, row_number() OVER (ORDER BY f1 DESC, model) = 1 AS chosen FROM m""")
def select_best(spark, sf):
    r = results(spark, sf)
    base = r.filter(~F.col("model").contains("tuned"))
    tuned = r.filter(F.col("model").contains("tuned") & (F.col("f1") > 0.6)).withColumn("model", F.expr("replace(model, ' (tuned)', '')"))
    return summarize.select_best(base, tuned, "model", ["f1", "auc"], "f1")


# ---------------------------------------------------------------- evaluation

CLASS_ROWS = ", ".join(f"('{c}')" for c in CLASSES)


@query("confusion_matrix", f"""
    WITH p AS (SELECT * FROM {PRED}), c AS (SELECT model, y, pred, count(*) AS n FROM p GROUP BY ALL),
    g AS (SELECT model, y, pred FROM (SELECT DISTINCT model FROM p), (VALUES {CLASS_ROWS}) a(y), (VALUES {CLASS_ROWS}) b(pred))
    SELECT model, y, pred, coalesce(n, 0)::BIGINT AS n, round(coalesce(n / sum(n) OVER (PARTITION BY model, y), 0), 6) AS share FROM g LEFT JOIN c USING (model, y, pred)""")
def confusion_matrix(spark, sf):
    return rounded(metrics.confusion_matrix(predictions(spark, sf), CLASSES, ["model"]))


REPORT = f"""
    p AS (SELECT * FROM {PRED}), cells AS (SELECT model, y, pred, count(*) AS n FROM p GROUP BY ALL),
    r AS (SELECT model, class, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
      coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f1, support, predicted, tp FROM (
      SELECT model, class, sum(CASE WHEN y = class THEN n ELSE 0 END)::BIGINT AS support, sum(CASE WHEN pred = class THEN n ELSE 0 END)::BIGINT AS predicted,
        sum(CASE WHEN pred = class AND y = class THEN n ELSE 0 END)::BIGINT AS tp FROM cells, (VALUES {CLASS_ROWS}) v(class) GROUP BY model, class))"""


@query("classification_metrics", f"""
    WITH {REPORT} SELECT model, round(sum(tp) / sum(support), 6) AS accuracy, round(sum(precision * support) / sum(support), 6) AS precision_w,
      round(sum(recall * support) / sum(support), 6) AS recall_w, round(sum(f1 * support) / sum(support), 6) AS f1_w, round(avg(f1), 6) AS f1_macro,
      sum(support)::BIGINT AS n FROM r GROUP BY model""")
def classification_metrics(spark, sf):
    return rounded(metrics.classification_metrics(predictions(spark, sf), ["model"]))


@query("per_class_report", f"""
    WITH {REPORT} SELECT model, class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support, predicted, tp FROM r""")
def per_class_report(spark, sf):
    return rounded(metrics.per_class_report(predictions(spark, sf), ["model"]))


SCORES = f"""p AS (SELECT * FROM {PRED}), s AS (SELECT model, y, unnest({CLASSES}) AS class, unnest(p) AS score FROM p)"""


@query("roc_auc_ovr", f"""
    WITH {SCORES}, k AS (SELECT model, class, y = class AS pos, rank() OVER (PARTITION BY model, class ORDER BY score)
        + (count(*) OVER (PARTITION BY model, class, score) - 1) / 2.0 AS r FROM s)
    SELECT model, class, round((sum(r) FILTER (pos) - count(*) FILTER (pos) * (count(*) FILTER (pos) + 1) / 2.0) / (count(*) FILTER (pos) * count(*) FILTER (NOT pos)), 6) AS auc,
           count(*) FILTER (pos)::BIGINT AS support FROM k GROUP BY model, class""")
def roc_auc_ovr(spark, sf):
    return rounded(metrics.roc_auc_ovr(predictions(spark, sf), CLASSES, ["model"]))


ROC = f"""{SCORES}, g AS (SELECT model, class, score, count(*) FILTER (y = class) AS pos, count(*) FILTER (y <> class) AS neg FROM s GROUP BY ALL
      UNION ALL SELECT model, 'micro', score, count(*) FILTER (y = class), count(*) FILTER (y <> class) FROM s GROUP BY model, score),
    c AS (SELECT model, class, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER a AS allp, sum(neg) OVER a AS alln FROM g
      WINDOW w AS (PARTITION BY model, class ORDER BY score DESC), a AS (PARTITION BY model, class))"""


@query("roc_points", f"WITH {ROC} SELECT model, class, score AS threshold, round(fp / alln, 6) AS fpr, round(tp / allp, 6) AS tpr FROM c")
def roc_points(spark, sf):
    return rounded(metrics.roc_points(predictions(spark, sf), CLASSES, ["model"]).drop("step", "rise"))


@query("roc_areas", f"""
    WITH {ROC}, t AS (SELECT model, class, round(sum((neg / alln) * (tp / allp - pos / allp / 2)), 6) AS auc FROM c GROUP BY model, class)
    SELECT model, class, auc FROM t UNION ALL SELECT model, 'macro', round(avg(auc), 6) FROM t WHERE class <> 'micro' GROUP BY model""")
def roc_areas(spark, sf):
    areas = rounded(metrics.roc_areas(metrics.roc_points(predictions(spark, sf), CLASSES, ["model"]), ["model"]))
    macro = areas.filter("class <> 'micro'").groupBy("model").agg(F.round(F.avg("auc"), 6).alias("auc")).select("model", F.lit("macro").alias("class"), "auc")
    return areas.select("model", "class", "auc").unionByName(macro)


@query("worst_classes", f"""
    WITH {ROC}, t AS (SELECT model, class, round(sum((neg / alln) * (tp / allp - pos / allp / 2)), 6) AS auc FROM c WHERE class <> 'micro' GROUP BY model, class)
    SELECT *, row_number() OVER (PARTITION BY model ORDER BY auc, class)::INT AS place FROM t QUALIFY place <= 3""")
def worst_classes(spark, sf):
    areas = rounded(metrics.roc_areas(metrics.roc_points(predictions(spark, sf), CLASSES, ["model"]), ["model"]))
    return metrics.worst_classes(areas, ["model"])


@query("regression_metrics", """
    WITH t AS (SELECT ln(1 + o_totalprice) AS y, ln(1 + o_totalprice) * 0.99 + (o_custkey % 10) / 100.0 AS h FROM orders), m AS (SELECT max(exp(y) - 1) AS cap FROM t)
    SELECT round(1 - sum((y - h) * (y - h)) / (var_pop(y) * count(*)), 6) AS r2, round(sqrt(avg((y - h) * (y - h))), 6) AS rmse, round(avg(abs(y - h)), 6) AS mae,
      round(sqrt(avg(pow(exp(y) - 1 - least(greatest(exp(h) - 1, 0), 500000), 2))), 3) AS rmse_raw, round(avg(abs(exp(y) - 1 - least(greatest(exp(h) - 1, 0), 500000))), 3) AS mae_raw FROM t""")
def regression_metrics(spark, sf):
    t = table(spark, sf, "orders").select(F.log1p("o_totalprice").alias("y"), F.expr("log1p(o_totalprice) * 0.99 + (o_custkey % 10) / 100.0").alias("h"))
    out = metrics.regression_metrics(t, "y", "h", 500000)
    return out.select(*[F.round(c, 6).alias(c) for c in ("r2", "rmse", "mae")], *[F.round(c, 3).alias(c) for c in ("rmse_raw", "mae_raw")])


@query("residual_report", """
    WITH t AS (SELECT ln(1 + o_totalprice) - (ln(1 + o_totalprice) * 0.99 + (o_custkey % 10) / 100.0::DOUBLE) AS r FROM orders),
    b AS (SELECT min(r) AS lo, max(r) AS hi, avg(r) AS mean, stddev_samp(r) AS std FROM t),
    c AS (SELECT least(floor((r - lo) / ((hi - lo) / 30)), 29)::INT AS bin, count(*)::BIGINT AS n FROM t, b GROUP BY 1)
    SELECT g.i::INT AS bin, round(lo + g.i * ((hi - lo) / 30), 6) AS left_edge, coalesce(n, 0)::BIGINT AS n, round(mean, 6) AS mean, round(std, 6) AS std
    FROM range(30) g(i) CROSS JOIN b LEFT JOIN c ON c.bin = g.i""")
def residual_report(spark, sf):
    t = table(spark, sf, "orders").select(F.log1p("o_totalprice").alias("y"), F.expr("log1p(o_totalprice) * 0.99D + (o_custkey % 10) / 100.0D").alias("h"))
    return rounded(metrics.residual_report(t, "y", "h", 30))


STEPS = ("[0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, "
         "0.9994058151824183, 0.9999167588507119, 0.9999897508033253, 0.999998874797402]")


@query("bootstrap_ci", f"""
    WITH p AS (SELECT row_id, model, y, pred FROM {PRED}), d AS (SELECT DISTINCT row_id FROM p),
    w AS (SELECT row_id, b, len(list_filter({STEPS}, lambda x: x <= ('0x' || substr(md5(concat_ws(':', row_id, 'b' || ((b - 1) // 4), '42')),
        1 + 8 * ((b - 1) % 4), 8))::BIGINT / 4294967296.0)) AS w FROM d, range(1, 41) r(b)),
    cells AS (SELECT model, b, y, pred, sum(w) AS n FROM p JOIN w USING (row_id) GROUP BY ALL),
    k AS (SELECT model, b, class, sum(CASE WHEN y = class THEN n ELSE 0 END) AS support, sum(CASE WHEN pred = class THEN n ELSE 0 END) AS predicted,
        sum(CASE WHEN y = class AND pred = class THEN n ELSE 0 END) AS tp FROM cells, (VALUES {CLASS_ROWS}) v(class) GROUP BY ALL),
    f AS (SELECT model, b, sum(support * 2 * tp / (support + predicted)) / sum(support) AS f1 FROM k GROUP BY model, b),
    c0 AS (SELECT model, y, pred, count(*) AS n FROM p GROUP BY ALL),
    k0 AS (SELECT model, class, sum(CASE WHEN y = class THEN n ELSE 0 END) AS support, sum(CASE WHEN pred = class THEN n ELSE 0 END) AS predicted,
        sum(CASE WHEN y = class AND pred = class THEN n ELSE 0 END) AS tp FROM c0, (VALUES {CLASS_ROWS}) v(class) GROUP BY ALL),
    f0 AS (SELECT model, sum(support * 2 * tp / (support + predicted)) / sum(support) AS f1_w FROM k0 GROUP BY model)
    SELECT model, round(any_value(f1_w), 6) AS f1_w, round(quantile_cont(f1, 0.025), 6) AS low, round(quantile_cont(f1, 0.975), 6) AS high, round(stddev_pop(f1), 6) AS std
    FROM f JOIN f0 USING (model) GROUP BY model""")
def bootstrap_ci(spark, sf):
    return rounded(metrics.bootstrap_ci(predictions(spark, sf), "row_id", ["model"], 40, "poisson"))


@query("bootstrap_ci_multinomial")
def bootstrap_ci_multinomial(spark, sf):
    return rounded(metrics.bootstrap_ci(predictions(spark, sf), "row_id", ["model"], 1000))


@query("mcnemar", f"""
    WITH p AS (SELECT row_id, model, y = pred AS ok FROM {PRED}), j AS (SELECT a.ok AS o1, b.ok AS o2 FROM p a JOIN p b USING (row_id) WHERE a.model = 'a' AND b.model = 'b'),
    c AS (SELECT count(*) FILTER (o1 AND NOT o2)::BIGINT AS b, count(*) FILTER (o2 AND NOT o1)::BIGINT AS c FROM j),
    t AS (SELECT b, c, sum(exp(lgamma(b + c + 1) - lgamma(k + 1) - lgamma(b + c - k + 1) - (b + c) * ln(2))) AS s FROM c, range(100000) r(k) WHERE k <= least(b, c) GROUP BY ALL)
    SELECT 'b' AS model, b AS only_best, c AS only_other, round(least(1, 2 * s), 6) AS p_value, least(1, 2 * s) < 0.05 AS significant FROM t""")
def mcnemar(spark, sf):
    return rounded(metrics.mcnemar(predictions(spark, sf), "a", ["b"]))


_CLICK = "(SELECT model, y = 'click' AS pos, p[1] AS s FROM " + PRED + ")"
CURVE = f"""WITH c AS (SELECT model, (i / 20.0)::DOUBLE AS threshold, count(*) FILTER (s >= (i / 20.0)::DOUBLE AND pos)::BIGINT AS tp, count(*) FILTER (s >= (i / 20.0)::DOUBLE AND NOT pos)::BIGINT AS fp,
      count(*) FILTER (s < (i / 20.0)::DOUBLE AND pos)::BIGINT AS fn, count(*) FILTER (s < (i / 20.0)::DOUBLE AND NOT pos)::BIGINT AS tn FROM {_CLICK}, range(1, 20) r(i) GROUP BY model, i)"""


@query("threshold_curve", f"""
    {CURVE} SELECT model, threshold, tp, fp, fn, tn, round(tp / greatest(1, tp + fp), 6) AS precision, round(tp / greatest(1, tp + fn), 6) AS recall,
      (10 * tp + tn - 15 * fp - 25 * fn)::BIGINT AS points FROM c""")
def threshold_curve(spark, sf):
    p = predictions(spark, sf).withColumn("s", F.col("p")[0])
    return rounded(metrics.threshold_curve(p, "s", F.col("y") == "click", ["model"]))


@query("uncertain_share", f"SELECT model, round(avg((s > 0.02 AND s < 0.38)::INT), 6) AS uncertain_share FROM {_CLICK} GROUP BY model")
def uncertain_share(spark, sf):
    p = predictions(spark, sf).withColumn("s", F.col("p")[0])
    return rounded(metrics.uncertain_share(p, "s", ["model"], 0.02, 0.38))


@query("reproduce_check", """
    WITH a AS (SELECT user_id, avg(value) AS m, sum(value) AS s FROM events GROUP BY user_id), b AS (SELECT user_id, round(avg(value), 2) AS m, sum(value) AS s FROM events GROUP BY user_id)
    SELECT 0::BIGINT AS unmatched, 'm' AS "column", round(max(abs(a.m - b.m)), 6) AS max_difference, max(abs(a.m - b.m)) <= 0.001 AS ok FROM a JOIN b USING (user_id)
    UNION ALL SELECT 0, 's', round(max(abs(a.s - b.s)), 6), max(abs(a.s - b.s)) <= 0.001 FROM a JOIN b USING (user_id)""")
def reproduce_check(spark, sf):
    e = table(spark, sf, "events")
    a = e.groupBy("user_id").agg(F.avg("value").alias("m"), F.sum("value").alias("s"))
    return rounded(metrics.reproduce_check(a, a.withColumn("m", F.round("m", 2)), ["user_id"], ["m", "s"], 0.001))


@query("scaling_check", f"""
    WITH f AS (SELECT * FROM {FLOWS}), s AS (SELECT avg(qty) AS mq, stddev_pop(qty) AS sq, avg(price) AS mp, stddev_pop(price) AS sp FROM f WHERE split = 'train')
    SELECT split, round(avg((qty - mq) / sq), 6) + 0.0 AS qty_mean, round(stddev_pop((qty - mq) / sq), 6) AS qty_std, round(avg((price - mp) / sp), 6) + 0.0 AS price_mean,
      round(stddev_pop((price - mp) / sp), 6) AS price_std FROM f, s GROUP BY split""")
def scaling_check(spark, sf):
    f = flows(spark, sf)
    out = rounded(metrics.scaling_check(encode.standardize(f.filter("split = 'train'"), ["qty", "price"]).apply(f), ["qty", "price"]))
    return out.withColumns({"qty_mean": F.col("qty_mean") + 0.0, "price_mean": F.col("price_mean") + 0.0})


@query("exemplars", f"""
    WITH p AS (SELECT row_id, y, pred, list_max(p) AS p FROM {PRED} WHERE model = 'a'),
    r AS (SELECT *, y = pred AS hit, row_number() OVER (PARTITION BY y, y = pred ORDER BY p DESC, row_id)::INT AS place FROM p)
    SELECT * FROM r WHERE place <= CASE WHEN hit THEN 2 ELSE 1 END""")
def exemplars(spark, sf):
    p = predictions(spark, sf).filter("model = 'a'").select("row_id", "y", "pred", F.array_max("p").alias("p"))
    return split.exemplars(p, "row_id")


@query("sample_hard_easy", f"""
    WITH p AS (SELECT row_id, y, p[1] AS s, p[1] > 0.1 AND p[1] < 0.3 AS hard FROM {PRED} WHERE model = 'a'),
    r AS (SELECT *, row_number() OVER (PARTITION BY hard ORDER BY md5(concat_ws(':', row_id, '42'))) AS rn, (SELECT round(avg(hard::INT), 6) FROM p) AS hard_share FROM p)
    SELECT row_id, y, s, hard, hard_share FROM r WHERE rn <= CASE WHEN hard THEN 260 ELSE 440 END""")
def sample_hard_easy(spark, sf):
    p = predictions(spark, sf).filter("model = 'a'").select("row_id", "y", F.col("p")[0].alias("s"))
    return rounded(split.sample_hard_easy(p, "s", ["row_id"], 260, 440, lo=0.1, hi=0.3))


# ---------------------------------------------------------------- cluster scores

def _silhouette_sql(rows: str, distance: str) -> str:
    return f"""s AS ({rows}),
    d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, sum({distance}) AS t, count(*) AS n FROM s a, s b WHERE a.vec_id <> b.vec_id GROUP BY ALL),
    m AS (SELECT vec_id, max(t / n) FILTER (la = lb) AS a, min(t / n) FILTER (la <> lb) AS b FROM d GROUP BY vec_id),
    sil AS (SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette, count(*)::BIGINT AS n FROM m)"""


_SQUARED = "pow(list_distance(a.v, b.v), 2)"


@query("silhouette", f"WITH {_silhouette_sql(f'SELECT * FROM {VECTORS}', _SQUARED)} SELECT round(silhouette, 6) AS silhouette, n FROM sil")
def silhouette(spark, sf):
    return rounded(cluster_metrics.silhouette(vectors(spark, sf), "vec_id", "v", "label"))


_SAMPLED = f"SELECT * FROM {VECTORS} ORDER BY md5(concat_ws(':', vec_id, '42')) LIMIT 5000"


@query("silhouette_sampled", f"WITH {_silhouette_sql(_SAMPLED, 'list_distance(a.v, b.v)')} SELECT round(silhouette, 6) AS silhouette, n FROM sil")
def silhouette_sampled(spark, sf):
    """The sample is the operator's feature: Euclidean silhouettes need the distances between all rows."""
    return rounded(cluster_metrics.silhouette(vectors(spark, sf), "vec_id", "v", "label", sample_size=5000))


CENTROIDS = f"""v AS (SELECT * FROM {VECTORS}), u AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
    c AS (SELECT label, i, avg(x) AS m FROM u GROUP BY label, i), cl AS (SELECT label, list(m ORDER BY i) AS cv FROM c GROUP BY label),
    dev AS (SELECT vec_id, label, list_distance(v.v, cl.cv) AS d FROM v JOIN cl USING (label))"""


@query("davies_bouldin", f"""
    WITH {CENTROIDS}, s AS (SELECT label, avg(d) AS s FROM dev GROUP BY label), w AS (SELECT a.label, max((sa.s + sb.s) / list_distance(a.cv, b.cv)) AS r
      FROM cl a JOIN cl b ON a.label <> b.label JOIN s sa ON sa.label = a.label JOIN s sb ON sb.label = b.label GROUP BY a.label)
    SELECT round(avg(r), 6) AS davies_bouldin, count(*)::BIGINT AS clusters FROM w""")
def davies_bouldin(spark, sf):
    return rounded(cluster_metrics.davies_bouldin(vectors(spark, sf), "v", "label"))


@query("calinski_harabasz", f"""
    WITH {CENTROIDS}, g AS (SELECT i, avg(x) AS m FROM u GROUP BY i), gl AS (SELECT list(m ORDER BY i) AS gv FROM g),
    b AS (SELECT sum(n * pow(list_distance(cv, gv), 2)) AS b, count(*) AS k, sum(n) AS n FROM cl JOIN (SELECT label, count(*) AS n FROM v GROUP BY label) USING (label), gl)
    SELECT round(b * (n - k) / ((SELECT sum(d * d) FROM dev) * (k - 1)), 6) AS calinski_harabasz, k::BIGINT AS clusters FROM b""")
def calinski_harabasz(spark, sf):
    return rounded(cluster_metrics.calinski_harabasz(vectors(spark, sf), "v", "label"))


_CLUSTERED = f"SELECT * FROM {VECTORS} WHERE label <> 0"


@query("cluster_scores", f"""
    WITH {_silhouette_sql(_CLUSTERED, _SQUARED)}, {CENTROIDS.replace(f'SELECT * FROM {VECTORS}', _CLUSTERED)},
    ds AS (SELECT label, avg(d) AS s FROM dev GROUP BY label), w AS (SELECT a.label, max((sa.s + sb.s) / list_distance(a.cv, b.cv)) AS r
      FROM cl a JOIN cl b ON a.label <> b.label JOIN ds sa ON sa.label = a.label JOIN ds sb ON sb.label = b.label GROUP BY a.label),
    g AS (SELECT i, avg(x) AS m FROM u GROUP BY i), gl AS (SELECT list(m ORDER BY i) AS gv FROM g),
    b AS (SELECT sum(n * pow(list_distance(cv, gv), 2)) AS b, count(*) AS k, sum(n) AS n FROM cl JOIN (SELECT label, count(*) AS n FROM v GROUP BY label) USING (label), gl)
    SELECT round(silhouette, 6) AS silhouette, round((SELECT avg(r) FROM w), 6) AS davies_bouldin,
      round(b * (b.n - k) / ((SELECT sum(d * d) FROM dev) * (k - 1)), 6) AS calinski_harabasz, k::BIGINT AS clusters,
      (SELECT count(*) FROM {VECTORS} WHERE label = 0)::BIGINT AS noise_rows FROM b, sil""")
def cluster_scores(spark, sf):
    noisy = vectors(spark, sf).withColumn("label", F.when(F.col("label") == 0, -1).otherwise(F.col("label")))
    return rounded(cluster_metrics.cluster_scores(noisy, "vec_id", "v", "label"))


@query("adjusted_rand", f"""
    WITH c AS (SELECT model, y, pred, count(*)::DOUBLE AS n FROM {PRED} GROUP BY ALL),
    i AS (SELECT model, sum(n * (n - 1) / 2) AS i, sum(n) AS t FROM c GROUP BY model),
    a AS (SELECT model, sum(n * (n - 1) / 2) AS a FROM (SELECT model, sum(n) AS n FROM c GROUP BY model, y) GROUP BY model),
    b AS (SELECT model, sum(n * (n - 1) / 2) AS b FROM (SELECT model, sum(n) AS n FROM c GROUP BY model, pred) GROUP BY model)
    SELECT model, round((i - a * b / (t * (t - 1) / 2)) / ((a + b) / 2 - a * b / (t * (t - 1) / 2)), 6) AS ari FROM i JOIN a USING (model) JOIN b USING (model)""")
def adjusted_rand(spark, sf):
    return rounded(cluster_metrics.adjusted_rand(predictions(spark, sf), "y", "pred", ["model"]))


_PB = f"(SELECT y AS a, pred AS b FROM {PRED} WHERE model = 'a')"


@query("nmi_homogeneity_completeness", f"""
    WITH c AS (SELECT a, b, count(*) AS n, (SELECT count(*) FROM {_PB}) AS t FROM {_PB} GROUP BY ALL),
    h AS (SELECT (SELECT -sum(n / t * ln(n / t)) FROM (SELECT sum(n) AS n, any_value(t) AS t FROM c GROUP BY a)) AS ha,
      (SELECT -sum(n / t * ln(n / t)) FROM (SELECT sum(n) AS n, any_value(t) AS t FROM c GROUP BY b)) AS hb, (SELECT -sum(n / t * ln(n / t)) FROM c) AS hab)
    SELECT round((ha + hb - hab) / ((ha + hb) / 2), 6) AS nmi, round((ha + hb - hab) / ha, 6) AS homogeneity, round((ha + hb - hab) / hb, 6) AS completeness FROM h""")
def nmi_homogeneity_completeness(spark, sf):
    return rounded(cluster_metrics.nmi_homogeneity_completeness(predictions(spark, sf).filter("model = 'a'"), "y", "pred"))


@query("purity", f"""
    SELECT round(sum(m) / sum(t), 6) AS purity FROM (SELECT b, max(n) AS m, sum(n) AS t FROM (SELECT a, b, count(*) AS n FROM {_PB} GROUP BY ALL) GROUP BY b)""")
def purity(spark, sf):
    return rounded(cluster_metrics.purity(predictions(spark, sf).filter("model = 'a'"), "y", "pred"))


@query("cluster_balance", """
    WITH c AS (SELECT CASE WHEN value > 150 THEN -1 ELSE user_id % 9 END AS c, count(*) AS n FROM events GROUP BY 1)
    SELECT count(*) FILTER (c >= 0)::BIGINT AS clusters, round(max(n) FILTER (c >= 0) / sum(n) FILTER (c >= 0), 6) AS largest_share,
      round(1 - sum(n) FILTER (c >= 0) / sum(n), 6) AS noise_share FROM c""")
def cluster_balance(spark, sf):
    e = table(spark, sf, "events").withColumn("c", F.expr("CASE WHEN value > 150 THEN -1 ELSE user_id % 9 END"))
    return rounded(cluster_metrics.cluster_balance(e, "c"))
