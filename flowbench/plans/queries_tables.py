"""Queries for sources, sinks and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowbench.functions.hashing import hash_uniform
from flowbench.operators import audit
from flowbench.plans.registry import query, table
from flowbench.plans.views import FLOWS, MESSY, flows, messy, rounded
from flowbench.session import scratch_path
from flowbench.sources import files, sinks
from flowbench.sources.schemas import numeric_columns


# ---------------------------------------------------------------- sources and sinks

@query("read_flows", """
    SELECT event_type, count(*)::BIGINT AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY event_type""")
def read_flows(spark, sf):
    df = files.read_flows(spark, f"{sf}/events.parquet", fmt="parquet")
    return rounded(df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")))


@query("read_flows_csv", """
    SELECT event_type, count(*)::BIGINT AS n, min(event_id) AS first_id, max(user_id) AS last_user FROM events GROUP BY event_type""")
def read_flows_csv(spark, sf):
    path = scratch_path(spark, "events-csv")
    src = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    src.write.option("header", True).csv(path)
    df = files.read_flows(spark, path, src.schema)
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("user_id").alias("last_user"))


@query("union_parts", """
    SELECT part, l_returnflag, count(*)::BIGINT AS n FROM (
      SELECT 'open' AS part, l_returnflag FROM lineitem WHERE l_linestatus = 'O'
      UNION ALL SELECT 'filled', l_returnflag FROM lineitem WHERE l_linestatus = 'F') GROUP BY part, l_returnflag""")
def union_parts(spark, sf):
    li = table(spark, sf, "lineitem").select("l_linestatus", "l_returnflag", "l_orderkey")
    filled = li.filter("l_linestatus = 'F'").select("l_orderkey", "l_returnflag", "l_linestatus")
    both = files.union_parts([li.filter("l_linestatus = 'O'"), filled], ["open", "filled"])
    return both.groupBy("part", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("discover_files")
def discover_files(spark, sf):
    return files.discover_files(spark, sf, ["lineitem*.parquet", "events*.parquet"]).select("file", "bytes")


@query("verify_shape", """
    SELECT 'region' AS file, 5::BIGINT AS expected_rows, (SELECT count(*) FROM region)::BIGINT AS actual_rows,
           2::BIGINT AS expected_columns, 2::BIGINT AS actual_columns, (SELECT count(*) FROM region) = 5 AS ok
    UNION ALL SELECT 'nation', 24, (SELECT count(*) FROM nation), 3, 3, (SELECT count(*) FROM nation) = 24
    UNION ALL SELECT 'lineitem', NULL, (SELECT count(*) FROM lineitem), 11, 11, TRUE
    UNION ALL SELECT 'events', NULL, (SELECT count(*) FROM events), 7, 6, FALSE""")
def verify_shape(spark, sf):
    expected = {"region": (5, 2), "nation": (24, 3), "lineitem": (None, 11), "events": (None, 7)}
    return files.verify_shape({name: table(spark, sf, name) for name in expected}, expected)


@query("write_splits", f"""
    SELECT split, count(*)::BIGINT AS n, count(DISTINCT machine)::BIGINT AS machines FROM {FLOWS} GROUP BY split""")
def write_splits(spark, sf):
    path = scratch_path(spark, "splits")
    sinks.write_splits(flows(spark, sf), path)
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("machine").alias("machines"))


@query("upsert_results", """
    SELECT user_id AS model, event_id AS run, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def upsert_results(spark, sf):
    runs = table(spark, sf, "events").select(F.col("user_id").alias("model"), F.col("event_id").alias("run"), "event_type", "value")
    return sinks.upsert_results(runs)


@query("write_report", """
    SELECT lang, source, count(*)::BIGINT AS n FROM documents GROUP BY lang, source""")
def write_report(spark, sf):
    path = scratch_path(spark, "report")
    report = table(spark, sf, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    sinks.write_report(report, path, single_file=True)
    return files.read_flows(spark, path, report.schema)


@query("export_json", """
    SELECT CAST(to_json(struct_pack(user_id := user_id, n := n, types := types)) AS VARCHAR) AS document FROM (
      SELECT user_id, sum(n)::BIGINT AS n, list(struct_pack(event_type := event_type, n := n) ORDER BY event_type) AS types
      FROM (SELECT user_id, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL) GROUP BY user_id)""")
def export_json(spark, sf):
    cells = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    nested = cells.groupBy("user_id").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("event_type", "n"))).alias("types"))
    return sinks.to_document(nested)


@query("synthetic_flows", """
    WITH u AS (SELECT event_id,
        ('0x' || substr(md5(concat_ws(':', event_id, 'u0', '42')), 1, 8))::BIGINT / 4294967296.0 AS u0,
        ('0x' || substr(md5(concat_ws(':', event_id, 'v0', '42')), 1, 8))::BIGINT / 4294967296.0 AS v0,
        ('0x' || substr(md5(concat_ws(':', event_id, 'u1', '42')), 1, 8))::BIGINT / 4294967296.0 AS u1,
        ('0x' || substr(md5(concat_ws(':', event_id, 'v1', '42')), 1, 8))::BIGINT / 4294967296.0 AS v1,
        ('0x' || substr(md5(concat_ws(':', event_id, 'y', '42')), 1, 8))::BIGINT / 4294967296.0 AS uy FROM events)
    SELECT event_id, round(sqrt(-2 * ln(1 - u0)) * cos(2 * pi() * v0), 6) AS f0,
           round(sqrt(-2 * ln(1 - u1)) * cos(2 * pi() * v1), 6) AS f1, floor(uy * 3)::INT AS y FROM u""")
def synthetic_flows(spark, sf):
    return rounded(files.synthetic_features(table(spark, sf, "events"), "event_id", 2, classes=3))


# ---------------------------------------------------------------- audit

@query("profile_schema", """
    SELECT n_rows, 6::BIGINT AS total_columns, dtype, n_columns FROM (SELECT count(*)::BIGINT AS n_rows FROM events),
      (VALUES ('bigint', 2::BIGINT), ('double', 1::BIGINT), ('string', 2::BIGINT), ('timestamp_ntz', 1::BIGINT)) t(dtype, n_columns)""")
def profile_schema(spark, sf):
    return audit.profile_schema(table(spark, sf, "events"))


@query("missing_report", f"""
    WITH m AS (SELECT * FROM {MESSY}), n AS (SELECT count(*) AS n FROM m)
    SELECT c AS "column", miss::BIGINT AS n_missing, ph::BIGINT AS n_placeholder, round(miss / n, 6) AS missing_share,
           round(ph / n, 6) AS placeholder_share
    FROM n, (SELECT 'qty' AS c, count(*) FILTER (qty IS NULL) AS miss, 0 AS ph FROM m
      UNION ALL SELECT 'service', count(*) FILTER (service IS NULL), count(*) FILTER (service = '-') FROM m
      UNION ALL SELECT 'flag', count(*) FILTER (flag IS NULL), count(*) FILTER (flag = '-') FROM m)""")
def missing_report(spark, sf):
    return rounded(audit.missing_report(messy(spark, sf), ["qty", "service", "flag"]))


NONFINITE_EXPRS = ["event_id",
                   "CASE WHEN event_id % 97 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN event_id % 89 = 0 THEN CAST('-Infinity' AS DOUBLE) "
                   "WHEN event_id % 83 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS v", "value AS w"]


@query("nonfinite_report", f"""
    WITH e AS (SELECT {', '.join(NONFINITE_EXPRS)} FROM events)
    SELECT 'v' AS "column", count(*) FILTER (isinf(v))::BIGINT AS n_infinite, count(*) FILTER (isnan(v))::BIGINT AS n_nan,
           count(*) FILTER (isfinite(v))::BIGINT AS n_kept FROM e
    UNION ALL SELECT 'w', count(*) FILTER (isinf(w)), count(*) FILTER (isnan(w)), count(*) FILTER (isfinite(w)) FROM e""")
def nonfinite_report(spark, sf):
    e = table(spark, sf, "events").selectExpr(*NONFINITE_EXPRS)
    fixed = audit.nonfinite_to_null(e, ["v", "w"])
    kept = fixed.agg(F.count("v").alias("v"), F.count("w").alias("w")).unpivot([], ["v", "w"], "column", "n_kept")
    return audit.nonfinite_report(e, ["v", "w"]).join(kept, "column")


@query("duplicate_report", """
    SELECT rows_before, rows_after, rows_before - rows_after AS duplicates,
           round(100.0 * (rows_before - rows_after) / rows_before, 6) AS duplicate_pct
    FROM (SELECT sum(n)::BIGINT AS rows_before, count(*)::BIGINT AS rows_after FROM (
      SELECT count(*) AS n FROM lineitem GROUP BY l_quantity, l_discount, l_tax, l_returnflag, l_linestatus))""")
def duplicate_report(spark, sf):
    cols = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return rounded(audit.duplicate_report(table(spark, sf, "lineitem"), cols))


@query("value_counts", """
    SELECT l_suppkey, count(*)::BIGINT AS n, round(count(*) / (SELECT count(*) FROM lineitem), 6) AS share
    FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 15""")
def value_counts(spark, sf):
    return rounded(audit.value_counts(table(spark, sf, "lineitem"), "l_suppkey", 15))


def _describe_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c})::BIGINT AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(skewness({c}), 6) AS skew,
        round(avg(({c} = 0)::INT), 6) AS zero_share, round(quantile_cont({c}, 0.25), 6) AS q25,
        round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75 FROM lineitem"""


@query("describe_numeric", " UNION ALL ".join(map(_describe_sql, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])))
def describe_numeric(spark, sf):
    return rounded(audit.describe_numeric(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query("level_counts", """
    SELECT 'l_returnflag' AS "column", count(DISTINCT l_returnflag)::BIGINT AS levels FROM lineitem
    UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus) FROM lineitem
    UNION ALL SELECT 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem""")
def level_counts(spark, sf):
    return audit.level_counts(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey"])


@query("histogram", """
    WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    c AS (SELECT least(floor((value - lo) / ((hi - lo) / 40)), 39)::INT AS bin, count(*)::BIGINT AS n FROM events, b GROUP BY 1)
    SELECT g.i::INT AS bin, round(lo + g.i * ((hi - lo) / 40), 6) AS left_edge, coalesce(n, 0)::BIGINT AS n
    FROM range(40) g(i) CROSS JOIN b LEFT JOIN c ON c.bin = g.i""")
def histogram(spark, sf):
    return rounded(audit.histogram(table(spark, sf, "events"), "value", 40))


@query("histogram_log", """
    WITH v AS (SELECT ln(1 + greatest(l_extendedprice, 0)) AS x FROM lineitem), b AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
    c AS (SELECT least(floor((x - lo) / ((hi - lo) / 50)), 49)::INT AS bin, count(*)::BIGINT AS n FROM v, b GROUP BY 1)
    SELECT g.i::INT AS bin, round(lo + g.i * ((hi - lo) / 50), 6) AS left_edge, coalesce(n, 0)::BIGINT AS n
    FROM range(50) g(i) CROSS JOIN b LEFT JOIN c ON c.bin = g.i""")
def histogram_log(spark, sf):
    return rounded(audit.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 50, log=True))


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CORR_PAIRS = [(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]


@query("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a, b in CORR_PAIRS))
def correlation_matrix(spark, sf):
    return rounded(audit.correlation_matrix(table(spark, sf, "lineitem"), CORR_COLS))


@query("target_correlation", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr({c}, l_extendedprice * (1 - l_discount)), 6) AS r FROM lineitem" for c in CORR_COLS)
       + ") ORDER BY abs(r) DESC LIMIT 2")
def target_correlation(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("revenue", F.expr("l_extendedprice * (1 - l_discount)"))
    return rounded(audit.target_correlation(li, CORR_COLS, "revenue", 2))


@query("group_quantiles", """
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS median,
                      quantile_cont(value, 0.75) AS q75 FROM events GROUP BY event_type)
    SELECT event_type, round(q25, 6) AS q25, round(median, 6) AS median, round(q75, 6) AS q75,
      min(value) FILTER (value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS whisker_low,
      max(value) FILTER (value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS whisker_high,
      count(*) FILTER (NOT value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25))::BIGINT AS n_outside
    FROM events JOIN q USING (event_type) GROUP BY event_type, q25, median, q75""")
def group_quantiles(spark, sf):
    return rounded(audit.group_quantiles(table(spark, sf, "events"), "event_type", "value"))


@query("leak_probe", """
    WITH t AS (SELECT *, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem), p AS (
      SELECT 'price' AS formula, l_extendedprice AS e, revenue FROM t
      UNION ALL SELECT 'price_less_discount', l_extendedprice * (1 - l_discount), revenue FROM t
      UNION ALL SELECT 'price_with_tax', l_extendedprice * (1 + l_tax), revenue FROM t)
    SELECT formula, round(corr(e, revenue), 6) AS r, round(avg((abs(e - revenue) <= 0.005)::INT), 6) AS equal_share,
           count(*) FILTER (revenue > e + 0.005)::BIGINT AS n_above FROM p GROUP BY formula""")
def leak_probe(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("revenue", F.expr("l_extendedprice * (1 - l_discount)"))
    return rounded(audit.leak_probe(li, "revenue", {
        "price": F.col("l_extendedprice"), "price_less_discount": F.expr("l_extendedprice * (1 - l_discount)"),
        "price_with_tax": F.expr("l_extendedprice * (1 + l_tax)")}, 0.005))


@query("twin_overlap", f"""
    WITH m AS (SELECT * FROM {MESSY}), s AS (SELECT DISTINCT qty, service, flag, l_linenumber FROM m WHERE l_suppkey % 5 <> 0 AND l_linenumber % 2 = 0),
    t AS (SELECT m.*, EXISTS (SELECT 1 FROM s WHERE s.qty IS NOT DISTINCT FROM m.qty AND s.service IS NOT DISTINCT FROM m.service
      AND s.flag IS NOT DISTINCT FROM m.flag AND s.l_linenumber IS NOT DISTINCT FROM m.l_linenumber) AS hit FROM m WHERE l_suppkey % 5 = 0)
    SELECT count(*)::BIGINT AS test_rows, count(*) FILTER (hit)::BIGINT AS twin_rows, round(avg(hit::INT), 6) AS twin_share FROM t""")
def twin_overlap(spark, sf):
    m = messy(spark, sf)
    return rounded(audit.twin_overlap(m.filter("l_suppkey % 5 <> 0 and l_linenumber % 2 = 0"), m.filter("l_suppkey % 5 = 0"),
                                      ["qty", "service", "flag", "l_linenumber"]))


@query("label_conflicts", """
    WITH g AS (SELECT count(*) AS n, count(DISTINCT l_returnflag) AS k FROM lineitem GROUP BY l_quantity, l_discount, l_tax, l_suppkey)
    SELECT count(*)::BIGINT AS groups, count(*) FILTER (k > 1)::BIGINT AS conflict_groups,
           coalesce(sum(n) FILTER (k > 1), 0)::BIGINT AS conflict_rows, sum(n)::BIGINT AS n_rows,
           round(coalesce(sum(n) FILTER (k > 1), 0) / sum(n), 6) AS conflict_share FROM g""")
def label_conflicts(spark, sf):
    return rounded(audit.label_conflicts(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_suppkey"], "l_returnflag"))


@query("label_determinism", """
    WITH c AS (SELECT p_type, p_brand, count(*)::BIGINT AS n FROM part GROUP BY ALL)
    SELECT p_type, p_brand, n, (count(*) OVER (PARTITION BY p_type))::BIGINT AS b_levels,
           count(*) OVER (PARTITION BY p_type) = 1 AS determined FROM c""")
def label_determinism(spark, sf):
    return audit.label_determinism(table(spark, sf, "part"), "p_type", "p_brand")


@query("zero_blocks", """
    SELECT zero_share, string_agg(c, ',' ORDER BY c) AS columns, count(*)::BIGINT AS n_columns FROM (
      SELECT 'l_discount' AS c, round(avg((l_discount = 0)::INT), 3) AS zero_share FROM lineitem
      UNION ALL SELECT 'l_tax', round(avg((l_tax = 0)::INT), 3) FROM lineitem
      UNION ALL SELECT 'l_quantity', round(avg((l_quantity = 0)::INT), 3) FROM lineitem
      UNION ALL SELECT 'l_extendedprice', round(avg((l_extendedprice = 0)::INT), 3) FROM lineitem) GROUP BY zero_share""")
def zero_blocks(spark, sf):
    return audit.zero_blocks(table(spark, sf, "lineitem"), ["l_discount", "l_tax", "l_quantity", "l_extendedprice"])


@query("variance_concentration", """
    WITH m AS (SELECT avg(value) AS a, var_pop(value) * count(*) AS t FROM events),
    r AS (SELECT pow(value - a, 2) AS d, row_number() OVER (ORDER BY pow(value - a, 2) DESC, event_id) AS rn FROM events, m)
    SELECT n::BIGINT AS top_n, round(sum(d) FILTER (rn <= n) / any_value(t), 6) AS share
    FROM r, m, (VALUES (10), (100), (500)) v(n) GROUP BY n""")
def variance_concentration(spark, sf):
    return rounded(audit.variance_concentration(table(spark, sf, "events"), "value", "event_id", [10, 100, 500]))


@query("prior_shift", """
    WITH g AS (SELECT l_returnflag, l_quantity, l_discount, l_tax, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT l_returnflag, sum(n)::BIGINT AS n_before, count(*)::BIGINT AS n_after, round(100 * (count(*) / sum(n) - 1), 6) AS change_pct
    FROM g GROUP BY l_returnflag""")
def prior_shift(spark, sf):
    return rounded(audit.prior_shift(table(spark, sf, "lineitem"), "l_returnflag", ["l_quantity", "l_discount", "l_tax"]))


@query("support_table", f"""
    SELECT y, count(*) FILTER (split = 'train')::BIGINT AS train_rows, count(DISTINCT CASE WHEN split = 'train' THEN machine END)::BIGINT AS train_groups,
           count(*) FILTER (split = 'test')::BIGINT AS test_rows, count(DISTINCT CASE WHEN split = 'test' THEN machine END)::BIGINT AS test_groups
    FROM {FLOWS} GROUP BY y""")
def support_table(spark, sf):
    return audit.support_table(flows(spark, sf), "y", "split", "machine")


@query("imbalance", """
    WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
    SELECT round(max(n) / min(n), 6) AS max_min_ratio, round(sum(n) FILTER (lang <> 'en') / sum(n), 6) AS attack_share,
           round(max(n) / sum(n), 6) AS majority_accuracy, count(*)::BIGINT AS classes FROM c""")
def imbalance(spark, sf):
    return rounded(audit.imbalance(table(spark, sf, "documents"), "lang", "en"))


@query("redundant_columns", """
    SELECT 'quality' AS a, 'toxic' AS b, round(avg((quality IS NOT DISTINCT FROM toxic)::INT), 6) AS equal_share FROM labels
    UNION ALL SELECT 'quality', 'good', round(avg((quality IS NOT DISTINCT FROM (CASE WHEN quality > 0 THEN 1 ELSE 0 END))::INT), 6) FROM labels
    UNION ALL SELECT 'toxic', 'good', round(avg((toxic IS NOT DISTINCT FROM (CASE WHEN quality > 0 THEN 1 ELSE 0 END))::INT), 6) FROM labels""")
def redundant_columns(spark, sf):
    lab = table(spark, sf, "labels").withColumn("good", F.expr("CASE WHEN quality > 0 THEN 1 ELSE 0 END"))
    return rounded(audit.redundant_columns(lab, ["quality", "toxic", "good"]))


@query("equal_columns", """
    SELECT 'also' AS "column", 'l_quantity' AS same_as WHERE (SELECT count(*) FROM lineitem) > 0 UNION ALL SELECT 'line', 'l_linenumber' WHERE (SELECT count(*) FROM lineitem) > 0""")
def equal_columns(spark, sf):
    li = table(spark, sf, "lineitem").withColumns({"also": F.col("l_quantity"), "line": F.col("l_linenumber"), "near": F.when(F.col("l_quantity") == 7, 8.0).otherwise(F.col("l_quantity"))})
    return audit.equal_columns(li, ["l_quantity", "l_linenumber", "l_tax", "also", "near", "line"])
