"""Queries for cleaning, encoding, feature packs, samples, splits and folds."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from flowbench.operators import clean, encode, features, split
from flowbench.plans.registry import query, table
from flowbench.plans.views import FLOW_A, FLOW_B, FLOWS, MESSY, flow_a, flow_b, flows, messy, rounded

# ---------------------------------------------------------------- cleaning


@query("drop_present", f"SELECT qty, price, service, flag, l_linenumber FROM {MESSY}")
def drop_present(spark, sf):
    return clean.drop_present(messy(spark, sf), ["l_orderkey", "l_suppkey", "not_there"])


@query("recode_placeholder", f"""
    SELECT CASE WHEN service = '-' THEN 'no_service' ELSE service END AS service, flag, count(*)::BIGINT AS n FROM {MESSY} GROUP BY ALL""")
def recode_placeholder(spark, sf):
    return clean.recode_placeholder(messy(spark, sf), "no_service", ["service"]).groupBy("service", "flag").agg(F.count(F.lit(1)).alias("n"))


@query("normalize_label", f"""
    SELECT CASE WHEN trim(attack_cat) IN ('', 'nan') THEN 'Normal' ELSE trim(attack_cat) END AS attack_cat, label, count(*)::BIGINT AS n
    FROM {FLOW_A} GROUP BY ALL""")
def normalize_label(spark, sf):
    return clean.normalize_label(flow_a(spark, sf), "attack_cat").groupBy("attack_cat", "label").agg(F.count(F.lit(1)).alias("n"))


@query("missing_policy", f"""
    WITH m AS (SELECT * FROM {MESSY})
    SELECT l_orderkey, coalesce(qty, (SELECT quantile_cont(qty, 0.5) FROM m)) AS qty, price,
           coalesce(flag, (SELECT mode(flag ORDER BY flag) FROM m)) AS flag FROM m""")
def missing_policy(spark, sf):
    df = messy(spark, sf).select("l_orderkey", "qty", "price", "flag")
    return clean.missing_policy(df)[0]


@query("missing_policy_drop", """
    SELECT event_id, value FROM events WHERE event_id % 200 <> 0""")
def missing_policy_drop(spark, sf):
    e = table(spark, sf, "events").selectExpr("event_id", "CASE WHEN event_id % 200 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value")
    return clean.missing_policy(e)[0]


@query("fit_imputer", f"""
    WITH m AS (SELECT * FROM {MESSY}), t AS (SELECT * FROM m WHERE l_suppkey % 5 <> 0)
    SELECT l_orderkey, l_suppkey, coalesce(qty, (SELECT quantile_cont(qty, 0.5) FROM t)) AS qty,
           coalesce(flag, (SELECT mode(flag ORDER BY flag) FROM t)) AS flag FROM m WHERE l_suppkey % 5 = 0""")
def fit_imputer(spark, sf):
    m = messy(spark, sf)
    model = clean.fit_imputer(m.filter("l_suppkey % 5 <> 0"), ["qty"], ["flag"])
    return model.apply(m.filter("l_suppkey % 5 = 0")).select("l_orderkey", "l_suppkey", "qty", "flag")


@query("dedup", """
    SELECT l_quantity, l_discount, l_tax, l_returnflag, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY ALL""")
def dedup(spark, sf):
    return clean.dedup(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"), ["l_orderkey"])


@query("dedup_all_columns", "SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem")
def dedup_all(spark, sf):
    return clean.dedup(table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag"))


def _clip_sql(lo: str, hi: str) -> str:
    return f"""
    WITH f AS (SELECT * FROM {FLOWS}), b AS (SELECT {lo.format(c='price')} AS plo, {hi.format(c='price')} AS phi,
      {lo.format(c='qty')} AS qlo, {hi.format(c='qty')} AS qhi FROM f WHERE split = 'train')
    SELECT row_id, split, round(greatest(least(price, phi), plo), 6) AS price, round(greatest(least(qty, qhi), qlo), 6) AS qty FROM f, b"""


@query("clip_quantile", _clip_sql("quantile_cont({c}, 0.01)", "quantile_cont({c}, 0.99)"))
def clip_quantile(spark, sf):
    f = flows(spark, sf)
    return rounded(clean.clip_quantile(f.filter("split = 'train'"), ["price", "qty"]).apply(f).select("row_id", "split", "price", "qty"))


@query("clip_quantile_report", f"""
    WITH f AS (SELECT * FROM {FLOWS}), b AS (SELECT quantile_cont(price, 0.01) AS lo, quantile_cont(price, 0.99) AS hi FROM f WHERE split = 'train')
    SELECT 'price' AS "column", round(any_value(lo), 6) AS lower, round(any_value(hi), 6) AS upper, count(*) FILTER (price < lo OR price > hi)::BIGINT AS n_clipped FROM f, b""")
def clip_quantile_report(spark, sf):
    f = flows(spark, sf)
    return rounded(clean.clip_quantile(f.filter("split = 'train'"), ["price"]).count_clipped(f))


@query("clip_iqr", """
    WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events WHERE user_id % 5 <> 0)
    SELECT event_id, round(greatest(least(value, q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)), 6) AS value FROM events, b""")
def clip_iqr(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "value")
    return rounded(clean.clip_iqr(e.filter("user_id % 5 <> 0"), ["value"]).apply(e).drop("user_id"))


@query("clip_upper", """
    WITH b AS (SELECT quantile_cont(value, 0.999) AS hi FROM events) SELECT event_id, round(least(value, hi), 6) AS value FROM events, b""")
def clip_upper(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    return rounded(clean.clip_upper(e, ["value"]).apply(e))


@query("log_scale", """
    SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0)), 6) AS c_acctbal FROM customer""")
def log_scale(spark, sf):
    return rounded(clean.log_scale(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"]))


# ---------------------------------------------------------------- encoding

@query("fold_rare", f"""
    WITH a AS (SELECT * FROM {FLOW_A}), k AS (SELECT proto FROM a WHERE id % 5 <> 0 GROUP BY proto HAVING count(*) >= 180)
    SELECT CASE WHEN proto IN (SELECT proto FROM k) THEN proto ELSE 'other' END AS proto, count(*)::BIGINT AS n FROM a GROUP BY 1""")
def fold_rare(spark, sf):
    a = flow_a(spark, sf)
    model = encode.fold_rare(a.filter("id % 5 <> 0"), "proto", 180)
    return model.apply(a).groupBy("proto").agg(F.count(F.lit(1)).alias("n"))


@query("fold_rare_share", """
    WITH k AS (SELECT source FROM documents GROUP BY source HAVING count(*) >= 0.05 * (SELECT count(*) FROM documents))
    SELECT doc_id, CASE WHEN source IN (SELECT source FROM k) THEN source ELSE 'other' END AS source FROM documents""")
def fold_rare_share(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    return encode.fold_rare(d, "source", min_share=0.05).apply(d)


@query("bucket_top_values", """
    WITH k AS (SELECT l_suppkey FROM lineitem GROUP BY l_suppkey ORDER BY count(*) DESC, l_suppkey LIMIT 10)
    SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey IN (SELECT l_suppkey FROM k) THEN l_suppkey ELSE -1 END AS l_suppkey FROM lineitem""")
def bucket_top_values(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return encode.bucket_top_values(li, "l_suppkey", 10).apply(li)


@query("bucket_top_values_legacy", """
    WITH k AS (SELECT count(*) AS c FROM lineitem GROUP BY l_suppkey ORDER BY count(*) DESC, l_suppkey LIMIT 10)
    SELECT CASE WHEN l_orderkey IN (SELECT c FROM k) THEN l_orderkey ELSE -1 END AS l_orderkey, count(*)::BIGINT AS n FROM lineitem GROUP BY 1""")
def bucket_top_values_legacy(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    counted = encode.bucket_top_values(li, "l_suppkey", 10, legacy_counts=True)
    counted.col = "l_orderkey"
    return counted.apply(li).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("one_hot", """
    SELECT l_orderkey, l_linenumber, (l_returnflag = 'N')::INT::DOUBLE AS l_returnflag_N, (l_returnflag = 'R')::INT::DOUBLE AS l_returnflag_R,
           (l_linestatus = 'O')::INT::DOUBLE AS l_linestatus_O FROM lineitem""")
def one_hot(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return encode.fit_one_hot(li, ["l_returnflag", "l_linestatus"], "drop_first").apply(li)


@query("one_hot_infrequent", """
    SELECT doc_id, (lang = 'de')::INT::DOUBLE AS lang_de, (lang = 'en')::INT::DOUBLE AS lang_en,
           (lang IN (SELECT lang FROM documents GROUP BY lang HAVING count(*) < (SELECT count(*) FROM documents) / 8.0))::INT::DOUBLE AS lang_infrequent
    FROM documents""")
def one_hot_infrequent(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    model = encode.fit_one_hot(d, ["lang"], "infrequent", min_frequency=d.count() / 8)
    out = model.apply(d)
    return out.select("doc_id", *[c if c in out.columns else F.lit(0.0).alias(c) for c in ("lang_de", "lang_en", "lang_infrequent")])


@query("one_hot_dummies", """
    SELECT o_orderkey, (o_orderstatus = 'F')::INT::DOUBLE AS o_orderstatus_F, (o_orderstatus = 'O')::INT::DOUBLE AS o_orderstatus_O FROM orders""")
def one_hot_dummies(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return encode.fit_one_hot(o.filter("o_orderstatus <> 'P'"), ["o_orderstatus"]).apply(o)


@query("one_hot_vector", """
    WITH t AS (SELECT 'l_partkey' AS "column", CAST(l_partkey AS VARCHAR) AS level, l_suppkey % 5 = 0 AS test FROM lineitem UNION ALL SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR), l_suppkey % 5 = 0 FROM lineitem),
    k AS (SELECT "column", level, row_number() OVER (ORDER BY "column", level) - 1 AS place FROM (SELECT DISTINCT "column", level FROM t WHERE NOT test))
    SELECT CAST(place AS INTEGER) AS place, k."column", k.level, CAST(count(*) AS DOUBLE) AS ones FROM k JOIN t ON t."column" = k."column" AND t.level = k.level GROUP BY ALL""")
def one_hot_vector(spark, sf):
    """Every level a slot of a sparse vector; the vectors add up to the counts of the levels that train has seen."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    model = encode.fit_one_hot_vector(li.filter("l_suppkey % 5 <> 0"), ["l_partkey", "l_suppkey"])
    sums = model.apply(li).agg(vector_to_array(Summarizer.sum(F.col("onehot"))).alias("s")).select(F.posexplode("s").alias("place", "ones"))
    names = model.table.withColumn("place", (F.col("slot") + F.when(F.col("column") == "l_suppkey", model.widths["l_partkey"]).otherwise(0)).cast("int"))
    return sums.join(names, "place").select("place", "column", "level", "ones")


@query("index_labels", """
    WITH l AS (SELECT event_type, dense_rank() OVER (ORDER BY event_type) - 1 AS i FROM (SELECT DISTINCT event_type FROM events WHERE event_type <> 'view'))
    SELECT event_id, coalesce(i, -1)::INT AS idx, l.event_type AS back FROM events LEFT JOIN l USING (event_type)""")
def index_labels(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type")
    model = encode.index_labels(e.filter("event_type <> 'view'"), "event_type")
    return model.invert(model.apply(e, "idx"), "idx", "back").select("event_id", "idx", "back")


@query("standardize", f"""
    WITH f AS (SELECT * FROM {FLOWS}), s AS (SELECT avg(qty) AS mq, stddev_pop(qty) AS sq, avg(price) AS mp, stddev_pop(price) AS sp FROM f WHERE split = 'train')
    SELECT row_id, round((qty - mq) / sq, 6) AS qty, round((price - mp) / sp, 6) AS price FROM f, s""")
def standardize(spark, sf):
    f = flows(spark, sf)
    return rounded(encode.standardize(f.filter("split = 'train'"), ["qty", "price"]).apply(f).select("row_id", "qty", "price"))


@query("select_continuous", """
    SELECT c AS "column" FROM (SELECT 'quality' AS c, count(DISTINCT quality) AS n FROM labels UNION ALL SELECT 'toxic', count(DISTINCT toxic) FROM labels
      UNION ALL SELECT 'doc_id', count(DISTINCT doc_id) FROM labels) WHERE n > 2""")
def select_continuous(spark, sf):
    names = encode.select_continuous(table(spark, sf, "labels"))
    return spark.createDataFrame([(c,) for c in names], "column string")


@query("assemble")
def assemble(spark, sf):
    f = flows(spark, sf)
    hot = encode.fit_one_hot(f, ["state"])
    plan = encode.FeaturePlan(["qty", "price", "disc", "tax", *hot.names()])
    return plan.assemble(hot.apply(f)).select("row_id", vector_to_array("features").alias("features"))


@query("polynomial", """
    SELECT row_id, [round(qty, 6), round(qty * qty, 6), round(disc, 6), round(qty * disc, 6), round(disc * disc, 6)] AS poly FROM """ + FLOWS)
def polynomial(spark, sf):
    df = encode.FeaturePlan(["qty", "disc"]).assemble(flows(spark, sf))
    return rounded(encode.polynomial(df).select("row_id", vector_to_array("poly").alias("poly")))


@query("quantile_bins", """
    WITH q AS (SELECT list_distinct(quantile_cont(o_totalprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM orders)
    SELECT o_orderkey, len(list_filter(e, lambda x: x < o_totalprice))::INT AS bin FROM orders, q""")
def quantile_bins(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return encode.quantile_bins(o, "o_totalprice", 10).apply(o).drop("o_totalprice")


@query("balanced_weights", """
    WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
    SELECT doc_id, round((SELECT sum(n) / count(*) FROM c) / n, 6) AS weight FROM documents JOIN c USING (lang)""")
def balanced_weights(spark, sf):
    return rounded(encode.balanced_weights(table(spark, sf, "documents").select("doc_id", "lang"), "lang").drop("lang"))


# ---------------------------------------------------------------- feature packs

@query("feature_pack_ratios", f"""
    SELECT row_id, round(dloss / (dpkts + 1e-6), 4) AS dst_loss_ratio, sttl - dttl AS ttl_diff, round(sjit / (djit + 1e-6), 4) AS jitter_ratio,
      round(sinpkt / (dinpkt + 1e-6), 4) AS iat_ratio, (dpkts = 0)::INT AS no_dst_response, round(ct_srv_src / (ct_dst_ltm + 1e-6), 4) AS conn_fanout,
      round(spkts / (dpkts + 1e-6), 4) AS pkt_dir_ratio, round(abs(sbytes - dbytes) / (sbytes + dbytes + 1e-6), 6) AS byte_dir_asymmetry FROM {FLOW_A}""")
def feature_pack_ratios(spark, sf):
    f = features.feature_pack_ratios(flow_a(spark, sf))
    return f.select("row_id", "ttl_diff", "no_dst_response", F.round("byte_dir_asymmetry", 6).alias("byte_dir_asymmetry"),
                    *[F.round(c, 4).alias(c) for c in ("dst_loss_ratio", "jitter_ratio", "iat_ratio", "conn_fanout", "pkt_dir_ratio")])


@query("feature_pack_intensity", f"""
    SELECT row_id, round(sbytes / (dbytes + 1), 6) AS byte_ratio, round((spkts + dpkts) / (dur + 1e-3), 4) AS total_pkts_rate, sttl - dttl AS ttl_diff FROM {FLOW_A}""")
def feature_pack_intensity(spark, sf):
    f = features.feature_pack_intensity(flow_a(spark, sf))
    return f.select("row_id", F.round("byte_ratio", 6).alias("byte_ratio"), F.round("total_pkts_rate", 4).alias("total_pkts_rate"), "ttl_diff")


@query("feature_pack_activity", f"""
    SELECT row_id, round(ln(1 + greatest(dur, 0)), 6) AS log_dur, ct_srv_src + ct_src_ltm + ct_src_dport_ltm AS src_activity_score,
           (proto = 'tcp')::INT AS is_tcp FROM {FLOW_A}""")
def feature_pack_activity(spark, sf):
    return rounded(features.feature_pack_activity(flow_a(spark, sf)).select("row_id", "log_dur", "src_activity_score", "is_tcp"))


@query("feature_pack_flow_cls", f"""
    WITH b AS (SELECT * FROM {FLOW_B}), cap AS (SELECT quantile_cont(duration, 0.999) AS hi FROM b),
    dp AS (SELECT dst_port FROM b GROUP BY dst_port ORDER BY count(*) DESC, dst_port LIMIT 10),
    sp AS (SELECT src_port FROM b GROUP BY src_port ORDER BY count(*) DESC, src_port LIMIT 50)
    SELECT row_id, (dns_AA <> '-' OR dns_RD <> '-' OR dns_RA <> '-' OR dns_rejected <> '-')::INT AS dns_present, (service = 'dns')::INT AS dns_query_parsed,
      (missed_bytes > 0)::INT AS has_missed, (starts_with(dst_ip, '192.168.1.'))::INT AS dst_internal, round(ln(1 + least(duration, hi)), 6) AS duration,
      round(ln(1 + src_bytes), 6) AS src_bytes, round(ln(1 + dst_pkts), 6) AS dst_pkts,
      CASE WHEN dst_port IN (SELECT dst_port FROM dp) THEN dst_port ELSE -1 END AS dst_port,
      CASE WHEN src_port IN (SELECT src_port FROM sp) THEN src_port ELSE -1 END AS src_port FROM b, cap""")
def feature_pack_flow_cls(spark, sf):
    b = flow_b(spark, sf)
    out = features.feature_pack_flow_cls(b, clean.clip_upper(b, ["duration"]), encode.bucket_top_values(b, "dst_port", 10),
                                         encode.bucket_top_values(b, "src_port", 50))
    return rounded(out.select("row_id", "dns_present", "dns_query_parsed", "has_missed", "dst_internal", "duration", "src_bytes", "dst_pkts",
                              "dst_port", "src_port"))


@query("feature_pack_flow_clu", f"""
    WITH b AS (SELECT * FROM {FLOW_B}), dp AS (SELECT dst_port FROM b GROUP BY dst_port ORDER BY count(*) DESC, dst_port LIMIT 10)
    SELECT row_id, round(ln(1 + missed_bytes), 6) AS missed_bytes, round(coalesce(ln(1 + src_bytes / nullif(src_pkts, 0)), 0), 6) AS bytes_per_src_pkt,
      round(coalesce(ln(1 + dst_bytes / nullif(dst_pkts, 0)), 0), 6) AS bytes_per_dst_pkt, (dst_pkts > 0)::INT AS has_reply,
      CASE WHEN dst_port IN (SELECT dst_port FROM dp) THEN dst_port::VARCHAR ELSE 'other' END AS dst_port_bucket, dns_qclass::VARCHAR AS dns_qclass FROM b""")
def feature_pack_flow_clu(spark, sf):
    b = flow_b(spark, sf)
    ports = encode.bucket_top_values(b, "dst_port", 10, other=None)
    out = features.feature_pack_flow_clu(b, encode.LevelModel("dst_port", ports.levels, None))
    return rounded(out.select("row_id", "missed_bytes", "bytes_per_src_pkt", "bytes_per_dst_pkt", "has_reply", "dst_port_bucket", "dns_qclass"))


@query("drop_leaky", f"""
    SELECT row_id, round(dloss / (dpkts + 1e-6), 4) AS dst_loss_ratio, dpkts, sttl - dttl AS ttl_diff FROM {FLOW_A}""")
def drop_leaky(spark, sf):
    wide = features.feature_pack_ratios(flow_a(spark, sf)).select("row_id", "dst_loss_ratio", "dpkts", "ttl_diff", *features.LEAKY,
                                                                   "pkt_dir_ratio", "byte_dir_asymmetry")
    leaks = {"sloss": features.LEAKY, "spkts": ["pkt_dir_ratio"], "sbytes": ["byte_dir_asymmetry"]}
    return clean.drop_leaky(wide, leaks, "sloss").withColumn("dst_loss_ratio", F.round("dst_loss_ratio", 4))


@query("target_log", "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS y_log FROM orders")
def target_log(spark, sf):
    return rounded(clean.target_log(table(spark, sf, "orders"), "o_totalprice", "y_log").select("o_orderkey", "y_log"))


@query("target_unlog", """
    WITH m AS (SELECT max(o_totalprice) AS cap FROM orders WHERE o_custkey % 5 <> 0)
    SELECT o_orderkey, round(least(greatest(exp(ln(1 + o_totalprice) * 1.01 - 0.2) - 1, 0), cap), 4) AS pred FROM orders, m""")
def target_unlog(spark, sf):
    o = table(spark, sf, "orders")
    cap = o.filter("o_custkey % 5 <> 0").agg(F.max("o_totalprice")).first()[0]
    logged = clean.target_log(o, "o_totalprice", "y_log").withColumn("p", F.expr("y_log * 1.01 - 0.2"))
    return clean.target_unlog(logged, "p", "pred", cap).select("o_orderkey", F.round("pred", 4).alias("pred"))


@query("complete_rows", f"""
    WITH p AS (SELECT row_id, CASE WHEN src_port % 3 = 0 THEN NULL ELSE proto END AS proto, service, CASE WHEN src_port % 4 = 0 THEN NULL ELSE src_pkts - 10 END AS src_pkts,
      src_bytes, CASE WHEN src_port % 2 = 0 THEN dns_qclass END AS dns_qclass FROM {FLOW_B})
    SELECT row_id, coalesce(proto, 'tcp') AS proto, service, greatest(coalesce(src_pkts, 1), 0) AS src_pkts, src_bytes,
      coalesce(CASE WHEN service = 'dns' AND dns_qclass IS NULL THEN 1 ELSE dns_qclass END, 0) AS dns_qclass, 'SF' AS conn_state,
      src_bytes + 40 * greatest(coalesce(src_pkts, 1), 0) AS src_ip_bytes FROM p""")
def complete_rows(spark, sf):
    p = flow_b(spark, sf).selectExpr("row_id", "CASE WHEN src_port % 3 = 0 THEN NULL ELSE proto END AS proto", "service",
                                     "CASE WHEN src_port % 4 = 0 THEN NULL ELSE src_pkts - 10 END AS src_pkts", "src_bytes",
                                     "CASE WHEN src_port % 2 = 0 THEN dns_qclass END AS dns_qclass")
    return clean.complete_rows(
        p, {"proto": "tcp", "src_pkts": 1, "dns_qclass": 0, "conn_state": "SF"},
        derived={"src_ip_bytes": F.col("src_bytes") + 40 * F.col("src_pkts")},
        conditional=[(F.col("service") == "dns", {"dns_qclass": 1})], non_negative=["src_pkts"])


@query("filter_rows", """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND NOT contains(l_returnflag, 'N') AND l_linestatus <> 'F'""")
def filter_rows(spark, sf):
    li = table(spark, sf, "lineitem")
    return clean.filter_rows(li, F.col("l_quantity").between(10, 20), ~F.col("l_returnflag").contains("N"), "l_linestatus <> 'F'"
                             ).select("l_orderkey", "l_linenumber", "l_quantity")


# ---------------------------------------------------------------- samples, splits, folds

def _h(key: str, seed: int = 42) -> str:
    return f"md5(concat_ws(':', {key}, '{seed}'))"


@query("split_stratified", f"""
    WITH r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {_h('event_id')}) AS rn,
      count(*) OVER (PARTITION BY event_type) AS n FROM events)
    SELECT event_id, event_type, CASE WHEN rn <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r""")
def split_stratified(spark, sf):
    return split.split_stratified(table(spark, sf, "events").select("event_id", "event_type"), "event_type", ["event_id"])


@query("sample_stratified", f"""
    WITH c AS (SELECT lang, count(*) AS n, (SELECT count(*) FROM documents) AS t FROM documents GROUP BY lang),
    e AS (SELECT lang, 137.0::DOUBLE * n / t AS e FROM c), f AS (SELECT lang, floor(e) AS f, e - floor(e) AS r FROM e),
    q AS (SELECT lang, f + (row_number() OVER (ORDER BY round(r, 9) DESC, lang) <= 137 - (SELECT sum(f) FROM f))::INT AS quota FROM f),
    s AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_h('doc_id')}) AS rn FROM documents)
    SELECT doc_id, lang FROM s JOIN q USING (lang) WHERE rn <= quota""")
def sample_stratified(spark, sf):
    return split.sample_stratified(table(spark, sf, "documents").select("doc_id", "lang"), "lang", ["doc_id"], 137)


@query("sample_n", f"SELECT event_id, value FROM events ORDER BY {_h('event_id', 7)} LIMIT 777")
def sample_n(spark, sf):
    return split.sample_n(table(spark, sf, "events").select("event_id", "value"), ["event_id"], 777, seed=7)


@query("shuffle_rows", f"SELECT event_id, user_id, {_h('event_id')} AS place FROM events")
def shuffle_rows(spark, sf):
    return split.shuffle_rows(table(spark, sf, "events").select("event_id", "user_id"), ["event_id"]).withColumn(
        "place", split.row_hash(["event_id"], 42))


@query("split_by_group", """
    SELECT user_id, event_id, CASE WHEN user_id IN (3, 17, 42, 99, 120) THEN 'test' ELSE 'train' END AS split FROM events""")
def split_by_group(spark, sf):
    return split.split_by_group(table(spark, sf, "events").select("user_id", "event_id"), "user_id", [3, 17, 42, 99, 120])


@query("subsample_quota", f"""
    WITH s AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_h('doc_id')}) AS rn, count(*) OVER (PARTITION BY lang) AS n,
      count(*) OVER () AS t FROM documents)
    SELECT doc_id, lang FROM s WHERE rn <= greatest(1, round(n * 120.0::DOUBLE / t))""")
def subsample_quota(spark, sf):
    return split.subsample_quota(table(spark, sf, "documents").select("doc_id", "lang"), "lang", ["doc_id"], 120)


@query("split_binned", f"""
    WITH q AS (SELECT list_distinct(quantile_cont(o_totalprice, [0.2, 0.4, 0.6, 0.8])) AS e FROM orders),
    b AS (SELECT o_orderkey, len(list_filter(e, lambda x: x < o_totalprice))::INT AS bin FROM orders, q),
    r AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY {_h('o_orderkey')}) AS rn, count(*) OVER (PARTITION BY bin) AS n FROM b)
    SELECT o_orderkey, bin, CASE WHEN rn <= round(n * 0.25) THEN 'test' ELSE 'train' END AS split FROM r""")
def split_binned(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return split.split_binned(o, "o_totalprice", ["o_orderkey"], 5, 0.25).drop("o_totalprice")


@query("kfold", "SELECT event_id, (ntile(7) OVER (ORDER BY event_id) - 1)::INT AS fold FROM events")
def kfold(spark, sf):
    return split.kfold(table(spark, sf, "events").select("event_id"), "event_id", 7)


@query("kfold_stratified", f"""
    WITH r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {_h('event_id')}) AS rn,
      count(*) OVER (PARTITION BY event_type) AS n FROM events)
    SELECT event_id, event_type, ((rn > ceil(n / 5))::INT + (rn > ceil(n * 2 / 5))::INT + (rn > ceil(n * 3 / 5))::INT + (rn > ceil(n * 4 / 5))::INT) AS fold FROM r""")
def kfold_stratified(spark, sf):
    return split.kfold_stratified(table(spark, sf, "events").select("event_id", "event_type"), "event_type", ["event_id"])


def _grouped_folds(k: int, seed: int) -> str:
    return f"""cells AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
      g AS (SELECT user_id, sum(n) AS size, arg_max(event_type, (n, event_type)) AS class FROM cells GROUP BY user_id),
      p AS (SELECT user_id, (row_number() OVER (PARTITION BY class ORDER BY size DESC, {_h('user_id', seed)}, user_id) - 1) % {2 * k} AS i FROM g),
      folded AS (SELECT event_id, event_type, user_id, CAST(CASE WHEN i < {k} THEN i ELSE {2 * k - 1} - i END AS INT) AS fold FROM events JOIN p USING (user_id))"""


@query("kfold_grouped", f"WITH {_grouped_folds(5, 42)} SELECT * FROM folded")
def kfold_grouped(spark, sf):
    return split.kfold_grouped(table(spark, sf, "events").select("event_id", "event_type", "user_id"), "event_type", "user_id")


@query("carve_validation", f"WITH {_grouped_folds(4, 7)} SELECT event_id, event_type, user_id, CASE WHEN fold = 0 THEN 'valid' ELSE 'fit' END AS part FROM folded")
def carve_validation(spark, sf):
    return split.carve_validation(table(spark, sf, "events").select("event_id", "event_type", "user_id"), "event_type", "user_id")


@query("check_split", """
    WITH e AS (SELECT *, CASE WHEN event_id % 1000 = 1 OR user_id % 4 = 0 THEN 'test' ELSE 'train' END AS split FROM events)
    SELECT 'shared group' AS violation, user_id::VARCHAR AS value FROM e WHERE split = 'train' AND user_id IN (SELECT user_id FROM e WHERE split = 'test')
    GROUP BY user_id UNION ALL SELECT 'class on one side', event_type FROM e GROUP BY event_type HAVING count(DISTINCT split) = 1""")
def check_split(spark, sf):
    e = table(spark, sf, "events").withColumn("split", F.expr("CASE WHEN event_id % 1000 = 1 OR user_id % 4 = 0 THEN 'test' ELSE 'train' END"))
    return split.check_split(e, "event_type", "user_id")


# The Poisson(1) distribution steps, as in the hash functions.
POISSON_STEPS = ("[0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, "
                 "0.9994058151824183, 0.9999167588507119, 0.9999897508033253, 0.999998874797402]")


@query("bootstrap", f"""
    WITH w AS (SELECT b::INT AS replicate, value, len(list_filter({POISSON_STEPS}, lambda x:
        x <= ('0x' || substr(md5(concat_ws(':', event_id, 'b' || ((b - 1) // 4), '42')), 1 + 8 * ((b - 1) % 4), 8))::BIGINT / 4294967296.0)) AS w FROM events, range(1, 21) r(b))
    SELECT replicate, sum(w)::BIGINT AS n, round(sum(w * value) / sum(w), 6) AS mean FROM w GROUP BY replicate""")
def bootstrap(spark, sf):
    return rounded(split.bootstrap(table(spark, sf, "events").select("event_id", "value"), ["event_id"], "value", 20))


@query("sample_banded", f"""
    WITH b(band, lo, hi) AS (VALUES (0, 0, 0.5), (1, 0.5, 5), (2, 5, 50), (3, 50, 500)),
    r AS (SELECT band::INT AS band, event_id, value, row_number() OVER (PARTITION BY band ORDER BY {_h('event_id')}) AS rn FROM events JOIN b ON value BETWEEN lo AND hi)
    SELECT band, event_id, value FROM r WHERE rn <= 3""")
def sample_banded(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    return split.sample_banded(e, "value", ["event_id"], [(0, 0.5), (0.5, 5), (5, 50), (50, 500)], 3)


@query("plot_sample", f"""
    WITH s AS (SELECT doc_id, lang FROM documents ORDER BY {_h('doc_id')} LIMIT 150), k AS (SELECT lang FROM documents GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 2)
    SELECT doc_id, lang FROM s WHERE lang IN (SELECT lang FROM k)""")
def plot_sample(spark, sf):
    return split.plot_sample(table(spark, sf, "documents").select("doc_id", "lang"), "lang", ["doc_id"], 150, 2)
