"""Views on the given tables that play the part of flow tables in the registered queries.

Each view is a list of SQL expressions that Spark and DuckDB both read, so both start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowbench.plans.registry import table

# A row key for lineitem: the table has none of its own, and no few columns identify a row. All columns do, unless two rows
# are equal in every one of them.
LINE_KEY = ("concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_quantity * 100) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT), "
            "CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT), l_returnflag, l_linestatus, CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)))")

MESSY_EXPRS = [
    "l_orderkey", "l_suppkey", "l_linenumber",
    "nullif(l_quantity, 7) AS qty",
    "l_extendedprice AS price",
    "CASE WHEN l_linenumber % 5 = 0 THEN '-' ELSE l_linestatus END AS service",
    "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS flag",
]
MESSY = f"(SELECT {', '.join(MESSY_EXPRS)} FROM lineitem)"

FLOW_EXPRS = [
    f"{LINE_KEY} AS row_id", "l_suppkey AS machine", "l_quantity AS qty", "l_extendedprice AS price",
    "l_discount AS disc", "l_tax AS tax", "l_linestatus AS state", "l_returnflag AS y",
    "CASE WHEN l_suppkey % 5 = 0 THEN 'test' ELSE 'train' END AS split",
]
FLOWS = f"(SELECT {', '.join(FLOW_EXPRS)} FROM lineitem)"


def messy(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*MESSY_EXPRS)


def flows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*FLOW_EXPRS)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round all doubles (also inside arrays) so that two engines agree on the printed value."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, digits).alias(f.name)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DoubleType):
            c = F.transform(c, lambda x: F.round(x, digits)).alias(f.name)
        cols.append(c)
    return df.select(*cols)


# lineitem in the shape of flow table A and B: every column is a formula of the row.
FLOW_A_EXPRS = [
    f"{LINE_KEY} AS row_id", "l_orderkey AS id", "l_tax * 100 AS dur",
    "CASE l_returnflag WHEN 'A' THEN 'tcp' WHEN 'N' THEN 'udp' ELSE concat('p', l_suppkey % 40) END AS proto",
    "CASE WHEN l_linenumber % 3 = 0 THEN '-' ELSE l_linestatus END AS service", "l_linestatus AS state",
    "CAST(l_quantity AS BIGINT) AS spkts", "CAST(l_linenumber - 1 AS BIGINT) AS dpkts",
    "CAST(floor(l_extendedprice) AS BIGINT) AS sbytes", "l_partkey AS dbytes", "l_partkey % 3 AS dloss", "l_suppkey % 29 AS sloss",
    "l_suppkey % 255 AS sttl", "l_partkey % 255 AS dttl", "l_discount AS sjit", "l_tax AS djit", "l_quantity / 7 AS sinpkt",
    "l_discount * 20 AS dinpkt", "l_orderkey % 30 AS ct_srv_src", "l_suppkey % 11 AS ct_dst_ltm", "l_partkey % 13 AS ct_src_ltm",
    "l_orderkey % 5 AS ct_src_dport_ltm", "l_suppkey % 2 AS ct_ftp_cmd", "l_quantity * l_tax AS smean", "l_quantity / 3 AS sload",
    "l_discount * 7 AS rate",
    "CASE WHEN l_linenumber = 1 THEN ' ' WHEN l_linenumber = 2 THEN 'nan' ELSE concat(' ', l_returnflag, ' ') END AS attack_cat",
    "CASE WHEN l_linenumber <= 2 THEN 0 ELSE 1 END AS label",
]
FLOW_A = f"(SELECT {', '.join(FLOW_A_EXPRS)} FROM lineitem)"

FLOW_B_EXPRS = [
    f"{LINE_KEY} AS row_id", "concat('10.0.0.', l_suppkey) AS src_ip", "CAST(l_partkey AS INT) AS src_port",
    "concat('192.168.', l_suppkey % 3, '.', l_suppkey) AS dst_ip", "CAST(l_suppkey AS INT) AS dst_port",
    "CASE l_linestatus WHEN 'O' THEN 'tcp' ELSE 'udp' END AS proto",
    "CASE WHEN l_linenumber % 3 = 0 THEN 'dns' WHEN l_linenumber % 3 = 1 THEN '-' ELSE 'http' END AS service",
    "l_tax * l_quantity AS duration", "CAST(floor(l_extendedprice) AS BIGINT) AS src_bytes", "l_partkey AS dst_bytes",
    "l_returnflag AS conn_state", "l_suppkey % 7 AS missed_bytes", "CAST(l_quantity AS BIGINT) AS src_pkts",
    "CAST(l_linenumber - 1 AS BIGINT) AS dst_pkts", "CAST(floor(l_extendedprice) AS BIGINT) + 40 AS src_ip_bytes", "l_partkey + 40 AS dst_ip_bytes",
    "l_linenumber % 3 AS dns_qclass", "CASE WHEN l_linenumber % 3 = 0 THEN 'F' ELSE '-' END AS dns_AA",
    "CASE WHEN l_suppkey % 10 = 0 THEN 'T' ELSE '-' END AS dns_RD", "'-' AS dns_RA", "'-' AS dns_rejected",
    "l_returnflag AS type",
]
FLOW_B = f"(SELECT {', '.join(FLOW_B_EXPRS)} FROM lineitem)"


def flow_a(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*FLOW_A_EXPRS)


def flow_b(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(*FLOW_B_EXPRS)


# A result table: one row per model, each score an aggregate of the events of some users.
RESULT_KEY = "concat('m', user_id % 12, CASE WHEN event_id % 2 = 1 THEN ' (tuned)' ELSE '' END)"
RESULT_FAMILY = "concat('f', user_id % 4)"
RESULT_AGGS = [
    "round(avg(CASE WHEN value < 60 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 4) AS accuracy",
    "round(avg(CASE WHEN value < 30 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 4) AS f1",
    "round(avg(CASE WHEN value > 10 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 4) AS auc",
    "round(max(value), 2) AS train_s",
]
RESULTS = f"(SELECT {RESULT_KEY} AS model, {RESULT_FAMILY} AS family, {', '.join(RESULT_AGGS)} FROM events GROUP BY 1, 2)"


def results(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.groupBy(F.expr(RESULT_KEY).alias("model"), F.expr(RESULT_FAMILY).alias("family")).agg(*[F.expr(a) for a in RESULT_AGGS])


# Fold scores: one row per model (user), kind (event type) and fold.
FOLDS = ("(SELECT concat('m', user_id % 12) AS model, event_type AS kind, CAST(event_id % 5 AS INT) AS fold, "
         "avg(value) / 100 AS f1 FROM events GROUP BY 1, 2, 3)")


def folds(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy(
        F.expr("concat('m', user_id % 12)").alias("model"), F.col("event_type").alias("kind"), F.expr("CAST(event_id % 5 AS INT)").alias("fold")
    ).agg(F.expr("avg(value) / 100").alias("f1"))


# A prediction table: two models guess the event type; their class scores are hash uniforms plus a bonus
# for the true class, rounded so that many scores tie.
CLASSES = ["click", "error", "purchase", "signup", "view"]
MODELS = {"a": 0.5, "b": 0.25}
_CLASS_LIST = "[" + ", ".join(f"'{c}'" for c in CLASSES) + "]"
_MODEL_ROWS = ", ".join(f"('{m}', {b}::DOUBLE)" for m, b in MODELS.items())
PRED = f"""(SELECT row_id, model, y, p, {_CLASS_LIST}[list_position(p, list_max(p))] AS pred FROM (
    SELECT row_id, model, y, list_transform(raw, lambda x: round(x / list_sum(raw), 3)) AS p FROM (
      SELECT event_id AS row_id, m AS model, event_type AS y, list_transform({_CLASS_LIST}, lambda c:
        ('0x' || substr(md5(concat_ws(':', event_id, m, c, '42')), 1, 8))::BIGINT / 4294967296.0 + CASE WHEN c = event_type THEN bonus ELSE 0 END) AS raw
      FROM events, (VALUES {_MODEL_ROWS}) v(m, bonus))))"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    from flowbench.functions.hashing import hash_uniform

    e = table(spark, sf, "events").select(F.col("event_id").alias("row_id"), F.col("event_type").alias("y"))
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(b).alias("bonus")) for m, b in MODELS.items()])
    e = e.select("row_id", "y", F.inline(models))
    raw = F.array(*[hash_uniform(["row_id", "model", F.lit(c)]) + F.when(F.col("y") == c, F.col("bonus")).otherwise(0.0) for c in CLASSES])
    total = F.aggregate("raw", F.lit(0.0), lambda s, x: s + x)
    scored = e.withColumn("raw", raw).withColumn("p", F.transform("raw", lambda x: F.round(x / total, 3)))
    names = F.array(*[F.lit(c) for c in CLASSES])
    return scored.select("row_id", "model", "y", "p", F.get(names, (F.array_position("p", F.array_max("p")) - 1).cast("int")).alias("pred"))


# Vectors with labels.
VECTORS = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


# Events as a learnable task: three tiers, a noisy value, a counter from the JSON text and the event type.
TIER_NOISE = "('0x' || substr(md5(concat_ws(':', event_id, 'noise', '42')), 1, 8))::BIGINT / 4294967296.0"
TIER_LABEL = "CASE WHEN value > 40 THEN 'high' WHEN event_type IN ('click', 'view') THEN 'browse' ELSE 'act' END"
TIER_FEATURES = ["noisy", "k", "click", "view", "error", "signup"]
TIERS = f"""(SELECT event_id AS row_id, user_id AS machine, {TIER_LABEL} AS y, value, ln(1 + value) AS target,
    value + 30 * ({TIER_NOISE}) AS noisy, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, (event_type = 'click')::INT::DOUBLE AS click,
    (event_type = 'view')::INT::DOUBLE AS view, (event_type = 'error')::INT::DOUBLE AS error, (event_type = 'signup')::INT::DOUBLE AS signup,
    CASE WHEN user_id % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM events)"""


def tiers(spark: SparkSession, sf: str) -> DataFrame:
    return tier_columns(table(spark, sf, "events"))


def tier_columns(events: DataFrame) -> DataFrame:
    from flowbench.functions.hashing import hash_uniform

    flags = [F.expr(f"CAST(CAST(event_type = '{t}' AS INT) AS DOUBLE)").alias(t) for t in ("click", "view", "error", "signup")]
    return events.select(
        F.col("event_id").alias("row_id"), F.col("user_id").alias("machine"), F.expr(TIER_LABEL).alias("y"), "value", F.log1p("value").alias("target"),
        (F.col("value") + 30 * hash_uniform(["event_id", F.lit("noise")])).alias("noisy"),
        F.get_json_object("props", "$.k").cast("double").alias("k"), *flags,
        F.expr("CASE WHEN user_id % 5 = 0 THEN 'test' ELSE 'train' END").alias("split"))


def tier_vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Train and test with scaled feature vectors; the scale is learned on train."""
    from flowbench.operators.encode import FeaturePlan, standardize

    t = tiers(spark, sf)
    scale = standardize(t.filter("split = 'train'"), ["noisy", "k"])
    v = FeaturePlan(TIER_FEATURES).assemble(scale.apply(t)).select("row_id", "machine", "y", "target", "split", "features")
    return v.filter("split = 'train'"), v.filter("split = 'test'")
