"""Queries that run a stream over the event files to its end."""

from __future__ import annotations

import numpy as np

from pyspark.sql import functions as F

from flowbench.functions.hashing import hash_uniform
from flowbench.operators import bayes
from flowbench.plans.queries_models import nb_sql
from flowbench.plans.registry import query, table
from flowbench.plans.views import TIERS, VECTORS, rounded, tier_columns, tiers, vectors
from flowbench.session import scratch_path
from flowbench.streaming import streams


def _events(spark, sf):
    return streams.stream_table(spark, sf, table(spark, sf, "events").schema, "events.parquet")


@query("stream_score", f"WITH {nb_sql(TIERS, ['noisy', 'k'], 'row_id')} SELECT row_id, pred, round(confidence, 6) AS confidence FROM scored")
def stream_score(spark, sf):
    model = bayes.gaussian_nb(tiers(spark, sf).filter("split = 'train'"), ["noisy", "k"], "y")

    def score(stream):
        return model.apply(tier_columns(stream).filter("split = 'test'")).select("row_id", "pred", F.array_max("p").alias("confidence"))

    return rounded(streams.stream_score(_events(spark, sf), score))


_P = "('0x' || substr(md5(concat_ws(':', event_id, 'p', '42')), 1, 8))::BIGINT / 4294967296.0 * 0.7 + CASE WHEN event_type = 'error' THEN 0.3 ELSE 0 END"


def _p():
    return hash_uniform(["event_id", F.lit("p")]) * 0.7 + F.when(F.col("event_type") == "error", 0.3).otherwise(0.0)


@query("stream_counters", f"""
    SELECT count(*)::BIGINT AS flows, count(*) FILTER (event_type = 'error')::BIGINT AS attacks, count(*) FILTER ((p >= 0.5) = (event_type = 'error'))::BIGINT AS "right"
    FROM (SELECT *, {_P} AS p FROM events)""")
def stream_counters(spark, sf):
    attack = F.col("event_type") == "error"
    return streams.stream_counters(_events(spark, sf), attack, (_p() >= 0.5) == attack)


_WINDOWS = f"""
    WITH e AS (SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type = 'error' AS attack, {_P} AS p FROM events),
    w AS (SELECT start, count(*) FILTER (p >= T AND attack)::BIGINT AS tp, count(*) FILTER (p >= T AND NOT attack)::BIGINT AS fp,
      count(*) FILTER (p < T AND attack)::BIGINT AS fn, count(*) FILTER (p < T AND NOT attack)::BIGINT AS tn FROM e GROUP BY start)
    SELECT *EXTRA FROM w WHERE start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""


@query("stream_window_metrics", _WINDOWS.replace("EXTRA", "").replace("T AND", "0.5 AND"))
def stream_window_metrics(spark, sf):
    return streams.stream_window_metrics(_events(spark, sf), "ts", _p() >= 0.5, F.col("event_type") == "error")


@query("stream_gate", _WINDOWS.replace("EXTRA", ", (10 * tp + tn - 15 * fp - 25 * fn)::BIGINT AS points").replace("T AND", "0.6 AND"))
def stream_gate(spark, sf):
    return streams.stream_gate(_events(spark, sf), "ts", _p(), 0.6, F.col("event_type") == "error")


@query("stream_dedup", "SELECT event_id, event_type, value FROM events")
def stream_dedup(spark, sf):
    twice = _events(spark, sf).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")
    return streams.stream_dedup(twice, "ts", ["event_id"]).select("event_id", "event_type", "value")


def _stream_kmeans_sql(batches: int) -> str:
    steps = "".join(f"""
    d{t} AS (SELECT u.vec_id, c.cluster, sqrt(sum(pow(u.x - c.x, 2))) AS d FROM u JOIN c{t} c USING (i) WHERE u.vec_id % {batches} = {t} GROUP BY ALL),
    a{t} AS (SELECT vec_id, cluster FROM d{t} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1),
    m{t} AS (SELECT a.cluster, u.i, avg(u.x) AS m, count(*) AS n FROM a{t} a JOIN u USING (vec_id) GROUP BY ALL),
    c{t + 1} AS (SELECT c.cluster, c.i, c.x + coalesce((m.m - c.x) * m.n / (c.w + m.n), 0) AS x, c.w + coalesce(m.n, 0) AS w FROM c{t} c LEFT JOIN m{t} m USING (cluster, i)),""" for t in range(batches))
    return f"""
    WITH v AS (SELECT * FROM {VECTORS}), u AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
    f AS (SELECT label, v FROM v QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1),
    c0 AS (SELECT label AS cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i, 0::DOUBLE AS w FROM f),{steps}
    z AS (SELECT cluster, round(any_value(w), 6) AS weight, list(round(x, 6) ORDER BY i) AS center FROM c{batches} GROUP BY cluster) SELECT * FROM z"""


@query("stream_kmeans", _stream_kmeans_sql(3))
def stream_kmeans(spark, sf):
    v = vectors(spark, sf)
    path = scratch_path(spark, "vector-stream")
    for b in range(3):  # one file a batch, in the order of writing
        v.filter(F.col("vec_id") % 3 == b).coalesce(1).write.mode("append").parquet(path)
    stream = streams.stream_table(spark, path, v.schema, per_trigger=1)
    first = v.groupBy("label").agg(F.min_by("v", "vec_id").alias("v")).orderBy("label").collect()
    return rounded(streams.stream_kmeans(stream, "v", np.array([r["v"] for r in first])))
