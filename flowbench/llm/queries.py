"""Registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowbench.llm import bpe_tree, chat, cover_tree, exact_dedup, hash_recount, kd_shards, near_dedup, ns_bounds, packing, quality, suffix_tree, token_counts, url_filter

JSON_BPE = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
CONTROL_TURN = "<|im_end|><|im_start|>assistant ok"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf, "documents"), public_tokenizers.path(JSON_BPE))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.url_verdicts(_table(spark, sf, "pages").select("page_id", "url"), rules)


def op3_suffix_tree(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return suffix_tree.score_texts(_table(spark, sf, "documents"), held_out)


def op4_chat(spark: SparkSession, sf: str) -> DataFrame:
    own = spark.createDataFrame([(-1, 0, "user", CONTROL_TURN), (-1, 1, "assistant", CONTROL_TURN)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)))


def op5_embedding_links(spark: SparkSession, sf: str) -> DataFrame:
    return cover_tree.embedding_links(_table(spark, sf, "embeddings"), 0.95)


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    grader = quality.fit_quality(docs, _table(spark, sf, "labels"), quality.grade_of(F.col("quality"), F.col("toxic")))
    return quality.grade_documents(docs, grader).drop("text")


def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf, "documents"), public_tokenizers.path(JSON_BPE))


def op8_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_dedup(_table(spark, sf, "documents"), width=3, percent=85, bands=25, rows=5)


def op9_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf, "documents"))


def op10_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_tree.round_trip_digests(_table(spark, sf, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op11_kd_shards(spark: SparkSession, sf: str) -> DataFrame:
    sharded = kd_shards.kd_shards(_table(spark, sf, "documents"), ["lang", "source", "n_chars"], shards=8)
    return sharded.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


def op12_ns_kmeans(spark: SparkSession, sf: str) -> DataFrame:
    found = ns_bounds.ns_kmeans(_table(spark, sf, "embeddings"), k=16, rounds=3)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", ns_bounds.centroid_digest(F.col("centroid")).alias("centroid_sha256"))


def op13_hash_recount(spark: SparkSession, sf: str) -> DataFrame:
    return hash_recount.divergence_audit(_table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_url_filter, op3_suffix_tree, op4_chat, op5_embedding_links, op6_quality, op7_token_counts, op8_near_dedup,
                                   op9_exact_dedup, op10_bpe, op11_kd_shards, op12_ns_kmeans, op13_hash_recount)}

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{h}{p}', '{v}')" for h, p, v in RULES)
_REST = "CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END"

_SQUARED = "sum((v.x - c.x) * (v.x - c.x))"


def _kmeans_sql(k: int, rounds: int) -> str:
    """Plain rounds over (vector, component) rows, in integers; a number of its own for every row keeps repeated ids apart."""
    parts = [f"""
        kept AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
                 WHERE len(embedding) = 64 AND (SELECT count(*) FROM unnest(embedding) AS t(x) WHERE isfinite(x)) = 64),
        v AS MATERIALIZED (SELECT r, unnest(range(64)) AS i, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM kept),
        first AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id), r) - 1 AS c FROM kept QUALIFY c < {k}),
        c0 AS MATERIALIZED (SELECT c, i, x FROM v JOIN first USING (r))"""]
    for t in range(rounds + 1):
        parts.append(f"""
        d{t} AS (SELECT r, c, {_SQUARED} AS d FROM v JOIN c{t} c ON v.i = c.i GROUP BY r, c),
        a{t} AS MATERIALIZED (SELECT r, c, d FROM d{t} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if t < rounds:
            parts.append(f"""
        m{t} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM v JOIN a{t} USING (r) GROUP BY c, i),
        c{t + 1} AS MATERIALIZED (SELECT o.c, o.i, coalesce(s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END, o.x) AS x FROM c{t} o LEFT JOIN m{t} m ON o.c = m.c AND o.i = m.i)""")
    return f"""
        WITH {",".join(parts)},
        h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM a{rounds} JOIN kept USING (r) JOIN h USING (c)"""


def _divergence_sql(min_docs: int, top: int) -> str:
    return rf"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        w AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
        kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {min_docs}),
        g AS (SELECT DISTINCT lang, source FROM d),
        n AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
        cell AS (SELECT g.lang, g.source, kept.term, coalesce(n.n, 0)::HUGEINT AS n FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
        s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(n) OVER (PARTITION BY lang, term) AS n_lang,
                     sum(n) OVER (PARTITION BY lang) AS total_lang, count(*) OVER (PARTITION BY lang, source) AS v FROM cell),
        p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 1)) // (total + v) AS p, 1 + (1000000000 * (n_lang + 1)) // (total_lang + v) AS q FROM s),
        pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
                 FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pair.value, 0) AS BIGINT) AS value
                  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
                  UNION ALL SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM p WHERE n > 0 AND p > q),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every)
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top}"""


SQL = {
    "op12_ns_kmeans": _kmeans_sql(16, 3),
    "op13_hash_recount": _divergence_sql(3, 200),
    "op2_url_filter": f"""
        WITH p AS (SELECT page_id, regexp_extract({_REST}, '^[^/?#]*') AS raw, {_REST} AS rest FROM pages),
        q AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
        r AS (SELECT * FROM (VALUES {_RULE_ROWS}) AS t(rh, rp, rule, v)),
        m AS (SELECT page_id, rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, v DESC) AS k
              FROM q JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
        SELECT q.page_id, host, path, m.rule, coalesce(m.v, 'allow') AS verdict FROM q LEFT JOIN m ON q.page_id = m.page_id AND m.k = 1""",
    "op4_chat": f"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TURN}'), (-1, 1, 'assistant', '{CONTROL_TURN}')),
        d AS (SELECT *, length(text) + len(regexp_extract_all(text, '<\\\\*\\|')) + length(role) + 12 + 1 + 10 + 1 AS chars FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM d GROUP BY conv_id""",
    "op9_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
}
