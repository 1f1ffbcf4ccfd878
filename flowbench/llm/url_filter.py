"""URL rules by hashed expressions: host suffixes and path prefixes, joined on short digest prefixes.

Each distinct URL is expanded into every (host suffix, path folder) pair that it begins with; a rule is keyed by its host and
the folder part of its path. Rules and expressions meet in an equi-join on the first four bytes of their SHA-256; the whole
digests and the rest of the rule's path are then compared, and among the rules that fit, the one with the longest rule
string gives the verdict (ties: block before allow).

Defined results: a null url, or one without ``://``, has an empty host and path and gets the default verdict; repeated
pages keep a row each; null rule parts are an empty host or path; an empty host in a rule fits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_HEX = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    return _lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # The line feed cannot stand in a host, so the pair cannot be read in two ways.
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _folder(path: Column) -> Column:
    """Up to and with the last ``/``; empty without one."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def rule_table(rules: DataFrame) -> DataFrame:
    """``rules`` (host, path, verdict) with the digest of host and the path's folder; equal rules are folded, block first."""
    r = rules.select(_lower(F.coalesce("host", F.lit(""))).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), F.col("verdict").alias("r_verdict"))
    r = r.filter("r_host <> ''").groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
    return r.withColumn("r_digest", _digest(F.col("r_host"), _folder(F.col("r_path")))).withColumn("r_prefix", F.substring("r_digest", 1, PREFIX_HEX))


def expressions(urls: DataFrame) -> DataFrame:
    """(url, path, digest, prefix) for each host suffix and each folder that the path begins with, the empty one included."""
    labels, parts = F.split("host", "\\."), F.split(_folder(F.col("path")), "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.concat(F.slice(parts, 1, i - 1), F.array(F.lit(""))), "/"))
    return (urls.filter("host <> ''").select("url", "path", F.explode(suffixes).alias("suffix"), starts.alias("starts"))
            .select("url", "path", "suffix", F.explode("starts").alias("start"))
            .select("url", "path", _digest(F.col("suffix"), F.col("start")).alias("digest"))
            .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)))


def url_verdicts(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` rows (all columns but clashing ones) with ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and all subdomains when the path starts with the rule's path.
    """
    own = ["host", "path", "rule", "verdict"]
    rows = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in own and c != url_col], F.coalesce(F.col(f"`{url_col}`"), F.lit("")).alias("__url"))
    table = rule_table(rules)
    urls = rows.select(F.col("__url").alias("url")).distinct().withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    hits = (expressions(urls).join(table, F.col("prefix") == F.col("r_prefix"))
            .filter((F.col("digest") == F.col("r_digest")) & F.startswith("path", "r_path"))
            .withColumn("rule", F.concat("r_host", "r_path")))
    best = hits.groupBy("url").agg(F.max(F.struct(F.length("rule").alias("n"), F.col("r_verdict"), F.col("rule"))).alias("best"))
    rest = [c for c in rows.columns if c != "__url"]
    return (rows.join(best.withColumnRenamed("url", "__url"), "__url", "left")
            .select(*[F.col(f"`{c}`") for c in rest], host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path"),
                    F.col("best.rule").alias("rule"), F.coalesce("best.r_verdict", F.lit(default)).alias("verdict")))
