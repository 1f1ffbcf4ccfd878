"""Profiling and leakage checks. Statistics of many columns come from one aggregate, not one job each."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowbench.functions.ordered import clean_double, exact_quantiles
from flowbench.functions.small import lookup, null_safe, pin_small
from flowbench.sources.schemas import numeric_columns


def _inline(df: DataFrame, rows: list[Column], keep: list[str] | None = None) -> DataFrame:
    """Turn a one-row (or one row per group) aggregate into long form."""
    return df.select(*(keep or []), F.inline(F.array(*rows)))


def profile_schema(df: DataFrame) -> DataFrame:
    """Rows, columns and number of columns per type."""
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        counts[f.dataType.simpleString()] = counts.get(f.dataType.simpleString(), 0) + 1
    rows = [F.struct(F.lit(t).alias("dtype"), F.lit(n).cast("long").alias("n_columns")) for t, n in sorted(counts.items())]
    total = df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("total_columns", F.lit(len(df.columns)).cast("long"))
    return _inline(total, rows, ["n_rows", "total_columns"])


def missing_report(df: DataFrame, cols: list[str], placeholder: str = "-") -> DataFrame:
    """Nulls and placeholder cells per column, with shares."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"m{i}"),
                 F.count_if(F.col(c).cast("string") == placeholder).alias(f"p{i}")]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing"), F.col(f"p{i}").alias("n_placeholder"),
                     (F.col(f"m{i}") / F.col("n")).alias("missing_share"),
                     (F.col(f"p{i}") / F.col("n")).alias("placeholder_share")) for i, c in enumerate(cols)]
    return _inline(df.agg(*aggs), rows)


def is_infinite(c: str) -> Column:
    return F.col(c).isin(float("inf"), float("-inf"))


def nonfinite_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """Infinite and NaN cells per double column."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count_if(is_infinite(c)).alias(f"i{i}"), F.count_if(F.isnan(c)).alias(f"n{i}")]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"i{i}").alias("n_infinite"), F.col(f"n{i}").alias("n_nan"))
            for i, c in enumerate(cols)]
    return _inline(df.agg(*aggs), rows)


def nonfinite_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.when(~(is_infinite(c) | F.isnan(c)), F.col(c)) for c in cols})


def duplicate_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows before and after exact de-duplication; nulls compare equal. Copies meet before the shuffle."""
    groups = df.groupBy(*(cols or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
    dups = F.col("rows_before") - F.col("rows_after")
    return total.select("rows_before", "rows_after", dups.alias("duplicates"),
                        (100 * dups / F.col("rows_before")).alias("duplicate_pct"))


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """Count and share per level, most frequent first, ties by value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("t"))
    out = counts.withColumn("share", F.col("n") / total.scalar())
    return out.orderBy(F.desc("n"), F.asc(col)).limit(top) if top else out


def adjusted_skew(c: Column) -> Column:
    """Bias-corrected skewness (null below three rows)."""
    n = F.count(c)
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1.0)) / (n - 2))


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max, adjusted skew and zero share per column."""
    aggs = []
    for i, c in enumerate(cols):
        x = clean_double(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}"), adjusted_skew(x).alias(f"k{i}"), F.avg((x == 0).cast("double")).alias(f"z{i}")]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                     F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"), F.col(f"k{i}").alias("skew"),
                     F.col(f"z{i}").alias("zero_share")) for i, c in enumerate(cols)]
    base = _inline(df.agg(*aggs), rows)
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).select(
        "column", F.col("quantiles")[0].alias("q25"), F.col("quantiles")[1].alias("q50"), F.col("quantiles")[2].alias("q75"))
    return base.join(q, "column", "left")


def level_counts(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """Distinct levels per column; ``approx`` uses the HyperLogLog sketch."""
    if approx:
        agg = df.agg(*[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(cols)])
        return _inline(agg, [F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("levels")) for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in cols])
    return (df.select(F.inline(pairs)).filter("v is not null").distinct()
            .groupBy("column").agg(F.count(F.lit(1)).alias("levels")))


def histogram(df: DataFrame, col: str, bins: int = 50, log: bool = False) -> DataFrame:
    """Equal-width bins between the minimum and maximum; the last bin is closed, empty bins are kept."""
    x = clean_double(col)
    x = F.log1p(F.greatest(x, F.lit(0.0))) if log else x
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    width = ((hi - lo) / bins) or 1.0
    counts = (df.select(F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int").alias("bin"))
              .filter("bin is not null").groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * width).alias("left_edge"), F.coalesce("n", F.lit(0)).alias("n")))


def _gram(x: np.ndarray) -> list[np.ndarray]:
    """For every pair (i, j) of columns, over rows where both are present: rows, sum of i, sum of squares of i, sum of products."""
    there = np.isfinite(x).astype(np.float64)
    x = np.where(there > 0, x, 0.0)
    return [there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x]


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every unordered pair, over the rows where both are present and finite; null if one is constant there.

    One pass for any number of columns: each task adds up four products of its matrix of rows with itself, in bounded slices, and
    Spark adds the tasks' rows. Values are taken about the median of some first rows, so that large means do not cancel digits.
    """
    xs, d = [F.when(F.abs(clean_double(c)) < float("inf"), F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)], len(cols)
    middle = df.select(*xs).limit(1_000).agg(*[F.percentile_approx(f"x{i}", 0.5, 1_000) for i in range(d)]).first()
    about = np.array([m if m is not None else 0.0 for m in middle])

    def fold(batches):
        sums = [np.zeros((d, d)) for _ in range(4)]
        for b in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in b.columns], axis=1) - about
            for part in np.array_split(x, max(1, -(-len(x) // 4_096))):
                sums = [s + g for s, g in zip(sums, _gram(part))]
        lists = [pa.array(list(s), pa.list_(pa.float64())) for s in sums]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), *lists], ["i", "n", "s", "q", "p"])

    rows = df.select(*xs).mapInArrow(fold, "i int, n array<double>, s array<double>, q array<double>, p array<double>")
    total = rows.groupBy("i").agg(*[vector_to_array(Summarizer.sum(array_to_vector(c))).alias(c) for c in "nsqp"])
    one = total.select("i", F.posexplode(F.arrays_zip("n", "s", "q", "p")).alias("j", "z")).select("i", "j", "z.*")
    back = one.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("s").alias("s_j"), F.col("q").alias("q_j"))
    both = one.filter("i < j").join(back, ["i", "j"])
    n = F.col("n")
    var_i, var_j = n * F.col("q") - F.col("s") * F.col("s"), n * F.col("q_j") - F.col("s_j") * F.col("s_j")
    r = F.when((var_i > 0) & (var_j > 0), (n * F.col("p") - F.col("s") * F.col("s_j")) / F.sqrt(var_i) / F.sqrt(var_j))
    name = pin_small(df.sparkSession.createDataFrame(list(enumerate(cols)), "k int, name string"))
    return (both.withColumn("r", r).join(name.select(F.col("k").alias("i"), F.col("name").alias("a")), "i")
            .join(name.select(F.col("k").alias("j"), F.col("name").alias("b")), "j").select("a", "b", "r"))


def target_correlation(df: DataFrame, cols: list[str], target: str, k: int = 10) -> DataFrame:
    """The k columns with the largest absolute correlation with the target."""
    feats = [c for c in cols if c != target]
    agg = df.agg(*[F.corr(clean_double(c), clean_double(target)).alias(f"r{i}") for i, c in enumerate(feats)])
    long = _inline(agg, [F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("r")) for i, c in enumerate(feats)])
    return long.orderBy(F.desc(F.abs("r")), "column").limit(k)


def group_quantiles(df: DataFrame, group: str, col: str) -> DataFrame:
    """Median, quartiles and whisker limits per class, with the place of the class by median."""
    q = exact_quantiles(df, [col], [0.25, 0.5, 0.75], [group]).select(
        group, F.col("quantiles")[0].alias("q25"), F.col("quantiles")[1].alias("median"), F.col("quantiles")[2].alias("q75"))
    iqr = F.col("q75") - F.col("q25")
    limits = q.withColumns({"lo": F.col("q25") - 1.5 * iqr, "hi": F.col("q75") + 1.5 * iqr})
    joined = lookup(df.select(group, clean_double(col).alias("x")), pin_small(limits), [group])
    inside = F.col("x").between(F.col("lo"), F.col("hi"))
    return joined.groupBy(group).agg(
        F.first("q25").alias("q25"), F.first("median").alias("median"), F.first("q75").alias("q75"),
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"), F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outside"))


def leak_probe(df: DataFrame, target: str, candidates: dict[str, Column], tolerance: float = 1e-6) -> DataFrame:
    """Is the target a formula of other columns: correlation, share of equal rows, rows above the formula."""
    aggs = []
    for i, expr in enumerate(candidates.values()):
        t = F.col(target)
        aggs += [F.corr(expr, t).alias(f"r{i}"), F.avg((F.abs(expr - t) <= tolerance).cast("double")).alias(f"e{i}"),
                 F.count_if(t > expr + tolerance).alias(f"v{i}")]
    rows = [F.struct(F.lit(name).alias("formula"), F.col(f"r{i}").alias("r"), F.col(f"e{i}").alias("equal_share"),
                     F.col(f"v{i}").alias("n_above")) for i, name in enumerate(candidates)]
    return _inline(df.agg(*aggs), rows)


def twin_overlap(train: DataFrame, test: DataFrame, cols: list[str]) -> DataFrame:
    """Share of test rows with an identical feature row in train. Both sides are reduced to distinct
    feature rows first, so a row copied many times is one row in the join."""
    t = test.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    seen = train.select(*cols).distinct()
    hit = t.join(seen, null_safe(t, seen, cols), "left_semi")
    found = hit.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("f"))
    return t.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("test_rows")).select(
        "test_rows", found.scalar().alias("twin_rows")).withColumn("twin_share", F.col("twin_rows") / F.col("test_rows"))


def label_conflicts(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Feature rows that carry more than one label, and the rows they cover."""
    groups = (df.groupBy(*features).agg(F.count(F.lit(1)).alias("n"), F.min(label).alias("lo"), F.max(label).alias("hi")))
    bad = F.col("lo") != F.col("hi")
    return groups.agg(F.count(F.lit(1)).alias("groups"), F.count_if(bad).alias("conflict_groups"),
                      F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("conflict_rows"), F.sum("n").alias("n_rows")
                      ).withColumn("conflict_share", F.col("conflict_rows") / F.col("n_rows"))


def label_determinism(df: DataFrame, a: str, b: str) -> DataFrame:
    """Crosstab of two labels with the number of b levels per a level; 1 means a decides b."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    levels = cells.groupBy(a).agg(F.count(F.lit(1)).alias("b_levels"))
    return lookup(cells, levels, [a]).withColumn("determined", F.col("b_levels") == 1)


def zero_blocks(df: DataFrame, cols: list[str], digits: int = 3) -> DataFrame:
    """Numeric columns grouped by their share of zeros."""
    agg = df.agg(*[F.avg((F.col(c) == 0).cast("double")).alias(f"z{i}") for i, c in enumerate(cols)])
    long = _inline(agg, [F.struct(F.lit(c).alias("column"), F.round(F.col(f"z{i}"), digits).alias("zero_share"))
                         for i, c in enumerate(cols)])
    return long.groupBy("zero_share").agg(F.array_join(F.sort_array(F.collect_list("column")), ",").alias("columns"),
                                          F.count(F.lit(1)).alias("n_columns"))


def variance_concentration(df: DataFrame, col: str, key: str, tops: list[int]) -> DataFrame:
    """Share of the squared deviation held by the N rows furthest from the mean."""
    mean, total = df.agg(F.avg(col), F.var_pop(col) * F.count(col)).first()
    dev = df.select(F.pow(F.col(col) - F.lit(mean), 2).alias("d"), F.col(key).alias("k"))
    biggest = dev.orderBy(F.desc("d"), F.asc("k")).limit(max(tops))
    rn = F.row_number().over(Window.orderBy(F.desc("d"), F.asc("k")))
    ranked = biggest.withColumn("rn", rn)
    agg = ranked.agg(*[F.sum(F.when(F.col("rn") <= n, F.col("d"))).alias(f"t{n}") for n in tops])
    return _inline(agg, [F.struct(F.lit(n).cast("long").alias("top_n"), (F.col(f"t{n}") / F.lit(total)).alias("share")) for n in tops])


def prior_shift(df: DataFrame, label: str, dedup_on: list[str]) -> DataFrame:
    """Class counts before and after removing duplicates, with the percent change."""
    groups = df.groupBy(*dict.fromkeys([label, *dedup_on])).agg(F.count(F.lit(1)).alias("n"))
    out = groups.groupBy(label).agg(F.sum("n").alias("n_before"), F.count(F.lit(1)).alias("n_after"))
    return out.withColumn("change_pct", 100 * (F.col("n_after") / F.col("n_before") - 1))


def support_table(df: DataFrame, label: str, split: str, group: str) -> DataFrame:
    """Per class: rows and distinct groups on each side of a split."""
    g = df.groupBy(label, split, group).agg(F.count(F.lit(1)).alias("n"))

    def side(name: str) -> list[Column]:
        on = F.col(split) == name
        return [F.coalesce(F.sum(F.when(on, F.col("n"))), F.lit(0)).alias(f"{name}_rows"), F.count_if(on).alias(f"{name}_groups")]

    return g.groupBy(label).agg(*side("train"), *side("test"))


def imbalance(df: DataFrame, label: str, normal) -> DataFrame:
    """Largest to smallest class ratio, share of rows that are not normal, accuracy of the majority guess."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return c.agg((F.max("n") / F.min("n")).alias("max_min_ratio"),
                 (F.sum(F.when(F.col(label) != normal, F.col("n")).otherwise(0)) / F.sum("n")).alias("attack_share"),
                 (F.max("n") / F.sum("n")).alias("majority_accuracy"), F.count(F.lit(1)).alias("classes"))


def _equal_shares(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    agg = df.agg(*[F.avg(F.col(a).eqNullSafe(F.col(b)).cast("double")).alias(f"e{i}") for i, (a, b) in enumerate(pairs)])
    return _inline(agg, [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"e{i}").alias("equal_share")) for i, (a, b) in enumerate(pairs)])


def redundant_columns(df: DataFrame, cols: list[str], least_share: float = 0.0) -> DataFrame:
    """Pairs of columns that are equal in at least ``least_share`` of the rows."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    return _equal_shares(df, pairs).filter(F.col("equal_share") >= least_share)


def equal_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns that hold the same value in every row: (column, same_as), the first of each group of equal columns.

    One digest a column from one pass, for any number of columns: a sum over the rows of a hash of the value and the row. Only columns
    with equal digests are compared, each with the first of its group, so equal hashes of different values do no harm. Values are
    compared as text: 7 and 7.0 differ.
    """
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, same_as string")
    row = F.xxhash64(*[F.col(c) for c in cols])
    plain = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    sums = df.withColumn("__row", row).agg(*[F.sum(F.xxhash64(plain(c), "__row").cast("decimal(38,0)")).alias(f"d{i}") for i, c in enumerate(cols)]).first()
    groups: dict = {}
    for c, digest in zip(cols, sums):
        groups.setdefault(digest, []).append(c)
    pairs = [(g[0], c) for g in groups.values() for c in g[1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column string, same_as string")
    differ = df.agg(*[F.count_if(~plain(a).eqNullSafe(plain(b))).alias(f"e{i}") for i, (a, b) in enumerate(pairs)])
    return _inline(differ, [F.struct(F.lit(b).alias("column"), F.lit(a).alias("same_as"), F.col(f"e{i}").alias("n")) for i, (a, b) in enumerate(pairs)]).filter("n = 0").drop("n")


def all_numeric(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    return numeric_columns(df.schema, exclude)


def any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
