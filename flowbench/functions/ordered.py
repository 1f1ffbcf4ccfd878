"""Running totals, ranks and exact quantiles that never sort a whole group in one task.

A window over a whole class is one task per class. Here values are counted first (so equal values
meet before the shuffle), then cut into value ranges: totals per range give the offset, and a window
inside each range does the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowbench.functions.small import lookup, pin_small
from flowbench.session import write_through

# Above this many distinct values over all columns the state of exact ``percentile`` aggregates (one task
# holds it, some 50 bytes per value) is no longer small.
EXACT_STATE_VALUES = 2_000_000


def add_range_bucket(df: DataFrame, keys: list[str], order: str, buckets: int = 64) -> DataFrame:
    """Add ``__bucket``: the value range of ``order`` inside each key group, about equal row counts."""
    probs = [i / buckets for i in range(1, buckets)]
    sketch = F.percentile_approx(F.col(order), F.array(*[F.lit(p) for p in probs]), F.lit(5000)).alias("__cuts")
    if keys:
        joined = lookup(df, pin_small(df.groupBy(*keys).agg(sketch), 2_000), keys)
    else:
        found = df.agg(sketch).first()[0] or []
        joined = df.withColumn("__cuts", F.array(*[F.lit(c) for c in found]))
    return joined.withColumn("__bucket", F.expr(f"size(filter(__cuts, c -> c < `{order}`))")).drop("__cuts")


def running_total(df: DataFrame, keys: list[str], order: str, values: list[str], buckets: int = 64) -> DataFrame:
    """Add ``cum_<v>`` = inclusive running sum of each value in ascending ``order`` within ``keys``, and
    ``all_<v>`` = the sum over the key group.

    ``order`` must be distinct within the keys (aggregate first) and numeric. The totals per range and the
    window inside a range use the same partitioning, so the rows are shuffled once.
    """
    b = add_range_bucket(df, keys, order, buckets)
    # The keys as one struct: equal also where a key is null, and one partitioning for window, totals and join.
    b = b.withColumn("__key", F.struct(*[F.col(k) for k in keys], F.lit(0).alias("__zero")))
    part = ["__key", "__bucket"]
    totals = b.groupBy(*part).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    group = Window.partitionBy("__key")
    before = group.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, *[F.coalesce(F.sum(f"__t_{v}").over(before), F.lit(0)).alias(f"__o_{v}") for v in values],
                            *[F.sum(f"__t_{v}").over(group).alias(f"all_{v}") for v in values])
    inside = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = b.withColumns({f"cum_{v}": F.sum(v).over(inside) for v in values}).join(offsets, part)
    return out.withColumns({f"cum_{v}": F.col(f"__o_{v}") + F.col(f"cum_{v}") for v in values}).drop(
        "__bucket", "__key", *[f"__o_{v}" for v in values])


def row_position(df: DataFrame, order: str, buckets: int = 64) -> DataFrame:
    """Add ``position`` (1..n) of every row by a unique numeric ``order`` without a global sort."""
    b = add_range_bucket(df, [], order, buckets)
    totals = b.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    inside = Window.partitionBy("__bucket").orderBy(order)
    out = lookup(b, pin_small(offsets), ["__bucket"])
    return out.withColumn("position", (F.col("__o") + F.row_number().over(inside)).cast("long")).drop("__bucket", "__o")


def clean_double(c: str | Column) -> Column:
    """The value as double with NaN turned to null (Spark sorts NaN highest in a percentile)."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(x), x)


def _few_values(df: DataFrame, cols: list[str], by: list[str], limit: int) -> bool:
    """Whether the columns of a group have at most ``limit`` distinct values together: few rows, or few by sketch."""
    if df.count() * len(cols) <= limit:
        return True
    sketch = df.groupBy(*by).agg(*[F.approx_count_distinct(F.col(c)).alias(f"d{i}") for i, c in enumerate(cols)])
    most = sketch.agg(F.max(sum((F.col(f"d{i}") for i in range(len(cols))), F.lit(0)))).first()[0] or 0
    return most <= limit


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None,
                    state_values: int = EXACT_STATE_VALUES) -> DataFrame:
    """Exact linear-interpolated quantiles: rows (by..., column, quantiles array<double>).

    One aggregate when the number of distinct values is small, else a distributed rank selection.
    """
    by = by or []
    if _few_values(df, cols, by, state_values):
        grid = F.array(*[F.lit(float(p)) for p in probs])
        wide = df.groupBy(*by).agg(*[F.percentile(clean_double(c), grid).alias(f"q{i}") for i, c in enumerate(cols)])
        parts = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"q{i}").alias("quantiles")) for i, c in enumerate(cols)])
        return wide.select(*by, F.inline(parts))
    return selected_quantiles(df, cols, probs, by)


def selected_quantiles(df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None) -> DataFrame:
    """Rank selection for any number of distinct values: count values, running count, pick the ranks."""
    by = by or []
    keys = [*by, "column"]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), clean_double(c).alias("x")) for c in cols])
    counted = (df.select(*by, F.inline(pairs)).filter(F.col("x").isNotNull())
               .groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("n")))
    ranked = running_total(counted, keys, "x", ["n"], 256)
    picks = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("all_n") - 1)
        for name, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (F.col("cum_n") - F.col("n") <= rank) & (rank < F.col("cum_n"))
            picks.append(F.max(F.when(hit, F.col("x"))).alias(f"{name}{i}"))
    agg = ranked.groupBy(*keys).agg(F.first("all_n").alias("total"), *picks)
    values = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("total") - 1)
        values.append(F.col(f"lo{i}") + (pos - F.floor(pos)) * (F.col(f"hi{i}") - F.col(f"lo{i}")))
    return agg.select(*keys, F.array(*values).alias("quantiles"))


def quantile_map(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float]]:
    """Exact quantiles of each column as a small dict (one entry per column)."""
    return {r["column"]: list(r["quantiles"]) if r["quantiles"] is not None else [None] * len(probs)
            for r in exact_quantiles(df, cols, probs).collect()}


def sorted_position(df: DataFrame, order: list[str], out: str = "position") -> DataFrame:
    """``df``, written down in ascending ``order``, with every row's place (from 0). ``order`` should identify a row.

    Rows are dealt by range and sorted inside; a row's place is the number of rows in earlier ranges and its place in its own,
    so it does not depend on where the ranges were cut.
    """
    laid = write_through(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("__at", 33)
    sizes = laid.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    placed = laid.withColumn("__part", part).join(pin_small(starts), "__part")
    return placed.withColumn(out, F.col("__start") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__part", "__at", "__start")
