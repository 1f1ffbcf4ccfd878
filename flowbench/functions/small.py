"""Small tables with a checked size, pinned on the driver so that Spark can broadcast them safely."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 20_000


def pin_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Hold ``df`` on the driver and mark it for broadcast when it has at most ``max_rows`` rows.

    The other side of a join then keeps its partitioning: a hot key moves no rows, and the small plan is not
    computed again. A larger table comes back unchanged and joins by shuffle, with skew left to AQE.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def collect_small(df: DataFrame, max_rows: int = SMALL_ROWS, what: str = "table") -> list:
    """Rows of a table that must be small by its meaning; a larger one is an error, never a cut."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows")
    return rows


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]):
    """Join condition that also matches null keys."""
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def lookup(df: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Null-safe join that keeps one copy of the keys; ``table`` has one row per key."""
    renamed = table
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__k_{k}")
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(renamed[f"__k_{k}"])
        cond = c if cond is None else cond & c
    return df.join(renamed, cond, how).drop(*[f"__k_{k}" for k in keys])


FIT_ROWS = 100_000


def fit_input(df: DataFrame, cols: list[str], part_rows: int = FIT_ROWS) -> DataFrame:
    """The columns a fit reads, cached for its passes (unpersist when fitted). Rows are dealt and sorted by their own
    hash into 8 partitions and one more for every ``part_rows`` rows, so a fit that draws by partition and place gives
    the same model on any number of cores."""
    out = df.select(*cols)
    return out.repartition(8 + df.count() // part_rows, F.xxhash64(*cols)).sortWithinPartitions(F.xxhash64(*cols), F.hash(*cols)).persist()
