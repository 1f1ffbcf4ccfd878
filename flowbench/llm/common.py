"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowbench.session import write_through

SPACES = r"[\x20\x09-\x0D]+"
SLICE_ROWS = 500


def sliced(batches, rows: int = SLICE_ROWS):
    """Batches of at most ``rows`` rows, none of them copied. A Python worker outlives its tasks and keeps the most memory that a
    batch ever took, so what is made of texts is made of few at a time, whatever the batches that Spark sends."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def fixed(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: what a lost executor takes with it is read again, not computed anew."""
    return write_through(df, label)


def sorted_names(df: DataFrame, keys: list[str], buckets: int = 1024) -> DataFrame:
    """Distinct rows of ``keys`` with an integer ``name`` of their own, given by their place in sorted order.

    Rows are dealt into buckets by hash and sorted inside; place * buckets + bucket cannot repeat, whatever the keys.
    Keys are distinct before they are dealt, so no bucket is hot.
    """
    from pyspark.sql import Window

    distinct = df.select(*keys).distinct().withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    place = F.row_number().over(Window.partitionBy("__bucket").orderBy(*keys)).cast("long")
    return distinct.withColumn("name", place * buckets + F.col("__bucket")).drop("__bucket")
