"""Seeded hash order: the same row order, uniforms and Poisson counts on every engine and every run.

Samples, splits and resamples never use a random generator. A row's place is the md5 of its key and
the seed, so a lost executor recomputes exactly the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cumulative distribution of Poisson(1), k = 0..8.
POISSON1_CDF = [
    0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563,
    0.9994058151824183, 0.9999167588507119, 0.9999897508033253, 0.999998874797402,
]


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_hash(keys: list[str | Column], seed: int | str = 42) -> Column:
    """md5 hex of the key columns and the seed; lexicographic order of it is the hash order."""
    return F.md5(F.concat_ws(":", *[as_col(k).cast("string") for k in keys], F.lit(str(seed))))


def hash_uniform(keys: list[str | Column], seed: int | str = 42) -> Column:
    """A uniform number in [0, 1) from the first 32 bits of the row hash."""
    return F.conv(F.substring(row_hash(keys, seed), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def count_at_or_below(x: Column, steps: list[float]) -> Column:
    """How many of the (few, fixed) steps are at or below x."""
    return reduce(lambda a, b: a + b, [(x >= F.lit(float(c))).cast("int") for c in steps])


def with_poisson(df: DataFrame, keys: list[str], replicates: int, seed: int | str = 42) -> DataFrame:
    """Add Poisson(1) counts ``__w1 .. __wB`` per row. One md5 serves four replicates; the three
    projections stay apart, so a hash is computed once although its digits are used many times."""
    blocks = range((replicates + 3) // 4)
    hashed = df.withColumns({f"__h{j}": row_hash([*keys, F.lit(f"b{j}")], seed) for j in blocks})
    reps = range(1, replicates + 1)
    digits = {f"__u{b}": F.conv(F.substring(f"__h{(b - 1) // 4}", 1 + 8 * ((b - 1) % 4), 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
              for b in reps}
    drawn = hashed.withColumns(digits)
    return drawn.withColumns({f"__w{b}": count_at_or_below(F.col(f"__u{b}"), POISSON1_CDF) for b in reps}).drop(
        *[f"__h{j}" for j in blocks], *digits)
