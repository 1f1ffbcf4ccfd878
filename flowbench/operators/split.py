"""Samples, splits and folds in seeded hash order.

The n-th row of a class in hash order is found from counts per hash prefix: only the rows that share
the prefix of the wanted place are sorted. The result is one cut-off hash per class, and the split of a
row is a comparison with it. No class is ever sorted in one task and no row is shuffled to be split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowbench.functions.hashing import row_hash, with_poisson
from flowbench.functions.ordered import row_position
from flowbench.functions.small import lookup, pin_small
from flowbench.operators.encode import quantile_bins

PREFIX = 3  # hex digits of the hash counted per class: 4,096 prefixes


def hash_cutoffs(df: DataFrame, by: list[str], keys: list[str], seed, quotas) -> DataFrame:
    """One row per class with, for each quota, the hash of the class's quota-th row.

    ``quotas`` maps a name to a column over the class size ``n`` and the table size ``total``, or is a
    function from that size table to a table with one column ``quota``. Quota 0 gives no cut-off.
    ``keys`` must identify a row. Two passes over the class and key columns.
    """
    hashed = df.select(*by, row_hash(keys, seed).alias("__h")).withColumn("__p", F.substring("__h", 1, PREFIX))
    counts = hashed.groupBy(*by, "__p").agg(F.count(F.lit(1)).alias("__n"))
    sizes = counts.groupBy(*by).agg(F.sum("__n").alias("n"))
    sizes = sizes.withColumn("total", F.sum("n").over(Window.partitionBy()))  # one row per class
    if callable(quotas):
        wanted_rows, names = quotas(sizes), ["quota"]
    else:
        wanted_rows, names = sizes.select(*by, *[c.alias(m) for m, c in quotas.items()]), list(quotas)
    cum = counts.withColumn("__c", F.sum("__n").over(Window.partitionBy(*by).orderBy("__p")))
    if by:
        joined = lookup(cum, wanted_rows, by, "inner")
    else:
        joined = cum.withColumns({m: wanted_rows.select(m).scalar() for m in names})
    wanted = F.array(*[F.struct(F.lit(m).alias("__name"), F.col(m).cast("long").alias("__q")) for m in names])
    edge = (joined.select(*by, "__p", "__n", "__c", F.inline(wanted))
            .filter((F.col("__c") - F.col("__n") < F.col("__q")) & (F.col("__q") <= F.col("__c")))
            .select(*by, "__p", "__name", (F.col("__q") - F.col("__c") + F.col("__n")).alias("__need")))
    near = lookup(hashed, pin_small(edge), [*by, "__p"], "inner")
    rn = F.row_number().over(Window.partitionBy(*by, "__name").orderBy("__h"))
    hits = near.withColumn("__rn", rn).filter("__rn = __need")
    return pin_small(hits.groupBy(*by).agg(*[F.max(F.when(F.col("__name") == m, F.col("__h"))).alias(m) for m in names]))


def with_cutoffs(df: DataFrame, by: list[str], cuts: DataFrame) -> DataFrame:
    """Add the cut-off hashes to every row; no cut-off is an empty string, which is below every hash."""
    names = [c for c in cuts.columns if c not in by]
    if by:
        return lookup(df, cuts, by).withColumns({m: F.coalesce(m, F.lit("")) for m in names})
    row = cuts.first()
    return df.withColumns({m: F.lit(row[m] if row and row[m] else "") for m in names})


def take_in_hash_order(df: DataFrame, by: list[str], keys: list[str], seed, quota) -> DataFrame:
    """The first ``quota`` rows of every class in hash order."""
    cuts = hash_cutoffs(df, by, keys, seed, quota if callable(quota) else {"quota": quota}).withColumnRenamed("quota", "__cut")
    return with_cutoffs(df, by, cuts).filter(row_hash(keys, seed) <= F.col("__cut")).drop("__cut")


def split_stratified(df: DataFrame, label: str, keys: list[str], test_share: float = 0.2, seed: int = 42,
                     names: tuple[str, str] = ("train", "test"), out: str = "split") -> DataFrame:
    """Add a split column with the same share of every class in test."""
    joined = with_cutoffs(df, [label], hash_cutoffs(df, [label], keys, seed, {"__cut": F.round(F.col("n") * test_share)}))
    side = F.when(row_hash(keys, seed) <= F.col("__cut"), names[1]).otherwise(names[0])
    return joined.withColumn(out, side).drop("__cut")


def proportional_quotas(sizes: DataFrame, label: str, n: int) -> DataFrame:
    """Quota per class for exactly n rows: floors, then one more for the largest remainders."""
    share = F.least(F.lit(float(n)), F.col("total")) * F.col("n") / F.col("total")
    floors = sizes.withColumn("__e", share).withColumns({"__f": F.floor("__e"), "__r": F.col("__e") - F.floor("__e")})
    short = F.least(F.lit(n), F.max("total").over(Window.partitionBy())) - F.sum("__f").over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy(F.desc(F.round("__r", 9)), F.asc(label)))
    return floors.withColumn("quota", F.col("__f") + (place <= short).cast("int")).select(label, "quota")


def sample_stratified(df: DataFrame, label: str, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows with class proportions kept."""
    return take_in_hash_order(df, [label], keys, seed, lambda sizes: proportional_quotas(sizes, label, n))


def sample_n(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """A simple random sample of n rows without replacement: the first n in hash order."""
    return take_in_hash_order(df, [], keys, seed, F.least(F.lit(n), F.col("n")))


def shuffle_rows(df: DataFrame, keys: list[str], seed: int = 42) -> DataFrame:
    """All rows in seeded random order (a range-partitioned sort)."""
    return df.orderBy(row_hash(keys, seed))


def split_by_group(df: DataFrame, group: str, test_groups: DataFrame | list, out: str = "split") -> DataFrame:
    """Rows of the listed groups go to test, the rest to train. A list is a literal, a table is joined."""
    if isinstance(test_groups, list):
        return df.withColumn(out, F.when(F.col(group).isin(test_groups), "test").otherwise("train"))
    marked = pin_small(test_groups.select(group).distinct()).withColumn("__t", F.lit(True))
    return lookup(df, marked, [group]).withColumn(out, F.when(F.col("__t"), "test").otherwise("train")).drop("__t")


def subsample_quota(df: DataFrame, label: str, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """About n rows: each class keeps max(1, its proportional share)."""
    share = F.greatest(F.lit(1), F.round(F.col("n") * F.lit(n) / F.col("total")))
    return take_in_hash_order(df, [label], keys, seed, F.least(F.col("n"), share.cast("long")))


def split_binned(df: DataFrame, target: str, keys: list[str], q: int = 10, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Split stratified on quantile bins of a continuous target; keeps the ``bin`` column."""
    return split_stratified(quantile_bins(df, target, q).apply(df, "bin"), "bin", keys, test_share, seed)


def kfold(df: DataFrame, order: str, k: int = 5, out: str = "fold") -> DataFrame:
    """k contiguous folds by a unique numeric order; the first n % k folds have one row more. Only the order
    column is ranked, to find the last value of each fold; the rows are then compared with those values."""
    base, extra = divmod(df.count(), k)
    ends, at = [], 0
    for i in range(k - 1):
        at += base + (1 if i < extra else 0)
        ends.append(at)
    ranked = row_position(df.select(order), order).filter(F.col("position").isin(ends))
    cuts = [r[order] for r in ranked.collect()]
    return df.withColumn(out, sum(((F.col(order) > F.lit(c)).cast("int") for c in cuts), F.lit(0)))


def kfold_stratified(df: DataFrame, label: str, keys: list[str], k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """k folds with every class spread evenly: consecutive stretches of each class's hash order."""
    names = [f"__c{i}" for i in range(1, k)]
    quotas = {m: F.ceil(F.col("n") * (i + 1) / k) for i, m in enumerate(names)}
    joined = with_cutoffs(df, [label], hash_cutoffs(df, [label], keys, seed, quotas))
    h = row_hash(keys, seed)
    fold = sum(((h > F.col(m)).cast("int") for m in names), F.lit(0))
    return joined.withColumn(out, fold).drop(*names)


def kfold_grouped(df: DataFrame, label: str, group: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """k folds that keep each group whole. The groups of each dominant class are ranked by size and hash and dealt out
    back and forth (0, 1, ..., k-1, k-1, ..., 0), so every fold gets large and small groups of every class."""
    cells = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("__n"))
    groups = cells.groupBy(group).agg(F.sum("__n").alias("__rows"), F.max_by(label, F.struct("__n", F.col(label).cast("string"))).alias("__class"))
    groups = groups.withColumn("__h", row_hash([group], seed))
    # Groups of one class and one size are counted by hash prefix, so no class is ranked in one task.
    groups = groups.withColumn("__p", F.substring("__h", 1, PREFIX))
    counts = groups.groupBy("__class", "__rows", "__p").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__class").orderBy(F.desc("__rows"), "__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__class", "__rows", "__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    inside = F.row_number().over(Window.partitionBy("__class", "__rows", "__p").orderBy("__h", group)) - 1
    placed = lookup(groups.withColumn("__i", inside), offsets, ["__class", "__rows", "__p"])
    place = (F.col("__o") + F.col("__i")) % (2 * k)
    folds = placed.select(group, F.when(place < k, place).otherwise(2 * k - 1 - place).cast("int").alias(out))
    return lookup(df, pin_small(folds), [group])


def carve_validation(train: DataFrame, label: str, group: str, k: int = 4, seed: int = 7) -> DataFrame:
    """One grouped fold of train as validation part: adds ``part`` = valid or fit."""
    folded = kfold_grouped(train, label, group, k, seed, "__fold")
    return folded.withColumn("part", F.when(F.col("__fold") == 0, "valid").otherwise("fit")).drop("__fold")


def check_split(df: DataFrame, label: str, group: str, split: str = "split") -> DataFrame:
    """Violations of a grouped split: groups on both sides, classes missing on one side."""
    sides = lambda c: df.groupBy(c).agg(F.min(split).alias("a"), F.max(split).alias("b"))
    shared = sides(group).filter("a <> b").select(F.lit("shared group").alias("violation"), F.col(group).cast("string").alias("value"))
    lone = sides(label).filter("a = b").select(F.lit("class on one side").alias("violation"), F.col(label).cast("string").alias("value"))
    return shared.unionByName(lone)


def bootstrap(df: DataFrame, keys: list[str], value: str, replicates: int = 20, seed: int = 42) -> DataFrame:
    """Poisson bootstrap of a mean: every replicate weights each row by a Poisson(1) count from its hash.
    All replicates are sums in one pass, so rows are never copied once per replicate."""
    weighted = with_poisson(df, keys, replicates, seed)
    aggs = []
    for b in range(1, replicates + 1):
        aggs += [F.sum(f"__w{b}").alias(f"n{b}"), F.sum(F.col(f"__w{b}") * F.col(value)).alias(f"s{b}")]
    rows = [F.struct(F.lit(b).alias("replicate"), F.col(f"n{b}").cast("long").alias("n"), (F.col(f"s{b}") / F.col(f"n{b}")).alias("mean"))
            for b in range(1, replicates + 1)]
    return weighted.agg(*aggs).select(F.inline(F.array(*rows)))


def top_per_group(df: DataFrame, by: list[str], order: list[Column], k: int, out: str = "place") -> DataFrame:
    """The first k rows per group. Spark limits every group before the shuffle, so a hot group costs k rows per task."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(out) <= k)


def exemplars(pred: DataFrame, key: str, hits: int = 2, misses: int = 1) -> DataFrame:
    """Per class the most confident hits and misses of a prediction table (y, pred, p)."""
    marked = pred.withColumn("hit", F.col("y") == F.col("pred"))
    order = [F.desc("p"), F.asc(key)]
    a = top_per_group(marked.filter("hit"), ["y"], order, hits)
    b = top_per_group(marked.filter("not hit"), ["y"], order, misses)
    return a.unionByName(b)


def sample_banded(df: DataFrame, value: str, keys: list[str], bands: list[tuple[float, float]], n: int = 2, seed: int = 42) -> DataFrame:
    """n random rows from every closed value band; bands may overlap."""
    table = F.array(*[F.struct(F.lit(i).alias("band"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"))
                      for i, (lo, hi) in enumerate(bands)])
    matched = F.filter(table, lambda b: (F.col(value) >= b["lo"]) & (F.col(value) <= b["hi"]))
    banded = df.withColumn("__b", F.explode(matched)).withColumn("band", F.col("__b.band")).drop("__b")
    return top_per_group(banded, ["band"], [row_hash(keys, seed)], n, "__place").drop("__place")


def sample_hard_easy(df: DataFrame, p: str, keys: list[str], n_hard: int, n_easy: int, seed: int = 42,
                     lo: float = 0.02, hi: float = 0.98) -> DataFrame:
    """n uncertain and m certain rows in hash order, with the share of uncertain rows in the whole table."""
    hard = (F.col(p) > lo) & (F.col(p) < hi)
    share = df.agg(F.avg(hard.cast("double")).alias("s"))
    marked = df.withColumn("hard", hard)
    quota = F.least(F.col("n"), F.when(F.col("hard"), F.lit(n_hard)).otherwise(F.lit(n_easy)))

    def quotas(sizes: DataFrame) -> DataFrame:
        return sizes.select("hard", quota.alias("quota"))

    return take_in_hash_order(marked, ["hard"], keys, seed, quotas).withColumn("hard_share", share.scalar())


def plot_sample(df: DataFrame, label: str, keys: list[str], n: int, classes: int, seed: int = 42) -> DataFrame:
    """A seeded sample limited to the most frequent classes."""
    top = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n")).orderBy(F.desc("__n"), F.asc(label)).limit(classes)
    return sample_n(df, keys, n, seed).join(F.broadcast(top.select(label)), label, "left_semi")


@dataclass
class FoldSet:
    """A table with a fold column; ``pairs`` yields (train, test) per fold."""

    df: DataFrame
    k: int
    col: str = "fold"

    def pairs(self):
        for i in range(self.k):
            yield i, self.df.filter(F.col(self.col) != i), self.df.filter(F.col(self.col) == i)
