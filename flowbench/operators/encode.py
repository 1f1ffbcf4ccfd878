"""Levels, one-hot columns, scaling, bins and weights. Each step is fitted on train and applied anywhere."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, PolynomialExpansion, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowbench.functions.ordered import clean_double, quantile_map, sorted_position
from flowbench.functions.small import collect_small, lookup, pin_small
from flowbench.sources.schemas import numeric_columns

# More levels than this are too many for a column each (``fit_one_hot_vector`` takes them) or for one expression.
FEW_LEVELS = 1_000


def level_table(train: DataFrame, col: str, min_count: int | None = None, min_share: float | None = None,
                top_n: int | None = None) -> DataFrame:
    """Levels worth keeping, as a table with the one column ``level``. Equal counts are ordered by value."""
    counts = train.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    if min_count is not None:
        counts = counts.filter(F.col("n") >= min_count)
    if min_share is not None:
        total = train.filter(F.col(col).isNotNull()).agg(F.count(F.lit(1)).alias("t"))
        counts = counts.filter(F.col("n") >= F.lit(min_share) * total.scalar())
    if top_n is not None:
        counts = counts.orderBy(F.desc("n"), F.asc("level")).limit(top_n)
    return counts.select("level")


@dataclass
class LevelModel:
    """Keep the fitted levels of a column, fold every other value into ``other``."""

    col: str
    levels: DataFrame
    other: object = "other"

    def apply(self, df: DataFrame, out: str | None = None) -> DataFrame:
        keep = self.levels.select(F.col("level").alias(self.col), F.lit(True).alias("__keep"))
        joined = lookup(df, keep, [self.col])
        folded = F.when(F.col("__keep"), F.col(self.col)).otherwise(F.lit(self.other))
        return joined.withColumn(out or self.col, folded).drop("__keep")


def fold_rare(train: DataFrame, col: str, min_count: int | None = 20, min_share: float | None = None,
              other: object = "other") -> LevelModel:
    """Fold levels below a count or a share. The table of kept levels is broadcast only when it is small."""
    if min_share is not None:
        min_count = None
    return LevelModel(col, pin_small(level_table(train, col, min_count, min_share)), other)


def fold_rare_columns(train: DataFrame, cols: list[str], min_count: int = 20, other: object = "other") -> list[LevelModel]:
    """``fold_rare`` for several string columns with one pass over train."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in cols])
    counts = train.select(F.inline(pairs)).filter("level is not null").groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
    kept = pin_small(counts.filter(F.col("n") >= min_count).select("column", "level"))
    return [LevelModel(c, kept.filter(F.col("column") == c).select("level"), other) for c in cols]


def bucket_top_values(train: DataFrame, col: str, n: int, other: object = -1, legacy_counts: bool = False) -> LevelModel:
    """Keep the n most frequent values. ``legacy_counts`` keeps values that equal one of the n largest
    *counts*, which reproduces published numbers made with that mistake."""
    if legacy_counts:
        counts = train.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(col)).limit(n)
        kind = train.schema[col].dataType
        return LevelModel(col, pin_small(counts.select(F.col("n").cast(kind).alias("level")).distinct()), other)
    return LevelModel(col, pin_small(level_table(train, col, top_n=n)), other)


@dataclass
class OneHotModel:
    """0/1 columns per fitted level. ``infrequent`` levels share one column; unknown levels are all zero."""

    levels: dict[str, list]
    infrequent: dict[str, list] = field(default_factory=dict)

    def names(self) -> list[str]:
        out = []
        for c, ls in self.levels.items():
            out += [f"{c}_{v}" for v in ls]
            if self.infrequent.get(c):
                out.append(f"{c}_infrequent")
        return out

    def apply(self, df: DataFrame, keep: bool = False) -> DataFrame:
        cols: dict[str, Column] = {}
        for c, ls in self.levels.items():
            for v in ls:
                cols[f"{c}_{v}"] = F.when(F.col(c) == F.lit(v), 1.0).otherwise(0.0)
            if self.infrequent.get(c):
                cols[f"{c}_infrequent"] = F.when(F.col(c).isin(self.infrequent[c]), 1.0).otherwise(0.0)
        out = df.withColumns(cols)
        return out if keep else out.drop(*self.levels)


def fit_one_hot(train: DataFrame, cols: list[str], policy: str = "dummies", min_frequency: int = 20) -> OneHotModel:
    """``drop_first`` leaves out the smallest level, ``infrequent`` pools rare levels, ``dummies`` keeps all."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in cols])
    counts = train.select(F.inline(pairs)).filter("v is not null").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    rows = collect_small(counts, FEW_LEVELS, "table with a column a level (use fit_one_hot_vector)")
    found: dict[str, list] = {c: sorted((r["v"], r["n"]) for r in rows if r["column"] == c) for c in cols}
    if policy == "drop_first":
        return OneHotModel({c: [v for v, _ in ls[1:]] for c, ls in found.items()})
    if policy == "infrequent":
        return OneHotModel({c: [v for v, n in ls if n >= min_frequency] for c, ls in found.items()},
                           {c: [v for v, n in ls if n < min_frequency] for c, ls in found.items()})
    if policy != "dummies":
        raise ValueError(f"unknown policy {policy}")
    return OneHotModel({c: [v for v, _ in ls] for c, ls in found.items()})


@dataclass
class SparseOneHot:
    """One sparse vector per row: a slot per fitted level of every column, in the order of columns and levels; unknown and missing levels
    are all zero. The level table (column, level, slot) is joined, so it may have any number of rows."""

    cols: list[str]
    table: DataFrame
    widths: dict[str, int]

    def apply(self, df: DataFrame, out: str = "onehot") -> DataFrame:
        cur, one_hot = df, {c: f"__i{i}" for i, c in enumerate(self.cols)}
        for i, c in enumerate(self.cols):
            mine = self.table.filter(F.col("column") == c).select(F.col("level").alias(f"__l{i}"), F.col("slot").alias(f"__s{i}"))
            cur = cur.withColumn(f"__l{i}", F.col(c).cast("string"))
            cur = lookup(cur, pin_small(mine), [f"__l{i}"]).withColumn(one_hot[c], F.coalesce(f"__s{i}", F.lit(self.widths[c])).cast("double")).drop(f"__l{i}", f"__s{i}")
        widest = df.sparkSession.createDataFrame([tuple(float(max(self.widths[c], 1) - 1) for c in self.cols)], [one_hot[c] for c in self.cols])
        vectors = [f"__v{i}" for i in range(len(self.cols))]
        # The last category of the encoder is the one for unknown levels, and it is dropped.
        model = OneHotEncoder(inputCols=list(one_hot.values()), outputCols=vectors, handleInvalid="keep", dropLast=True).fit(widest)
        encoded = VectorAssembler(inputCols=vectors, outputCol=out).transform(model.transform(cur))
        return encoded.drop(*one_hot.values(), *vectors)


def fit_one_hot_vector(train: DataFrame, cols: list[str], policy: str = "dummies", min_frequency: int = 20) -> SparseOneHot:
    """Like ``fit_one_hot`` for columns with many levels; ``infrequent`` sends all rare levels of a column to its last slot."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols])
    counts = train.select(F.inline(pairs)).filter("level is not null").groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
    if policy not in ("dummies", "drop_first", "infrequent"):
        raise ValueError(f"unknown policy {policy}")
    counts = counts.withColumn("rare", (F.col("n") < min_frequency) if policy == "infrequent" else F.lit(False))
    placed = sorted_position(counts, ["column", "rare", "level"])
    about = placed.groupBy("column").agg(F.min("position").alias("first"), F.count_if(~F.col("rare")).alias("common"), F.count_if("rare").alias("rares"))
    slot = F.least(F.col("position") - F.col("first"), F.col("common")) - (1 if policy == "drop_first" else 0)
    table = placed.join(F.broadcast(about), "column").select("column", "level", slot.alias("slot")).filter("slot >= 0")
    found = {r["column"]: r["common"] + min(r["rares"], 1) - (1 if policy == "drop_first" else 0) for r in about.collect()}
    return SparseOneHot(cols, table, {c: found.get(c, 0) for c in cols})


@dataclass
class IndexModel:
    """Sorted levels as 0..k-1; unseen or missing levels are -1. Few levels are an expression, many a joined table (level, index)."""

    col: str
    few: list | None
    table: DataFrame | None = None

    @property
    def levels(self) -> list:
        """All levels, for models that hold something for each class."""
        return self.few if self.few is not None else [r["level"] for r in collect_small(self.table.orderBy("index"), what=f"classes of {self.col}")]

    def apply(self, df: DataFrame, out: str) -> DataFrame:
        if self.few is not None:
            pos = F.array_position(F.array(*[F.lit(v) for v in self.few]), F.col(self.col)).cast("int") - 1
            return df.withColumn(out, F.coalesce(pos, F.lit(-1)))
        found = lookup(df, pin_small(self.table.select(F.col("level").alias(self.col), F.col("index").alias("__index"))), [self.col])
        return found.withColumn(out, F.coalesce("__index", F.lit(-1))).drop("__index")

    def invert(self, df: DataFrame, index: str, out: str) -> DataFrame:
        i = F.col(index).cast("int")
        if self.few is not None:
            return df.withColumn(out, F.when(i >= 0, F.get(F.array(*[F.lit(v) for v in self.few]), i)))
        named = pin_small(self.table.select(F.col("index").alias("__index"), F.col("level").alias("__level")))
        return lookup(df.withColumn("__index", i), named, ["__index"]).withColumn(out, F.col("__level")).drop("__index", "__level")


def index_labels(train: DataFrame, col: str) -> IndexModel:
    distinct = train.select(F.col(col).alias("level")).filter("level is not null").distinct()
    few = distinct.limit(FEW_LEVELS + 1).collect()
    if len(few) <= FEW_LEVELS:
        return IndexModel(col, sorted(r[0] for r in few))
    return IndexModel(col, None, sorted_position(distinct, ["level"], "index").select("level", F.col("index").cast("int")))


@dataclass
class ScaleModel:
    """Mean and population standard deviation per column; a constant column becomes 0."""

    stats: dict[str, tuple[float, float]]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s if s else 1.0)
                               for c, (m, s) in self.stats.items() if c in df.columns})


def standardize(train: DataFrame, cols: list[str]) -> ScaleModel:
    r = train.agg(*[F.avg(clean_double(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                  *[F.stddev_pop(clean_double(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return ScaleModel({c: (r[f"m{i}"] or 0.0, r[f"s{i}"] or 0.0) for i, c in enumerate(cols)})


def select_continuous(train: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Numeric columns with more than two distinct values: some value lies strictly between the extremes.
    Exact in two passes that keep two numbers per column."""
    cols = numeric_columns(train.schema, exclude)
    lim = train.agg(*[F.min(c).alias(f"a{i}") for i, c in enumerate(cols)], *[F.max(c).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    inner = train.agg(*[F.max((F.col(c) > F.lit(lim[f"a{i}"])) & (F.col(c) < F.lit(lim[f"b{i}"]))).alias(f"m{i}")
                        for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if inner[f"m{i}"]]


@dataclass
class FeaturePlan:
    """Names of the vector's entries, in order."""

    names: list[str]
    output: str = "features"

    def assemble(self, df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=self.names, outputCol=self.output).transform(df)


def polynomial(df: DataFrame, col: str = "features", out: str = "poly", degree: int = 2) -> DataFrame:
    return PolynomialExpansion(degree=degree, inputCol=col, outputCol=out).transform(df)


@dataclass
class BinModel:
    """Right-closed quantile bins; equal edges are merged."""

    col: str
    edges: list[float]

    def column(self) -> Column:
        x = clean_double(self.col)
        inner = self.edges[1:-1]
        below = F.size(F.filter(F.array(*[F.lit(e) for e in inner]), lambda e: e < x)) if inner else F.lit(0)
        return F.when(x.isNotNull(), below.cast("int"))

    def apply(self, df: DataFrame, out: str = "bin") -> DataFrame:
        return df.withColumn(out, self.column())


def quantile_bins(train: DataFrame, col: str, q: int = 10) -> BinModel:
    edges = quantile_map(train, [col], [i / q for i in range(q + 1)])[col]
    return BinModel(col, sorted(set(edges)))


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """Per class: n / (number of classes * class count)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg((F.sum("n") / F.count(F.lit(1))).alias("t"))
    return counts.select(label, (whole.scalar() / F.col("n")).alias("weight"))


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Row weight that gives every class the same total."""
    return lookup(df, pin_small(class_weights(df, label).withColumnRenamed("weight", out)), [label])
