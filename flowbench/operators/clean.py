"""Cleaning: placeholders, missing values, duplicates, outliers. Fitted steps learn from train only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowbench.functions.ordered import clean_double, quantile_map
from flowbench.operators.audit import any_null, is_infinite
from flowbench.sources.schemas import numeric_columns, string_columns


def drop_present(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*cols)


def recode_placeholder(df: DataFrame, value: str, cols: list[str], placeholder: str = "-") -> DataFrame:
    return df.replace({placeholder: value}, subset=cols)


def normalize_label(df: DataFrame, col: str, default: str = "Normal") -> DataFrame:
    """Trim a label; empty, ``nan`` and missing labels become the default."""
    t = F.trim(col)
    return df.withColumn(col, F.when(t.isNull() | t.isin("", "nan"), F.lit(default)).otherwise(t))


def smallest_modes(df: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent value per column, the smallest among ties. Values are counted first, so neither a
    frequent value nor a column with many values becomes the state of one task."""
    if not cols:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in cols])
    counts = (df.select(F.inline(pairs)).filter("v is not null").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("column").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v"))
    return {r["column"]: r["v"] for r in best.collect()}


@dataclass
class ImputerModel:
    """Fill values per column: medians of numeric columns, modes of the others."""

    medians: dict[str, float]
    modes: dict[str, str]

    def apply(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, v in self.medians.items():
            if c in df.columns and v is not None:
                x = F.col(c).cast("double")
                out[c] = F.coalesce(F.when(~F.isnan(x) & ~is_infinite(c), x), F.lit(v))
        for c, v in self.modes.items():
            if c in df.columns and v is not None:
                out[c] = F.coalesce(F.col(c), F.lit(v))
        return df.withColumns(out) if out else df


def fit_imputer(train: DataFrame, numeric: list[str], categorical: list[str]) -> ImputerModel:
    medians = {c: q[0] for c, q in quantile_map(train, numeric, [0.5]).items()} if numeric else {}
    return ImputerModel(medians, smallest_modes(train, categorical))


def missing_policy(df: DataFrame, cols: list[str] | None = None, drop_below: float = 0.01) -> tuple[DataFrame, dict]:
    """Drop rows with a missing value when they are rarer than ``drop_below``, else impute.

    Infinite values count as missing. Returns the new table and a report.
    """
    cols = cols or df.columns
    numeric = numeric_columns(df.select(*cols).schema)
    text = [c for c in cols if c not in numeric]
    fixed = df.withColumns({c: F.when(~is_infinite(c) & ~F.isnan(c), F.col(c)) for c in numeric
                            if dict(df.dtypes)[c] in ("double", "float")})
    r = fixed.agg(F.count(F.lit(1)).alias("n"), F.count_if(any_null(cols)).alias("bad"),
                  *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in cols]).first()
    report = {"rows": r["n"], "rows_with_missing": r["bad"], "missing": {c: r[f"m_{c}"] for c in cols if r[f"m_{c}"]}}
    if r["bad"] == 0:
        return fixed, {**report, "action": "none"}
    if r["bad"] / r["n"] < drop_below:
        return fixed.na.drop(subset=cols), {**report, "action": "drop"}
    holes = report["missing"]
    model = fit_imputer(fixed, [c for c in numeric if c in holes],
                        [c for c in string_columns(fixed.select(*text).schema) if c in holes] if text else [])
    return model.apply(fixed), {**report, "action": "impute"}


def dedup(df: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Remove exact copies. Columns in ``ignore`` are not compared; the row with their smallest values stays."""
    ignore = ignore or []
    keys = [c for c in df.columns if c not in ignore]
    if not ignore:
        return df.dropDuplicates(keys)
    kept = df.groupBy(*keys).agg(F.min(F.struct(*ignore)).alias("__kept"))
    return kept.select(*[F.col(f"__kept.{c}").alias(c) if c in ignore else F.col(c) for c in df.columns])


@dataclass
class ClipModel:
    """Lower and upper limit per column; a missing limit leaves that side open."""

    bounds: dict[str, tuple[float | None, float | None]]

    def _clipped(self, c: str) -> Column:
        lo, hi = self.bounds[c]
        x = F.col(c).cast("double")
        y = x if lo is None else F.greatest(x, F.lit(lo))
        y = y if hi is None else F.least(y, F.lit(hi))
        return F.when(x.isNotNull(), y)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self._clipped(c) for c in self.bounds if c in df.columns})

    def count_clipped(self, df: DataFrame) -> DataFrame:
        """Number of values outside the limits per column, in one pass."""
        cols = [c for c in self.bounds if c in df.columns]
        aggs = [F.count_if(F.col(c).cast("double") != self._clipped(c)).alias(f"k{i}") for i, c in enumerate(cols)]
        rows = [F.struct(F.lit(c).alias("column"), F.lit(self.bounds[c][0]).cast("double").alias("lower"),
                         F.lit(self.bounds[c][1]).cast("double").alias("upper"), F.col(f"k{i}").alias("n_clipped"))
                for i, c in enumerate(cols)]
        return df.agg(*aggs).select(F.inline(F.array(*rows)))


def clip_quantile(train: DataFrame, cols: list[str], lower: float = 0.01, upper: float = 0.99) -> ClipModel:
    return ClipModel({c: (q[0], q[1]) for c, q in quantile_map(train, cols, [lower, upper]).items()})


def clip_iqr(train: DataFrame, cols: list[str], factor: float = 1.5) -> ClipModel:
    out = {}
    for c, (q1, q3) in quantile_map(train, cols, [0.25, 0.75]).items():
        out[c] = (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return ClipModel(out)


def clip_upper(train: DataFrame, cols: list[str], upper: float = 0.999) -> ClipModel:
    return ClipModel({c: (None, q[0]) for c, q in quantile_map(train, cols, [upper]).items()})


def log_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """log1p of the column with negatives set to 0."""
    return df.withColumns({c: F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0))) for c in cols})


def target_log(df: DataFrame, target: str, out: str) -> DataFrame:
    return df.withColumn(out, F.log1p(F.greatest(F.col(target).cast("double"), F.lit(0.0))))


def target_unlog(df: DataFrame, pred: str, out: str, cap: float) -> DataFrame:
    """Back to the original unit, kept inside [0, largest train target]."""
    return df.withColumn(out, F.least(F.greatest(F.expm1(pred), F.lit(0.0)), F.lit(float(cap))))


def drop_leaky(df: DataFrame, leaks: dict[str, list[str]], target: str) -> DataFrame:
    """Drop the columns listed as formulas of the target, and columns derived from them."""
    gone = set(leaks.get(target, []))
    grew = True
    while grew:
        more = {child for parent in gone for child in leaks.get(parent, [])} - gone
        gone |= more
        grew = bool(more)
    return df.drop(*gone)


def filter_rows(df: DataFrame, *conditions: Column | str) -> DataFrame:
    """Rows that meet every condition; one filter so that Catalyst pushes the whole conjunction down."""
    cond = F.lit(True)
    for c in conditions:
        cond = cond & (F.expr(c) if isinstance(c, str) else c)
    return df.filter(cond)


def complete_rows(df: DataFrame, defaults: dict, derived: dict[str, Column] | None = None,
                  conditional: list[tuple[Column, dict]] | None = None, non_negative: list[str] | None = None) -> DataFrame:
    """Complete partial rows: conditional defaults first, then plain defaults, limits at zero, derived columns."""
    for cond, values in conditional or []:
        df = df.withColumns({c: F.when(cond & F.col(c).isNull(), F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})
    present = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in df.columns}
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    df = df.withColumns({**present, **absent})
    if non_negative:
        df = df.withColumns({c: F.greatest(F.col(c), F.lit(0)) for c in non_negative})
    return df.withColumns(derived) if derived else df


def numeric_template(train: DataFrame, exclude: list[str] | None = None) -> dict:
    """Median of every numeric column and mode of every string column of train."""
    model = fit_imputer(train, numeric_columns(train.schema, exclude), string_columns(train.schema, exclude))
    return {**model.medians, **model.modes}


def double_or_null(c: str) -> Column:
    return clean_double(c)
