"""Shards of near equal bytes by a k-d tree over the metadata of documents.

A node that stands for several shards is split along its widest dimension at a weighted median: the place where the bytes
before it are the share of the shards on its left. Splitting ends when a node stands for one shard, which holds the target bytes.

The place is found without moving a row. All open nodes are looked at in one pass: their rows are counted into cells between the
least and the greatest value, running sums over the cells tell in which one the median lies, and the next pass looks into that cell
only. Rows with the same value are told apart by the hash of their text, then of their id, so a source or a group of copies with a
third of all rows is cut like any other, and equal texts lie side by side. A pass ends for a node when its cell holds less than
``tolerance`` of a shard.

The tree is a table of splits a level, so documents are routed where they lie and move once, to their shard.

Positions: text columns by their first six bytes, numbers by a signed logarithm. Widths are relative to the whole table's.

Defined results: a null text has no bytes (size 1); null or unreadable metadata count as empty or 0; rows that agree in id, text and
all dimensions are not told apart; ids may repeat or be null; fewer rows than shards leave shards empty; an empty table gives an
empty result; columns named ``size``, ``shard`` or ``slot`` are replaced, all others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from flowbench.functions.small import SMALL_ROWS, pin_small
from flowbench.llm.common import fixed, text_or_empty

CELLS = 4096
TOLERANCE = 0.0005
SLICE_BYTES = 16 << 20
TIE_END = 1 << 62
_KEY = ["__node", "__parts"]


def text_size(text_col: str = "text") -> Column:
    """Bytes of the text in UTF-8, and one for its end."""
    return (F.octet_length(text_or_empty(text_col)) + F.lit(1)).cast("long")


def _position(df: DataFrame, name: str) -> Column:
    raw = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, NumericType):
        x = F.coalesce(F.nanvl(raw.cast("double"), F.lit(0.0)), F.lit(0.0))
        return F.signum(x) * F.least(F.log1p(F.abs(x)), F.lit(1e3))
    first = F.rpad(F.hex(F.substring(F.coalesce(raw.cast("string"), F.lit("")).cast("binary"), 1, 6)), 12, "0")
    return F.conv(first, 16, 10).cast("double")


def _keyed(docs: DataFrame, dims: list[str], id_col: str, text_col: str) -> DataFrame:
    """``docs`` with position, tie-breaker (62 bits: text first, then id and metadata) and size."""
    text = F.shiftleft(F.shiftrightunsigned(F.xxhash64(text_or_empty(text_col)), 34), 32)
    rest = F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in [id_col, *dims]]), 32)
    return docs.withColumns({"__pos": F.array(*[_position(docs, d) for d in dims]), "__tie": text.bitwiseOR(rest), "__size": text_size(text_col)})


def _settled(df: DataFrame) -> DataFrame:
    """``df`` computed once: broadcast up to the limit of ``pin_small``, written down and joined by shuffle beyond it."""
    rows = df.limit(SMALL_ROWS + 1).collect()
    return fixed(df, "kd-nodes") if len(rows) > SMALL_ROWS else F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def _before(pos: Column, tie: Column) -> Column:
    return (pos < F.col("cut_pos")) | ((pos == F.col("cut_pos")) & (tie < F.col("cut_tie")))


def _descend(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows one level further down; nodes without a split keep their rows."""
    at = rows.join(splits, _KEY, "left")
    half = F.floor(F.col("__parts") / 2).cast("int")
    left = _before(F.col("__pos")[F.col("dim")], F.col("__tie"))
    whole = F.col("dim").isNull()
    return at.withColumns({
        "__node": F.when(whole | left, F.col("__node")).otherwise(F.col("__node") + half),
        "__parts": F.when(whole, F.col("__parts")).when(left, half).otherwise(F.col("__parts") - half),
    }).drop("dim", "cut_pos", "cut_tie")


def _open_nodes(rows: DataFrame, spans: list[float], tolerance: float) -> DataFrame:
    """Nodes to split: widest dimension, range of its values, bytes wanted on the left."""
    d = range(len(spans))
    low, high = [F.min(F.col("__pos")[i]).alias(f"lo{i}") for i in d], [F.max(F.col("__pos")[i]).alias(f"hi{i}") for i in d]
    node = rows.filter("__parts > 1").groupBy(*_KEY).agg(F.sum("__size").alias("bytes"), F.min("__tie").alias("tie_lo"), F.max("__tie").alias("tie_hi"), *low, *high)
    width = F.array(*[(F.col(f"hi{i}") - F.col(f"lo{i}")) / F.lit(spans[i] or 1.0) for i in d])
    node = node.withColumn("dim", (F.array_position(width, F.array_max(width)) - 1).cast("int"))
    share = F.floor(F.col("__parts") / 2) / F.col("__parts")
    return node.select(*_KEY, "dim", F.array(*[F.col(f"lo{i}") for i in d])[F.col("dim")].alias("lo"), F.array(*[F.col(f"hi{i}") for i in d])[F.col("dim")].alias("hi"),
                       "tie_lo", "tie_hi", F.lit(False).alias("tied"), (F.col("bytes") * share).alias("need"),
                       (F.col("bytes") / F.col("__parts") * tolerance).alias("slack"), F.lit(None).cast("double").alias("cut_pos"), F.lit(None).cast("long").alias("cut_tie"))


def _look_closer(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """One pass over the rows of open nodes: the cell in which the wanted place lies, or the cut itself."""
    at = rows.join(nodes, _KEY).withColumn("at", F.col("__pos")[F.col("dim")]).filter(
        F.when(F.col("tied"), (F.col("at") == F.col("lo")) & F.col("__tie").between(F.col("tie_lo"), F.col("tie_hi"))).otherwise(F.col("at").between(F.col("lo"), F.col("hi"))))
    line = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("at") - F.col("lo")) / (F.col("hi") - F.col("lo")) * CELLS)).otherwise(0)
    cell = F.when(F.col("tied"), F.expr(f"(__tie - tie_lo) div ((tie_hi - tie_lo) div {CELLS} + 1)")).otherwise(F.least(line, F.lit(CELLS - 1))).cast("int")
    per_node = ["dim", "tied", "need", "slack"]
    cells = at.groupBy(*_KEY, *per_node, cell.alias("cell")).agg(F.sum("__size").alias("bytes"), F.min("at").alias("lo"), F.max("at").alias("hi"),
                                                                 F.min("__tie").alias("tie_lo"), F.max("__tie").alias("tie_hi"))
    order = Window.partitionBy(*_KEY).orderBy("cell")
    upto = cells.withColumn("upto", F.sum("bytes").over(order))
    last = F.row_number().over(Window.partitionBy(*_KEY).orderBy(F.desc("cell"))) == 1
    # Rounding can put the wanted place just past the last cell.
    hit = upto.withColumn("last", last).filter(((F.col("upto") >= F.col("need")) | F.col("last")) & (F.col("upto") - F.col("bytes") < F.col("need")))
    found = (F.col("bytes") <= F.col("slack")) | (F.col("tied") & (F.col("tie_lo") == F.col("tie_hi")))
    after = F.col("upto") - F.col("need") < F.col("need") - (F.col("upto") - F.col("bytes"))
    tie = F.when(F.col("tied"), F.when(after, F.col("tie_hi") + 1).otherwise(F.col("tie_lo"))).otherwise(F.when(after, F.lit(TIE_END)).otherwise(F.lit(0)))
    return hit.select(*_KEY, "dim", "lo", "hi", "tie_lo", "tie_hi", (F.col("tied") | (F.col("lo") == F.col("hi"))).alias("tied"),
                      (F.col("need") - (F.col("upto") - F.col("bytes"))).alias("need"), "slack",
                      F.when(found, F.when(after, F.col("hi")).otherwise(F.col("lo"))).alias("cut_pos"), F.when(found, tie.cast("long")).alias("cut_tie"))


@dataclass
class KdTree:
    """Splits a level: node (its first shard), parts, dimension, and the first key that lies to the right."""

    dims: list[str]
    id_col: str
    text_col: str
    levels: list[DataFrame]
    shards: int
    total: int

    def descend(self, rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({"__node": F.lit(0), "__parts": F.lit(self.shards)})
        for splits in self.levels:
            rows = _descend(rows, splits)
        return rows

    def route(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``shard``; also for documents the tree was not made from."""
        return self.descend(_keyed(docs, self.dims, self.id_col, self.text_col)).withColumn("shard", F.col("__node")).drop("__node", "__parts", "__pos", "__tie", "__size")


def fit_tree(rows: DataFrame, dims: list[str], shards: int, id_col: str, text_col: str, tolerance: float = TOLERANCE) -> KdTree:
    """The tree of ``rows`` (positions, tie-breakers and sizes, written down)."""
    d = range(len(dims))
    root = rows.agg(F.sum("__size").alias("total"), *[(F.max(F.col("__pos")[i]) - F.min(F.col("__pos")[i])).alias(f"w{i}") for i in d]).first()
    tree = KdTree(dims, id_col, text_col, [], shards, root["total"] or 0)
    spans = [root[f"w{i}"] or 0.0 for i in d]
    at = rows.withColumns({"__node": F.lit(0), "__parts": F.lit(shards)})
    parts = shards
    while parts > 1 and tree.total:
        nodes = _settled(_open_nodes(at, spans, tolerance))
        done = []
        while not nodes.isEmpty():
            seen = _settled(_look_closer(at, nodes))
            done.append(seen.filter("cut_pos IS NOT NULL").select(*_KEY, "dim", "cut_pos", "cut_tie"))
            nodes = _settled(seen.filter("cut_pos IS NULL"))
        cuts = _settled(reduce(DataFrame.unionByName, done))
        tree.levels.append(cuts)
        parts = -(-parts // 2)
        if parts > 1:
            at = fixed(_descend(at, cuts), "kd-rows")
    return tree


def kd_shards(docs: DataFrame, dims: list[str], shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text",
              tolerance: float = TOLERANCE, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot`` (gapless from 0 in its shard), lying together by shard.

    Give the number of shards, or the bytes one shard should hold. A shard is moved in slices of some ``slice_bytes``, so no task
    holds a whole one.
    """
    rows = fixed(_keyed(docs, dims, id_col, text_col).select("__pos", "__tie", "__size"), "kd-keys")
    if shards is None:
        if not target_bytes:
            raise ValueError("give shards or target_bytes")
        shards = max(1, -(-(rows.agg(F.sum("__size")).first()[0] or 0) // target_bytes))
    tree = fit_tree(rows, dims, shards, id_col, text_col, tolerance)
    part = F.pmod(F.xxhash64("__tie"), F.lit(tree.total // shards // slice_bytes + 1))
    key = ["__node", "__slice"]
    counts = tree.descend(rows).withColumn("__slice", part).groupBy(*key).agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy("__node").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*key, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"))
    placed = tree.descend(_keyed(docs, dims, id_col, text_col)).withColumn("__slice", part)
    inside = Window.partitionBy(*key).orderBy("__tie", F.col(f"`{id_col}`"))
    placed = placed.withColumn("__rank", F.row_number().over(inside) - 1).join(pin_small(starts), key)
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("size", "shard", "slot")]
    return placed.select(*keep, F.col("__size").alias("size"), F.col("__node").cast("int").alias("shard"), (F.col("__first") + F.col("__rank")).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard; files follow the slices."""
    sharded.write.partitionBy("shard").parquet(path)
