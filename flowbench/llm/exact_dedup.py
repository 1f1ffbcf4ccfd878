"""Exact de-duplication by deterministic block naming, in DataFrame operations only.

A normalised text is cut into blocks of a fixed number of bytes. Equal blocks get the same integer name, different blocks
different ones, by sorting the distinct blocks. Then neighbouring names are named in pairs, again by sorting, until one
name stands for the whole text (Karp, Miller and Rosenberg's naming). Names cannot collide: two texts share their last
name exactly when all their blocks are equal.

Blocks travel as 64-bit labels, and their bytes are shuffled once, to prove that no two different blocks share a label; if
any do, the labels are drawn again with another seed. Copies are folded before every shuffle, so a hot group of copies is
one row per task, and the long tables hold labels and names only.

Defined results: a null text is an empty one; an empty table gives an empty result; rows that repeat both id and text all
carry the same answer; null ids come last when the row that stays is chosen; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowbench.llm.common import SPACES, fixed, sorted_names, text_or_empty

BLOCK_BYTES = 16_384


def normalised(col: str) -> Column:
    return F.regexp_replace(text_or_empty(col), SPACES, " ")


def _blocks(raw: Column, size: int) -> Column:
    """Blocks of ``size`` bytes, at least one."""
    last = F.greatest(F.octet_length(raw) - 1, F.lit(0))
    starts = F.sequence(F.lit(0), (last / size).cast("int"))
    return F.transform(starts, lambda i: F.substring(raw, i * size + 1, F.lit(size)))


def _proven_labels(texts: DataFrame, size: int, label) -> tuple[DataFrame, int]:
    """Distinct block labels, and the seed under which no two different blocks share one."""
    seed = 0
    while True:
        blocks = texts.select(F.explode(_blocks(F.col("raw"), size)).alias("block"))
        contents = blocks.select(label(F.col("block"), seed).alias("label"), "block").groupBy("label", "block").agg(F.count("*").alias("n"))
        labels = fixed(contents.groupBy("label").agg(F.count("*").alias("contents")), "block-labels")
        if not labels.filter("contents > 1").limit(1).collect():
            return labels.select("label"), seed
        seed += 1


def _label(block: Column, seed: int) -> Column:
    return F.xxhash64(block, F.lit(seed))


def text_identity(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, label=_label) -> DataFrame:
    """One row per input row: id, ``text_sha256``, ``levels`` and ``name``; (levels, name) is equal exactly for equal texts.

    ``label(block, seed)`` is the 64-bit label of a block; any function of the two that can tell blocks apart for some
    seed gives the same result.
    """
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), normalised(text_col).alias("norm")).withColumn("raw", F.col("norm").cast("binary"))
    labels, seed = _proven_labels(texts, block_bytes, label)
    rows = fixed(texts.select("id", F.sha2("raw", 256).alias("text_sha256"),
                              F.transform(_blocks(F.col("raw"), block_bytes), lambda b: label(b, seed)).alias("labels")), "block-rows")
    named = fixed(sorted_names(labels, ["label"]), "block-names")
    # Texts with the same list of labels go through the naming once.
    lists = fixed(rows.select("labels").distinct().withColumn("list_id", F.monotonically_increasing_id()), "block-lists")
    level = (lists.select("list_id", F.posexplode("labels").alias("pos", "label")).join(named, "label")
             .select("list_id", "pos", "name", F.lit(0).alias("levels")))
    size = F.size("labels")
    done = level.join(lists.filter(size == 1).select("list_id"), "list_id", "left_semi").select("list_id", "levels", "name")
    level = level.join(lists.filter(size > 1).select("list_id"), "list_id", "left_semi")
    most = lists.agg(F.max(size)).first()[0] or 1
    depth = 0
    while most > 1:
        depth += 1
        half = F.floor(F.col("pos") / 2).cast("int")
        pairs = fixed(level.groupBy("list_id", half.alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left_name"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right_name")), "block-pairs")
        named = fixed(sorted_names(pairs, ["left_name", "right_name"]), "block-names")
        level = pairs.join(named, ["left_name", "right_name"]).select("list_id", "pos", "name", F.lit(depth).alias("levels"))
        # A list is finished at the level at which it has one name left.
        counts = lists.select("list_id", F.ceil(size / F.lit(float(2 ** depth))).alias("left"), F.ceil(size / F.lit(float(2 ** (depth - 1)))).alias("before"))
        done = done.unionByName(level.join(counts.filter("left = 1 and before > 1").select("list_id"), "list_id", "left_semi").select("list_id", "levels", "name"))
        level = level.join(counts.filter("left > 1").select("list_id"), "list_id", "left_semi")
        most = -(-most // 2)
    identity = lists.join(done, "list_id").select("labels", "levels", "name")
    return rows.join(identity, "labels").select(F.col("id").alias(id_col), "text_sha256", "levels", "name")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, label=_label) -> DataFrame:
    """``id``, ``keep_id`` (smallest id of the rows with an equal text), ``group_size``, ``kept``, ``text_sha256``."""
    rows = fixed(text_identity(docs, id_col, text_col, block_bytes, label).withColumnRenamed(id_col, "id"), "text-identity")
    groups = rows.groupBy("levels", "name").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    return rows.join(groups, ["levels", "name"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
