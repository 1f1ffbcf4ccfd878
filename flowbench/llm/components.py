"""Connected components of a table of links, in rounds of joins over ever fewer links."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowbench.llm.common import fixed


def union_find(pairs) -> dict[int, int]:
    """Node -> smallest node reachable, for the nodes of some pairs."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def _forest(batches):
    """Each partition's links as a forest of stars: the same components with fewer links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    roots: dict[int, int] = {}
    for batch in batches:
        roots = union_find([*roots.items(), *zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())])
    stars = [(x, r) for x, r in roots.items() if x != r]
    for i in range(0, len(stars), 100_000):
        a, b = zip(*stars[i:i + 100_000])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)


def connected(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has a link; ``links`` has long columns a and b.

    Union-find inside partitions leaves a forest. In each round every node hooks onto its smallest neighbour, hooks are
    followed to their end by pointer jumping, and links between different ends remain; at least half of the nodes go.
    Links with a null or with itself are ignored.
    """
    spark = links.sparkSession
    edges = fixed(links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b").mapInArrow(_forest, "a long, b long"), "links")
    roots = spark.createDataFrame([], "node long, root long")
    first = True
    while edges.limit(1).collect():
        both = edges.union(edges.select("b", "a"))
        hooks = fixed(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("up")), "hooks")
        while True:
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = fixed(hooks.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"), (F.col("top") < F.col("up")).alias("moved")), "hooks")
            hooks = jumped.select("node", "up")
            if not jumped.filter("moved").limit(1).collect():
                break
        if first:
            roots, first = hooks.withColumnRenamed("up", "root"), False
        else:
            up = hooks.select(F.col("node").alias("root"), "up")
            roots = fixed(roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        a, b = hooks.select(F.col("node").alias("a"), F.col("up").alias("up_a")), hooks.select(F.col("node").alias("b"), F.col("up").alias("up_b"))
        edges = fixed(edges.join(a, "a").join(b, "b").select(F.col("up_a").alias("a"), F.col("up_b").alias("b")).filter("a <> b").distinct()
                      .mapInArrow(_forest, "a long, b long"), "links")
    return roots
