"""Density clusters in few dimensions over a grid (Gunawan 2013; Gan and Tao 2015).

Cells have side eps / sqrt(d), so rows of one cell are neighbours. Equal rows are one site with a weight. A cell of enough rows is core as
a whole; only the sites of other cells count their neighbours, in the cells within reach. Core sites of a cell belong together, so
clusters are components of cells: two cells are linked when some core sites are within eps. That is told from boxes around the sites of
small parts of the cells - all of two boxes within eps, or none - and sites are compared only where boxes leave it open and no other
part of the two cells has settled it. A crowded cell is cut into blocks by hash, and pairs of rows never leave a join.
"""

from __future__ import annotations

from functools import reduce
from itertools import product
from math import ceil, sqrt

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowbench.session import write_through

MAX_DIMS = 3
PARTS = 8
TILE = 32
BLOCK_SITES = 20_000


def _d2(a: str, b: str, d: int) -> Column:
    return reduce(lambda x, y: x + y, [(F.col(f"{a}{i}") - F.col(f"{b}{i}")) * (F.col(f"{a}{i}") - F.col(f"{b}{i}")) for i in range(d)])


def _around(sites: DataFrame, d: int, half: bool = False) -> DataFrame:
    """Rows once for every cell within reach (or one of each two directions), in columns c0.. ; their own cell becomes o0.. ."""
    reach = ceil(sqrt(d) * (1 + 1e-6))
    steps = [s for s in product(range(-reach, reach + 1), repeat=d) if sum(max(abs(x) - 1, 0) ** 2 for x in s) <= d * (1 + 1e-6)]
    steps = [s for s in steps if s > (0,) * d] if half else steps
    moves = F.array(*[F.array(*[F.lit(x) for x in s]) for s in steps])
    out = sites.withColumn("__s", F.explode(moves))
    return out.select(*[c for c in sites.columns if c not in {f"c{i}" for i in range(d)}], *[F.col(f"c{i}").alias(f"o{i}") for i in range(d)],
                      *[(F.col(f"c{i}") + F.col("__s")[i]).alias(f"c{i}") for i in range(d)])


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def _near_sites(asking: DataFrame, sites: DataFrame, d: int) -> DataFrame:
    """Every asking site beside the sites of all cells within reach; the caller folds the pairs at once."""
    cell = [f"c{i}" for i in range(d)]
    there = _renamed(sites.select(*cell, "__block", "x", "n", "first"), {"x": "y", "n": "n_y", "first": "first_y"}).select("*", *[F.col("y")[i].alias(f"y{i}") for i in range(d)]).drop("y")
    spans = sites.groupBy(*cell).agg(F.max("__block").alias("__last"))
    here = _around(asking.select("first", *cell, *[F.col("x")[i].alias(f"x{i}") for i in range(d)]), d).join(spans, cell)
    here = here.withColumn("__block", F.explode(F.sequence(F.lit(0), "__last"))).drop("__last")
    return here.join(there, [*cell, "__block"])


def _folded(group: pd.DataFrame) -> pd.DataFrame:
    """Links inside one tile as a star around each part's smallest node."""
    nodes, at = np.unique(group[["a", "b"]].to_numpy(), return_inverse=True)
    at, top = at.reshape(-1, 2), np.arange(len(nodes))
    while True:
        low = top.copy()
        m = np.minimum(low[at[:, 0]], low[at[:, 1]])
        np.minimum.at(low, at[:, 0], m)
        np.minimum.at(low, at[:, 1], m)
        low = low[low]
        if (low == top).all():
            return pd.DataFrame({"node": nodes, "root": nodes[top]})
        top = low


def _cell_links(core: DataFrame, d: int, side: float, eps: float) -> DataFrame:
    """(a, b): smallest core keys of linked cells, and whether both lie in one tile; every core cell is linked with itself."""
    cell = [f"c{i}" for i in range(d)]
    part = [F.floor((F.col("x")[i] / side - F.col(f"c{i}")) * PARTS).cast("int").alias(f"p{i}") for i in range(d)]
    boxes = core.groupBy(*cell, *part).agg(F.min("first").alias("first"), *[f(F.col("x")[i]).alias(f"{n}{i}") for i in range(d) for f, n in ((F.min, "lo"), (F.max, "hi"))])
    names = core.groupBy(*cell).agg(F.min("first").alias("name"))
    boxes = write_through(boxes.join(names, cell), "boxes")
    other = _renamed(boxes, {**{f"{n}{i}": f"{n}_{i}" for i in range(d) for n in ("lo", "hi")}, **{f"p{i}": f"q{i}" for i in range(d)}, "name": "b"}).drop("first")
    pairs = _around(_renamed(boxes, {"name": "a"}).drop("first"), d, half=True).join(other, cell)
    gap = [F.greatest(F.col(f"lo{i}") - F.col(f"hi_{i}"), F.col(f"lo_{i}") - F.col(f"hi{i}"), F.lit(0.0)) for i in range(d)]
    wide = [F.greatest(F.col(f"hi{i}") - F.col(f"lo_{i}"), F.col(f"hi_{i}") - F.col(f"lo{i}")) for i in range(d)]
    squares = lambda xs: reduce(lambda x, y: x + y, [x * x for x in xs])
    limit = eps * (1 + 1e-12)
    pairs = pairs.withColumns({"near": F.sqrt(squares(gap)), "far": F.sqrt(squares(wide))}).filter(F.col("near") <= limit)
    here, there = [f"o{i}" for i in range(d)], [f"p{i}" for i in range(d)]
    pairs = pairs.select("a", "b", *here, *there, *cell, *[f"q{i}" for i in range(d)], "far")
    settled = F.min("far").over(Window.partitionBy("a", "b")) <= limit
    pairs = write_through(pairs.withColumn("settled", settled), "box-pairs")
    sites = core.select(*cell, *part, *[F.col("x")[i].alias(f"x{i}") for i in range(d)])
    left = _renamed(sites, {f"c{i}": f"o{i}" for i in range(d)})
    right = _renamed(sites, {**{f"p{i}": f"q{i}" for i in range(d)}, **{f"x{i}": f"y{i}" for i in range(d)}})
    open_ = pairs.filter(~F.col("settled"))
    close = open_.join(left, [*here, *there]).join(right, [*cell, *[f"q{i}" for i in range(d)]]).filter(F.sqrt(_d2("x", "y", d)) <= limit)
    tile = lambda cols: F.struct(*[F.floor(F.col(c) / TILE).alias(f"t{i}") for i, c in enumerate(cols)])
    found = pairs.filter("settled").unionByName(close.select(*pairs.columns)).select("a", "b", tile(here).alias("ta"), tile(cell).alias("tb"))
    own = names.select(F.col("name").alias("a"), F.col("name").alias("b"), tile(cell).alias("ta"), tile(cell).alias("tb"))
    return found.unionByName(own).distinct()


def grid_dbscan(df: DataFrame, key: str, vec: str, eps: float, min_samples: int, components) -> DataFrame:
    """(key, core, cluster_key) of rows with 1 to ``MAX_DIMS`` coordinates; see ``cluster.dbscan``. Rows without usable coordinates are noise."""
    d = df.select(F.max(F.size(vec))).first()[0]
    cell, kt = [f"c{i}" for i in range(d)], df.schema[key].dataType.simpleString()
    side, limit = eps / sqrt(d) * (1 - 1e-9), eps * (1 + 1e-12)
    rows = df.select(F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("x"))
    usable = rows.filter((F.size("x") == d) & F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))))
    sites = usable.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).withColumns({c: F.floor(F.col("x")[i] / side) for i, c in enumerate(cell)})
    per_cell = Window.partitionBy(*cell)
    sites = write_through(sites.withColumns({"full": F.sum("n").over(per_cell) >= min_samples, "__sites": F.count(F.lit(1)).over(per_cell)})
                          .withColumn("__block", F.pmod(F.xxhash64("x"), F.ceil(F.col("__sites") / BLOCK_SITES)).cast("int")), "sites")
    thin = sites.filter("not full")
    counted = _near_sites(thin, sites, d).filter(F.sqrt(_d2("x", "y", d)) <= limit).groupBy("first").agg(F.sum("n_y").alias("near")).filter(F.col("near") >= min_samples)
    core = write_through(sites.filter("full").unionByName(thin.join(counted.select("first"), "first", "left_semi").select(*sites.columns)), "core")
    links = write_through(_cell_links(core, d, side, eps), "cell-links")
    inner = links.filter("ta = tb").groupBy("ta").applyInPandas(lambda g: _folded(g), f"node {kt}, root {kt}")
    roots = write_through(inner, "cell-roots")
    up = [roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b")]
    across = links.filter("ta <> tb").join(up[0], "a").join(up[1], "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct()
    tops = components(across).select(F.col("node").alias("root"), F.col("component"))
    named = roots.join(tops, "root", "left").select(F.col("node").alias("name"), F.coalesce("component", "root").alias("cluster_key"))
    names = core.groupBy(*cell).agg(F.min("first").alias("name")).join(named, "name")
    core_sites = write_through(core.join(names.drop("name"), cell), "core-named")
    edge = thin.join(core.select("first"), "first", "left_anti")
    nearest = _near_sites(edge, core, d).withColumn("distance", F.sqrt(_d2("x", "y", d))).filter(F.col("distance") <= limit)
    nearest = nearest.groupBy("first").agg(F.min(F.struct("distance", "first_y")).alias("m")).select("first", F.col("m.first_y").alias("core_first"))
    border = nearest.join(core_sites.select(F.col("first").alias("core_first"), "cluster_key"), "core_first").select("first", F.lit(False).alias("core"), "cluster_key")
    known = core_sites.select("first", F.lit(True).alias("core"), "cluster_key").unionByName(border)
    labels = write_through(sites.select("x", "first").join(known, "first").drop("first"), "site-labels")
    return rows.join(labels, "x", "left").select(F.col("id").alias(key), F.coalesce("core", F.lit(False)).alias("core"), "cluster_key")
