"""Exact nearest neighbours and radius search without a cross join.

Train rows are put into the cell of their nearest pivot (Lu et al. 2012, kNN joins on MapReduce). A query
searches its own cell first; the k-th distance found there is the radius of the second round. The triangle
inequality, with the range of a cell's distances to its own pivot and to up to 32 others, tells which other
cells can still hold a neighbour, and the query is sent to those only. A cell is cut into blocks of bounded
size by row hash, and the queries of a block into chunks, so a hot cell (many copies of one row) is many
tasks. Inside a task one matrix product scores a chunk against a block and only the best k rows per query
leave it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowbench.functions.small import collect_small, pin_small
from flowbench.operators.split import sample_n, top_per_group
from flowbench.session import write_through

MAX_PIVOTS = 2_048
ROWS_PER_CELL = 2_000
BOUND_PIVOTS = 32
RING_PIVOTS = 32
BLOCK_ROWS = 20_000
CHUNK_ROWS = 20_000
SLICE_ROWS = 500  # rows of a batch held against the pivots at once


@dataclass
class Cells:
    """Pivots and, per cell, its size, smallest distances to its pivot, and ranges of distances to its pivot and to the ring pivots."""

    pivots: np.ndarray
    size: np.ndarray
    near: np.ndarray
    far: np.ndarray
    smallest: np.ndarray
    ring_near: np.ndarray
    ring_far: np.ndarray

    @property
    def rings(self) -> np.ndarray:
        return ring_pivots(len(self.pivots))

    def blocks(self, block_rows: int) -> np.ndarray:
        return np.maximum(1, -(-self.size // block_rows)).astype(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a @ b.T
    d *= -2.0
    d += (a * a).sum(axis=1)[:, None]
    d += (b * b).sum(axis=1)[None, :]
    np.maximum(d, 0.0, out=d)
    return np.sqrt(d, out=d)


def ring_pivots(m: int) -> np.ndarray:
    """Places of the pivots that every cell keeps its distances to."""
    return np.unique(np.linspace(0, m - 1, min(RING_PIVOTS, m)).astype(np.int64)) if m else np.zeros(0, np.int64)


def stack(col: pd.Series) -> np.ndarray:
    if not len(col):
        return np.zeros((0, 0))
    rows = col.to_numpy()
    widths = {len(v) if isinstance(v, np.ndarray) else -1 for v in rows}
    if len(widths) == 1 and -1 not in widths:
        return np.concatenate(rows).astype(np.float64, copy=False).reshape(len(rows), widths.pop())
    return np.stack([np.asarray(v, dtype=np.float64) for v in col])


def _with_cell(df: DataFrame, vec: str, pivots: np.ndarray) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    @F.pandas_udf("cell int, reach double")
    def nearest(v: pd.Series) -> pd.DataFrame:
        x, cell, reach = stack(v), np.zeros(len(v), np.int32), np.zeros(len(v))
        for lo in range(0, len(v), SLICE_ROWS):
            d = distances(x[lo:lo + SLICE_ROWS], shared.value)
            near = d.argmin(axis=1)
            cell[lo:lo + SLICE_ROWS], reach[lo:lo + SLICE_ROWS] = near, d[np.arange(len(d)), near]
        return pd.DataFrame({"cell": cell, "reach": reach})

    # Marked nondeterministic so that filters on the cell do not evaluate it a second time.
    return df.withColumn("__c", nearest.asNondeterministic()(vec)).select("*", F.col("__c.cell").alias("__cell"), F.col("__c.reach").alias("__reach")).drop("__c")


def _with_rings(df: DataFrame, vec: str, pivots: np.ndarray) -> DataFrame:
    """Distances to the ring pivots, as an array."""
    shared = df.sparkSession.sparkContext.broadcast(pivots[ring_pivots(len(pivots))])

    @F.pandas_udf("array<double>")
    def rings(v: pd.Series) -> pd.Series:
        return pd.Series(list(distances(stack(v), shared.value)) if len(v) else [], dtype=object)

    return df.withColumn("__rings", rings.asNondeterministic()(vec))


def fit_cells(train: DataFrame, key: str, vec: str, k: int, seed: int = 42, rows_per_cell: int = ROWS_PER_CELL) -> tuple[Cells, DataFrame]:
    """Choose pivots by hash sample and describe the cells; returns them and train with its cell."""
    want = max(1, min(MAX_PIVOTS, train.count() // rows_per_cell))
    rows = collect_small(sample_n(train.select(key, vec), [key], want, seed), MAX_PIVOTS, "pivots")
    if not rows:
        return Cells(np.zeros((0, 0)), *(np.zeros(0) for _ in range(3)), *(np.zeros((0, max(k, 1))) for _ in range(3))), train.withColumns({"__cell": F.lit(0), "__reach": F.lit(0.0)})
    points = np.unique(np.array([r[vec] for r in rows], dtype=np.float64), axis=0)
    celled, m = _with_cell(train, vec, points), len(points)
    # Written once: the ranges, the smallest distances and the search all read it.
    celled = write_through(celled, "cells") if m > 1 else celled
    rings = range(len(ring_pivots(m)))
    ranges = [f(F.col("__rings")[i]).alias(f"{n}{i}") for i in rings for f, n in ((F.min, "lo"), (F.max, "hi"))]
    stats = _with_rings(celled.select("__cell", "__reach", vec), vec, points).groupBy("__cell").agg(F.count(F.lit(1)).alias("n"), F.min("__reach").alias("lo"), F.max("__reach").alias("hi"), *ranges).collect()
    ring_near, ring_far = np.full((m, len(rings)), np.inf), np.full((m, len(rings)), -np.inf)
    size, near, far = np.zeros(m, dtype=np.int64), np.full(m, np.inf), np.full(m, -np.inf)
    for r in stats:
        size[r["__cell"]], near[r["__cell"]], far[r["__cell"]] = r["n"], r["lo"], r["hi"]
        ring_near[r["__cell"]], ring_far[r["__cell"]] = ([r[f"{n}{i}"] for i in rings] for n in ("lo", "hi"))
    smallest = np.full((m, max(k, 1)), np.inf)
    if k:
        first = top_per_group(celled.select("__cell", "__reach", key), ["__cell"], [F.asc("__reach"), F.asc(key)], k, "__i")
        for r in first.select("__cell", "__reach", "__i").collect():
            smallest[r["__cell"], r["__i"] - 1] = r["__reach"]
    return Cells(points, size, near, far, smallest, ring_near, ring_far), celled


def _visits(queries: DataFrame, vec: str, cells: Cells, k: int, radius: float | None, block_rows: int, second: bool = False) -> DataFrame:
    """Queries with one row per block they must look at: within ``radius``, or for the k nearest. In the ``second`` round a query
    has searched its own cell (``__own``) and knows a k-th distance (``__kth``, null if it found fewer)."""
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast((cells, cells.blocks(block_rows)))

    def some(x: np.ndarray, kth: np.ndarray, own: np.ndarray, c: Cells) -> tuple[np.ndarray, np.ndarray]:
        """Row and cell of every visit of a slice of queries."""
        d = distances(x, c.pivots)
        if radius is None:
            # The k-th smallest way over a pivot bounds the k-th neighbour; the nearest pivots suffice.
            m = min(BOUND_PIVOTS, d.shape[1])
            close = np.argpartition(d, m - 1, axis=1)[:, :m]
            ways = (np.take_along_axis(d, close, axis=1)[:, :, None] + c.smallest[close]).reshape(len(x), m * c.smallest.shape[1])
            reach = np.fmin(np.partition(ways, k - 1, axis=1)[:, k - 1], kth)
        else:
            reach = np.full(len(x), radius)
        # Distances come from products, whose error near zero grows with the root of the precision.
        most = np.sqrt((c.pivots ** 2).sum(axis=1)).max() + c.far[c.size > 0].max(initial=0.0)
        norm = np.sqrt((x ** 2).sum(axis=1))
        reach = reach * (1 + 1e-9) + 1e-7 * (norm + most) + 1e-12
        go = (d - c.far[None, :] <= reach[:, None]) & (c.near[None, :] - d <= reach[:, None]) & (c.size[None, :] > 0)
        if second:
            go[np.arange(len(x)), own] = False
        row, cell = np.divmod(np.flatnonzero(go.ravel()), go.shape[1])
        for i, p in enumerate(c.rings):  # only for cells that their own pivot leaves open
            at = d[row, p]
            keep = (at - c.ring_far[cell, i] <= reach[row]) & (c.ring_near[cell, i] - at <= reach[row])
            if not keep.all():
                row, cell = row[keep], cell[keep]
        return row, cell

    @F.pandas_udf("array<struct<cell:int,block:int>>")
    def targets(v: pd.Series, kth: pd.Series, own: pd.Series) -> pd.Series:
        c, nb = shared.value
        x, kth, own, out = stack(v), kth.to_numpy(np.float64), own.to_numpy(np.int64), []
        for lo in range(0, len(v), SLICE_ROWS):
            part = slice(lo, lo + SLICE_ROWS)
            row, cell = some(x[part], kth[part], own[part], c)
            ends, cells_of = np.searchsorted(row, np.arange(len(x[part]) + 1)).tolist(), [(j, n) for j, n in zip(cell.tolist(), nb[cell].tolist())]
            out += [[{"cell": j, "block": b} for j, n in cells_of[s:e] for b in range(n)] for s, e in zip(ends, ends[1:])]
        return pd.Series(out, dtype=object)

    known = (F.col("__kth"), F.col("__own")) if second else (F.lit(None).cast("double"), F.lit(0))
    out = queries.withColumn("__t", F.explode(targets(vec, *known)))
    return out.select("*", F.col("__t.cell").alias("__cell"), F.col("__t.block").alias("__block")).drop("__t", "__kth", "__own")


def _meeting(visits: DataFrame, celled: DataFrame, cells: Cells, qkey: str, tkey: str, block_rows: int, chunk_rows: int):
    """Both sides keyed by (cell, block, chunk): bounded chunks of queries meet bounded blocks of train."""
    load = visits.groupBy("__cell", "__block").agg(F.count(F.lit(1)).alias("__v"))
    chunks = pin_small(load.select("__cell", "__block", F.ceil(F.col("__v") / chunk_rows).cast("int").alias("__chunks")))
    per_cell = visits.sparkSession.createDataFrame([(i, int(b)) for i, b in enumerate(cells.blocks(block_rows))], "__cell int, __blocks bigint")
    right = celled.join(F.broadcast(per_cell), "__cell").withColumn("__block", F.pmod(F.xxhash64(tkey), F.col("__blocks")).cast("int")).drop("__blocks")
    left = visits.join(chunks, ["__cell", "__block"]).withColumn("__chunk", F.pmod(F.xxhash64(qkey, F.lit(7)), F.col("__chunks").cast("bigint")).cast("int"))
    right = right.join(chunks, ["__cell", "__block"]).withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1)))
    return left.drop("__chunks"), right.drop("__chunks", "__reach")


def _paired_blocks(queries: DataFrame, train: DataFrame, qkey: str, tkey: str, qvec: str, tvec: str, radius: float, block_rows: int, chunk_rows: int,
                   seed: int, rows_per_cell: int):
    """Both sides of a radius search."""
    cells, celled = fit_cells(train, tkey, tvec, 0, seed, rows_per_cell)
    if not len(cells.pivots):  # nothing to be near to
        place = {c: F.lit(0) for c in ("__cell", "__block", "__chunk")}
        return queries.filter(F.lit(False)).withColumns(place), celled.drop("__reach").withColumns(place)
    return _meeting(_visits(queries, qvec, cells, 0, radius, block_rows), celled, cells, qkey, tkey, block_rows, chunk_rows)


def block_top_k(qid: np.ndarray, q: np.ndarray, tid: np.ndarray, t: np.ndarray, k: int, skip_same: bool):
    """Best k train rows per query of one chunk and block, exact distances, ties by train key."""
    out_q, out_t, out_d = [], [], []
    step = max(1, 4_000_000 // max(len(t), 1))
    norm_t = (t * t).sum(axis=1)
    for lo in range(0, len(q), step):
        a = q[lo:lo + step]
        norm_a = (a * a).sum(axis=1)
        d2 = norm_a[:, None] + norm_t[None, :] - 2.0 * (a @ t.T)
        if skip_same:
            d2[qid[lo:lo + step][:, None] == tid[None, :]] = np.inf
        m = min(k, d2.shape[1])
        kth = np.partition(d2, m - 1, axis=1)[:, m - 1]
        slack = 1e-11 * (norm_a[:, None] + norm_t[None, :] + 1.0)
        i, j = np.nonzero((d2 <= kth[:, None] + slack) & np.isfinite(d2))
        d = np.sqrt(((a[i] - t[j]) ** 2).sum(axis=1))
        order = np.lexsort((tid[j], d, i))
        i, j, d = i[order], j[order], d[order]
        start = np.searchsorted(i, i, side="left")
        best = np.arange(len(i)) - start < k
        out_q.append(lo + i[best])
        out_t.append(j[best])
        out_d.append(d[best])
    return np.concatenate(out_q), np.concatenate(out_t), np.concatenate(out_d)


@dataclass
class _Search:
    """A prepared search: train rows in cells, and the best rows of the blocks that a table of visits names."""

    queries: DataFrame
    celled: DataFrame
    cells: Cells
    k: int
    skip_same: bool
    block_rows: int
    chunk_rows: int

    def run(self, visits: DataFrame) -> DataFrame:
        left, right = _meeting(visits, self.celled, self.cells, "__q", "__t", self.block_rows, self.chunk_rows)
        extra = "__payload" in self.celled.columns
        types = {c: f.dataType.simpleString() for c, f in zip(("__q", "__t"), (self.queries.schema["__q"], self.celled.schema["__t"]))}
        names = ["query", "neighbor", "distance"] + (["payload"] if extra else [])
        k, skip_same = self.k, self.skip_same

        def best(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
            if lp.empty or rp.empty:
                return pd.DataFrame({n: [] for n in names})
            qi, tj, d = block_top_k(lp["__q"].to_numpy(), stack(lp["__qv"]), rp["__t"].to_numpy(), stack(rp["__tv"]), k, skip_same)
            out = {"query": lp["__q"].to_numpy()[qi], "neighbor": rp["__t"].to_numpy()[tj], "distance": d}
            if extra:
                out["payload"] = rp["__payload"].to_numpy()[tj]
            return pd.DataFrame(out)

        schema = f"query {types['__q']}, neighbor {types['__t']}, distance double" + (f", payload {self.celled.schema['__payload'].dataType.simpleString()}" if extra else "")
        keys = ["__cell", "__block", "__chunk"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(best, schema)
        return top_per_group(found, ["query"], [F.asc("distance"), F.asc("neighbor")], k)

    def home(self) -> DataFrame:
        """First round: every block of the query's own cell."""
        per_cell = self.queries.sparkSession.createDataFrame([(i, int(b)) for i, b in enumerate(self.cells.blocks(self.block_rows))], "__cell int, __blocks bigint")
        home = _with_cell(self.queries, "__qv", self.cells.pivots).drop("__reach").join(F.broadcast(per_cell), "__cell")
        return home.withColumn("__block", F.explode(F.sequence(F.lit(0), F.col("__blocks").cast("int") - 1))).drop("__blocks")

    def beyond(self, first: DataFrame) -> DataFrame:
        """Second round: the blocks of other cells that the k-th distance of the first does not rule out."""
        kth = first.groupBy(F.col("query").alias("__q")).agg(F.when(F.count(F.lit(1)) >= self.k, F.max("distance")).alias("__kth"))
        asking = _with_cell(self.queries, "__qv", self.cells.pivots).drop("__reach").withColumnRenamed("__cell", "__own").join(kth, "__q", "left")
        return _visits(asking, "__qv", self.cells, self.k + 1 if self.skip_same else self.k, None, self.block_rows, second=True)


def _prepared(queries: DataFrame, train: DataFrame, k: int, qkey: str, tkey: str, vec: str, payload: str | None, skip_same: bool, block_rows: int, chunk_rows: int,
              rows_per_cell: int, seed: int) -> _Search:
    q = queries.select(F.col(qkey).alias("__q"), F.col(vec).alias("__qv"))
    t = train.select(F.col(tkey).alias("__t"), F.col(vec).alias("__tv"), *([F.col(payload).alias("__payload")] if payload else []))
    cells, celled = fit_cells(t, "__t", "__tv", k + 1 if skip_same else k, seed, rows_per_cell)
    return _Search(q, celled, cells, k, skip_same, block_rows, chunk_rows)


def nearest_neighbors(queries: DataFrame, train: DataFrame, k: int, qkey: str, tkey: str, vec: str, payload: str | None = None,
                      skip_same: bool = False, block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS, rows_per_cell: int = ROWS_PER_CELL,
                      seed: int = 42) -> DataFrame:
    """The k nearest train rows of every query: rows (query, place, neighbor, distance[, payload]).

    Exact Euclidean distance, ties by train key. ``skip_same`` leaves out the train row with the query's key.
    """
    s = _prepared(queries, train, k, qkey, tkey, vec, payload, skip_same, block_rows, chunk_rows, rows_per_cell, seed)
    if not len(s.cells.pivots):
        none = [F.lit(None).cast(s.celled.schema[c].dataType).alias(n) for c, n in (("__t", "neighbor"), ("__payload", "payload")) if c in s.celled.columns]
        return s.queries.filter(F.lit(False)).select(F.col("__q").alias("query"), *none, F.lit(0.0).alias("distance"), F.lit(0).alias("place"))
    first = s.run(s.home())
    if len(s.cells.pivots) == 1:
        return first
    first = write_through(first, "own-cell")
    both = first.unionByName(s.run(s.beyond(first))).drop("place")
    return top_per_group(both, ["query"], [F.asc("distance"), F.asc("neighbor")], k)


def neighbor_visits(queries: DataFrame, train: DataFrame, k: int, key: str, vec: str, block_rows: int = BLOCK_ROWS, rows_per_cell: int = ROWS_PER_CELL,
                    seed: int = 42) -> DataFrame:
    """What a search costs: (query, blocks visited in both rounds, blocks there are)."""
    s = _prepared(queries, train, k, key, key, vec, None, False, block_rows, CHUNK_ROWS, rows_per_cell, seed)
    home = s.home()
    looked = home.select("__q").unionByName(s.beyond(write_through(s.run(home), "own-cell")).select("__q"))
    return looked.groupBy(F.col("__q").alias("query")).agg(F.count(F.lit(1)).alias("visited")).withColumn("blocks", F.lit(int(s.cells.blocks(block_rows).sum())))


def knn_vote(neighbors: DataFrame) -> DataFrame:
    """Distance-weighted class vote: rows (query, pred, votes per class as shares). A zero distance wins alone."""
    zero = F.max(F.col("distance") == 0).over(Window.partitionBy("query"))
    w = neighbors.withColumn("__z", zero).withColumn(
        "__w", F.when(F.col("__z"), (F.col("distance") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("distance"))))
    votes = w.groupBy("query", F.col("payload").alias("class")).agg(F.sum("__w").alias("w"))
    return votes.groupBy("query").agg(F.min_by("class", F.struct(-F.col("w"), F.col("class"))).alias("pred"),
                                      (F.max("w") / F.sum("w")).alias("confidence"))


def knn_classify(train: DataFrame, queries: DataFrame, key: str, vec: str, label: str, k: int = 5) -> DataFrame:
    """Class of every query by its k nearest train rows, weighted by 1/distance."""
    return knn_vote(nearest_neighbors(queries, train, k, key, key, vec, label)).withColumnRenamed("query", key)


def knn_regress(train: DataFrame, queries: DataFrame, key: str, vec: str, target: str, k: int = 10) -> DataFrame:
    """Distance-weighted mean of the k nearest targets; zero distances decide alone."""
    n = nearest_neighbors(queries, train, k, key, key, vec, target)
    zero = F.col("distance") == 0
    w = F.try_divide(F.lit(1.0), F.when(~zero, F.col("distance")))
    out = n.groupBy("query").agg(F.count_if(zero).alias("__nz"), F.avg(F.when(zero, F.col("payload"))).alias("__z"),
                                 (F.sum(F.col("payload") * w) / F.sum(w)).alias("__m"))
    return out.select(F.col("query").alias(key), F.when(F.col("__nz") > 0, F.col("__z")).otherwise(F.col("__m")).alias("pred"))


def radius_blocks(df: DataFrame, key: str, vec: str, radius: float, extra: list[str] | None = None,
                  block_rows: int = 4_000, chunk_rows: int = 4_000, rows_per_cell: int = ROWS_PER_CELL, seed: int = 42):
    """Both sides of a self radius search as bounded chunks and blocks (see ``_paired_blocks``)."""
    q = df.select(F.col(key).alias("__q"), F.col(vec).alias("__qv"), *[F.col(c).alias(f"__q_{c}") for c in extra or []])
    t = df.select(F.col(key).alias("__t"), F.col(vec).alias("__tv"), *[F.col(c).alias(f"__t_{c}") for c in extra or []])
    return _paired_blocks(q, t, "__q", "__t", "__qv", "__tv", radius, block_rows, chunk_rows, seed, rows_per_cell)
