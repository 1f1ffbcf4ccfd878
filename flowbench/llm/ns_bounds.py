"""Exact k-means on integer vectors with ns-bounds (Newling and Fleuret): bounds loosened by the norm of a sum of displacements.

For every vector and centroid the last exact distance and its round are stored. All earlier centroids are kept, so a stored distance
is loosened by how far the centroid is now from where it was then - not by the sum of its moves since, which is larger when a centroid
turns. A vector keeps its centroid unread while every other lower bound lies above its upper bound; else its own distance is computed
anew, and then those of the centroids whose bounds still fail.

Distances are squared and exact in 64-bit integers; bounds are their roots in double precision with a margin for rounding, so ties are
always settled by exact distances. State is written once a round and read back; k centroids a round are all that passes the driver.

Defined results: vectors that are null, have another length, or hold null or non-finite components are left out; so are those with
a component beyond ``RANGE``, whose distances no 64-bit integer holds; ids may repeat or be null (a null counts as an empty string in
the hash that draws the first centroids); fewer vectors than centroids give fewer centroids; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowbench.llm.common import fixed

# Largest absolute component, after scaling, for which 64 squared differences fit a 64-bit integer with room to spare.
RANGE = 1 << 26
MARGIN = 1e-9


def grid_vectors(df: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """``id`` and ``v``: floor(scale * component) of the usable vectors."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("raw"))
    usable = (F.size("raw") == dims) & F.forall("raw", lambda x: x.isNotNull() & (F.abs(x) < RANGE / scale))
    return rows.filter(F.coalesce(usable, F.lit(False))).select("id", F.transform("raw", lambda x: F.floor(x * scale).cast("int")).alias("v"))


class History:
    """Centroids of all rounds so far, and how far each stands now from where it stood in every earlier round."""

    def __init__(self, first: np.ndarray):
        self.rounds = [first]

    @property
    def now(self) -> np.ndarray:
        return self.rounds[-1]

    def displacement(self) -> np.ndarray:
        """[round, centroid]: norm of the displacement from that round to now."""
        return np.stack([np.sqrt(((self.now - c) ** 2).sum(axis=1).astype(np.float64)) for c in self.rounds])


def _squared(v: np.ndarray, centre: np.ndarray) -> np.ndarray:
    d = v - centre
    return np.einsum("ij,ij->i", d, d)


def assign(v: np.ndarray, history: History, state: tuple[np.ndarray, np.ndarray, np.ndarray] | None):
    """Nearest centroid of every vector (ties: the smaller number) by stored bounds; state is (cluster, squared distances, their rounds).

    Returns the new state and the number of distances computed for each vector.
    """
    now, t, k, n = history.now, len(history.rounds) - 1, len(history.now), len(v)
    if state is None:
        far = np.stack([_squared(v, c) for c in now], axis=1)
        return (far.argmin(axis=1), far, np.full((n, k), t, np.int16)), np.full(n, k, np.int64)
    own, far, seen = (x.copy() for x in state)
    drift, row = history.displacement(), np.arange(n)
    moved = drift[seen, np.arange(k)]
    root = np.sqrt(far.astype(np.float64))
    lower = (root - moved) * (1 - MARGIN) - MARGIN * (1 + root)
    upper = (root[row, own] + moved[row, own]) * (1 + MARGIN) + MARGIN
    lower[row, own] = np.inf
    work = np.zeros(n, np.int64)
    # Vectors whose bounds overlap: first their own distance, exactly.
    open_ = np.flatnonzero(lower.min(axis=1) <= upper) if k > 1 else row[:0]
    for j in np.unique(own[open_]):
        mine = open_[own[open_] == j]
        far[mine, j], seen[mine, j] = _squared(v[mine], now[j]), t
    work[open_] += 1
    upper[open_] = np.sqrt(far[open_, own[open_]].astype(np.float64)) * (1 + MARGIN) + MARGIN
    # Then every centroid whose lower bound still does not rule it out.
    for j in range(k):
        again = open_[lower[open_, j] <= upper[open_]]
        far[again, j], seen[again, j] = _squared(v[again], now[j]), t
        work[again] += 1
    exact = np.where(seen[open_] == t, far[open_], np.iinfo(np.int64).max)
    own[open_] = exact.argmin(axis=1)
    return (own, far, seen), work


_STATE = "id {id}, v array<int>, cluster int, far array<long>, seen array<smallint>, n_distances long"


def _matrix(col: pa.ListArray, dtype) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(col), -1)


def _lists(m: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.reshape(-1), kind))


def _round(rows: DataFrame, history: History, last: bool) -> DataFrame:
    """All vectors assigned to the centroids of now; the last round returns distances instead of state."""
    first, kind = "cluster" not in rows.columns, rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column("v"), np.int64)
            state = None if first else (b.column("cluster").to_numpy().astype(np.int64), _matrix(b.column("far"), np.int64), _matrix(b.column("seen"), np.int16))
            (own, far, seen), work = assign(v, history, state)
            work += 0 if first else b.column("n_distances").to_numpy()
            cluster = pa.array(own.astype(np.int32))
            if last:
                exact = np.zeros(len(v), np.int64)
                for j in np.unique(own):
                    exact[own == j] = _squared(v[own == j], history.now[j])
                yield pa.RecordBatch.from_arrays([b.column("id"), cluster, pa.array(exact), pa.array(work)], ["id", "cluster", "distance", "n_distances"])
            else:
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), cluster, _lists(far, pa.int64()), _lists(seen, pa.int16()), pa.array(work)],
                                                 ["id", "v", "cluster", "far", "seen", "n_distances"])

    schema = f"id {kind}, cluster int, distance long, n_distances long" if last else _STATE.format(id=kind)
    return rows.mapInArrow(run, schema)


def _means(state: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Componentwise exact floor(sum / count); a centroid without vectors stays."""
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.col("v")[i].cast("long")).alias(f"s{i}") for i in range(centres.shape[1])]).collect()
    out = centres.copy()
    for r in sums:
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(centres.shape[1])]
    return out


def ns_kmeans(df: DataFrame, k: int, rounds: int, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """One row per usable vector: id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid`` (components) and
    ``n_distances`` (distances computed for it before the last one; k * (rounds + 1) without bounds).

    The first centroids are the k vectors with the smallest sha256 of seed and id; each round assigns and then moves them; vectors
    are assigned once more at the end.
    """
    spark, kind = df.sparkSession, df.schema[id_col].dataType.simpleString()
    rows = fixed(grid_vectors(df, id_col, vec_col, dims, scale), "ns-vectors")
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = [r["v"] for r in rows.orderBy(draw, "v").limit(k).collect()]
    schema = f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<int>, n_distances long"
    if not first:
        return spark.createDataFrame([], schema)
    history = History(np.array(first, np.int64))
    for _ in range(rounds):
        rows = fixed(_round(rows, history, last=False), "ns-state")
        history.rounds.append(_means(rows, history.now))
    out = fixed(_round(rows, history, last=True), "ns-assigned")
    sums = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    whole = lambda x: x if x < 1 << 63 else None  # noqa: E731 - a sum beyond 64 bits is null
    about = spark.createDataFrame([(j, whole(s), whole(sum(sums.values())), history.now[j].tolist()) for j, s in sums.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<int>")
    return out.join(F.broadcast(about), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid", "n_distances")


def centroid_digest(centroid: Column) -> Column:
    """Lowercase hex sha256 of the components as decimal integers joined by commas."""
    return F.sha2(F.concat_ws(",", F.transform(centroid, lambda x: x.cast("string"))).cast("binary"), 256)

