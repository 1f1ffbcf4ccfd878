"""Gradient boosting with a softmax over the classes: in every round one regression tree per class on the residuals
of that class (Friedman 2001).

Features are coded once as the number of candidate cuts below them. A level of the trees of all classes is one job: tasks
add up counts, weights and residuals per class, node, feature and code; the sums meet once per feature, and each task sends back only its best
split per class and node. What travels depends on classes, nodes, features and cuts, never on rows. Scores of the rows
are written to the shared folder every few rounds and brought up to date from the trees grown since.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowbench.operators.blocks import SCHEMA, numbers, unpack, write_blocks
from flowbench.session import write_through

BLOCK = 8_192
UNSPLIT = 255
FEATURES_A_TASK = 8
DIRECT_BYTES = 32 << 20
_SPLIT = "k int, node int, f int, cut int, gain double, left array<double>, right array<double>"


def candidate_cuts(df: DataFrame, features: str, bins: int) -> list[np.ndarray]:
    """Cuts of every feature at its approximate quantiles; all distinct values when each of them has a fair share of the rows."""
    long = df.select(F.posexplode(numbers(features)).alias("f", "x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    points = [i / bins for i in range(bins + 1)]
    rows = long.groupBy("f").agg(F.percentile_approx("x", F.array(*[F.lit(p) for p in points]), 100 * bins).alias("q")).collect()
    width = df.select(F.size(numbers(features)).alias("d")).agg(F.max("d")).first()[0] or 0
    cuts = [np.array([])] * width
    for r in rows:
        cuts[r["f"]] = np.unique(r["q"])[:-1]
    return cuts


def encode(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Number of cuts below each value: x <= cuts[j] where its code <= j. Missing numbers lie above all cuts."""
    return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.uint8)


def route(codes: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Node of every row on a level of a tree; feature and cut list the nodes of the levels above in order."""
    node, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
    for level in range(levels):
        at = (1 << level) - 1 + node
        node = 2 * node + (codes[rows, feature[at]] > cut[at])
    return node


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Round:
    """One tree per class: feature and cut per inner node (k x 2^depth - 1), value per leaf (k x 2^depth)."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def add(self, s: np.ndarray, codes: np.ndarray, depth: int) -> None:
        for k in range(s.shape[1]):
            s[:, k] += self.value[k][route(codes, self.feature[k], self.cut[k], depth)]


@dataclass
class Boosted:
    """Start scores, cuts and rounds of a fit."""

    start: np.ndarray
    cuts: list[np.ndarray]
    rounds: list[Round]
    depth: int

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        codes, s = encode(x, self.cuts), np.tile(self.start, (len(x), 1))
        for r in self.rounds:
            r.add(s, codes, self.depth)
        return softmax(s)

    def apply(self, df: DataFrame, features: str) -> DataFrame:
        """Add ``p``, the softmax of the scores; null without features."""
        return with_probabilities(df, features, self.probabilities)


def with_probabilities(df: DataFrame, features: str, score) -> DataFrame:
    """Add ``p`` by a function from a matrix of features to a matrix of probabilities; null without features."""

    @F.pandas_udf("array<double>")
    def udf(v: pd.Series) -> pd.Series:
        out, there = [None] * len(v), [i for i, x in enumerate(v) if x is not None]
        if there:
            for i, p in zip(there, score(np.stack([v.iloc[i] for i in there]))):
                out[i] = p
        return pd.Series(out, index=v.index, dtype=object)

    return df.withColumn("p", udf(numbers(features)))


def _histograms(state: DataFrame, model: Boosted, done: int, grown: tuple[np.ndarray, np.ndarray], level: int, share: float, seed: str) -> DataFrame:
    """Per feature: rows, weight, residuals and their curvature by class, node and code, as bytes; one row a task and feature."""
    k, d, start = len(model.start), len(model.cuts), model.start
    bins, since, depth, feature, cut = max(len(c) for c in model.cuts) + 1, model.rounds[done:], model.depth, *grown
    whole = done == 0

    def fold(batches):
        sums = np.zeros((d, 4, k, (1 << level) * bins))
        for block, codes, y, w, one in unpack(batches, np.uint8):
            s = np.tile(start, (len(y), 1)) if whole else np.frombuffer(one.column("s")[0].as_py(), np.float64).reshape(len(y), k).copy()
            for r in since:
                r.add(s, codes, depth)
            res = (y[:, None] == np.arange(k)) - softmax(s)
            drawn = np.flatnonzero(w > 0) if share >= 1 else np.flatnonzero((w > 0) & (_draw(seed, block, len(y)) < share))
            codes, res, w = codes[drawn], res[drawn], w[drawn]
            for c in range(k):
                node, r = route(codes, feature[c], cut[c], level) * bins, res[:, c]
                for f in range(d):
                    at = node + codes[:, f]
                    for j, v in enumerate((None, w, w * r, w * np.abs(r) * (1 - np.abs(r)))):
                        sums[f, j, c] += np.bincount(at, v, (1 << level) * bins)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([h.tobytes() for h in sums], pa.binary())], names=["f", "h"])

    return state.mapInArrow(fold, "f int, h binary")


def _draw(seed: str, block: int, n: int) -> np.ndarray:
    return np.random.default_rng([*seed.encode(), block >> 32, block & 0xFFFFFFFF]).random(n)


def _best_splits(sums: DataFrame, model: Boosted, level: int, tasks: int) -> list[dict]:
    """The best split per class and node; the largest gain counts, the first feature and cut among equals. Sums that are small
    by the number of tasks and the shape of the model (``DIRECT_BYTES``) are compared at once, others by tasks with some features each."""
    k, d, nodes = len(model.start), len(model.cuts), 1 << level
    bins = max(len(c) for c in model.cuts) + 1

    def choose(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for f, h in zip(b.column("f").to_pylist(), b.column("h").to_pylist()):
                got = np.frombuffer(h, np.float64).reshape(4, k, nodes, bins)
                held[f] = held[f] + got if f in held else got
        best: dict[tuple[int, int], tuple] = {}
        for f in sorted(held):
            left = held[f].cumsum(axis=3)
            right = left[..., -1:] - left
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = left[1] * right[1] / (left[1] + right[1]) * (left[2] / left[1] - right[2] / right[1]) ** 2
            gain = np.where((left[0] > 0.5) & (right[0] > 0.5), gain, -1.0).astype(np.float32)
            for c in range(k):
                for node in range(nodes):
                    j = int(gain[c, node].argmax())
                    row = (c, node, f, j, float(gain[c, node, j]), left[:, c, node, j].tolist(), right[:, c, node, j].tolist())
                    if (c, node) not in best or row[4] > best[c, node][4]:
                        best[c, node] = row
        if best:
            names = ["k", "node", "f", "cut", "gain", "left", "right"]
            kinds = [pa.int32()] * 4 + [pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*best.values()), kinds)], names=names)

    if tasks * d * 4 * k * nodes * bins * 8 <= DIRECT_BYTES:
        rows = [r for b in choose(sums.toArrow().to_batches()) for r in b.to_pylist()]
    else:
        rows = [r.asDict() for r in sums.repartition(max(1, d // FEATURES_A_TASK), "f").mapInArrow(choose, _SPLIT).collect()]
    out = {}
    for r in sorted(rows, key=lambda r: (-r["gain"], r["f"])):
        out.setdefault((r["k"], r["node"]), r)
    return list(out.values())


def fit_boosted(df: DataFrame, features: str, label: str, weight: str, classes: int, rounds: int = 100, step: float = 0.1, depth: int = 3, share: float = 1.0,
                bins: int = 128, seed: int = 42, cut_every: int = 10) -> Boosted:
    """Boosting of ``classes`` classes numbered in ``label`` from 0. Start scores are the logs of the weighted class shares;
    a leaf is worth step * (k - 1) / k * sum(w r) / sum(w |r| (1 - |r|)). A node in which no cut parts two rows stays whole; ``share`` of
    the rows, drawn by block and round, grow each round."""
    if not 2 <= bins <= UNSPLIT:
        raise ValueError("bins must lie between 2 and 255")
    totals = {r["y"]: r["w"] for r in df.groupBy(F.col(label).cast("int").alias("y")).agg(F.sum(weight).alias("w")).collect()}
    mass = np.array([totals.get(c, 0.0) for c in range(classes)])
    cuts = candidate_cuts(df, features, bins)
    start = np.log(np.maximum(mass / max(mass.sum(), 1e-300), 1e-12))
    model = Boosted(start, cuts, [], depth)
    if classes < 2 or not any(len(c) for c in cuts):
        return model
    state = write_blocks(df, features, label, weight, BLOCK, lambda x: encode(x, cuts)).drop("slice").persist()
    done, shrink, tasks = 0, step * (classes - 1) / classes, state.rdd.getNumPartitions()
    for t in range(rounds):
        if t and t % cut_every == 0:
            old, state, done = state, write_through(_advance(state, model, done), "scores").persist(), t
            old.unpersist()
            tasks = state.rdd.getNumPartitions()
        feature, cut = np.zeros((classes, (1 << depth) - 1), np.int64), np.full((classes, (1 << depth) - 1), UNSPLIT, np.int64)
        value = np.zeros((classes, 1 << depth))
        for level in range(depth):
            for r in _best_splits(_histograms(state, model, done, (feature, cut), level, share, f"{seed}:{t}"), model, level, tasks):
                c, node, at = r["k"], r["node"], (1 << level) - 1 + r["node"]
                left, right = np.array(r["left"]), np.array(r["right"])
                if r["gain"] > 0:
                    feature[c, at], cut[c, at] = r["f"], r["cut"]
                else:
                    left = right = left + right
                if level == depth - 1:
                    for side, part in enumerate((left, right)):
                        value[c, 2 * node + side] = shrink * part[2] / part[3] if part[3] > 1e-150 else 0.0
        model.rounds.append(Round(feature, cut, value))
    state.unpersist()
    return model


def _advance(state: DataFrame, model: Boosted, done: int) -> DataFrame:
    """Scores of all blocks after the rounds grown so far."""
    k, start, since, depth, whole = len(model.start), model.start, model.rounds[done:], model.depth, done == 0

    def run(batches):
        for _, codes, y, _, one in unpack(batches, np.uint8):
            s = np.tile(start, (len(y), 1)) if whole else np.frombuffer(one.column("s")[0].as_py(), np.float64).reshape(len(y), k).copy()
            for r in since:
                r.add(s, codes, depth)
            yield pa.RecordBatch.from_arrays([*[one.column(c) for c in ("block", "n", "x", "y", "w")], pa.array([s.tobytes()], pa.binary())],
                                             names=["block", "n", "x", "y", "w", "s"])

    return state.mapInArrow(run, f"{SCHEMA}, s binary")
