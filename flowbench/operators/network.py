"""Feed-forward networks with rectified units, fitted by Adam (Kingma and Ba 2015) on mini-batches.

Rows are dealt by their hash into blocks and the blocks into slices, each a folder of its own. A step reads one slice; each task adds up
the gradient of its blocks, the tasks' sums meet in a tree, and the driver holds parameters and moments, whose size is the network's.
An epoch reads every row once, its slices in an order drawn from the seed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame

from flowbench.operators.blocks import SCHEMA, unpack, write_blocks
from flowbench.operators.boosting import softmax, with_probabilities

BLOCK = 512
DIRECT = 32


@dataclass
class Network:
    """Layer sizes and all weights in one vector: per layer a matrix (in x out) by rows, then its biases."""

    sizes: tuple[int, ...]
    theta: np.ndarray

    def layers(self, theta: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        flat, out, at = self.theta if theta is None else theta, [], 0
        for a, b in zip(self.sizes, self.sizes[1:]):
            out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
            at += a * b + b
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        for w, b in self.layers()[:-1]:
            x = np.maximum(x @ w + b, 0.0)
        w, b = self.layers()[-1]
        return softmax(x @ w + b)

    def loss_and_gradient(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
        """Sums over the rows of weighted cross-entropy and its gradient, in the order of ``theta``."""
        layers, seen = self.layers(), [x]
        for w, b in layers[:-1]:
            seen.append(np.maximum(seen[-1] @ w + b, 0.0))
        p = softmax(seen[-1] @ layers[-1][0] + layers[-1][1])
        rows = np.arange(len(y))
        loss = float(-(weight * np.log(np.maximum(p[rows, y], 1e-300))).sum())
        p[rows, y] -= 1.0
        back, grads = p * weight[:, None], []
        for i in range(len(layers) - 1, -1, -1):
            grads.append(np.concatenate([(seen[i].T @ back).ravel(), back.sum(axis=0)]))
            if i:
                back = (back @ layers[i][0].T) * (seen[i] > 0)
        return loss, np.concatenate(grads[::-1])

    def matrices(self) -> np.ndarray:
        """1 where theta holds an entry of a matrix, 0 for biases: the penalty falls on matrices only."""
        return np.concatenate([np.repeat([1.0, 0.0], [a * b, b]) for a, b in zip(self.sizes, self.sizes[1:])])

    def apply(self, df: DataFrame, features: str) -> DataFrame:
        """Add ``p``, the softmax of the last layer; null without features."""
        return with_probabilities(df, features, self.probabilities)


def new_network(sizes: tuple[int, ...], seed: int = 42) -> Network:
    """Weights and biases uniform within sqrt(6 / (in + out)) of each layer (Glorot and Bengio 2010)."""
    rng = np.random.default_rng(seed)
    return Network(sizes, np.concatenate([rng.uniform(-1, 1, a * b + b) * math.sqrt(6.0 / (a + b)) for a, b in zip(sizes, sizes[1:])]))


def summed_gradient(part: DataFrame, net: Network) -> tuple[float, float, np.ndarray]:
    """Weight, loss and gradient summed over blocks of rows. Above ``DIRECT`` tasks, groups of them are summed by tasks first;
    sums are added in the order of the tasks' first blocks, so a repeated step gives the same number."""

    def fold(batches):
        first, total = None, np.zeros(2 + len(net.theta))
        for block, x, y, w, _ in unpack(batches, np.float64):
            loss, grad = net.loss_and_gradient(x, y, w)
            total += np.concatenate([[w.sum(), loss], grad])
            first = block if first is None else first
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["first", "sums"])

    def join(batches):
        rows = sorted((f, s) for b in batches for f, s in zip(b.column("first").to_pylist(), b.column("sums").to_pylist()))
        if rows:
            total = sum(np.frombuffer(s, np.float64) for _, s in rows)
            yield pa.RecordBatch.from_arrays([pa.array([rows[0][0]], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["first", "sums"])

    sums, tasks = part.mapInArrow(fold, "first long, sums binary"), part.rdd.getNumPartitions()
    if tasks > DIRECT:
        sums = sums.repartition(math.ceil(math.sqrt(tasks)), "first").mapInArrow(join, "first long, sums binary")
    rows = sorted((r["first"], bytes(r["sums"])) for r in sums.collect())
    total = sum((np.frombuffer(s, np.float64) for _, s in rows), np.zeros(2 + len(net.theta)))
    return float(total[0]), float(total[1]), total[2:]


class Adam:
    """Step sizes from running means of the gradient and its square."""

    def __init__(self, size: int, rate: float = 1e-3, beta: tuple[float, float] = (0.9, 0.999), eps: float = 1e-8):
        self.rate, self.beta, self.eps = rate, beta, eps
        self.mean, self.square, self.steps = np.zeros(size), np.zeros(size), 0

    def step(self, theta: np.ndarray, grad: np.ndarray) -> np.ndarray:
        a, b = self.beta
        self.steps += 1
        self.mean, self.square = a * self.mean + (1 - a) * grad, b * self.square + (1 - b) * grad * grad
        rate = self.rate * math.sqrt(1 - b ** self.steps) / (1 - a ** self.steps)
        return theta - rate * self.mean / (np.sqrt(self.square) + self.eps)


def fit_network(df: DataFrame, features: str, label: str, weight: str, width: int, classes: int, hidden: tuple[int, ...] = (100, 50), epochs: int = 300,
                slices: int = 8, alpha: float = 1e-4, rate: float = 1e-3, tol: float = 1e-4, patience: int = 10, seed: int = 42) -> tuple[Network, list[float]]:
    """A fitted network and the mean loss of each epoch. The loss of a step is the weighted mean cross-entropy of its slice and
    alpha / 2 times the squared matrices over the slice's weight. Fitting ends after ``epochs`` or when the loss has not fallen by ``tol`` for
    more than ``patience`` epochs in a row."""
    table = write_blocks(df, features, label, weight, BLOCK, lambda x: x, slices)
    net, names = new_network((width, *hidden, classes), seed), [c.split(" ")[0] for c in SCHEMA.split(", ")]
    parts = [table.filter(f"slice = {s}").select(*names).persist() for s in range(slices)]
    adam, penalised, rng = Adam(len(net.theta), rate), net.matrices(), np.random.default_rng([seed, 1])
    losses, best, waited = [], math.inf, 0
    for _ in range(epochs):
        mass, lost = 0.0, 0.0
        for s in rng.permutation(slices):
            n, loss, grad = summed_gradient(parts[s], net)
            if n > 0:
                theta = net.theta
                mass, lost = mass + n, lost + loss + alpha / 2 * float((penalised * theta * theta).sum())
                net = Network(net.sizes, adam.step(theta, (grad + alpha * penalised * theta) / n))
        if not mass:
            break
        losses.append(lost / mass)
        waited = waited + 1 if losses[-1] > best - tol else 0
        best = min(best, losses[-1])
        if waited > patience:
            break
    for part in parts:
        part.unpersist()
    return net, losses
