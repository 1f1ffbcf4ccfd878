"""Quality grades by ordinal cumulative-link regression on hashed text.

Ratings are grades 0 < 1 < ... < top. One weight per hashed feature is shared by all grades, and ordered thresholds cut the
score: P(grade > k) = logistic(score - threshold k). From it follow the expected grade and the tail probability, by which
documents are selected. Features are the distinct words of the whole text and how it is written: logarithmic bins of the
shares of capitals, digits, marks and spaces, of the words' mean length and of the share of distinct words.

The model is fitted on at most ``sample_rows`` rated documents (those whose ids come first in hash order), a bound that is a
parameter; only features that ``min_docs`` of them share get a weight. All documents are scored.

Defined results: a null text is an empty one; a document with several ratings takes the lowest; null ratings, ratings of
null ids and of documents that are not there are ignored; without any rating every document gets the top grade and stays;
ids and repeated rows pass through unchanged; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowbench.llm.common import sliced

BITS = 20
SAMPLE_ROWS = 20_000
MIN_DOCS = 4
RIDGE = 3e-4
ROUNDS = 60
KEEP_TAIL = 0.5
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_TO_SPACE = bytes.maketrans(_MARKS, b" " * len(_MARKS))
_KINDS = {"capital": [*range(65, 91)], "digit": [*range(48, 58)], "white": [9, 10, 11, 12, 13, 32], "beyond": [*range(128, 256)],
          **{chr(b): [b] for b in _MARKS}}


def grade_of(quality: Column, toxic: Column) -> Column:
    """Grades of the labels: 0 toxic, 1 poor, 2 good."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


def features(text: str | None) -> np.ndarray:
    """Distinct hashed features of a whole text."""
    raw = (text or "").encode()
    words = (text or "").lower().encode().translate(_TO_SPACE).split()
    hashed = np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(1, len(raw))
    shape = [f"{kind}:{int(round(2 * np.log2(n / size)))}" for kind, own in _KINDS.items() if (n := int(counts[own].sum()))]
    shape.append(f"length:{int(round(2 * np.log2(size / max(1, len(words)))))}")
    shape.append(f"distinct:{int(10 * len(hashed) / max(1, len(words)))}")
    extra = np.fromiter((xxhash.xxh3_64_intdigest(s, 1) for s in shape), np.uint64, len(shape))
    return np.unique(np.append(hashed, extra) & np.uint64((1 << BITS) - 1)).astype(np.int32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass(frozen=True)
class Grader:
    """Weights by feature and rising thresholds, one below each grade but the lowest."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, one row per score."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def _loss(params: np.ndarray, at: np.ndarray, starts: np.ndarray, owner: np.ndarray, grade: np.ndarray, top: int, ridge: float):
    """Mean negative log-likelihood with ridge, and its gradient. The first ``top`` parameters are the lowest threshold and the
    logarithms of the steps between thresholds."""
    steps = np.exp(np.clip(params[1:top], -10, 10))
    thresholds, w = params[0] + np.append([0.0], np.cumsum(steps)), params[top:]
    score = np.add.reduceat(w[at], starts)
    edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
    low, high = _sigmoid(score - edges[grade + 1]), _sigmoid(score - edges[grade])  # P(grade > k), P(grade > k - 1)
    low, high = np.where(grade == top, 0.0, low), np.where(grade == 0, 1.0, high)
    p = np.maximum(high - low, 1e-12)
    d_low, d_high = low * (1 - low) / p, high * (1 - high) / p  # slopes of log p by the two edges
    n = len(score)
    d_score = -(d_high - d_low) / n
    grad = np.zeros_like(params)
    grad[top:] = np.bincount(at, d_score[owner], len(w)) + ridge * w
    by_threshold = np.bincount(np.minimum(grade, top - 1), np.where(grade < top, -d_low, 0) / n, top)
    by_threshold += np.bincount(np.maximum(grade - 1, 0), np.where(grade > 0, d_high, 0) / n, top)
    grad[0] = by_threshold.sum()
    for i in range(1, top):
        grad[i] = by_threshold[i:].sum() * steps[i - 1]
    return -np.log(p).mean() + 0.5 * ridge * (w @ w), grad


def minimise(loss, x: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with a backtracking line search."""
    value, grad = loss(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        step, used = grad.copy(), []
        for s, y in reversed(pairs):
            a = (s @ step) / (s @ y)
            used.append(a)
            step -= a * y
        step *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(1.0, np.linalg.norm(grad))
        for (s, y), a in zip(pairs, reversed(used)):
            step += s * (a - (y @ step) / (s @ y))
        slope, size = grad @ step, 1.0
        while True:
            new, new_grad = loss(x - size * step)
            if new <= value - 1e-4 * size * slope or size < 1e-6:
                break
            size /= 2
        moved, turned = -size * step, new_grad - grad
        if moved @ turned > 1e-12:
            pairs = [*pairs[1 - memory:], (moved, turned)] if len(pairs) >= memory else [*pairs, (moved, turned)]
        done = value - new < 1e-7 * max(1.0, abs(value))
        x, value, grad = x + moved, new, new_grad
        if done:
            break
    return x


def fit_grades(lists: list[np.ndarray], grade: np.ndarray, ridge: float = RIDGE, min_docs: int = MIN_DOCS, rounds: int = ROUNDS) -> Grader:
    """Fit on feature lists (each has one feature at least) and grades from 0."""
    weights = np.zeros(1 << BITS, np.float32)
    if not len(grade):
        return Grader(weights, np.array([-np.inf]))
    top = max(1, int(grade.max()))
    flat = np.concatenate(lists)
    common = np.bincount(flat, minlength=1 << BITS) >= min_docs
    place = np.where(common, np.cumsum(common), 0)  # place 0 holds the features without a weight of their own
    at, sizes = place[flat], np.array([len(x) for x in lists])
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(lists)), sizes)
    n = int(common.sum()) + 1

    def loss(x):
        value, grad = _loss(x, at, starts, owner, grade, top, ridge)
        grad[top] = 0.0
        return value, grad

    x = minimise(loss, np.zeros(top + n), rounds)
    weights[common] = x[top + 1:]
    return Grader(weights, x[0] + np.append([0.0], np.cumsum(np.exp(np.clip(x[1:top], -10, 10)))))


def fit_quality(docs: DataFrame, ratings: DataFrame, grade: Column, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Grader:
    """Fit on the rated documents whose ids come first in hash order, ``sample_rows`` at most."""
    rated = ratings.select(F.col(f"`{id_col}`").alias("id"), grade.cast("int").alias("grade")).filter("id is not null and grade is not null")
    rated = rated.groupBy("id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    chosen = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).join(F.broadcast(rated), "id")

    def run(batches):
        for b in sliced(batches):
            yield pa.RecordBatch.from_arrays([pa.array([features(t) for t in b.column(0).to_pylist()], pa.list_(pa.int32())), b.column(1)], names=["features", "grade"])

    got = chosen.select("text", "grade").mapInArrow(run, "features array<int>, grade int").toArrow()
    column = got.column("features").combine_chunks()
    flat, ends = column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())
    return fit_grades(np.split(flat, ends[:-1]) if len(ends) else [], got.column("grade").to_numpy().astype(np.int64))


def grade_documents(docs: DataFrame, grader: Grader, keep_tail: float = KEEP_TAIL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Input columns but clashing ones, with ``expected_grade``, ``tail_prob`` (of the top grade) and ``kept``."""
    own = ["expected_grade", "tail_prob", "kept"]
    text = docs.schema.names.index(text_col)
    others = [f for f in docs.schema.fields if f.name not in own]
    if [f.name for f in others] != docs.schema.names:
        return grade_documents(docs.select(*[F.col(f"`{f.name}`") for f in others]), grader, keep_tail, id_col, text_col)

    def run(batches):
        for b in sliced(batches):
            score = np.array([grader.weights[features(t)].sum() for t in b.column(text).cast(pa.string()).to_pylist()], np.float64)
            tails = grader.tails(score)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= keep_tail)],
                                             names=[*b.schema.names, *own])

    added = [T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_prob", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))
