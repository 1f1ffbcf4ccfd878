"""Exact cosine links between embeddings by dual traversal of cover trees.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c), a metric. The top of the tree is chosen on a
bounded sample, in farthest-first order, which covers it with ever smaller radii; every vector joins its nearest centre, and
a centre's covering radius is measured over all its vectors. Cells are cut into blocks of about ``block_rows``. Two blocks meet
in one task unless the radii rule a link out, and a vector goes there only if it could reach the other cell.

Inside a task each block is a tree of its own: nested levels with halving radii, a node's covering radius measured over its
rows. Node pairs farther apart than the threshold and both radii are pruned, the others opened, and the rows of two leaves, or
of two nodes with few rows, are compared in double precision, in tiles of bounded size. So every pair is pruned by a bound or compared: the links are exact.

Equal vectors are folded first and counted by their number. A task returns the number of links of each vector and a forest of
links, never the pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing; of vectors of
several lengths only those of equal length link; rows that share an id count as linked; null ids keep their row, with a null
component; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowbench.llm.common import fixed
from flowbench.llm.components import connected, union_find

SAMPLE = 4096
BLOCK_ROWS = 8192
LEAF_ROWS = 64
CANDIDATES = 128
SLICE = 1024
TILE = 512
SLACK = 1e-4  # single-precision distances are off by less


def unit(vectors: np.ndarray) -> np.ndarray:
    v = np.asarray(vectors, np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class Node:
    """Rows within ``radius`` of the row ``center``; ``children`` are nodes with half the radius, none in a leaf."""

    __slots__ = ("center", "rows", "radius", "children")

    def __init__(self, rows: np.ndarray, center: int, radius: float, children: list[Node]):
        self.rows, self.center, self.radius, self.children = rows, center, radius, children


def build(x: np.ndarray, rows: np.ndarray, center: int, level: float) -> Node:
    """The tree of some rows of ``x`` (unit vectors in single precision), with children of radius ``level`` / 2.

    Centres are drawn evenly from the rows, the node's own first, and thinned until they are level / 2 apart. A row that none
    of them covers is a child by itself.
    """
    reach = distances(x[rows], x[[center]])[:, 0]
    radius = float(reach.max()) + SLACK
    if len(rows) <= LEAF_ROWS or level < 1 / 32:
        return Node(rows, center, radius, [])
    drawn = np.unique(np.append([center], rows[:: max(1, len(rows) // CANDIDATES)]))
    apart, centers = distances(x[drawn], x[drawn]), [int(np.flatnonzero(drawn == center)[0])]
    for i in range(len(drawn)):
        if apart[i, centers].min() > level / 2:
            centers.append(i)
    d = distances(x[rows], x[drawn[centers]])
    near = d.argmin(axis=1)
    covered = d[np.arange(len(rows)), near] <= level / 2
    children = [build(x, own, int(drawn[c]), level / 2) for k, c in enumerate(centers) if len(own := rows[covered & (near == k)])]
    children += [Node(rows[i:i + 1], int(rows[i]), 0.0, []) for i in np.flatnonzero(~covered)]
    return Node(rows, center, radius, children)


class Links:
    """Links between the rows of two blocks (or of one with itself), as counts and a forest."""

    def __init__(self, left: np.ndarray, right: np.ndarray, left_copies: np.ndarray, right_copies: np.ndarray, cosine: float):
        self.left, self.right, self.same = left, right, left is right
        self.small = left.astype(np.float32), right.astype(np.float32)
        self.copies, self.cosine = (left_copies, right_copies), cosine
        self.reach = float(np.sqrt(2 - 2 * cosine)) + SLACK
        self.counts = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
        self.forest: dict[int, int] = {}  # right rows are numbered after the left ones

    def find(self) -> None:
        a = build(self.small[0], np.arange(len(self.left)), 0, 2.0)
        self.meet(a, a if self.same else build(self.small[1], np.arange(len(self.right)), 0, 2.0))

    def meet(self, a: Node, b: Node) -> None:
        """All links between the rows of two nodes that the bounds do not rule out."""
        if not a.children and not b.children or len(a.rows) * len(b.rows) <= TILE * TILE:
            self.compare(a.rows, b.rows, a is b)
            return
        ours = self.parts(a)
        theirs = ours if a is b else self.parts(b)
        at, bt = np.array([n.center for n in ours]), np.array([n.center for n in theirs])
        ra, rb = np.array([n.radius for n in ours], np.float32), np.array([n.radius for n in theirs], np.float32)
        for first in range(0, len(ours), SLICE):
            part = slice(first, first + SLICE)
            near = distances(self.small[0][at[part]], self.small[1][bt]) <= self.reach + ra[part, None] + rb[None, :]
            if a is b:
                near &= np.arange(len(theirs))[None, :] >= np.arange(first, first + len(near))[:, None]
            i, j = np.nonzero(near)
            for k, m in zip((i + first).tolist(), j.tolist()):
                self.meet(ours[k], theirs[m])

    def parts(self, a: Node) -> list[Node]:
        """A node's children, with its single rows as one leaf."""
        single = [n.center for n in a.children if len(n.rows) == 1]
        return [n for n in a.children if len(n.rows) > 1] + [Node(np.array(single), a.center, a.radius, [])] * bool(single) or [a]

    def compare(self, i: np.ndarray, j: np.ndarray, same: bool) -> None:
        """All rows of two leaves, in tiles."""
        for first in range(0, len(i), TILE):
            for other in range(first if same else 0, len(j), TILE):
                a, b = i[first:first + TILE], j[other:other + TILE]
                linked = self.left[a] @ self.right[b].T >= self.cosine
                self.add(a, b, np.triu(linked, 1) if same and first == other else linked)

    def add(self, i: np.ndarray, j: np.ndarray, linked: np.ndarray) -> None:
        if not linked.any():
            return
        self.counts[0][i] += linked @ self.copies[1][j]
        self.counts[1][j] += self.copies[0][i] @ linked
        j = j if self.same else j + len(self.left)
        # Links already joined in the forest add nothing; of the rest one a row is taken until all are joined.
        while True:
            root = self.forest.get
            a = np.fromiter((root(x, x) for x in i.tolist()), np.int64, len(i))
            b = np.fromiter((root(x, x) for x in j.tolist()), np.int64, len(j))
            apart = linked & (a[:, None] != b[None, :])
            rows = np.flatnonzero(apart.any(axis=1))
            if not len(rows):
                return
            self.forest = union_find([*self.forest.items(), *zip(a[rows].tolist(), b[apart[rows].argmax(axis=1)].tolist())])


def _farthest_first(sample: np.ndarray, k: int) -> np.ndarray:
    chosen = [0]
    reach = distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(k, len(sample)) and reach.max() > 0:
        chosen.append(int(reach.argmax()))
        reach = np.minimum(reach, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def embedding_links(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, n_links, component_id, kept), one row per input row; ``cosine`` above 0."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("v", F.when(finite, F.col("v")))
    classes = rows.filter("v is not null and id is not null").groupBy("v").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    classes = fixed(classes.withColumn("dim", F.size("v")), "cover-classes")
    found = None
    for dim, n in ((r["dim"], r["n"]) for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()):
        part = _links(classes.filter(F.col("dim") == dim), n, cosine, block_rows)
        found = part if found is None else found.union(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "node long, links long, other long")
    found = fixed(found, "cover-links")
    counts = found.filter("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    answers = (classes.join(counts, "node", "left").join(roots, "node", "left")
               .select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")))
    return (rows.join(answers, "v", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))


def _links(classes: DataFrame, n: int, cosine: float, block_rows: int) -> DataFrame:
    """(node, links, null) and (node, 0, other): numbers of links and a forest of them, in parts."""
    sample = classes.select("v", "node").orderBy(F.xxhash64("node"), "node").limit(SAMPLE).toArrow()
    top = _farthest_first(unit(np.array(sample.column("v").to_pylist())), -(-n // block_rows)).astype(np.float32)

    def assign(batches):
        for b in batches:
            if b.num_rows:
                d = distances(unit(np.array(b.column("v").to_pylist())).astype(np.float32), top)
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([b.column("node"), b.column("copies"), b.column("v"), pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell], pa.float64())],
                                                 names=["node", "copies", "v", "cell", "reach"])

    placed = fixed(classes.select("node", "copies", "v").mapInArrow(assign, "node long, copies long, v array<double>, cell int, reach double"), "cover-cells")
    radius, blocks = np.zeros(len(top)), np.zeros(len(top), np.int64)  # one row per centre, of which there are SAMPLE at most
    for r in placed.groupBy("cell").agg(F.max("reach").alias("radius"), F.count("*").alias("n")).collect():
        radius[r["cell"]], blocks[r["cell"]] = r["radius"] + SLACK, -(-r["n"] // block_rows)
    first = np.cumsum(blocks) - blocks
    reach = float(np.sqrt(2 - 2 * cosine)) + SLACK
    apart = distances(top, top)
    meets = apart <= reach + radius[:, None] + radius[None, :]

    def send(batches):
        for b in batches:
            if not b.num_rows:
                continue
            node, cell = b.column("node").to_numpy(), b.column("cell").to_numpy()
            d = distances(unit(np.array(b.column("v").to_pylist())).astype(np.float32), top)
            goes = meets[cell] & (d <= reach + radius[None, :])
            goes[np.arange(len(d)), cell] = True
            own = first[cell] + (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks[cell]
            at, to = np.nonzero(goes)
            times = blocks[to]
            at, to = np.repeat(at, times), np.repeat(first[to], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            mine = own[at]
            for i in range(0, len(at), 20_000):
                part = slice(i, i + 20_000)
                take = pa.array(at[part])
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(mine[part], to[part])), pa.array(np.maximum(mine[part], to[part])), pa.array(mine[part] > to[part]),
                                                  b.column("node").take(take), b.column("copies").take(take), b.column("v").take(take)],
                                                 names=["left", "right", "is_right", "node", "copies", "v"])

    sent = placed.select("node", "copies", "v", "cell").mapInArrow(send, "left long, right long, is_right boolean, node long, copies long, v array<double>")

    def meet(key, table):
        node, copies, right = (table.column(c).to_numpy() for c in ("node", "copies", "is_right"))
        flat = table.column("v").combine_chunks().flatten().to_numpy()
        x = unit(flat.reshape(len(node), -1))
        sides = [np.flatnonzero(right == s) for s in (False, True)]
        same = key[0].as_py() == key[1].as_py()
        a, b = sides[0], sides[0] if same else sides[1]
        out: list[tuple] = []
        if len(a) and len(b):
            xa = x[a]
            links = Links(xa, xa if same else x[b], copies[a], copies[b], cosine)
            links.find()
            ids = node[a] if same else np.append(node[a], node[b])
            counts = links.counts[0] + links.counts[1] if same else np.append(*links.counts)
            out = [(int(ids[i]), int(counts[i]), None) for i in np.flatnonzero(counts)]
            out += [(int(ids[i]), 0, int(ids[j])) for i, j in links.forest.items() if i != j]
        return pa.table({k: pa.array(c, pa.int64()) for k, c in zip(("node", "links", "other"), zip(*out) if out else ((), (), ()))})

    return sent.groupBy("left", "right").applyInArrow(meet, "node long, links long, other long")
