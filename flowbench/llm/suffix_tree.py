"""Language-model scores by a probabilistic suffix tree.

Tokens are the words of the lower-cased text (A-Z) and one end. Every word seen ``min_count`` times in training is a symbol of its
own, as is the end; rarer words share classes by how they begin and end, and have their own share of their class. Contexts are
strings of symbols before a token, back to the start of its text, of any length unless ``depth`` limits it. A context is retained
when it was seen often enough and a divergence test, its count times the Kullback-Leibler distance from its next-symbol
distribution to that of its shorter suffix, exceeds what so many different next symbols give by chance. Only contexts of which the
shorter suffix is retained are looked at. Distributions are smoothed by the shorter context's, down to the root, and a symbol is
scored in the longest retained suffix of what stands before it.

Texts are read once. Each block of documents is kept as places in its own list of words; words with their counts go to buckets,
where the vocabulary is merged, and its counts and symbols return to the blocks that ask for them. The tree grows by one level at a
time, and with the corpus: a block counts which symbols followed the contexts that may be retained, buckets of contexts add the
blocks' counts up and test, and what is retained returns to the blocks that ask for it. A context too frequent for one bucket is
spread over several by its next symbols, and only its sums meet. A block comes to its own place by repeating the answers of the levels
before, until few contexts are left to be made longer: from then on it is handed over from level to level with the tokens that are
still on their way. So neither the table of words nor the tree is ever in one place.

Defined results: a null text is an empty one, whose only token is its end; a null ``held_out`` counts as false; without any
training token all classes are as likely; ids and repeated rows pass through unchanged; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowbench.llm.common import fixed

CLASSES = 48
MIN_COUNT = 16
MIN_GAIN = 2.0
PARENT_WEIGHT = 8.0
BLOCK_TOKENS = 2_000_000
BUCKET_WORDS = 400_000
BUCKET_TOKENS = 1_500_000
SPREAD_TOKENS = 200_000
HAND_OVER = 5  # when a level retains less than one event in so many tokens, walks are kept instead of repeated
START = 2**32 - 1  # the symbol before a text


def _binary(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "longs": pa.list_(pa.int64()), "booleans": pa.list_(pa.bool_())}
    fields = [f.split() for f in schema.split(",")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns)})


def _packed(values: np.ndarray) -> bytes:
    """Compressed by planes of bytes, after the number of values."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T) if len(values) else np.zeros(0, np.uint8)
    return len(values).to_bytes(8, "little") + (pa.compress(planes.tobytes(), "zstd", asbytes=True) if len(values) else b"")


def _unpacked(raw: bytes, kind) -> np.ndarray:
    n, kind = int.from_bytes(raw[:8], "little"), np.dtype(kind)
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(raw[8:], n * kind.itemsize, "zstd", asbytes=True), np.uint8).reshape(kind.itemsize, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


# --- blocks of documents ----------------------------------------------------------------------------------------------------

_BLOCK = "block long, ids longs, held booleans, sizes longs, places binary, words binary, trained binary, n_words long, n_tokens long, n_docs long"


def _blocks(docs: DataFrame) -> DataFrame:
    """One row per block: the documents' words as places in the block's list of words, most frequent first (packed), and how often each was seen in training."""
    def row(block: int, index: dict, ids: list, held: list, parts: list) -> tuple:
        sizes = np.array([len(p) for p in parts], np.int64)
        flat, train = np.concatenate(parts).astype(np.int64), ~np.array(held, bool)
        order = np.argsort(-np.bincount(flat, minlength=len(index)), kind="stable")
        rank = np.empty(len(index), np.int64)
        rank[order] = np.arange(len(index))
        flat = rank[flat]
        words = np.array(list(index), object)[order] if index else []
        trained = np.bincount(flat[np.repeat(train, sizes)], minlength=len(index)).astype(np.uint32)
        return (block, ids, held, sizes.tolist(), _packed(flat.astype(np.uint32)), _packed(np.frombuffer(b" ".join(words), np.uint8)), _packed(trained), len(index), int(sizes[train].sum()), int(train.sum()))

    def run(batches):
        base, number = TaskContext.get().partitionId() << 20, 0
        index, ids, held, parts, tokens = defaultdict(count().__next__), [], [], [], 0
        for b in batches:
            for i, text, out in zip(*(c.to_pylist() for c in b.columns)):
                words = text.encode().lower().split()
                parts.append(np.fromiter(map(index.__getitem__, words), np.uint32, len(words)))
                ids.append(i)
                held.append(out)
                tokens += len(words)
                if tokens >= BLOCK_TOKENS:
                    yield from _table(_BLOCK, [row(base + number, index, ids, held, parts)]).to_batches()
                    number += 1
                    index, ids, held, parts, tokens = defaultdict(count().__next__), [], [], [], 0
        if ids:
            yield from _table(_BLOCK, [row(base + number, index, ids, held, parts)]).to_batches()

    return fixed(docs.mapInArrow(run, _BLOCK.replace("longs", "array<long>").replace("booleans", "array<boolean>")), "lm-blocks")


def _dealt(blocks: DataFrame, buckets: int) -> DataFrame:
    """The blocks' words by bucket: (bucket, block, words, trained, places)."""
    schema = "bucket long, block long, words binary, trained binary, places binary"

    def run(batches):
        for b in batches:
            for block, raw, trained in zip(*(c.to_pylist() for c in b.columns)):
                words = np.array(_unpacked(raw, np.uint8).tobytes().split(), object)
                trained = _unpacked(trained, np.uint32)
                to = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(buckets)
                order = np.argsort(to, kind="stable")
                edges = np.flatnonzero(np.diff(to[order], prepend=np.uint64(buckets)))
                rows = [(int(to[p[0]]), block, b" ".join(words[p]), _binary(trained[p]), _binary(p.astype(np.uint32))) for p in np.split(order, edges)[1:]] if len(order) else []
                for i in range(0, len(rows), 1000):
                    yield from _table(schema, rows[i:i + 1000]).to_batches()

    return blocks.select("block", "words", "trained").mapInArrow(run, schema)


# --- vocabulary, classes and tree ------------------------------------------------------------------------------------------------------

def class_of(words: list[bytes], frequent: dict[bytes, int], classes: int) -> np.ndarray:
    """Classes of words: a frequent word's own, else one by its first two bytes and its last. The last class is the end's."""
    first, rest = len(frequent), classes - 1 - len(frequent)
    known, ends = frequent.get, {}

    def other(w: bytes) -> int:
        key = w[:2] + w[-1:]
        if key not in ends:
            ends[key] = first + xxhash.xxh3_64_intdigest(key) % rest
        return ends[key]

    return np.fromiter((c if (c := known(w)) is not None else other(w) for w in words), np.int64, len(words))


_CODED = "block long, places binary, counts binary, symbols binary, words binary, n_words long, n_seen long"


def _coded(classes: int, buckets: int, least: int):
    """A bucket's part of the vocabulary, in a row without a block, and for each block how often its words were seen in training, and their symbols."""
    def run(key, table):
        index: dict[bytes, int] = defaultdict(count().__next__)
        asked = [np.fromiter(map(index.__getitem__, raw.split()), np.int64) for raw in table.column("words").to_pylist()]
        trained = [np.frombuffer(x, np.uint32) for x in table.column("trained").to_pylist()]
        counts = np.bincount(np.concatenate(asked), np.concatenate(trained), len(index)).astype(np.int64)
        symbols = np.where(counts >= least, classes + np.arange(len(index)) * buckets + key[0].as_py(), class_of(list(index), {}, classes))
        if len(symbols) and symbols.max() >= START:
            raise ValueError("more words than symbols")
        rows = [(None, None, _packed(counts), None, b" ".join(index), len(index), int((counts > 0).sum()))]
        for block, places, p in zip(table.column("block").to_pylist(), table.column("places").to_pylist(), asked):
            rows.append((block, places, _packed(counts[p]), _packed(symbols[p].astype(np.uint32)), None, None, None))
        return _table(_CODED, rows)

    return run


def _class_sizes(vocabulary: DataFrame, classes: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct training words of each class of words seen fewer than ``least`` times."""
    schema = "class long, tokens long, words long"

    def run(batches):
        for b in batches:
            for raw, counts in zip(*(c.to_pylist() for c in b.columns)):
                counts = _unpacked(counts, np.int64)
                rare = counts < least
                own = class_of(np.array(raw.split(), object)[rare].tolist(), {}, classes)
                tokens, words = np.bincount(own, counts[rare], classes), np.bincount(own, counts[rare] > 0, classes)
                yield from _table(schema, [(c, int(tokens[c]), int(words[c])) for c in np.flatnonzero(words).tolist()]).to_batches()

    tokens, words = np.zeros(classes), np.zeros(classes)
    for r in vocabulary.select("words", "counts").mapInArrow(run, schema).groupBy("class").agg(F.sum("tokens").alias("t"), F.sum("words").alias("w")).collect():
        tokens[r["class"]], words[r["class"]] = r["t"], r["w"]
    return tokens, words


def _stream(places: bytes, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The block's tokens as places in its list of words, ``end`` for the end, and where each document begins."""
    ends = np.cumsum(sizes)
    flat = np.insert(_unpacked(places, np.uint32), ends, end)
    return flat, np.append([0], (ends + np.arange(1, len(ends) + 1))[:-1])


def _contexts(symbols: np.ndarray, starts: np.ndarray, depth: int, classes: int) -> np.ndarray:
    """Each symbol with the ``depth`` before it in its document, as one number in base classes + 1, the nearest last."""
    place = np.arange(len(symbols)) - np.repeat(starts, np.diff(np.append(starts, [len(symbols)])))
    keys = symbols.copy()
    for k in range(1, depth + 1):
        before = np.full(len(symbols), classes, np.int64)  # stands before the text
        before[k:] = np.where(place[k:] >= k, symbols[:-k], classes)
        keys += before * (classes + 1) ** k
    return keys


def grow(counts: np.ndarray, root: np.ndarray, min_count: int = MIN_COUNT, min_gain: float = MIN_GAIN, weight: float = PARENT_WEIGHT) -> tuple[np.ndarray, np.ndarray]:
    """From counts[oldest, ..., nearest, symbol] and the root's distribution: the probability of each symbol in each whole context,
    and the length of the suffix that it is scored in."""
    p, state = root, np.zeros(1, np.int64)
    depth = counts.ndim - 1
    for k in range(1, depth + 1):
        seen = counts.sum(axis=tuple(range(depth - k)))
        total = seen.sum(axis=-1, keepdims=True)
        q = np.broadcast_to(p, seen.shape)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(seen > 0, seen * np.log(seen / total / q), 0).sum(axis=-1, keepdims=True)
        kept = (total >= min_count) & (gain >= min_gain * (seen > 0).sum(axis=-1, keepdims=True))
        p = np.where(kept, (seen + weight * q) / (total + weight), q)
        state = np.where(kept[..., 0], k, np.broadcast_to(state, kept.shape[:-1]))
    return p, state


# --- levels --------------------------------------------------------------------------------------------------------------------------

_SENT = "bucket long, block long, runs binary, parents binary, symbols binary, priors binary, older binary, counts binary, bounds binary, state binary"
_LEVEL = "block long, level int, bucket long, useful binary, seen binary, totals binary, nodes binary, contexts binary, parents binary, symbols binary, sums binary, kept long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _groups(parents: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by (parent, pair), and where in it each distinct one begins."""
    order = np.lexsort((pairs, parents))
    a, b = parents[order], pairs[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new)


def _event_order(before: np.ndarray, older: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of tokens by (before, older, place), and where in it each distinct (before, older) begins. Where the three fit 64 bits
    they are sorted as one number, which takes much less time than sorting places by keys."""
    if not len(before):
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    low, high = int(older.max()).bit_length(), int(before.max()).bit_length()
    bits = (len(before) - 1).bit_length()
    keys = before.astype(np.uint64) << np.uint64(low) | older
    if low + high + bits <= 64:
        keys <<= np.uint64(bits)
        keys |= np.arange(len(keys), dtype=np.uint64)
        keys.sort()
        order = (keys & np.uint64((1 << bits) - 1)).astype(np.uint32)
        keys >>= np.uint64(bits)
    else:
        order = np.argsort(keys, kind="stable").astype(np.uint32)
        keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return order, np.flatnonzero(new).astype(np.uint32)


class Shape:
    """What every block knows of the training texts."""

    def __init__(self, total: int, distinct: int, train_docs: int, tokens: np.ndarray, kinds: np.ndarray, min_count: int, weight: float):
        self.total, self.distinct, self.train_docs, self.min_count, self.weight = total, distinct, train_docs, min_count, weight
        self.tokens, self.mass = tokens.copy(), tokens + kinds + 1
        self.tokens[-1], self.mass[-1] = train_docs, train_docs + 1
        self.sum = total + distinct - (train_docs > 0) + len(tokens)  # of the masses: one more for each word, class and the end
        self.spread = max(SPREAD_TOKENS, total // 1000)


class Walk:
    """A block's tokens on their way down the tree. Tokens after the same context are one event, and what they have in common is
    kept once for the event. Before the first level, events are symbols. ``shares``: also keep the shares of the tokens that stop."""

    def __init__(self, shape: Shape, places: bytes, sizes: np.ndarray, held: np.ndarray, counts: np.ndarray, symbols: np.ndarray, buckets: int, state: bytes | None = None, shares: bool = True):
        end, self.shape, self.buckets = [len(shape.tokens) - 1], shape, buckets
        own = symbols >= len(shape.tokens)
        classes = np.where(own, 0, symbols)
        flat, self.starts = _stream(places, sizes, len(counts))
        values, ranks = np.unique(np.append(symbols, end).astype(np.uint32), return_inverse=True)
        self.values = np.append(values, np.uint32(START))  # symbols by rank, and what stands before a text
        self.often = np.full(len(self.values), shape.train_docs, np.int64)
        self.often[ranks] = np.append(np.where(own, counts, shape.tokens[classes]), [0])
        self.flat, self.ranks = flat, ranks.astype(np.uint32)[flat]
        self.train = np.repeat(~held, sizes + 1)
        self.place = np.arange(len(flat), dtype=np.uint32)
        self.place -= np.repeat(self.starts.astype(np.uint32), sizes + 1)
        self.q = np.ones(len(flat)) if shares else None  # shares of tokens that are no longer on their way
        self.level, self.done, self.came = 0, np.zeros(len(sizes)), slice(None)
        if state is None:
            self.at, self.of = np.arange(len(flat), dtype=np.uint32), self.ranks  # tokens of which the context may be longer, and their events
            self.symbol, self.share = values, np.empty(len(values))
            self.share[ranks] = np.append(np.where(own, counts + 1, shape.mass[classes]), shape.mass[end]) / shape.sum
            self.nodes, self.totals = np.zeros(len(values), np.int64), np.full(len(values), np.iinfo(np.int64).max)
        else:
            self.level, *parts = pickle.loads(state)
            kinds = (np.float64, np.uint32, np.uint32, np.float64, np.int64, np.int64)
            self.done, self.at, self.of, self.share, self.nodes, self.totals = map(_unpacked, parts, kinds)
            self.came = self.at = np.cumsum(self.at, dtype=np.uint32)
            self.symbol = np.empty(len(self.share), np.uint32)
            self.symbol[self.of] = values[self.ranks[self.at]]

    def state(self) -> bytes:
        """What goes on from here: the tokens on their way, and the sums of the logarithms of the others' shares."""
        rest = np.zeros(len(self.q))
        rest[self.came] = np.log10(self.q[self.came])
        done = self.done + (np.add.reduceat(rest, self.starts) if len(rest) else 0)
        order = np.argsort(self.at)
        gaps = np.diff(self.at[order], prepend=np.uint32(0))
        return pickle.dumps((self.level, *map(_packed, (done, gaps, self.of[order], self.share, self.nodes, self.totals))))

    def scored(self) -> np.ndarray:
        """Shares of all tokens, of those still on their way too."""
        self.q[self.at] = self.share[self.of]
        return self.q

    def open(self) -> None:
        """The next level's events: tokens after contexts longer by one symbol, and the buckets that they are counted in."""
        self.level += 1
        k = np.uint32(self.level)
        older = np.where(self.place[self.at] >= k, self.ranks[np.maximum(self.at, k) - k], np.uint32(len(self.values) - 1))
        order, self.first = _event_order(self.of, older)
        one = order[self.first]
        self.before, older, self.at, self.of = self.of[one], older[one], self.at[order], None
        del order, one
        self.older, self.symbol, self.share = self.values[older], self.symbol[self.before], self.share[self.before]
        spread = (np.minimum(self.often[older], self.totals[self.before]) // self.shape.spread + 1).astype(np.uint64)
        self.wide = spread > 1
        to = _mixed(_mixed(self.nodes)[self.before] ^ self.older.astype(np.uint64))
        w = np.flatnonzero(self.wide)
        to[w] += _mixed(self.older[w].astype(np.uint64) << np.uint64(32) | self.symbol[w]) % spread[w]
        to = (to % np.uint64(self.buckets)).astype(np.uint32)
        self.dealt = np.argsort(to.astype(np.uint16) if self.buckets <= 1 << 16 else to, kind="stable").astype(np.uint32)  # events by bucket; 16 bits are sorted by radix
        to = to[self.dealt]
        begin = np.flatnonzero(np.diff(to, prepend=np.uint32(START)))
        self.parts = dict(zip(to[begin].tolist(), zip(begin.tolist(), [*begin[1:].tolist(), len(to)])))

    def events(self, block: int) -> list[tuple]:
        """By bucket; what follows from the event of the level before is sent once for the events that come from it."""
        if not len(self.first):
            return []
        n, rows = np.add.reduceat(self.train[self.at], self.first, dtype=np.uint32), []
        for bucket, (i, j) in self.parts.items():
            p = self.dealt[i:j]
            before, older = self.before[p], self.older[p]
            new = np.ones(len(p), bool)
            new[1:] = before[1:] != before[:-1]
            run = p[new]
            rows.append((bucket, block, _packed(np.packbits(new)), _packed(self.nodes[before[new]]), _packed(self.symbol[run]), _packed(self.share[run].astype(np.float32)),
                         _packed(np.diff(older, prepend=np.uint32(0))), _packed(n[p]), _packed(np.packbits(self.wide[p])), None))
        return rows

    def step(self, answers: list[tuple], hot: tuple) -> None:
        """Go where the answers lead: (bucket, useful, seen, totals, nodes, contexts) of its events; a total of -1 is among the hot contexts'."""
        m = len(self.first)
        seen, totals, nodes = (np.zeros(m, np.int64) for _ in range(3))
        for bucket, useful, own, context_totals, context_nodes, contexts in answers:
            i, j = self.parts[bucket]
            p = self.dealt[i:j][np.unpackbits(_unpacked(useful, np.uint8), count=j - i).view(bool)]
            contexts = _unpacked(contexts, np.uint32)
            seen[p] = _unpacked(own, np.int64)
            totals[p], nodes[p] = _unpacked(context_totals, np.int64)[contexts], _unpacked(context_nodes, np.int64)[contexts]
        self.dealt = self.parts = None
        spread = np.flatnonzero(totals < 0)
        if len(spread):
            parents, rank = np.unique(self.nodes[self.before[spread]], return_inverse=True)
            keys, pair = np.unique(rank.astype(np.uint64) << np.uint64(32) | self.older[spread], return_inverse=True)
            found = [hot.get((int(parents[x >> 32]), x & START), (0, 0)) for x in keys.tolist()]
            nodes[spread], totals[spread] = np.array(found, np.int64)[pair].T
        kept, w = totals > 0, self.shape.weight
        share = np.where(kept, (seen + w * self.share) / (totals + w), self.share)
        times = np.diff(np.append(self.first, [len(self.at)]))
        often = np.ones(len(self.ranks), bool)
        often[self.at] = np.repeat(seen >= self.shape.min_count, times)
        further = np.repeat(kept & (self.older != START), times)
        further &= often[np.maximum(self.at, 1) - 1]  # a longer context was seen no more often than its last symbol after the context before it
        of = np.repeat(np.arange(m, dtype=np.uint32), times)
        if self.q is not None:
            self.q[self.at[~further]] = share[of[~further]]
        self.at, of = self.at[further], of[further]
        new = np.ones(len(of), bool)
        new[1:] = of[1:] != of[:-1]
        e, self.of = of[new], np.cumsum(new, dtype=np.uint32) - np.uint32(1)
        self.symbol, self.share, self.nodes, self.totals = self.symbol[e], share[e], nodes[e], totals[e]
        self.first = self.before = self.older = self.wide = None


def _tested(key, table, level: int, buckets: int, min_count: int, min_gain: float):
    """A bucket's contexts: what is retained, answered to each block, and the sums of the contexts that are spread."""
    columns = {c: table.column(c).to_pylist() for c in ("block", "runs", "parents", "symbols", "priors", "older", "counts", "bounds")}
    older = [np.cumsum(_unpacked(x, np.uint32), dtype=np.uint32) for x in columns.pop("older")]
    sizes = [len(x) for x in older]
    older, counts = np.concatenate(older), np.concatenate([_unpacked(x, np.uint32) for x in columns.pop("counts")])
    bits = {c: np.concatenate([np.unpackbits(_unpacked(x, np.uint8), count=n).view(bool) for x, n in zip(columns.pop(c), sizes)]) for c in ("runs", "bounds")}
    runs, spread = np.cumsum(bits["runs"], dtype=np.int32) - 1, bits["bounds"]
    parents, symbols, priors = (np.concatenate([_unpacked(x, k) for x in columns.pop(c)]) for c, k in (("parents", np.int64), ("symbols", np.uint32), ("priors", np.float32)))
    pairs = older.astype(np.uint64) << np.uint64(32) | symbols[runs]
    order, first = _groups(parents[runs], pairs)
    seen = np.add.reduceat(counts[order], first, dtype=np.int64)
    one = order[first]
    q, parent, older, wide = priors[runs[one]].astype(np.float64), parents[runs[one]], older[one], spread[one]
    event = np.empty(len(pairs), np.uint32)
    event[order] = np.repeat(np.arange(len(one), dtype=np.uint32), np.diff(np.append(first, [len(pairs)])))
    del pairs, order, first, runs, counts, spread
    new = np.ones(len(one), bool)
    new[1:] = (parent[1:] != parent[:-1]) | (older[1:] != older[:-1])
    begin = np.flatnonzero(new)
    terms = seen * np.log(np.where(seen > 0, seen, 1) / q)
    total, gain, kinds_seen = np.add.reduceat(seen, begin), np.add.reduceat(terms, begin), np.add.reduceat((seen > 0).astype(np.int64), begin)
    kept = (total >= min_count) & (gain - total * np.log(np.maximum(total, 1)) >= min_gain * kinds_seen) & ~wide[begin]
    of = (np.cumsum(new) - 1).astype(np.uint32)
    totals = np.where(wide[begin], -1, np.where(kept, total, 0))
    nodes = np.where(kept, (np.arange(len(begin)) + 1) * buckets + key[0].as_py(), 0)
    useful, goes_on = (seen >= min_count) | (totals[of] != 0), totals[of] != 0
    rows, at, here = [], 0, np.zeros(len(begin), bool)
    for block, size in zip(columns["block"], sizes):
        e = event[at:at + size]
        u = useful[e]
        if u.any():
            e = e[u]
            here[:] = False
            here[of[e]] = True
            own, contexts = np.flatnonzero(here), (np.cumsum(here, dtype=np.uint32) - np.uint32(1))[of[e]]
            rows.append((block, level, key[0].as_py(), _packed(np.packbits(u)), _packed(seen[e]), _packed(totals[own]), _packed(nodes[own]),
                         _packed(contexts), None, None, None, int(goes_on[e].sum())))
        at += size
    h = wide[begin] & (total > 0)
    if h.any():
        sums = np.stack([total[h], np.rint(gain[h] * 1024).astype(np.int64), kinds_seen[h]], axis=1).reshape(-1)
        rows.append((-1, level, key[0].as_py(), None, None, None, None, None, _packed(parent[begin][h]), _packed(older[begin][h].astype(np.int64)), _packed(sums), 0))
    return _table(_LEVEL, rows)


def _hot(level: DataFrame, min_count: int, min_gain: float) -> dict[tuple[int, int], tuple[int, int]]:
    """Retained contexts that were spread over buckets: (parent, symbol) to (node, total). Each may have a thousandth of all tokens."""
    def run(batches):
        for b in batches:
            for parents, symbols, sums in zip(*(c.to_pylist() for c in b.columns)):
                sums = _unpacked(sums, np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([pa.array(_unpacked(parents, np.int64)), pa.array(_unpacked(symbols, np.int64)), *(pa.array(sums[:, i].copy()) for i in range(3))],
                                                 names=["parent", "symbol", "total", "gain", "kinds"])

    sums = (level.filter("block = -1").select("parents", "symbols", "sums").mapInArrow(run, "parent long, symbol long, total long, gain long, kinds long")
            .groupBy("parent", "symbol").agg(F.sum("total").alias("total"), F.sum("gain").alias("gain"), F.sum("kinds").alias("kinds")).filter(F.col("total") >= min_count))
    kept = sorted((r["parent"], r["symbol"], r["total"]) for r in sums.collect() if r["gain"] / 1024 - r["total"] * np.log(r["total"]) >= min_gain * r["kinds"])
    return {(p, s): (-1 - i, n) for i, (p, s, n) in enumerate(kept)}


# --- scores ----------------------------------------------------------------------------------------------------------------------

def _walked(shape: Shape, buckets: int, block, coded, steps: list[tuple], hot: list[dict], state: bytes | None, shares: bool) -> tuple[Walk, np.ndarray, np.ndarray]:
    """A block's walk after the levels of ``hot``, from its beginning or the level that it was handed over at; its words' counts and shares."""
    sizes, held = np.array(block["sizes"], np.int64), np.array(block["held"], bool)
    counts, symbols = np.zeros(block["n_words"], np.int64), np.zeros(block["n_words"], np.int64)
    for at, c, x in coded:
        at = np.frombuffer(at, np.uint32)
        counts[at], symbols[at] = _unpacked(c, np.int64), _unpacked(x, np.uint32)
    walk = Walk(shape, block["places"], sizes, held, counts, symbols, buckets, state, shares)
    for k in range(walk.level + 1, len(hot) + 1):
        walk.open()
        walk.step([s[1:] for s in steps if s[0] == k], hot[k - 1])
    return walk, counts, symbols


_STATE = ["sizes", "held", "places", "n_words"]
_ANSWER = ["bucket", "useful", "seen", "totals", "nodes", "contexts"]
_KNOWN = ["block", "level", "places", "counts", "symbols", *_ANSWER, "state"]


def _on_blocks(blocks: DataFrame, words: DataFrame, levels: list[DataFrame], states: DataFrame | None, use, schema: str) -> DataFrame:
    """``use(block, coded, steps, state)`` on each block with what is known of it."""
    def rows(df: DataFrame, level: Column) -> DataFrame:
        own = [F.col(c) if c in df.columns else F.lit(None).cast("long" if c == "bucket" else "binary").alias(c) for c in _KNOWN[2:]]
        return df.select("block", level.alias("level"), *own)

    known = rows(words, F.lit(0))
    for level in levels:
        known = known.union(rows(level.filter("block >= 0").select("block", "level", *_ANSWER), F.col("level")))
    if states is not None:
        known = known.union(rows(states.filter("state IS NOT NULL").select("block", "state"), F.lit(-1)))

    def run(key, block, known):
        known = list(zip(*(known.column(c).to_pylist() for c in _KNOWN[1:])))
        one = {c: block.column(c)[0].as_py() for c in block.column_names}
        state = next((r[-1] for r in known if r[0] == -1), None)
        return use(one, [r[1:4] for r in known if r[0] == 0], [(r[0], *r[4:-1]) for r in known if r[0] > 0], state)

    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, schema)


def _scored(shape: Shape, hot: list[dict], buckets: int):
    """Scores of a block's documents."""
    def run(block, coded, steps, state):
        walk, counts, symbols = _walked(shape, buckets, block, coded, steps, hot, state, True)
        sizes, ids, flat, starts = np.array(block["sizes"], np.int64), block["ids"], walk.flat, walk.starts
        within = np.where(symbols < len(shape.mass), np.log10((counts + 1) / shape.mass[np.minimum(symbols, len(shape.mass) - 1)]), 0.0)
        counts = np.append(counts, [shape.train_docs])  # each document's end
        base = np.log10((counts + 1) / (shape.total + shape.distinct + 1))
        known, score = (counts > 0).astype(np.int64)[flat], np.log10(walk.scored()) + np.append(within, [0.0])[flat]
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(block["held"], pa.bool_()), "n_tokens": pa.array(sizes + 1),
                         "n_known": pa.array(np.add.reduceat(known, starts)), "train_tokens": pa.array(np.full(len(ids), shape.total), pa.int64()),
                         "base_score": pa.array(np.add.reduceat(base[flat], starts)), "score": pa.array(walk.done + np.add.reduceat(score, starts))})

    return run


def _next_level(blocks: DataFrame, words: DataFrame, levels: list[DataFrame], states: DataFrame | None, shape: Shape, hot: list[dict], buckets: int, min_gain: float,
                hand_over: bool) -> tuple[DataFrame, DataFrame | None]:
    """The answers of the next level, and the walks as they are before it if they are handed over."""
    k, min_count = len(hot) + 1, shape.min_count

    def send(block, coded, steps, state):
        walk = _walked(shape, buckets, block, coded, steps, hot, state, hand_over)[0]
        rows = [(None, block["block"], *[None] * 7, walk.state())] if hand_over else []
        walk.open()
        return _table(_SENT, rows + walk.events(block["block"]))

    sent = _on_blocks(blocks.select("block", *_STATE), words, levels, states, send, _SENT)
    if hand_over:
        sent = fixed(sent, f"lm-walks-{k}")
    events = sent.filter("bucket IS NOT NULL").drop("state")
    return fixed(events.groupBy("bucket").applyInArrow(lambda key, table: _tested(key, table, k, buckets, min_count, min_gain), _LEVEL), f"lm-level-{k}"), sent if hand_over else None


def score_texts(docs: DataFrame, held_out: Column, depth: int | None = None, classes: int = CLASSES, min_count: int = MIN_COUNT, min_gain: float = MIN_GAIN,
                weight: float = PARENT_WEIGHT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), one row per input row; learns from the
    rows where ``held_out`` does not hold."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks = _blocks(rows)
    sums = blocks.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens"), F.sum("n_docs").alias("docs")).first()
    train_docs, min_count = sums["docs"] or 0, max(1, min_count)
    buckets = max(1, -(-(sums["words"] or 0) // BUCKET_WORDS))
    known = fixed(_dealt(blocks, buckets).groupBy("bucket").applyInArrow(_coded(classes, buckets, min_count), _CODED), "lm-words")
    vocabulary, words = known.filter("block IS NULL"), known.filter("block IS NOT NULL").select("block", "places", "counts", "symbols")
    seen = vocabulary.agg(F.sum("n_seen").alias("n")).first()["n"] or 0
    total, distinct = (sums["tokens"] or 0) + train_docs, seen + (train_docs > 0)
    tokens, kinds = _class_sizes(vocabulary, classes, min_count)
    shape = Shape(total, distinct, train_docs, tokens, kinds, min_count, weight)
    levels, hot, states, hand_over, spread = [], [], None, False, max(1, -(-total // BUCKET_TOKENS))
    while total and (depth is None or len(hot) < depth):
        level, states = _next_level(blocks, words, levels, states, shape, hot, spread, min_gain, hand_over)
        levels = [level] if hand_over else [*levels, level]
        hot.append(_hot(level, min_count, min_gain))
        docs.sparkSession.sparkContext._jvm.System.gc()  # lets Spark's cleaner delete the shuffle files of the level
        kept = level.agg(F.sum("kept").alias("n")).first()["n"] or 0
        if not kept:
            break
        hand_over = hand_over or kept * HAND_OVER < total
    return _on_blocks(blocks.select("block", *_STATE, "ids"), words, levels, states, _scored(shape, hot, spread),
                      "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
