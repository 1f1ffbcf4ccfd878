"""Mixture-controlled packing of documents into sequences of a fixed length by deficit round-robin over source queues.

Each source is a queue of its documents' tokens. Sequences are made of slots of ``grain`` tokens. A source's deficit grows by its
weight all the time, falls by one slot when it is served, and it is served when half a slot is owed to it. When a queue runs
dry, the others share its part. Documents are cut where a slot ends; neighbouring slots of one document are one piece.

When a source's next slot falls due follows from its number and the weights alone, so deficits are carried across windows and
partitions without one task seeing the whole queue: a document knows its place in its source's queue (running sums by block
and source), hence its slots, hence its sequences. Rows never move to be packed.

Defined results: a null text is an empty document (its end token alone); a null source is a source of its own; weights not
given are the source's share of the tokens; a weight must be positive; ids may repeat or be null; an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowbench.functions.small import pin_small
from flowbench.llm.common import fixed, sliced

LENGTH = 1024
GRAIN = 128
END_ID = 0
BASE_ROWS = 50_000
PLACED_ROWS = 2_500  # the cost of a call of ``pieces`` grows with the sources, so more rows at a time than of texts
_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """The tokenizer file's vocabulary in the fast byte-pair encoder; the file's special strings inside texts are kept whole.

    For a plain byte-level BPE whose ids are the order of its merges both libraries give the same ids; others are refused.
    """
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed: bytes that stand for themselves
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or [vocab[t] for t in joined] != list(range(256, 256 + len(joined))):
            raise ValueError("ids are not in the order of merges")
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in vocab.items() if t not in special}
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _ENCODERS[path]


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text. One on which the fast encoder's pattern runs out of stack, such as half a million spaces in a row, goes to the
    library that the file is made for."""
    try:
        return encoder(path).encode_to_numpy(text, allowed_special="all")
    except ValueError:
        from tokenizers import Tokenizer

        if (slow := f"{path}:whole") not in _ENCODERS:
            _ENCODERS[slow] = Tokenizer.from_file(path)
        return np.array(_ENCODERS[slow].encode(text, add_special_tokens=False).ids, np.uint32)


def tokenized(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", end_id: int = END_ID) -> DataFrame:
    """Per document: ``ids`` (little-endian unsigned 16 bits, with the end token), ``n_tokens``, its ``block`` of rows, and the
    tokens of its source ``before`` it in the block. Written once, so that blocks stay as they are."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        enc, block, seen = encoder(path), TaskContext.get().partitionId(), {}
        if enc.max_token_value > 0xFFFF:
            raise ValueError("ids do not fit 16 bits")
        for b in sliced(batches):
            ids, n, before = [], [], []
            for source, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                own = np.append(token_ids(text, path), end_id).astype("<u2")
                ids.append(own.tobytes())
                n.append(len(own))
                before.append(seen.get(source, 0))
                seen[source] = before[-1] + len(own)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary()), pa.array(n, pa.int64()), pa.array([block] * len(n), pa.int64()),
                                              pa.array(before, pa.int64())], names=["doc_id", "source", "ids", "n_tokens", "block", "before"])

    return fixed(rows.mapInArrow(run, f"doc_id {kind}, source string, ids binary, n_tokens long, block long, before long"), "pack-tokens")


@dataclass(frozen=True)
class Phase:
    """A run of slots in which the same sources are served: ``counts`` slots each, dealt evenly."""

    start: int
    counts: list[int]
    before: list[int]


class Schedule:
    """Which slot serves which part of which queue.

    A phase ends when the queue that is soonest empty runs dry. In a phase, a source with n slots is owed its r-th one (from
    0) when it has run for (r + 1/2) / n, half a slot of deficit; slots are served in that order, the first source first at
    ties. So a slot's number is the count of turns that are due before it, source by source.
    """

    def __init__(self, totals: dict[str | None, int], weights: dict[str | None, float] | None = None, length: int = LENGTH, grain: int = GRAIN):
        if length % grain:
            raise ValueError("grain must divide length")
        self.names = sorted(totals, key=lambda s: (s is not None, s or ""))
        self.at = {s: i for i, s in enumerate(self.names)}
        self.length, self.grain = length, grain
        self.tokens = [totals[s] for s in self.names]
        slots = [-(-t // grain) for t in self.tokens]
        weight = [float((weights or {}).get(s, n)) for s, n in zip(self.names, slots)] if not weights else \
            [float(weights[s]) if s in weights else t / max(1, sum(self.tokens)) for s, t in zip(self.names, self.tokens)]
        if any(w <= 0 for w, n in zip(weight, slots) if n):
            raise ValueError("weights must be positive")
        self.phases: list[Phase] = []
        left, before, start = list(slots), [0] * len(slots), 0
        while any(left):
            first = min((i for i, n in enumerate(left) if n), key=lambda i: left[i] / weight[i])
            pace = left[first] / weight[first]
            counts = [n if i == first else min(n, round(pace * w)) for i, (n, w) in enumerate(zip(left, weight))]
            self.phases.append(Phase(start, counts, list(before)))
            left = [n - c for n, c in zip(left, counts)]
            before = [b + c for b, c in zip(before, counts)]
            start += sum(counts)
        self.kind = np.int64 if start < 2_000_000_000 else object  # products of slot numbers must stay exact
        last = sorted((int(self.slots(i, np.array([n - 1]))[0]), n * grain - t) for i, (n, t) in enumerate(zip(slots, self.tokens)) if n and n * grain > t)
        self.short_slots = np.array([j for j, _ in last], np.int64)
        self.short_by = np.append([0], np.cumsum([m for _, m in last])).astype(np.int64)

    def slots(self, source: int, places: np.ndarray) -> np.ndarray:
        """Global slots that serve the given slots of a source's queue."""
        out = np.zeros(len(places), np.int64)
        for p in self.phases:
            n = p.counts[source]
            mine = (places >= p.before[source]) & (places < p.before[source] + n)
            if not n or not mine.any():
                continue
            nth = (places[mine] - p.before[source]).astype(self.kind)
            rank = nth.copy()
            for other, m in enumerate(p.counts):
                if m and other != source:  # turns of the other that are due before: (2 r + 1) / m against (2 nth + 1) / n
                    ahead = (2 * nth + 1) * m - n
                    rank += np.clip(ahead // (2 * n) + 1 if other < source else -(-ahead // (2 * n)), 0, m)
            out[mine] = p.start + rank.astype(np.int64)
        return out

    def pieces(self, sources: list[str | None], places: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, start in it, length, sequence, offset) of the pieces of documents of ``sizes`` tokens, ``places`` tokens into their sources' queues."""
        g, per = self.grain, self.length // self.grain
        count = (places + sizes - 1) // g + 1 - places // g
        row = np.repeat(np.arange(len(places)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + (places // g)[row]
        source = np.fromiter(map(self.at.__getitem__, sources), np.int64, len(sources))[row]
        slot = np.empty(len(row), np.int64)
        for i in np.unique(source).tolist():
            mine = source == i
            slot[mine] = self.slots(i, nth[mine])
        begin = np.maximum(nth * g, places[row])
        size = np.minimum(nth * g + g, (places + sizes)[row]) - begin
        sequence = slot // per
        missing = self.short_by[np.searchsorted(self.short_slots, slot)] - self.short_by[np.searchsorted(self.short_slots, sequence * per)]
        offset = slot % per * g + begin % g - missing
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (sequence[1:] != sequence[:-1]) | (offset[1:] != offset[:-1] + size[:-1])
        at = np.flatnonzero(new)
        return row[at], begin[at] - places[row[at]], np.add.reduceat(size, at), sequence[at], offset[at]


def pack(docs: DataFrame, path: str, weights: dict[str | None, float] | None = None, length: int = LENGTH, grain: int = GRAIN, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, source, start, length, ids (little-endian unsigned 32 bits), doc_tokens, sequence_id, offset.

    ``weights`` gives the mixture by source; the table of sources, one row each, is what the mixture is written in and is
    read by the driver.
    """
    rows = tokenized(docs, path, id_col, text_col, source_col, end_id)
    by_block = fixed(rows.groupBy("block", "source").agg(F.sum("n_tokens").alias("n")), "pack-blocks")
    totals = {r["source"]: r["n"] for r in by_block.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    schedule = Schedule(totals, weights, length, grain)
    running = F.sum("n").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    base = by_block.select(F.col("block").alias("b_block"), F.col("source").alias("b_source"), F.coalesce(running, F.lit(0)).alias("base"))
    placed = rows.join(pin_small(base, BASE_ROWS), F.col("block").eqNullSafe(F.col("b_block")) & F.col("source").eqNullSafe(F.col("b_source")))
    placed = placed.select("doc_id", "source", "ids", (F.col("base") + F.col("before")).alias("place"))

    def run(batches):
        for b in sliced(batches, PLACED_ROWS):
            own = [np.frombuffer(raw, "<u2") for raw in b.column(2).to_pylist()]
            sizes = np.fromiter(map(len, own), np.int64, len(own))
            row, start, size, seq, off = schedule.pieces(b.column(1).to_pylist(), b.column(3).to_numpy(zero_copy_only=False).astype(np.int64), sizes)
            ids = [own[r][s:s + n].astype("<u4").tobytes() for r, s, n in zip(row.tolist(), start.tolist(), size.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), *map(pa.array, (start, size, seq, off)), pa.array(ids, pa.binary()),
                                              pa.array(sizes[row])], names=["doc_id", "source", "start", "length", "sequence_id", "offset", "ids", "doc_tokens"])

    return placed.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, source string, start long, length long, sequence_id long, offset long, ids binary, doc_tokens long")


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = END_ID) -> DataFrame:
    """(sequence_id, n_tokens, ids array<int>): whole sequences of at most ``length`` ids, padded to it unless their own
    length is a power of two. A sequence has a bounded number of pieces."""
    rows = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("n_tokens"))

    def run(batches):
        for b in batches:
            out = []
            for parts in b.column(1).to_pylist():
                own = np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int32)
                bare = len(own) & (len(own) - 1) == 0
                out.append(own if bare else np.append(own, np.full(length - len(own), pad_id, np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(out, pa.list_(pa.int32()))], names=["sequence_id", "n_tokens", "ids"])

    return rows.select("sequence_id", "parts", "n_tokens").mapInArrow(run, "sequence_id long, n_tokens long, ids array<int>")
