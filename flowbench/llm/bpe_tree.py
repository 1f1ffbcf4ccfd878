"""Byte-level BPE by monoid tree reduction: encode halves, join neighbours, concatenate to decode.

A list of tokens is the encoding of its bytes exactly when each neighbouring pair is the encoding of its own bytes. So the
encodings of two halves are joined by re-encoding a window around the seam, and growing it on the side where the pair
formed with the token outside is not stable yet; once both pairs are stable, no token outside the window can change. Join
is associative with the empty list as its unit, so a text of any length is reduced as a balanced tree. Decoding maps
tokens to bytes and concatenates up the same tree.

Defined results: a null text is an empty one (no ids, the digest of nothing); an empty table gives an empty result; ids and
repeated rows pass through unchanged; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 12
SHORT = 64
CACHED = 400_000


def compiled(pattern: str, stop: int) -> re.Pattern:
    """``pattern`` for Python's own, faster matcher and texts of characters below ``stop``: ``\\p{L}``, ``\\p{N}`` and ``\\s``
    are written out as ranges."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, stop))))

    def ranges(kind: str) -> str:
        out = []
        for m in regex.finditer(f"{kind}+", every):
            first = m.start()
            for k in range(m.start() + 1, m.end() + 1):  # a run may step over the surrogates
                if k == m.end() or ord(every[k]) != ord(every[k - 1]) + 1:
                    out.append(f"\\U{ord(every[first]):08x}-\\U{ord(every[k - 1]):08x}")
                    first = k
        return "".join(out)

    for kind in (r"\p{L}", r"\p{N}", r"\s", r"\S"):
        span = ranges(kind.lower() if kind == r"\S" else kind)
        inside = re.compile(r"(\[[^\]]*)" + re.escape(kind))
        while inside.search(pattern) and kind != r"\S":
            pattern = inside.sub(lambda m, r=span: m[1] + r, pattern)
        pattern = pattern.replace(kind, f"[{'^' * (kind == r'\S')}{span}]")
    return re.compile(pattern)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class TreeCoder:
    """Encoder and decoder of one rank table in which each token encodes to itself; short pieces are remembered, at most
    ``CACHED`` of each kind."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.narrow, self.wide = ranks, compiled(pattern, 0x10000), compiled(pattern, 0x110000)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.windows = _Remembered(self.merge)
        self.words = _Remembered(self.word)

    # --- leaves -----------------------------------------------------------------------------------------------------

    def merge(self, piece: bytes) -> list[int]:
        """Encoding of a short stretch: merge the neighbours of lowest rank, leftmost first, until none can be merged."""
        rank, n, never = self.ranks.get, len(piece), len(self.ranks) << 8
        if n > 16 * SHORT:
            return self._merge_long(piece)
        cuts, pairs = list(range(n + 1)), [rank(piece[i:i + 2], never) for i in range(n - 1)]
        while pairs and (least := min(pairs)) < never:
            i = pairs.index(least)
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(piece[cuts[i]:cuts[i + 2]], never)
            if i:
                pairs[i - 1] = rank(piece[cuts[i - 1]:cuts[i + 1]], never)
        return [self.ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap of pairs, for windows that had to grow; pairs that are gone are skipped."""
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue
            end[j], end[i] = 0, stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (k := before[i]) >= 0 and (r := ranks.get(piece[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    # --- the monoid ---------------------------------------------------------------------------------------------------

    def _window(self, piece: bytes) -> list[int]:
        return self.windows[piece] if len(piece) <= SHORT else self.merge(piece)

    def is_stable(self, a: int, b: int) -> bool:
        """Whether (a, b) is the encoding of its own bytes."""
        return len(w := self._window(self.bytes_of[a] + self.bytes_of[b])) == 2 and w[0] == a

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the two halves' bytes together, from the halves' encodings."""
        if not left or not right:
            return left + right
        bytes_of, i, j = self.bytes_of, 1, 1
        window = self._window(bytes_of[left[-1]] + bytes_of[right[0]])
        while True:
            left_ok = i >= len(left) or window[0] == left[-i] or self.is_stable(left[-i - 1], window[0])
            right_ok = j >= len(right) or window[-1] == right[j - 1] or self.is_stable(window[-1], right[j])
            if left_ok and right_ok:
                return left[:-i] + window + right[j:]
            i = i if left_ok else min(2 * i, len(left))
            j = j if right_ok else min(2 * j, len(right))
            window = self._window(b"".join(map(bytes_of.__getitem__, left[-i:] + right[:j])))

    def encode_piece(self, piece: bytes) -> list[int]:
        """One match of the pattern, by halves; a stretch that is itself a token is a leaf."""
        token = self.ranks.get(piece)
        if token is not None:
            return [token]
        if len(piece) <= LEAF:
            return self.merge(piece)
        half = len(piece) // 2
        return self.join(self.encode_piece(piece[:half]), self.encode_piece(piece[half:]))

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the tokens; halves are concatenated up the tree, runs of tokens at its leaves at once."""
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    # --- texts ----------------------------------------------------------------------------------------------------------

    def word(self, word: str) -> tuple[list[int], bytes]:
        """Ids of one match of the pattern, also as decimals joined by commas."""
        ids = self.encode_piece(word.encode())
        return ids, ",".join(map(str, ids)).encode()

    def encode(self, text: str) -> tuple[list[int], bytes]:
        """Ids of a text (matches of the pattern do not merge, so their join is concatenation), also as joined decimals."""
        matches = (self.narrow if 2 * len(text) == len(text.encode("utf-16-le")) else self.wide).findall(text)
        ids, decimals = zip(*map(self.words.__getitem__, matches)) if matches else ((), ())
        return list(itertools.chain.from_iterable(ids)), b",".join(decimals)


class _Remembered(dict):
    """Values of a function of short keys, made when first asked for; emptied when ``CACHED`` are held."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= SHORT:
            if len(self) >= CACHED:
                self.clear()
            self[key] = value
        return value


_CODERS: dict[tuple[str, str], TreeCoder] = {}


def coder(path: str, pattern: str) -> TreeCoder:
    """The coder of a vocabulary file, built once in each Python worker."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = TreeCoder(read_ranks(path), pattern)
    return _CODERS[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text."""
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        c = coder(path, pattern)
        for b in batches:
            ids = [c.encode(t)[0] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    return rows.mapInArrow(run, f"`{id_col}` {_kind(docs, id_col)}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, decoded binary) of a table of ids; null ids decode to nothing."""
    def run(batches):
        c = coder(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(x or []) for x in b.column(1).to_pylist()], pa.binary())], names=[id_col, "decoded"])

    return encoded.select(f"`{id_col}`", "ids").mapInArrow(run, f"`{id_col}` {_kind(encoded, id_col)}, decoded binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode, decode and digest in one pass, without ids leaving the worker."""
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        c = coder(path, pattern)
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                ids, decimals = c.encode(t)
                out.append((len(ids), hashlib.sha256(decimals).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()))
            n, digest, decoded = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(decoded, pa.string())],
                                             names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, f"`{id_col}` {_kind(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _kind(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()
