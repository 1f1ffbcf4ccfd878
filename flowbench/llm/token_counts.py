"""Token counts by finite-state transducers.

A byte-level BPE tokenizer is compiled into two deterministic machines. The first reads classes of characters (with the next
two in view) and marks where the pre-tokenizer's pieces begin; it has eight states. The second reads the bytes of a piece;
its state holds what the encoding of any longer prefix can depend on, and each transition is annotated with the change
in the number of tokens, so that the annotations of a text add up to its count. Its transitions are compiled when first
taken and kept in a table of bounded size.

The stream of a batch is cut into chunks of a fixed size, without regard to texts or pieces, and all chunks advance together.
For the first machine each chunk gives a map from entry state to exit state, and the maps are composed by a parallel prefix
scan. For the second a chunk's map is constant as soon as a piece begins in it, so the scan hands exit states on to the next
chunk, whose head is then read; only a piece longer than a chunk needs further rounds.

Defined results: a null text is an empty one with no tokens; an empty table gives an empty result; ids and repeated rows pass
through unchanged; other columns of the input are not read.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 256
MAX_STATES = 120_000
FEW = 40
STREAM_CHARS = 4_000_000

# Classes of characters, and the symbols of the first machine.
LETTER, NUMBER, OTHER, SPACE, WHITE, END, UNKNOWN = 0, 1, 2, 3, 4, 5, 255
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_SPACE, S_LAST_SPACE, S_WHITE, S_LAST_WHITE, S_END = range(10)
NEW, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_WHITE, AFTER_SPACE, ONE_LEFT, TWO_LEFT = range(8)


def _boundary_machine() -> tuple[np.ndarray, np.ndarray]:
    """next[state, symbol], and whether a piece begins at that symbol."""
    nxt, begins = np.zeros((8, 10), np.uint8), np.ones((8, 10), bool)
    for state in range(8):
        for symbol, into in ((S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS), (S_OTHER, IN_OTHER)):
            nxt[state, symbol], begins[state, symbol] = into, state not in (into, AFTER_SPACE)
        for symbol, into in ((S_SHORT, ONE_LEFT), (S_LONG, TWO_LEFT)):  # an apostrophe before s, t, m, d or re, ve, ll
            joins = state in (IN_OTHER, AFTER_SPACE)
            nxt[state, symbol], begins[state, symbol] = IN_OTHER if joins else into, not joins
        for symbol in (S_SPACE, S_WHITE):
            nxt[state, symbol], begins[state, symbol] = IN_WHITE, state != IN_WHITE
        nxt[state, S_LAST_SPACE], nxt[state, S_LAST_WHITE], nxt[state, S_END] = AFTER_SPACE, NEW, NEW
    for state, into in ((ONE_LEFT, NEW), (TWO_LEFT, ONE_LEFT)):
        nxt[state, S_LETTER], begins[state, S_LETTER] = into, False
    return nxt, begins


def scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of maps (one row each: state -> state) in log2(n) rounds."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], axis=1)
        step *= 2
    return out


class CountTransducer:
    """The two machines of a tokenizer file with byte-level BPE, the usual pattern, and added tokens that are split off first."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if (spec["normalizer"] or spec["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])):
            raise ValueError("the transducer is compiled for plain byte-level BPE only")
        self.added = [t["content"] for t in spec["added_tokens"]]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed: bytes that stand for themselves; the others follow from 256 on
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        raw = lambda s: bytes(map(byte_of.__getitem__, s))
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in reversed(list(enumerate(merges)))}
        self.tokens = {raw(t) for t in spec["model"]["vocab"] if t not in self.added}
        self._halve([(raw(a), raw(b)) for a, b in merges])
        self.longer: dict[bytes, list[bytes]] = {}  # tokens that go on after a prefix
        for t in self.tokens:
            for i in range(1, len(t)):
                self.longer.setdefault(t[:i], []).append(t)
        self.classes = np.full(0x110001, UNKNOWN, np.uint8)
        self.classes[0x110000], self.classes[0x20] = END, SPACE
        self.next_state, self.begins = _boundary_machine()
        self.stable: dict[tuple[bytes, bytes], bool] = {}
        self.open: dict[tuple[bytes, bytes], frozenset[bytes]] = {}
        self._forget()

    # --- the second machine, compiled on demand -------------------------------------------------------------------------

    def _forget(self) -> None:
        """State 0 is a piece's beginning, state 1 reads on without counting (a chunk before its first piece)."""
        self.table = np.full((4096, 256), -1, np.int32)
        self.table[1] = 1 | 64 << 24
        self.ids: dict[tuple, int] = {(b"", ((0, b"", 0),)): 0, (): 1}
        self.keys: list[tuple] = list(self.ids)

    def is_stable(self, a: bytes, b: bytes) -> bool:
        """Whether tokens a and b are the encoding of their bytes: no merge, lowest rank first, reaches across the seam."""
        known = self.stable.get((a, b))
        if known is None:
            if len(self.stable) > 500_000:
                self.stable.clear()
            known = self.stable[a, b] = self._stay_apart(self.number[a], self.number[b], len(self.left)) if self.number else self._keeps_seam(a + b, len(a))
        return known

    def _halve(self, merges: list[tuple[bytes, bytes]]) -> None:
        """Numbers of the tokens, bytes first, then in the order of merges, and the two numbers that each is merged from.

        ``number`` is empty unless every token is the encoding of its own bytes by the merge that it is listed with.
        """
        self.number = {bytes([b]): b for b in range(256)}
        self.left, self.right, self.pair = list(range(256)), list(range(256)), {}
        for a, b in merges:
            halves = self.number.get(a), self.number.get(b)
            if None in halves or a + b in self.number or not self._stay_apart(*halves, len(self.left)):
                self.number = {}
                return
            self.number[a + b] = self.pair[halves] = len(self.left)
            self.left.append(halves[0])
            self.right.append(halves[1])
        if not self.tokens <= self.number.keys():
            self.number = {}

    def _stay_apart(self, a: int, b: int, before: int) -> bool:
        """Whether no merge numbered below ``before`` reaches across the seam of two tokens: their last merges are undone, latest
        first, and the parts at the seam must not have had a merge of their own by then."""
        pair, left, right = self.pair.get, self.left, self.right
        while True:
            if (across := pair((a, b))) is not None and across < before:
                return False
            if a < 256 and b < 256:
                return True
            if a > b:
                before, a = a, right[a]
            else:  # of equal merges the first in the text comes first
                before, b = b + 1, left[b]

    def _keeps_seam(self, piece: bytes, seam: int) -> bool:
        never = len(self.rank)
        rank = lambda i, j, k: self.rank.get((piece[i:j], piece[j:k]), never)
        cuts = list(range(len(piece) + 1))
        pairs = [rank(i, i + 1, i + 2) for i in range(len(piece) - 1)]
        while pairs and (least := min(pairs)) < never:
            i = pairs.index(least)
            if cuts[i + 1] == seam:
                return False
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(cuts[i], cuts[i + 1], cuts[i + 2])
            if i:
                pairs[i - 1] = rank(cuts[i - 1], cuts[i], cuts[i + 1])
        return True

    def _still_open(self, prior: bytes, begun: bytes) -> frozenset[bytes]:
        """Tokens that go on after ``begun`` and are stable after ``prior``."""
        known = self.open.get((prior, begun))
        if known is None:
            if len(self.open) > 500_000:
                self.open.clear()
            known = self.open[prior, begun] = frozenset(t for t in self.longer[begun] if not prior or self.is_stable(prior, t))
        return known

    def _compile(self, state: int, byte: int) -> int:
        """Table entry of one transition: next state, and 64 plus the change in the count in the bits above.

        A state's key: the longest end of the text so far that begins a token which can still come, and for each such end
        its length, what may come of it, and the number of tokens before it relative to now. What may come is a set of
        tokens where few are left, else the last token before, after which the one to come must be stable. An encoding
        ends in the one token that is stable after the encoding before it.
        """
        tail, live = self.keys[state]
        tail += bytes([byte])
        size, change, token, after = len(tail), None, b"", []
        for length, may, before in live:
            begun = tail[size - 1 - length:]
            few = isinstance(may, frozenset)
            if change is None and (begun in may if few else begun in self.tokens and (not may or self.is_stable(may, begun))):
                change, token = before + 1, begun
            if few:
                may = frozenset(t for t in may if len(t) > len(begun) and t.startswith(begun))
            elif (goes_on := self.longer.get(begun)) is None:
                continue
            elif len(goes_on) <= FEW:
                may = self._still_open(may, begun)
            if not isinstance(may, frozenset) or may:
                after.append((length + 1, may, before))
        after = [(length, may, before - change) for length, may, before in after] + [(0, token, 0)]
        key = (tail[size - after[0][0]:], tuple(after))
        target = self.ids.get(key)
        if target is None:
            target = self.ids[key] = len(self.keys)
            self.keys.append(key)
            if target >= len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        entry = self.table[state, byte] = target | change + 64 << 24
        return entry

    def _step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        at = states.astype(np.int64) << 8 | symbols
        out = self.table.ravel()[at]
        missing = np.flatnonzero(out < 0)
        if len(missing):
            pairs, place = np.unique(at[missing], return_inverse=True)
            out[missing] = np.array([self._compile(p >> 8, p & 255) for p in pairs.tolist()], np.int32)[place]
        return out

    # --- streams ----------------------------------------------------------------------------------------------------------

    def _class_of(self, points: np.ndarray) -> np.ndarray:
        """Classes of characters; a new character is put to the library's own pre-tokenizer."""
        classes = self.classes[points]
        if (classes == UNKNOWN).any():
            pre = self.library.pre_tokenizer
            for p in np.unique(points[classes == UNKNOWN]).tolist():
                joins = [len(pre.pre_tokenize_str(x + chr(p))) == 1 for x in "a1!"]
                self.classes[p] = (LETTER, NUMBER, OTHER)[joins.index(True)] if any(joins) else WHITE
            classes = self.classes[points]
        return classes

    def _piece_starts(self, points: np.ndarray) -> np.ndarray:
        """Whether a piece begins at each character; END (0x110000) stands after each text."""
        classes = self._class_of(points)
        one, two = np.append(points[1:], [0x110000]), np.append(points[2:], [0x110000] * 2)
        symbols = np.array([S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_WHITE, S_END], np.uint8)[classes]
        white = (classes == SPACE) | (classes == WHITE)
        last = white & ~np.append(white[1:], True) & (one != 0x110000)
        symbols[last] += 1
        quote = np.flatnonzero(points == ord("'"))
        a, b = one[quote], two[quote]
        symbols[quote[np.isin(a, [ord(c) for c in "stmd"])]] = S_SHORT
        symbols[quote[((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))]] = S_LONG
        n, chunks = len(points), -(-len(points) // CHUNK)
        columns = np.ascontiguousarray(np.append(symbols, np.full(chunks * CHUNK - n, S_END, np.uint8)).reshape(chunks, CHUNK).T)
        table = self.next_state.ravel()
        entry = np.append([NEW], scan(self._chunk_maps(columns))[:-1, NEW]).astype(np.uint8)
        out, begins = np.empty((CHUNK, chunks), bool), self.begins.ravel()
        for j, column in enumerate(columns):
            at = entry * 10 + column
            out[j], entry = begins[at], table[at]
        return out.T.ravel()[:n]

    def _chunk_maps(self, columns: np.ndarray) -> np.ndarray:
        """Map from entry to exit state for each chunk. All entry states run side by side until they meet, then one goes on."""
        table, chunks = self.next_state.ravel(), columns.shape[1]
        apart, maps = np.arange(chunks), np.tile(np.arange(8, dtype=np.uint8), (chunks, 1))
        one, every = np.full(chunks, NEW, np.uint8), np.empty((chunks, 8), np.uint8)
        for j, column in enumerate(columns):
            one = table[one * 10 + column]
            if len(apart):
                maps = table[maps * 10 + column[apart, None]]
                if j % 8 == 7:
                    on = (maps != maps[:, :1]).any(axis=1)
                    apart, maps = apart[on], maps[on]
        every[:] = one[:, None]
        every[apart] = maps
        return every

    def _changes(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The annotation of each byte's transition."""
        n, chunks = len(data), -(-len(data) // CHUNK)
        pad = chunks * CHUNK - n
        symbols = np.ascontiguousarray(np.append(data, np.zeros(pad, np.uint8)).reshape(chunks, CHUNK).T)
        starts = np.ascontiguousarray(np.append(begins, np.ones(pad, bool)).reshape(chunks, CHUNK).T)
        out, state = np.zeros((CHUNK, chunks), np.int8), np.ones(chunks, np.int32)
        for j in range(CHUNK):
            state[starts[j]] = 0
            entry = self._step(state, symbols[j])
            out[j], state = (entry >> 24) - 64, entry & 0xFFFFFF
        head = np.where(starts.any(0), starts.argmax(0), CHUNK)
        todo = np.flatnonzero(head > 0)
        while len(todo):
            ready = todo[(todo > 0) & (state[todo - 1] != 1)]
            now, lanes = state[ready - 1], ready
            for j in range(CHUNK):
                on = head[lanes] > j
                lanes, now = lanes[on], now[on]
                if not len(lanes):
                    break
                entry = self._step(now, symbols[j, lanes])
                out[j, lanes], now = (entry >> 24) - 64, entry & 0xFFFFFF
            state[lanes] = now  # chunks without a beginning: their exit state is known now
            todo = np.setdiff1d(todo, ready, assume_unique=True)
        return out.T.ravel()[:n]

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and UTF-8 bytes of each text."""
        tokens, sizes = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        parts: list[str] = []
        owner: list[int] = []
        chars = 0
        for i, text in enumerate(texts):
            split = [text]
            for mark in self.added:
                split = [p for s in split for p in s.split(mark)]
                tokens[i] += text.count(mark)
            sizes[i] = len(text.encode())
            parts += split
            owner += [i] * len(split)
            chars += len(text)
            if chars >= STREAM_CHARS or i == len(texts) - 1:
                np.add.at(tokens, owner, self._count(parts))
                parts, owner, chars = [], [], 0
        return tokens, sizes

    def _count(self, parts: list[str]) -> np.ndarray:
        """Tokens of each part of a stream."""
        if len(self.keys) > MAX_STATES:
            self._forget()
        joined = "\0".join(parts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        points[ends] = 0x110000
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        width[ends] = 1
        place = np.cumsum(width) - width
        data = np.frombuffer(joined.encode(), np.uint8)
        begins = np.zeros(len(data), bool)
        begins[place[self._piece_starts(points)]] = True
        total = np.append([0], np.cumsum(self._changes(data, begins), dtype=np.int64))
        stop = place[ends]
        return total[stop] - total[np.append([0], stop[:-1] + 1)]


_MACHINES: dict[str, CountTransducer] = {}


def machine(path: str) -> CountTransducer:
    """The transducer of a tokenizer file, compiled once in each Python worker."""
    if path not in _MACHINES:
        _MACHINES[path] = CountTransducer(path)
    return _MACHINES[path]


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text."""
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        m = machine(path)
        for b in batches:
            tokens, sizes = m.counts(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
