"""How far the sources of a language differ in their words: an exact audit by a recount through minimal perfect hashes.

First pass: the number of documents of each language that hold a term, exactly; terms in too few documents are dropped. The kept terms
are dealt into shards of bounded size, and each shard gets a minimal perfect hash: a displacement per small bucket sends every key to a
slot of its own, without holes. Second pass: the hashes and their keys are broadcast, a term is looked up in its shard, the key stored
in its slot must be that very term, and then a dense array of counters of its group (language, source) is incremented in that slot.

What is broadcast at once is held below ``broadcast_bytes``: a larger vocabulary is recounted in waves of shards, one reading of the texts a
wave. Counters are flushed when they fill ``CELLS`` cells, and added up by slot. No term string is shuffled in the second pass.

Audit: each group gives each kept term the share p = 1 + floor(10^9 (count + 1) / (N + V)). Sources are compared over all kept terms in
tiles of slots (both directions at once), and each group's terms are ranked by how far their share lies above the language's.

Defined results: null text, language and source are empty strings; a group without kept terms has N = 0; a language without kept terms
has pairs of value 0 and no terms; repeated rows count as often as they occur; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowbench.functions.small import pin_small
from flowbench.llm.common import fixed, text_or_empty

SHARD_KEYS = 16_384
BROADCAST_BYTES = 64 << 20
CELLS = 4_000_000
FLUSH_TERMS = 200_000
MEMO = 100_000
TILE = 1024
BLOCK = 256
SHARE = 1_000_000_000
TRIES = 1 << 20
_HELD: dict[str, dict] = {}
# Spark's own seed of xxhash64; a shard keeps it unless two of its keys share a hash.
SEED = 42
# Every byte that cannot be part of a term becomes a space; A-Z become lower case.
_TERM_BYTES = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms_of(raw: bytes, step: int = 1 << 20):
    """The terms of a UTF-8 text, in lists of some ``step`` bytes."""
    flat, at = raw.translate(_TERM_BYTES), 0
    while at < len(flat):
        end = flat.find(b" ", at + step)
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


def _bytes_of(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _document_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, docs): in how many documents, added up in each task first."""
    def run(batches):
        counts: dict[bytes, Counter] = defaultdict(Counter)
        held = 0

        def flush():
            for lang, c in counts.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.binary()).cast(pa.string()), pa.array(list(c), pa.binary()).cast(pa.string()),
                                                  pa.array(list(c.values()), pa.int64())], ["lang", "term", "docs"])

        for b in batches:
            for lang, raw in zip(_bytes_of(b.column("lang")), _bytes_of(b.column("text"))):
                seen: set[bytes] = set()
                for part in terms_of(raw):
                    seen.update(part)
                mine = counts[lang]
                held -= len(mine)
                mine.update(seen)
                held += len(mine)
                if held > FLUSH_TERMS:
                    yield from flush()
                    counts.clear()
                    held = 0
        yield from flush()

    return docs.select("lang", "text").mapInArrow(run, "lang string, term string, docs long").groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def _mixed(h: np.ndarray) -> np.ndarray:
    """The upper half of a well-mixed 64-bit hash."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h >> np.uint64(32)


def _slots(h: np.ndarray, displacement: np.ndarray, n) -> np.ndarray:
    return _mixed(h + displacement * np.uint64(0x9E3779B97F4A7C15)) % n


def _buckets(n):
    return n // 3 + 1


def perfect_hash(h: np.ndarray) -> np.ndarray | None:
    """Displacements under which the n hashes take the slots 0..n-1; None if two are equal or no displacement is found.

    Buckets of keys are placed from the largest down; a bucket of one key takes any free slot, named directly (as -1 - slot).
    """
    n = len(h)
    if len(np.unique(h)) < n:
        return None
    g = (_mixed(h) % np.uint64(_buckets(n))).astype(np.int64)
    order, sizes = np.argsort(g, kind="stable"), np.bincount(g, minlength=_buckets(n))
    starts = np.cumsum(sizes) - sizes
    taken, out = np.zeros(n, bool), np.zeros(len(sizes), np.int32)
    for size in range(sizes.max(), 1, -1):
        left = np.flatnonzero(sizes == size)
        d = 0
        while len(left) and d < TRIES:  # all buckets of a size try the next displacements; of those that collide, the first stays
            step = max(1, 2_048 // (size * len(left)))
            keys = h[order[starts[left][:, None] + np.arange(size)]]
            slots = np.sort(_slots(keys[:, None, :], np.arange(d + 1, d + 1 + step, dtype=np.uint64)[None, :, None], np.uint64(n)), axis=2)
            good = ~taken[slots].any(axis=2) & (slots[:, :, 1:] != slots[:, :, :-1]).all(axis=2)
            can, at = np.flatnonzero(good.any(axis=1)), good.argmax(axis=1)
            wanted = slots[can, at[can]]
            _, first = np.unique(wanted, return_index=True)
            mine = np.zeros(wanted.size, bool)
            mine[first] = True
            won = mine.reshape(wanted.shape).all(axis=1)
            out[left[can[won]]] = d + 1 + at[can[won]]
            taken[wanted[won]] = True
            # Losers of a collision try their displacement's successors; nobody goes back.
            left = np.delete(left, can[won])
            d += step
        if len(left):
            return None
    out[np.flatnonzero(sizes == 1)] = -1 - np.flatnonzero(~taken)
    return out


def slots_of(h: np.ndarray, disp: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Slots of hashes in shards of ``n`` keys whose displacements begin at ``first``."""
    g = (_mixed(h) % _buckets(n).astype(np.uint64)).astype(np.int64)
    d = disp[first + g].astype(np.int64)
    return np.where(d < 0, -1 - d, _slots(h, np.maximum(d, 0).astype(np.uint64), n.astype(np.uint64)).astype(np.int64))


def _hashes(terms: list[bytes], seed: int = SEED) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t, seed) for t in terms), np.uint64, len(terms))


def _build(group: pd.DataFrame) -> pd.DataFrame:
    terms = [t.encode() for t in sorted(group["term"])]
    for seed in range(SEED, SEED + 64):
        h = _hashes(terms, seed)
        disp = perfect_hash(h)
        if disp is not None:
            break
    else:
        raise ValueError("no perfect hash found")
    n = np.full(len(terms), len(terms))
    slot = slots_of(h, disp, np.zeros(len(terms), np.int64), n)
    keys = [None] * len(terms)
    for t, s in zip(terms, slot):
        keys[s] = t.decode()
    return pd.DataFrame({"lang": [group["lang"].iloc[0]], "bucket": [group["bucket"].iloc[0]], "seed": [seed], "n": [len(terms)], "disp": [disp.tobytes()],
                         "keys": [keys], "bytes": [sum(map(len, terms)) + 64 * len(terms)]})


def hash_shards(docs: DataFrame, min_docs: int, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Perfect hashes of the terms that at least ``min_docs`` documents of their language hold; ``keys`` are in the order of their slots."""
    kept = fixed(_document_counts(docs).filter(F.col("docs") >= min_docs), "kept-terms")
    shards = kept.groupBy("lang").agg((F.floor(F.count("*") / shard_keys) + 1).alias("shards"), F.count("*").alias("terms"))
    dealt = kept.join(pin_small(shards), "lang").withColumn("bucket", F.pmod(F.xxhash64("term"), "shards"))
    built = dealt.select("lang", "bucket", "term").groupBy("lang", "bucket").applyInPandas(_build, "lang string, bucket long, seed int, n int, disp binary, keys array<string>, bytes long")
    return fixed(built.join(pin_small(shards), "lang"), "hash-shards")


class Lookup:
    """The broadcast shards of one language."""

    def __init__(self, rows: list[tuple]):
        self.shards = rows[0][5]
        self.place = np.full(self.shards, -1, np.int64)
        self.bucket = np.array([r[0] for r in rows], np.int64)
        self.place[self.bucket] = np.arange(len(rows))
        self.seed = np.array([r[1] for r in rows], np.int64)
        self.n = np.array([r[2] for r in rows], np.int64)
        parts = [np.frombuffer(r[3], np.int32) for r in rows]
        self.disp, self.first = np.concatenate(parts), np.cumsum([0, *map(len, parts)])[:-1]
        self.base = np.cumsum(self.n) - self.n
        self.keys = [k for r in rows for k in r[4]]
        self.memo: dict[bytes, int] = {}
        self.others = 0

    def places(self, terms: list[bytes]) -> np.ndarray:
        """Places of terms among all slots of the shards, -1 for what is not a stored key. Answers are remembered: all stored keys (under the
        stored object itself) and up to ``MEMO`` other terms."""
        memo = self.memo
        out = np.fromiter((memo.get(t, -2) for t in terms), np.int64, len(terms))
        new = np.flatnonzero(out == -2)
        if len(new):
            asked = [terms[i] for i in new.tolist()]
            idx, shard, slot = self.find(asked)
            found = np.full(len(asked), -1, np.int64)
            found[idx] = self.base[shard] + slot
            out[new] = found
            memo.update((self.keys[p], p) for p in found[idx].tolist())
            if self.others + len(asked) - len(idx) > MEMO:
                self.memo = memo = {t: p for t, p in memo.items() if p >= 0}
                self.others = 0
            memo.update((t, -1) for t, p in zip(asked, found.tolist()) if p < 0)
            self.others += len(asked) - len(idx)
        return out

    def find(self, terms: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which terms are stored keys, and their shards and slots."""
        h = _hashes(terms)
        shard = self.place[h.view(np.int64) % self.shards]
        idx = np.flatnonzero(shard >= 0)
        h, shard = h[idx], shard[idx]
        for seed in np.unique(self.seed[shard]):
            if seed != SEED:
                mine = np.flatnonzero(self.seed[shard] == seed)
                h[mine] = _hashes([terms[i] for i in idx[mine]], int(seed))
        slot = slots_of(h, self.disp, self.first[shard], self.n[shard])
        own = np.fromiter((self.keys[p] == terms[i] for p, i in zip((self.base[shard] + slot).tolist(), idx.tolist())), bool, len(idx))
        return idx[own], shard[own], slot[own]


def _held(name: str, sent) -> dict[bytes, Lookup]:
    """The lookups of one broadcast, kept by a worker from task to task."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = {lang: Lookup(rows) for lang, rows in sent.value.items()}
    return _HELD[name]


def _recount(docs: DataFrame, shards: list) -> DataFrame:
    """Second pass over one wave of shards: (lang, source, bucket, slots, counts) of every flush."""
    by_lang: dict[bytes, list] = defaultdict(list)
    for r in shards:
        by_lang[r["lang"].encode()].append((r["bucket"], r["seed"], r["n"], bytes(r["disp"]), [k.encode() for k in r["keys"]], r["shards"]))
    sent, name = docs.sparkSession.sparkContext.broadcast(dict(by_lang)), uuid.uuid4().hex

    def run(batches):
        lookups = _held(name, sent)
        words: dict[tuple, Counter] = defaultdict(Counter)
        slots: dict[tuple, np.ndarray] = {}
        held = cells = 0

        def into_slots():
            nonlocal cells
            for (lang, source), c in words.items():
                at = lookups[lang]
                place, n = at.places(list(c)), np.fromiter(c.values(), np.int64, len(c))
                place, n = place[place >= 0], n[place >= 0]
                shard = np.searchsorted(at.base, place, side="right") - 1
                for s in np.unique(shard):
                    mine = shard == s
                    key = (lang, source, s)
                    if key not in slots:
                        slots[key] = np.zeros(at.n[s], np.int64)
                        cells += at.n[s]
                    slots[key][place[mine] - at.base[s]] += n[mine]
                if cells > CELLS:
                    yield from flush()
            words.clear()

        def flush():
            nonlocal cells
            full = list(slots.items())
            for some in (full[i:i + 64] for i in range(0, len(full), 64)):
                used = [np.flatnonzero(dense) for _, dense in some]
                ends = pa.array(np.cumsum([0, *map(len, used)]), pa.int32())
                keys = [pa.array([k[i] for k, _ in some], pa.binary()).cast(pa.string()) for i in (0, 1)]
                found = np.concatenate(used).astype(np.int32), np.concatenate([dense[u] for u, (_, dense) in zip(used, some)])
                yield pa.RecordBatch.from_arrays([*keys, pa.array([int(lookups[lang].bucket[s]) for (lang, _, s), _ in some], pa.int64()),
                                                  *[pa.ListArray.from_arrays(ends, pa.array(f)) for f in found]], ["lang", "source", "bucket", "slots", "counts"])
            slots.clear()
            cells = 0

        for b in batches:
            for lang, source, raw in zip(*(_bytes_of(b.column(c)) for c in ("lang", "source", "text"))):
                if lang not in lookups:
                    continue
                mine = words[lang, source]
                for part in terms_of(raw):
                    held -= len(mine)
                    mine.update(part)
                    held += len(mine)
                    if held > FLUSH_TERMS:
                        yield from into_slots()
                        mine, held = words[lang, source], 0
        yield from into_slots()
        yield from flush()

    return docs.mapInArrow(run, "lang string, source string, bucket long, slots array<int>, counts array<long>")


def _cell(bucket: Column, slot: Column) -> Column:
    """Shard and slot as one number."""
    return F.shiftleft(bucket, 32).bitwiseOR(slot.cast("long"))


def recount(docs: DataFrame, shards: DataFrame, groups: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(gid, cell, n): occurrences of the kept terms in every group (lang, source, gid), zeros left out."""
    waves, room = [[]], broadcast_bytes
    for r in shards.select("lang", "bucket", "bytes").orderBy("lang", "bucket").collect():
        if waves[-1] and r["bytes"] > room:
            waves.append([])
            room = broadcast_bytes
        waves[-1].append((r["lang"], r["bucket"]))
        room -= r["bytes"]
    out = None
    for wave in waves:
        held = shards.join(F.broadcast(docs.sparkSession.createDataFrame(wave, "lang string, bucket long")), ["lang", "bucket"]) if len(waves) > 1 else shards
        part = _recount(docs, held.collect())
        out = part if out is None else out.unionByName(part)
    # Groups become numbers while a row still holds a whole shard's counters.
    out = out.join(pin_small(groups.select("lang", "source", "gid")), ["lang", "source"]).select("gid", "bucket", F.inline(F.arrays_zip("slots", "counts")))
    return fixed(out.groupBy("gid", _cell(F.col("bucket"), F.col("slots")).alias("cell")).agg(F.sum("counts").alias("n")), "slot-counts")


def share(count: Column, total: Column, terms: Column) -> Column:
    """p = 1 + floor(10^9 (count + 1) / (N + V)), exact at any count."""
    wide = F.call_function("div", F.lit(SHARE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"), (total + terms).cast("decimal(20,0)"))
    return F.lit(1) + F.when(count < (1 << 63) // SHARE - 1, F.call_function("div", F.lit(SHARE).cast("long") * (count + 1), total + terms)).otherwise(wide.cast("long"))


def _pair_values(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Sums over one tile of slots for all ordered pairs of two blocks of sources."""
    cols = ["lang", "src", "other", "value"]
    if left.empty:
        return pd.DataFrame({c: [] for c in cols})
    t = left.iloc[0]
    (ia, pa_), (ib, pb) = [[np.array([s[f] for s in t[k]], np.int64) for f in ("src", "p0")] for k in ("sources_a", "sources_b")]
    same, n = t["block_a"] == t["block_b"], int(t["slots"])
    src, off, p = (right[c].to_numpy(np.int64) for c in ("src", "off", "p"))

    def dense(ids, p0):
        m = np.repeat(p0[:, None], n, axis=1)
        at = np.minimum(np.searchsorted(ids, src), len(ids) - 1)
        mine = ids[at] == src
        m[at[mine], off[mine]] = p[mine]
        return m

    a = dense(ia, pa_)
    b = a if same else dense(ib, pb)
    out = []
    for i, row in enumerate(a):
        square = (row - b) ** 2
        out.append(pd.DataFrame({"src": ia[i], "other": ib, "value": (square // b).sum(axis=1)}))
        if not same:
            out.append(pd.DataFrame({"src": ib, "other": ia[i], "value": (square // row).sum(axis=1)}))
    got = pd.concat(out)
    return got[got["src"] != got["other"]].assign(lang=t["lang"])[cols]


def _pairs(counts: DataFrame, shards: DataFrame, groups: DataFrame, tile: int, block: int) -> DataFrame:
    per = groups.withColumn("block", F.floor(F.col("src") / block).cast("int"))
    blocks = per.groupBy("lang", "block").agg(F.sort_array(F.collect_list(F.struct("src", "p0"))).alias("sources"))
    spans = groups.groupBy("lang").agg(F.floor(F.max("src") / block).cast("int").alias("last"))
    tiles = shards.select("lang", "bucket", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / tile).cast("int"))).alias("tile"))
    tiles = tiles.select("lang", "bucket", "tile", F.least(F.col("n") - F.col("tile") * tile, F.lit(tile)).alias("slots"))
    without = spans.join(shards.select("lang").distinct(), "lang", "left_anti").select("lang", F.lit(-1).cast("long").alias("bucket"), F.lit(0).alias("tile"), F.lit(0).alias("slots"))
    work = tiles.unionByName(without).join(spans, "lang").withColumn("block_a", F.explode(F.sequence(F.lit(0), "last"))).withColumn("block_b", F.explode(F.sequence("block_a", "last")))
    work = work.join(blocks.select("lang", F.col("block").alias("block_a"), F.col("sources").alias("sources_a")), ["lang", "block_a"])
    work = work.join(blocks.select("lang", F.col("block").alias("block_b"), F.col("sources").alias("sources_b")), ["lang", "block_b"])
    # A counter goes to every pair of blocks that its own block is part of.
    lids = groups.groupBy("lang").agg(F.first("lid").alias("lid"))
    work = work.join(pin_small(lids), "lang")
    slot = F.col("cell").bitwiseAND(F.lit((1 << 32) - 1))
    sent = counts.join(pin_small(spans.join(lids, "lang").select("lid", "last")), "lid").withColumn("block", F.floor(F.col("src") / block).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), "last")))
    sent = sent.select("lid", F.shiftright("cell", 32).alias("bucket"), F.floor(slot / tile).cast("int").alias("tile"), F.least("block", "with").alias("block_a"),
                       F.greatest("block", "with").alias("block_b"), "src", (slot % tile).alias("off"), "p")
    key = ["lid", "bucket", "tile", "block_a", "block_b"]
    sums = work.groupBy(*key).cogroup(sent.groupBy(*key)).applyInPandas(_pair_values, "lang string, src long, other long, value long")
    names = groups.select("lang", "src", "source")
    return (sums.groupBy("lang", "src", "other").agg(F.sum("value").alias("value")).join(names, ["lang", "src"])
            .join(names.select("lang", F.col("src").alias("other"), F.col("source").alias("item")), ["lang", "other"]).select("lang", "source", "item", "value"))


def divergence_audit(docs: DataFrame, min_docs: int = 3, top: int = 200, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                     shard_keys: int = SHARD_KEYS, broadcast_bytes: int = BROADCAST_BYTES, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value``, ``rank``."""
    docs = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"), text_or_empty(text_col).alias("text"))
    shards = hash_shards(docs, min_docs, shard_keys)
    by_lang, by_source = Window.partitionBy("lang"), Window.partitionBy("lang").orderBy("source")
    names = fixed(docs.select("lang", "source").distinct().withColumn("gid", F.monotonically_increasing_id()), "audit-names")
    found = recount(docs, shards, names, broadcast_bytes)
    totals = found.groupBy("gid").agg(F.sum("n").alias("total"))
    groups = names.join(totals, "gid", "left").join(shards.groupBy("lang").agg(F.first("terms").alias("terms")), "lang", "left").fillna(0, ["total", "terms"])
    groups = groups.withColumns({"src": (F.row_number().over(by_source) - 1).cast("long"), "lid": F.min("gid").over(by_lang), "lang_total": F.sum("total").over(by_lang)})
    groups = fixed(groups.withColumn("p0", F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))).otherwise(1)), "audit-groups")
    about = pin_small(groups.select("gid", "lid", "src", "total", "terms", "lang_total"))
    counts = found.join(about, "gid").withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    pairs = _pairs(counts, shards, groups, tile, block).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    over = counts.withColumn("q", share(F.sum("n").over(Window.partitionBy("lid", "cell")), F.col("lang_total"), F.col("terms"))).filter("p > q")
    over = over.select("gid", "lid", "cell", F.expr("((p - q) * (p - q)) div q").alias("value"))
    # Ties at the last rank go on until the terms are known.
    over = over.withColumn("__r", F.rank().over(Window.partitionBy("gid").orderBy(F.desc("value")))).filter(F.col("__r") <= top)
    keys = shards.select("lang", "bucket", F.posexplode("keys").alias("slot", "item")).join(pin_small(groups.select("lang", "lid").distinct()), "lang")
    over = over.join(keys.select("lid", _cell(F.col("bucket"), F.col("slot")).alias("cell"), "item"), ["lid", "cell"]).join(pin_small(groups.select("gid", "lang", "source")), "gid")
    ranked = over.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))).filter(F.col("rank") <= top)
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*cols).unionByName(ranked.withColumn("part", F.lit("term")).select(*cols))
