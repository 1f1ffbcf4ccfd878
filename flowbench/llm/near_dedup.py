"""Near-duplicates by SuperMinHash signatures, banding, verification on whole shingle sets, and union-find.

SuperMinHash (Ertl 2017): every shingle draws one random permutation of the signature's slots and gives the slot at rank j the
value j plus a random fraction; a slot keeps its least value. Ranks are drawn one after the other and stop as soon as none can
lower a slot. Slots are spread evenly over the shingles, so estimates vary less than with independent hash functions.

Documents with the same shingle set are folded into one class first. Classes that agree in all rows of a band share a bucket.
In a bucket every class is compared with two leaders only, the smallest id and one drawn by hash for each bucket. Buckets that
these links leave in several groups are compared with a third leader, the member with most links, and what is apart even then
with each other, unless a link is ruled out by the sizes, by the distances to that leader (the Jaccard distance is a metric) or
by parity bits, which bound the number of shingles that two sets do not share. So a hot bucket costs a few comparisons per
member, and no pair of a bucket that could join two groups is skipped.

Defined results: a null text or one without words has an empty set and is linked with nothing; with fewer words than the
shingle's width the whole sequence is the one shingle; rows that share an id count as linked; a null id has a
null component; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowbench.functions.small import pin_small
from flowbench.llm.common import fixed, sliced
from flowbench.llm.components import connected

GROUP_SHINGLES = 200_000
SMALL_IDS = 100_000
PARITY_BITS = 1024
_FRACTION = 56


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits are all well mixed (splitmix64's finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingles of a text's words, A-Z in lower case, split at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(width, len(w))
    out = np.full(len(w) - span + 1, np.uint64(span))
    for i in range(span):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + w[i:len(w) - span + 1 + i])
    return np.unique(out)


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash values, one row per non-empty set: rank in the top bits, fraction below."""
    sizes = np.array([len(s) for s in sets])
    least = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    elements, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    places: np.ndarray | None = None
    rows = np.arange(len(elements))
    with np.errstate(over="ignore"):
        for rank in range(slots):
            draw = mix(elements + np.uint64(2 * rank + 1) * np.uint64(0x9E3779B97F4A7C15))
            pick = rank + (mix(draw + np.uint64(1)) % np.uint64(slots - rank)).astype(np.int64)
            if places is None:
                slot = pick
            else:
                slot = places[rows, pick].astype(np.int64)
                places[rows, pick] = places[rows, rank]
            value = np.uint64(rank << _FRACTION) | draw >> np.uint64(64 - _FRACTION)
            np.minimum.at(least.reshape(-1), owner * slots + slot, value)
            going = (least.max(axis=1) >> np.uint64(_FRACTION)) > np.uint64(rank)  # some slot could still be lowered
            on = going[owner]
            if not on.any():
                break
            if places is None:
                elements, owner, pick = elements[on], owner[on], pick[on]
                places = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
                places[np.arange(len(elements)), pick] = 0
            elif not on.all():
                elements, owner, places = elements[on], owner[on], places[on]
            rows = np.arange(len(elements))
    return least


def parity(elements: np.ndarray) -> np.ndarray:
    """``PARITY_BITS`` bits, each the parity of the elements hashed to it. Two sets differ in at least as many elements as
    their bits differ, since an element of one set alone turns one bit."""
    with np.errstate(over="ignore"):
        place = mix(elements + np.uint64(0x632BE59BD9B4E019)) % np.uint64(PARITY_BITS)
    return np.packbits(np.bincount(place.astype(np.int64), minlength=PARITY_BITS).astype(np.uint8) & 1).view(np.int64)


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.tile(np.arange(bands, dtype=np.uint64), (len(values), 1))
    with np.errstate(over="ignore"):
        for r in range(rows):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + values[:, r:bands * rows:rows])
    return out.view(np.int64)


def signed(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bits, buckets): size, 128-bit digest and parity bits of the shingle set, a bucket for each band."""
    def run(batches):
        for b in sliced(batches):
            sets = [shingles(t, width) for t in b.column(1).to_pylist()]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            buckets: list = [None] * len(sets)
            group, held = [], 0
            for i, s in enumerate(sets):
                if len(s):
                    group.append(i)
                    held += len(s)
                if group and (held >= GROUP_SHINGLES or i == len(sets) - 1):
                    for k, row in zip(group, band_keys(signatures([sets[k] for k in group], bands * rows), bands, rows)):
                        buckets[k] = row
                    group, held = [], 0
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array([parity(s) for s in sets], pa.list_(pa.int64())), pa.array(buckets, pa.list_(pa.int64()))],
                                             names=["doc_id", "n_shingles", "set_key", "bits", "buckets"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bits array<long>, buckets array<long>")


def _sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(doc_id, shingles array<long>) of the documents named in ``ids``, from their whole texts."""
    wanted = docs.select("doc_id", "text").join(pin_small(ids, SMALL_IDS), "doc_id", "left_semi")

    def run(batches):
        for b in sliced(batches):
            sets = [shingles(t, width).view(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "shingles"])

    return wanted.mapInArrow(run, "doc_id long, shingles array<long>")


def verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int, label: str) -> DataFrame:
    """``pairs`` (a, b) with ``common``, ``total`` (sizes of intersection and union) and ``linked``."""
    ids = fixed(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{label}-ids")
    sets = _sets(docs, ids, width)
    a, b = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s")), sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("t"))
    common = F.size(F.array_intersect("s", "t"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", common.alias("common"), (F.size("s") + F.size("t")).alias("sizes"))
    return fixed(both.select("a", "b", "common", (F.col("sizes") - F.col("common")).alias("total"))
                 .withColumn("linked", 100 * F.col("common") >= percent * F.col("total")), f"{label}-pairs")


def _pairs(df: DataFrame) -> DataFrame:
    """Distinct unordered pairs of x and y as (a, b)."""
    return df.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _edges(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their ``group``, of the buckets that hold more than one group."""
    placed = members.drop("group").join(roots.withColumnRenamed("root", "group"), "node", "left").withColumn("group", F.coalesce("group", "node"))
    apart = placed.groupBy("bucket").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low <> high").select("bucket")
    return placed.join(apart, "bucket", "left_semi")


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 32, rows: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept): documents whose shingle sets agree by ``percent`` are linked.

    A link at the threshold is missed with probability (1 - (percent / 100) ** rows) ** bands at most. ``bands * rows``
    slots, 256 at most. The component's id is its smallest document id.
    """
    if bands * rows > 256:
        raise ValueError("a signature has 256 slots at most")
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows_ = fixed(signed(docs, width, bands, rows), "near-rows")
    classes = (rows_.filter("n_shingles > 0 and doc_id is not null").groupBy("set_key", "n_shingles", "bits", "buckets").agg(F.min("doc_id").alias("node")))
    classes = fixed(classes, "near-classes")
    entries = classes.select("node", "n_shingles", F.explode("buckets").alias("bucket"))
    drawn = F.struct(F.xxhash64("bucket", "node").alias("h"), F.col("node"))
    shared = entries.groupBy("bucket").agg(F.min("node").alias("first"), F.min(drawn)["node"].alias("drawn"), F.count("*").alias("n")).filter("n > 1")
    members = fixed(entries.join(shared, "bucket").select("bucket", "node", "n_shingles", "first", "drawn"), "near-members")
    pairs = _pairs(members.select(F.explode(F.array("first", "drawn")).alias("x"), F.col("node").alias("y")))
    checked = verified(docs, fixed(pairs, "near-candidates"), width, percent, "near-first")
    links = checked.filter("linked").select("a", "b")
    roots = connected(links)

    # Buckets that are still apart: all members against the one with the most links, which is near to most of them.
    held = _apart(members, roots)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    rank = F.struct(F.coalesce("links", F.lit(0)).alias("links"), (-F.col("node")).alias("last"))
    hubs = held.join(degree, "node", "left").groupBy("bucket").agg((-F.max(rank)["last"]).alias("hub"))
    held = fixed(held.join(hubs, "bucket"), "near-held")
    to_hub = verified(docs, fixed(_pairs(held.select(F.col("hub").alias("x"), F.col("node").alias("y"))), "near-hub-pairs"), width, percent, "near-hub")
    roots = connected(_edges(roots).union(to_hub.filter("linked").select("a", "b")))

    # What is apart even now is compared unless sizes, parity bits or distances to the hub rule a link out.
    distance = (1 - F.col("common") / F.col("total")).alias("d")
    sides = to_hub.select(F.col("a").alias("hub"), F.col("b").alias("node"), distance).union(to_hub.select("b", "a", distance))
    held = _apart(held, roots).join(sides, ["hub", "node"], "left").withColumn("d", F.coalesce("d", F.lit(0.0)))  # a hub is no pair with itself
    main = held.filter("node = hub").select("bucket", F.col("group").alias("main"))
    reach = 1 - percent / 100 + 1e-9
    cell = F.floor(F.col("d") / reach).cast("int")
    held = fixed(held.join(main, "bucket").join(classes.select("node", "bits"), "node").withColumn("cell", cell), "near-apart")
    here = held.filter("group <> main").select("bucket", F.col("node").alias("x"), F.col("n_shingles").alias("nx"), F.col("group").alias("gx"), F.col("d").alias("dx"), F.col("bits").alias("px"),
                                               F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell"))
    there = held.select("bucket", "cell", F.col("node").alias("y"), F.col("n_shingles").alias("ny"), F.col("group").alias("gy"), F.col("d").alias("dy"), F.col("bits").alias("py"))
    turned = F.aggregate(F.zip_with("px", "py", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    close = ((F.abs(F.col("dx") - F.col("dy")) <= reach) & (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
             & ((100 + percent) * turned <= (100 - percent) * (F.col("nx") + F.col("ny"))))
    rest = _pairs(here.join(there, ["bucket", "cell"]).filter((F.col("gx") != F.col("gy")) & close))
    for done in (checked, to_hub):
        rest = rest.join(done.select("a", "b"), ["a", "b"], "left_anti")
    more = verified(docs, fixed(rest, "near-rest"), width, percent, "near-second").filter("linked").select("a", "b")
    final = connected(_edges(roots).union(more))
    nodes = classes.select("set_key", "node").join(final, "node", "left").select("set_key", F.coalesce("root", "node").alias("component_id"))
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return (rows_.select("doc_id", "n_shingles", "set_key").join(nodes, "set_key", "left")
            .select(F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.col(f"`{id_col}`").eqNullSafe(F.col("component_id"))))
