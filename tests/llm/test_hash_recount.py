import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowbench.llm import hash_recount
from flowbench.llm.hash_recount import divergence_audit, perfect_hash, slots_of, terms_of

SCHEMA = "doc_id long, text string, lang string, source string, src long, value string"  # src and value clash with names used inside
PATTERN = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return PATTERN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, min_docs=3, top=200):
    docs = [(r[2] or "", r[3] or "", terms(r[1])) for r in rows]
    seen, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, t in docs:
        seen[lang].update(set(t))
        count[lang, source].update(t)
    out = []
    for lang in {d[0] for d in docs}:
        kept = sorted(t for t, n in seen[lang].items() if n >= min_docs)
        groups = {s: c for (g, s), c in count.items() if g == lang}
        whole = sum(groups.values(), Counter())

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        q, p = shares(whole), {s: shares(c) for s, c in groups.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for s in groups:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            term = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return sorted(out)


def rows(n, seed):
    r = random.Random(seed)
    words = [f"{c}word{'a' * i}" for i in range(12) for c in "abÉéßК"] + ["Ελλάδα", "日本", "😀x", "rare" + "z" * 40]
    out = []
    for i in range(n):
        lang, source = r.choice(["en", "en", "de", None, "fr"]), r.choice(["hot", "hot", "s1", "S2", "é", None, ""])
        text = r.choice([" ", "1", "-", "\n", "_"]).join(r.choice(words[:r.randint(3, len(words))]).upper() if r.random() < 0.2 else r.choice(words) for _ in range(r.randint(0, 40)))
        out.append((i, text if r.random() < 0.9 else None, lang, source, 1, "v"))
    return out + out[:5] + [(900, "once only", "xx", "a", 0, ""), (901, None, "xx", "b", 0, ""), (902, "", "yy", "alone", 0, "")]


@pytest.mark.parametrize("args", [{}, {"shard_keys": 5, "broadcast_bytes": 600, "tile": 3, "block": 2}, {"top": 3, "min_docs": 1, "shard_keys": 20, "tile": 7, "block": 3}])
def test_against_brute_force(spark, args):
    data = rows(150, len(args))
    got = divergence_audit(spark.createDataFrame(data, SCHEMA).repartition(5), **args)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(data, args.get("min_docs", 3), args.get("top", 200))


def test_flushes(spark, monkeypatch):
    """Full counters and full term tables are emptied in the middle of a task."""
    monkeypatch.setattr(hash_recount, "FLUSH_TERMS", 7)
    monkeypatch.setattr(hash_recount, "CELLS", 10)
    data = rows(60, 9)
    docs = spark.createDataFrame(data, SCHEMA).coalesce(1)
    assert sorted(tuple(r) for r in divergence_audit(docs, shard_keys=8).collect()) == brute(data)


def test_empty_and_wordless(spark):
    assert divergence_audit(spark.createDataFrame([], SCHEMA)).collect() == []
    data = [(1, None, None, None, 0, ""), (2, "1 2 3", "", "b", 0, "")]
    assert sorted(tuple(r) for r in divergence_audit(spark.createDataFrame(data, SCHEMA)).collect()) == brute(data) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def test_large_counts_are_exact(spark):
    got = spark.range(1).select(hash_recount.share(*[F.lit(x).cast("long") for x in (12_345_678_901_234, 98_765_432_109_876, 7)]).alias("p")).first()["p"]
    assert got == 1 + 10**9 * 12_345_678_901_235 // (98_765_432_109_876 + 7)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=400))
def test_perfect_hash_is_minimal(keys):
    h = np.array(sorted(keys), np.uint64)
    disp = perfect_hash(h)
    slots = slots_of(h, disp, np.zeros(len(h), np.int64), np.full(len(h), len(h)))
    assert sorted(slots) == list(range(len(h)))


def test_perfect_hash_of_many_and_of_equal_keys():
    h = np.random.default_rng(0).integers(0, 2**63, 20_000).astype(np.uint64)
    slots = slots_of(h, perfect_hash(h), np.zeros(len(h), np.int64), np.full(len(h), len(h)))
    assert (np.sort(slots) == np.arange(len(h))).all()
    assert perfect_hash(np.array([1, 2, 2], np.uint64)) is None


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60), st.integers(1, 9))
def test_terms(text, step):
    got = [t.decode() for part in terms_of(text.encode("utf-8", "ignore"), step) for t in part]
    assert got == terms(text.encode("utf-8", "ignore").decode())
