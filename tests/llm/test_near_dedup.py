import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from flowbench.llm.components import connected, union_find
from flowbench.llm.near_dedup import near_dedup, parity, shingles, signatures

SCHEMA = "doc_id long, text string, bucket string, node int"


def brute(rows, width, percent):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, frozenset([tuple(w)] if 0 < len(w) < width else (tuple(w[k:k + width]) for k in range(len(w) - width + 1)))))
    links = [(a, b) for k, (a, s) in enumerate(sets) for b, t in sets[:k] if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t)]
    root = union_find(links)
    return sorted([(i, len(s), root.get(i, i), i == root.get(i, i)) for i, s in sets], key=str)


def corpus():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(30):
        base = [rng.choice(vocab) for _ in range(rng.randint(3, 200))]
        for _ in range(rng.randint(1, 8)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((len(rows) * 7 % 1009, "  ".join(w).upper() if rng.random() < 0.3 else " \n".join(w)))
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE"), (2005, "one two"), (2006, "two one"), (2007, "é É"), (2008, "É É"),
             (None, rows[0][1]), (None, None), (2010, rows[3][1]), (2010, rows[3][1])]
    return rows


def run(spark, docs, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in docs], SCHEMA)
    return sorted([tuple(r) for r in near_dedup(df, **kw).select("doc_id", "n_shingles", "component_id", "kept").collect()], key=str)


def fixed_null(rows):
    """A row without an id has no component, whatever its text."""
    return sorted([(i, n, None, True) if i is None else (i, n, c, k) for i, n, c, k in rows], key=str)


def test_against_brute_force(spark):
    rows = corpus()
    assert run(spark, rows, width=3, percent=85, bands=25, rows=5) == fixed_null(brute(rows, 3, 85))
    assert run(spark, rows) == fixed_null(brute(rows, 5, 80))


def test_hot_group_of_near_copies(spark):
    """A long chain of near copies in one bucket: links that no leader sees are still found."""
    words = [f"v{i}" for i in range(400)]
    rows = [(k, " ".join(words[k * 4:k * 4 + 120])) for k in range(60)] + [(1000 + k, " ".join(words[:60] + [f"z{k}"] * 3)) for k in range(40)]
    assert run(spark, rows, width=3, percent=85, bands=25, rows=5) == brute(rows, 3, 85)


def test_empty_table(spark):
    assert near_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = np.unique(pool[:240]), np.unique(pool[60:])
        s = signatures([a, b, a], 128)
        assert (s[0] == s[2]).all()
        errors.append((s[0] == s[1]).mean() - 180 / 300)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_signature_is_the_least_rank_of_all_shingles():
    """Early stopping changes nothing: a set's signature is the slotwise minimum of its parts' signatures."""
    sets = [shingles(" ".join(f"a{i}" for i in range(n)), 3) for n in (5, 40, 900)]
    for s in sets:
        whole = signatures([s], 32)[0]
        parts = signatures([s[i:i + 1] for i in range(len(s))], 32)
        assert (whole == parts.min(axis=0)).all()


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**63)), st.sets(st.integers(0, 2**63)))
def test_parity_bits_bound_the_difference(a, b):
    one, two = (parity(np.array(sorted(s), np.uint64)).view(np.uint64) for s in (a, b))
    turned = sum(int(x).bit_count() for x in one ^ two)
    assert turned <= len(a ^ b) and (len(a ^ b) - turned) % 2 == 0
    if a == b:
        assert turned == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_union_find(pairs):
    root = union_find(pairs)
    assert all(root[a] == root[b] for a, b in pairs)
    assert all(root[r] == r <= x for x, r in root.items())


def test_connected_long_path(spark):
    n = 300
    ids = [(i * 37) % n for i in range(n)]
    links = spark.createDataFrame(list(zip(ids, ids[1:])) + [(1000, 1001), (5, 5)], "a long, b long").repartition(40)
    got = {r["node"]: r["root"] for r in connected(links).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}
