import collections
import itertools
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from flowbench.llm import suffix_tree

SCHEMA = "doc_id long, text string, score string, block int"


def corpus():
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the", "a", "The"]) + " " + rng.choice(["cat", "dog", f"x{rng.randint(0, 400)}"]) for _ in range(rng.randint(0, 60))), "s", 1) for i in range(400)]
    return rows + [(400, None, "s", 1), (401, "", "s", 1), (402, " \x0b\n", "s", 1), (1, "again", "s", 1), (None, "The\tcat \r dog", "s", 1), (403, "é É \x1c x", "s", 1), (404, "w " * 30_000, "s", 1)]


def test_counts_and_base(spark, monkeypatch):
    rows = corpus()
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    tokens = [(i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, (t or "").encode().lower().split() + [None]) for i, t, *_ in rows]
    seen = collections.Counter(w for _, h, ws in tokens if not h for w in ws)
    n, v = sum(seen.values()), len(seen)
    want = sorted([(i, h, len(ws), sum(seen[w] > 0 for w in ws), n, round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, h, ws in tokens], key=str)
    monkeypatch.setattr(suffix_tree, "BUCKET_WORDS", 100)
    out = suffix_tree.score_texts(df, held).collect()
    got = sorted([(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out], key=str)
    assert got == want
    for side in (True, False):  # what stands before a word tells which is next
        assert sum(r["score"] for r in out if r["held_out"] == side) > sum(r["base_score"] for r in out if r["held_out"] == side)


def test_empty_and_untrained(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    assert suffix_tree.score_texts(df.limit(0), F.lit(False)).collect() == []
    out = suffix_tree.score_texts(df, F.lit(True)).collect()
    assert len(out) == len(corpus()) and all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in out)


def test_tree_is_a_distribution_and_scores_in_the_longest_kept_suffix():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 3, (4, 4, 3)).astype(float)
    counts[0, 1] = [90, 0, 0]  # this context knows its next symbol, as does the suffix 2
    counts[:, 2] = [0, 60, 0]
    root = np.array([0.5, 0.3, 0.2])
    p, state = suffix_tree.grow(counts, root, min_count=10, min_gain=2.0, weight=1.0)
    assert np.allclose(p.sum(axis=-1), 1)
    assert state[0, 1] == 2 and state[0, 2] == 1 and state[1, 2] == 1
    ones = counts.sum(axis=0)
    for a, b in itertools.product(range(4), range(4)):
        q, longest = root, 0
        for k, seen in ((1, ones[b]), (2, counts[a, b])):
            n = seen.sum()
            gain = sum(x * math.log(x / n / y) for x, y in zip(seen, q) if x)
            if n >= 10 and gain >= 2.0 * (seen > 0).sum():
                q, longest = (seen + q) / (n + 1), k
        assert np.allclose(p[a, b], q) and state[a, b] == longest


def test_contexts_do_not_cross_texts():
    symbols, starts = np.array([1, 2, 3, 1, 3]), np.array([0, 3])
    keys = suffix_tree._contexts(symbols, starts, 2, 4)
    assert keys.tolist() == [1 + 4 * 5 + 4 * 25, 2 + 1 * 5 + 4 * 25, 3 + 2 * 5 + 1 * 25, 1 + 4 * 5 + 4 * 25, 3 + 1 * 5 + 4 * 25]


def test_tree_grows_with_words_and_length(spark, monkeypatch):
    """Every word seen often is a symbol, contexts are as long as the texts ask for, and the scores are those of a tree grown in one place."""
    rng = random.Random(8)
    words = [f"same{i}e" for i in range(300)]  # equal beginnings and ends, and none is among the most frequent

    def text():
        line = ["u", "u", "u"]
        while len(line) < 60:
            odds = [random.Random(" ".join(line[-k:]) + w).random() ** 4 * k for k in (1, 2, 3) for w in "stuv"]
            line.append(rng.choices(list("stuv"), [sum(odds[i::4]) for i in range(4)])[0])
        return " ".join(line)

    rows = [(i, text(), "s", 1) for i in range(300)]
    rows += [(i, " ".join(f"{words[w := rng.randrange(300)]} q{w % 9}" for _ in range(12)), "s", 1) for i in range(300, 1500)]
    rows += [(i, " ".join(rng.choice(["the", f"z{rng.randint(0, 900)}"]) for _ in range(20)), "s", 1) for i in range(1500, 1700)]
    texts = [(i, i % 7 == 2, t.split()) for i, t, *_ in rows]
    seen = collections.Counter(w for _, h, ws in texts if not h for w in ws)
    rare = collections.defaultdict(lambda: [0, 0])

    def symbol(w):
        return w if seen[w] >= 16 else int(suffix_tree.class_of([w.encode()], {}, 48)[0])

    for w, n in seen.items():
        if n < 16:
            rare[symbol(w)][0] += n
            rare[symbol(w)][1] += 1
    docs = sum(not h for _, h, _ in texts)
    mass = {c: sum(rare[c]) + 1 for c in range(47)} | {w: n + 1 for w, n in seen.items() if n >= 16} | {"end": docs + 1}
    lines = [(i, h, ws, [symbol(w) for w in ws] + ["end"]) for i, h, ws in texts]
    kept = {(): {x: m / sum(mass.values()) for x, m in mass.items()}}
    level = [()]
    while level:
        k = len(level[0]) + 1
        after = collections.defaultdict(collections.Counter)
        for _, h, _, line in lines:
            line = ["start", *line]
            for j in range(k, len(line)) if not h else ():
                if tuple(line[j - k + 1:j]) in kept:
                    after[tuple(line[j - k:j])][line[j]] += 1
        level = []
        for c, nexts in after.items():
            q, n = kept[c[1:]], sum(nexts.values())
            if n >= 16 and sum(x * math.log(x / n / q[y]) for y, x in nexts.items()) >= 2.0 * len(nexts):
                kept[c] = {y: (nexts[y] + 8.0 * q[y]) / (n + 8.0) for y in q}
                level.append(c)
    assert max(map(len, kept)) > 2 and sum(len(c) == 1 for c in kept) > 200

    def score(ws, line):
        out, line = 0.0, ["start", *line]
        for j in range(1, len(line)):
            k = 0
            while k < j and tuple(line[j - k - 1:j]) in kept:
                k += 1
            out += math.log10(kept[tuple(line[j - k:j])][line[j]])
        return out + sum(math.log10((seen[w] + 1) / mass[symbol(w)]) for w in ws if seen[w] < 16)

    want = {i: score(ws, line) for i, _, ws, line in lines}
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for buckets, spread in ((20_000, 200_000), (5_000, 300)):  # frequent contexts in one bucket, then in several
        monkeypatch.setattr(suffix_tree, "BUCKET_TOKENS", buckets)
        monkeypatch.setattr(suffix_tree, "SPREAD_TOKENS", spread)
        got = {r["doc_id"]: r["score"] for r in suffix_tree.score_texts(df, F.col("doc_id") % 7 == 2).collect()}
        assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-5


def test_walks_are_handed_over_instead_of_repeated(spark, monkeypatch):
    """However deep the tree, a pass reads the answers of one level, and the scores stay those of walks repeated from the start."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["s t u v s", "t t v", "u s v t u v", "v"]) for _ in range(40)) + f" r{i % 40}", "s", 1) for i in range(250)]
    df, on_blocks, passes = spark.createDataFrame(rows, SCHEMA).repartition(3), suffix_tree._on_blocks, []
    monkeypatch.setattr(suffix_tree, "_on_blocks", lambda *a: passes.append(len(a[2])) or on_blocks(*a))
    scores = {}
    for hand_over in (10**9, 0):  # never, at once
        monkeypatch.setattr(suffix_tree, "HAND_OVER", hand_over, raising=False)
        passes.clear()
        scores[hand_over] = {r["doc_id"]: r["score"] for r in suffix_tree.score_texts(df, F.col("doc_id") % 7 == 2, min_count=4).collect()}
        assert len(passes) > 4
    assert max(passes) == 1
    assert all(abs(scores[0][i] - x) < 1e-9 for i, x in scores[10**9].items())
