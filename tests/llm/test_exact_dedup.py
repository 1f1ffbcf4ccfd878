import hashlib
import re

import pytest
from pyspark.sql import functions as F

from flowbench.llm.exact_dedup import exact_dedup

SCHEMA = "doc_id long, text string, kept string, norm int"  # kept and norm clash with names used inside


def brute(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for i, r in enumerate(rows)}
    groups = {}
    for i, t in norm.items():
        groups.setdefault(t, []).append(rows[i][0])
    out = []
    for i, t in norm.items():
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((rows[i][0], keep, len(groups[t]), rows[i][0] == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(3, "a b"), (1, "a  b"), (2, "a\t\nb"), (5, None), (4, ""), (9, " "), (10, "\r\n"), (7, "é" * 50), (8, "é" * 50), (11, "é" * 49 + "e"),
        (20, "abcd" * 40), (21, "abcd" * 40), (22, "abcd" * 39 + "abce"), (23, "bbcd" + "abcd" * 39), (24, "abcd" * 41), (25, "abcd" * 20), (None, "only"), (None, "a b"), (1, "a  b"),
        (30, "abcdabcd" * 3 + "x"), (31, "abcdabcd" * 3 + "x"), (32, " a"), (33, "a")]


@pytest.mark.parametrize("block", [4, 7, 16_384])
def test_against_brute_force(spark, block):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], SCHEMA)
    got = sorted([tuple(r) for r in exact_dedup(df, block_bytes=block).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=str)
    assert got == brute(ROWS)


def test_labels_that_collide_are_drawn_again(spark):
    def weak(block, seed):
        return F.xxhash64(block) % 3 if seed < 2 else F.xxhash64(block, F.lit(seed))

    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], SCHEMA)
    got = sorted([tuple(r) for r in exact_dedup(df, block_bytes=16, label=weak).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=str)
    assert got == brute(ROWS)


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_text(spark):
    long = "lorem ipsum " * 100_000
    df = spark.createDataFrame([(1, long, "", 1), (2, long + "x", "", 1), (3, "  ".join(long.split(" ")), "", 1)], SCHEMA)
    assert {r["doc_id"]: r["keep_id"] for r in exact_dedup(df).collect()} == {1: 1, 2: 2, 3: 1}
