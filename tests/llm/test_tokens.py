"""Token counts, byte-level BPE and packing against the tokenizers' own libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowbench.llm import bpe_tree, packing, token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
PARTS = ["a", "aa", "e", "  ", "\n", "\t", " ", "é", "ü", "漢", "字", "😀", "́", "​", "\x1c", "\x85", "　", "1", "½", "٣", "'s", "'re", "'", "'ll", "'d", "l", "r",
         "v", "m", "!", "...", "的", "the", "ing", "ß", "﻿", "\x00", " ", "Ⅷ", "ª", "<|endoftext|>", "\r\n", "\U00031350", "Thtionble", " thnter"]
texts = st.lists(st.sampled_from(PARTS), max_size=40).map("".join) | st.text(max_size=60)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def ranks_library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_tree.read_ranks(RANKS), special_tokens={})


def odd_texts():
    rng = random.Random(2)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 80))) for _ in range(800)]
    return made + ["", "a" * 5000, " " * 3000 + "x", "的" * 900, "".join(rng.choice("ein") for _ in range(9000)), "x" * 255 + " y", " " * 256, "ab " * 700]


def test_counts_of_odd_texts(library):
    made = odd_texts()
    tokens, sizes = token_counts.machine(JSON).counts(made)
    assert tokens.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in made]
    assert sizes.tolist() == [len(t.encode()) for t in made]


@settings(max_examples=150, deadline=None)
@given(st.lists(texts, max_size=6))
def test_counts_of_any_texts(made):
    tokens, _ = token_counts.machine(JSON).counts(made)
    library = Tokenizer.from_file(JSON) if not hasattr(test_counts_of_any_texts, "lib") else test_counts_of_any_texts.lib
    test_counts_of_any_texts.lib = library
    assert tokens.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in made]


def test_counts_with_a_small_table_of_states(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    monkeypatch.setattr(token_counts, "STREAM_CHARS", 500)
    made = odd_texts()[:200]
    assert token_counts.CountTransducer(JSON).counts(made)[0].tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in made]


def test_scan_composes_maps():
    rng = np.random.default_rng(0)
    maps = rng.integers(0, 8, (37, 8)).astype(np.uint8)
    state, out = np.arange(8), []
    for m in maps:
        state = m[state]
        out.append(state)
    assert (token_counts.scan(maps) == np.stack(out)).all()


def test_tree_coder_on_odd_texts(ranks_library):
    coder = bpe_tree.coder(RANKS, P.PATTERN)
    for t in odd_texts():
        ids, decimals = coder.encode(t)
        assert ids == ranks_library.encode_ordinary(t)
        assert decimals == ",".join(map(str, ids)).encode()
        assert coder.decode(ids) == t.encode()


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=200), st.integers(0, 200))
def test_join_does_not_depend_on_the_cut(piece, cut):
    coder = bpe_tree.coder(RANKS, P.PATTERN)
    assert coder.join(coder.encode_piece(piece[:cut]) if piece[:cut] else [], coder.encode_piece(piece[cut:]) if piece[cut:] else []) == coder.merge(piece)


def test_ranks_encode_to_themselves():
    """What the stability rule rests on."""
    ranks = bpe_tree.read_ranks(RANKS)
    coder = bpe_tree.coder(RANKS, P.PATTERN)
    assert all(coder.merge(b) == [i] for b, i in list(ranks.items())[::7])


ROWS = [(1, "hello world", "a", 1), (2, None, "a", 1), (3, "", None, 1), (None, "x y z", "b", 1), (1, "hello world", "a", 1), (5, "word " * 3000, "b", 1), (6, "<|endoftext|> it's", "a", 1)]
SCHEMA = "doc_id long, text string, source string, ids int"


def test_queries_on_odd_rows(spark, library, ranks_library):
    df = spark.createDataFrame(ROWS, SCHEMA)
    counts = [tuple(r) for r in token_counts.token_counts(df, JSON).collect()]
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t, _, _ in ROWS]
    assert sorted(counts, key=str) == sorted(want, key=str)
    trips = [tuple(r) for r in bpe_tree.round_trip_digests(df, RANKS, P.PATTERN).collect()]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(ids := ranks_library.encode_ordinary(t or "")), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())) for i, t, _, _ in ROWS]
    assert sorted(trips, key=str) == sorted(want, key=str)
    encoded = bpe_tree.encode_texts(df, RANKS, P.PATTERN)
    assert sorted(bytes(r["decoded"]) for r in bpe_tree.decode_ids(encoded, RANKS, P.PATTERN).collect()) == sorted((t or "").encode() for _, t, _, _ in ROWS)
    empty = spark.createDataFrame([], SCHEMA)
    assert token_counts.token_counts(empty, JSON).collect() == [] and bpe_tree.round_trip_digests(empty, RANKS, P.PATTERN).collect() == []


# --- packing ---------------------------------------------------------------------------------------------------------------


def check_packed(pieces, docs, library, length):
    """Each id in exactly one piece, gapless sequences, true ids."""
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["source"], p["doc_tokens"]), []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    n = 0
    for i, t, s, *_ in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        own = sorted(by_doc[i, s, len(ids)], key=lambda p: (p["start"], p["sequence_id"]))
        copies = sum(1 for d in docs if d[0] == i and d[1] == t and d[2] == s)
        assert sum(p["length"] for p in own) == len(ids) * copies
        for p in own:
            assert p["ids"] == np.array(ids[p["start"]:p["start"] + p["length"]], "<u4").tobytes()
        n += len(ids)
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= length
    assert sorted(by_seq) == list(range(len(by_seq)))
    return n, len(by_seq)


def test_pack_odd_rows(spark, library):
    df = spark.createDataFrame(ROWS, SCHEMA)
    pieces = packing.pack(df, JSON, length=64, grain=16).collect()
    tokens, sequences = check_packed(pieces, ROWS, library, 64)
    assert sequences <= -(-tokens // 64) + 3
    assert packing.pack(spark.createDataFrame([], SCHEMA), JSON).collect() == []
    zlib.crc32(pieces[0]["ids"])


def test_windows_hold_the_mixture(spark, library):
    rng = random.Random(1)
    docs = [(k, " ".join(rng.choice(["the", "of", "house", "and"]) for _ in range(rng.randint(1, 300))), rng.choice(["a", "a", "b", "c"]), 1) for k in range(300)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(7, "doc_id")
    pieces = packing.pack(df, JSON, weights={"a": 1, "b": 2, "c": 1}, length=256, grain=32).collect()
    check_packed(pieces, docs, library, 256)
    totals = {s: sum(p["length"] for p in pieces if p["source"] == s) for s in "abc"}
    shared = int(totals["b"] / 2 * 4 // 256)  # b, of which half a window asks, is empty first
    for upto in range(1, shared):
        held = {s: sum(p["length"] for p in pieces if p["source"] == s and p["sequence_id"] < upto) for s in "abc"}
        assert all(abs(held[s] - upto * 256 * w / 4) <= 2 * 32 for s, w in (("a", 1), ("b", 2), ("c", 1)))
    whole = packing.sequences(packing.pack(df, JSON, length=256, grain=32), 256).collect()
    assert all(len(r["ids"]) == 256 or len(r["ids"]) & (len(r["ids"]) - 1) == 0 for r in whole)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 400), min_size=1, max_size=6), st.lists(st.integers(1, 9), min_size=6, max_size=6))
def test_every_slot_is_served_once(totals, weights):
    totals = {str(i): t for i, t in enumerate(totals)}
    for w in (None, {str(i): x for i, x in enumerate(weights)}):
        s = packing.Schedule(totals, w, 64, 16)
        served = np.concatenate([s.slots(i, np.arange(-(-t // 16))) for i, t in enumerate(s.tokens)])
        assert sorted(served.tolist()) == list(range(len(served)))
        for i, t in enumerate(s.tokens):
            assert (np.diff(s.slots(i, np.arange(-(-t // 16)))) > 0).all()


def test_large_slot_numbers_stay_exact():
    s = packing.Schedule({"a": 10**15, "b": 3 * 10**14 + 7}, None, 1024, 128)
    assert s.kind is object
    places = np.array([0, 1, 10**12, -(-s.tokens[1] // 128) - 1])
    got = s.slots(1, places)
    m, n = s.phases[0].counts
    for q, j in zip(places.tolist(), got.tolist()):
        assert j == q + ((2 * q + 1) * m - n) // (2 * n) + 1


@pytest.mark.parametrize("text", [" " * 1_000_000 + "a", "a" * 200_000, "\n \t" * 300_000 + "<|endoftext|>b", " " * 499_999])
def test_ids_of_very_long_runs(text):
    """Texts on which the fast encoder's pattern runs out of stack have ids as well, the library's own."""
    assert packing.token_ids(text, JSON).tolist() == Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids


def test_packing_of_a_million_spaces(spark):
    docs = spark.createDataFrame([(1, " " * 1_000_000 + "a", "s"), (2, "b c", "s"), (3, None, None)], "doc_id long, text string, source string")
    got = packing.pack(docs, JSON).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in got} == {1: 1_000_001, 2: 3, 3: 1}


def test_pieces_of_many_documents_at_once():
    """All documents of a batch are cut together, with one look at the slots of each source, as their tokens one by one would be."""
    rng = random.Random(6)
    docs = [(rng.choice([None, "a", "b"]), rng.choice([1, 15, 16, 17, 64, rng.randint(1, 500)])) for _ in range(120)]
    totals, places = {}, []
    for s, n in docs:
        places.append(totals.get(s, 0))
        totals[s] = places[-1] + n
    schedule, looks = packing.Schedule(totals, None, 64, 16), []
    order = sorted((int(j), s, r) for s in totals for r, j in enumerate(schedule.slots(schedule.at[s], np.arange(-(-totals[s] // 16)))))
    at, filled = {}, {}  # sequence and offset of each token of each queue
    for j, s, r in order:
        for t in range(r * 16, min(r * 16 + 16, totals[s])):
            at[s, t] = j // 4, filled.get(j // 4, 0)
            filled[j // 4] = at[s, t][1] + 1
    slots = schedule.slots
    schedule.slots = lambda *a: looks.append(a) or slots(*a)
    got = list(zip(*(c.tolist() for c in schedule.pieces([s for s, _ in docs], np.array(places), np.array([n for _, n in docs])))))
    assert len(looks) == len(totals)
    assert [(r, start + i, q, o + i) for r, start, n, q, o in got for i in range(n)] == [(r, i, *at[s, p + i]) for r, ((s, n), p) in enumerate(zip(docs, places)) for i in range(n)]
    assert all(a[0] != b[0] or (a[3], a[4] + a[2]) != (b[3], b[4]) for a, b in zip(got, got[1:]))  # neighbouring slots are one piece


def test_seams_are_judged_by_halves_of_tokens(library, monkeypatch):
    """Undoing the last merges of two tokens tells what merging their bytes anew tells, and is all that compiling takes."""
    machine, rng = token_counts.CountTransducer(JSON), random.Random(5)
    tokens = sorted(machine.tokens)
    short = [t for t in tokens if len(t) <= 3]
    pairs = [(rng.choice(tokens), rng.choice(tokens)) for _ in range(5000)] + [(rng.choice(short), rng.choice(short)) for _ in range(20_000)]
    pairs += [(t[:i], t[i:]) for t in rng.sample(tokens, 3000) for i in range(1, len(t)) if t[:i] in machine.tokens and t[i:] in machine.tokens]
    apart = [machine._keeps_seam(a + b, len(a)) for a, b in pairs]
    assert 1000 < sum(apart) < len(pairs) - 1000
    monkeypatch.setattr(token_counts.CountTransducer, "_keeps_seam", lambda *a: pytest.fail("bytes were merged anew"))
    assert [machine.is_stable(a, b) for a, b in pairs] == apart
    made = odd_texts()
    assert machine.counts(made)[0].tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in made]


def test_tokens_that_do_not_encode_to_themselves_are_merged_anew():
    machine = token_counts.CountTransducer(JSON)
    machine._halve([(b"b", b"c"), (b"a", b"b"), (b"ab", b"c")])  # abc is a, bc
    assert machine.number == {}
