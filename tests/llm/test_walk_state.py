"""A walk keeps what tokens of an event have in common once, so that little is handed over, and it goes on from that as if it had never stopped."""

import numpy as np
import pyarrow as pa

from flowbench.llm import suffix_tree as st


class Key:
    def as_py(self):
        return 0


def walk(state=None):
    rng = np.random.default_rng(5)
    flat, follows = rng.integers(0, 60, 60_000), rng.random(60_000) < 0.5
    for i in np.flatnonzero(follows)[1:]:
        flat[i] = (flat[i - 1] * 3 + flat[i - 2] % 2) % 60  # half of the words follow from the two before
    sizes = np.full(60, 1000)
    counts = np.bincount(flat, minlength=60)
    shape = st.Shape(60_060, 60, 60, np.zeros(48), np.zeros(48), 16, 8.0)
    return st.Walk(shape, st._packed(flat.astype(np.uint32)), sizes, np.zeros(60, bool), counts, 48 + np.arange(60), 1, state)


def go_down(w):
    w.open()
    rows = [dict(zip([f.split()[0] for f in st._SENT.split(", ")], r)) for r in w.events(0)]
    answers = st._tested([Key()], pa.Table.from_pylist(rows), w.level, 1, 16, 2.0).to_pylist()
    w.step([[a[c] for c in st._ANSWER] for a in answers], {})


def test_little_is_handed_over():
    w = walk()
    go_down(w)
    assert len(w.at) > 1000
    assert len(w.state()) < 3 * len(w.flat)


def test_a_walk_goes_on_from_its_state():
    whole = walk()
    go_down(whole)
    rest = walk(whole.state())
    for w in (whole, rest):
        go_down(w)
    assert rest.level == whole.level == 2 and sorted(rest.at.tolist()) == sorted(whole.at.tolist())
    sums = [w.done + np.add.reduceat(np.log10(w.scored()), w.starts) for w in (whole, rest)]
    assert np.abs(sums[0] - sums[1]).max() < 1e-9
