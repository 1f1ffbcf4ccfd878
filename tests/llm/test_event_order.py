"""Events are ordered the same whether their keys fit one number or not."""

import numpy as np
import pytest

from flowbench.llm import suffix_tree


@pytest.mark.parametrize("low, high", [(5, 7), (1 << 17, 1 << 20), (1 << 32, 1 << 32)])  # the last do not fit 64 bits with a place
def test_order_is_that_of_keys_and_places(low, high):
    rng = np.random.default_rng(low)
    older, before = (rng.integers(0, n, 5000, dtype=np.uint64).astype(np.uint32) for n in (low, high))
    older[::3], before[::3] = older[0], before[0]
    order, first = suffix_tree._event_order(before, older)
    assert order.tolist() == np.lexsort((np.arange(5000), older, before)).tolist()
    pairs = list(zip(before[order].tolist(), older[order].tolist()))
    assert first.tolist() == [i for i, p in enumerate(pairs) if i == 0 or p != pairs[i - 1]]


def test_no_tokens_have_no_events():
    order, first = suffix_tree._event_order(np.zeros(0, np.uint32), np.zeros(0, np.uint32))
    assert not len(order) and not len(first)
