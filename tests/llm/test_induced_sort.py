"""Induced suffix sorting against plain sorting."""

import numpy as np
import pytest

from tagloom.llm.induced_sort import sorted_suffixes

RANDOM = np.random.default_rng(5)
TEXTS = {
    "one": np.array([3]), "equal": np.full(50, 7), "two": np.array([1, 2] * 40), "falling": np.arange(30)[::-1], "rising": np.arange(30),
    "binary": RANDOM.integers(0, 2, 700), "few": RANDOM.integers(0, 4, 900), "many": RANDOM.integers(0, 500, 600),
    "repeats": np.tile(RANDOM.integers(0, 5, 90), 9), "runs": np.repeat(RANDOM.integers(0, 3, 120), RANDOM.integers(1, 9, 120)),
}


@pytest.mark.parametrize("limit", [1, 40, 1 << 20])
@pytest.mark.parametrize("name", TEXTS)
def test_order_and_common_prefixes(name, limit):
    text = TEXTS[name].astype(np.int64)
    positions, prefixes = [], []
    sorted_suffixes(text, lambda p, q: (positions.extend(p.tolist()), prefixes.extend(q.tolist())), limit)
    whole = text.tolist()
    expected = sorted(range(len(whole)), key=lambda i: whole[i:], reverse=True)
    assert positions == expected
    for a, b, shared in zip(expected, expected[1:], prefixes[1:], strict=False):
        known = 0
        while max(a, b) + known < len(whole) and whole[a + known] == whole[b + known]:
            known += 1
        assert shared == known
