"""Numbering of equal hashes."""

from __future__ import annotations

import numpy as np
import pytest

from ledgerline.llm import words


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_distinct_numbers_keys_in_order_of_appearance(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, max(1, n // 3), n).astype(np.uint64) << np.uint64(40)
    first, index = words.distinct(keys)
    seen = {}
    assert index.tolist() == [seen.setdefault(k, len(seen)) for k in keys.tolist()]
    assert keys[first].tolist() == list(seen)
    assert first.tolist() == [keys.tolist().index(k) for k in seen]
