"""The index of sums of lengths against all combinations, as counts fall."""

from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pytest

from minutemark.llm import packing


@pytest.mark.parametrize("seed", range(4))
def test_sums_are_found_until_they_run_out(seed):
    draw = np.random.default_rng(seed)
    counts = draw.integers(0, 4, 41) * (draw.random(41) < 0.4)
    counts[0] = 0
    index = packing.SumIndex(counts)
    for _ in range(60):
        for parts in (1, 2):
            total = int(draw.integers(parts, 60)) if parts > 1 else int(draw.integers(1, 41))
            there = [
                c
                for c in combinations_with_replacement(np.flatnonzero(counts).tolist(), parts)
                if sum(c) == total and all(counts[x] >= k for x, k in Counter(c).items())
            ]
            got = index.find(total, parts)
            assert (got is not None) == bool(there), (total, parts, got, there)
            if got:
                assert tuple(sorted(got)) in there and got == sorted(got, reverse=True)
                counts[got[0]] -= 1
        total = int(draw.integers(3, 90))
        if got := index.find(total, 3):
            assert sum(got) == total and all(counts[x] >= k for x, k in Counter(got).items())


def test_surplus_short_pieces_fill_long_gaps():
    plan = packing.plan_sequences({60: 20, 40: 10, 25: 10, 15: 10}, 100)
    assert sorted((sorted(p.items()), n) for p, n in plan) == [([(15, 1), (25, 1), (60, 1)], 10), ([(40, 1), (60, 1)], 10)]
