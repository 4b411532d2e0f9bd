"""Hard negatives against all products, and the cover tree's search against a scan."""

import math
import random

import numpy as np
import pytest

from minutemark.llm import negatives
from minutemark.llm.negatives import CoverTree

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, key int, block long"


def brute(rows):
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in v]
        kept[i] = min(kept.get(i, (label, whole)), (label, whole))
    kept = {i: ((label + 1) % 10 if i % 7 == 0 else label, v) for i, (label, v) in kept.items()}
    out = []
    for a, (la, va) in kept.items():
        if a % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(va, v)), i, label == la) for i, (label, v) in kept.items() if i != a))
        for s, p, _ in [x for x in scored if x[2]][:5]:
            fits = [(n, i) for n, i, same in scored if not same and 80 * -s <= 100 * -n <= 100 * -s]
            out += [(a, p, r, i, -s, -n) for r, (n, i) in enumerate(fits[:5], 1)]
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in negatives.hard_negatives(df).collect())
    assert got == brute(rows)
    return got


def sample(n, dims=6, spread=0.2):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(8, dims))
    return [(i, [float(x) for x in centres[i % 8] + spread * draw.normal(size=dims)], int(draw.integers(0, 3))) for i in range(n)]


def test_equals_brute_force(spark):
    """A hot vector, ties, repeated ids and rows, nulls, bad numbers, short and empty vectors."""
    rows = sample(500)
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], i % 3) for i in range(300)]
    rows += [(3, rows[3][1], 9), (100, rows[100][1], rows[100][2]), (None, [1.0] * 6, 1), (600, None, 1), (700, [1.0] * 6, None)]
    rows += [(800, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (900, [float("nan")] * 6, 1), (901, [float("inf")] + [0.0] * 5, 2)]
    rows += [(2000, [2.0, 1.0], 1), (2100, [], 2), (2200, [-1.0] * 6, 0), (2201, [0.0] * 6, 0)]
    assert check(spark, rows)


def test_blocks_and_groups_of_any_size_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 40)
    monkeypatch.setattr(negatives, "GROUP", 2)
    assert check(spark, sample(600, spread=0.05))


def test_empty_results(spark):
    assert check(spark, []) == []
    assert check(spark, [(5, [1.0], 1), (6, [1.0], 2)]) == []
    assert check(spark, [(100, [1.0], 1), (5, [1.0], 1)]) == []


@pytest.mark.parametrize("spread", [0.02, 0.3, 3.0])
def test_tree_search_equals_a_scan_and_leaves_nodes_out(spread):
    draw = random.Random(6)
    rows = sample(1500, dims=12, spread=spread)
    points = np.floor(256 * np.array([r[1] for r in rows]))
    ids, labels = np.arange(len(rows)), np.array([r[2] for r in rows])
    norm2 = (points**2).sum(1)
    tree = CoverTree.build(points, np.sqrt(norm2.max() - norm2), ids, labels)
    assert sorted(tree.ids.tolist()) == ids.tolist()
    for centre, first, last, start, stop in tree.nodes[tree.nodes[:, 1] < 0]:
        near = np.sqrt(((tree.points[start:stop] - tree.points[centre]) ** 2).sum(1))
        assert near.max() <= tree.radius[(tree.nodes[:, 3] == start) & (tree.nodes[:, 1] < 0)].max() + 1e-6
    q = np.array(draw.sample(range(1500), 30))
    low = np.stack([np.full(30, -np.inf), 0.8 * norm2[q]], 1)
    high = np.stack([np.full(30, np.inf), norm2[q]], 1)
    for same in (True, False):
        got = sorted(zip(*(x.tolist() for x in tree.search(points[q], q, labels[q], same, low, high, 4))))
        want = []
        for k, i in enumerate(q):
            product = (points @ points[i]).astype(int)
            for j in range(2):
                fits = [(-p, x) for x, p in enumerate(product) if x != i and (labels[x] == labels[i]) == same and low[k, j] <= p <= high[k, j]]
                want += [(k, j, x, -p) for p, x in sorted(fits)[:4]]
        assert got == sorted(want)
