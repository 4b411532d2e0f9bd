"""How near the mix comes to its targets, and that each document keeps its expected copies, over many sources of one make."""

from collections import defaultdict
from statistics import median

import pytest

from minutemark.llm import mixing

SIZES = [900, 400, 400, 150, *range(10, 90)]


def _mixed(spark, sizes, sources):
    rows = [(i * 1000 + k, f"s{i:03}", s) for i in range(sources) for k, s in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n int").selectExpr("doc_id", "source", "repeat('w ', n) text")
    return mixing.mix(docs).collect()


@pytest.mark.parametrize("head", [256, 4])
def test_targets_are_met_and_copies_stay(spark, monkeypatch, head):
    monkeypatch.setattr(mixing, "HEAD", head)
    sources = 240
    got = _mixed(spark, SIZES, sources)
    taken, target, copies = defaultdict(int), {}, defaultdict(list)
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size and r.taken % r.size == 0
        copies[round(r.target / r.source_size, 6), r.doc_id % 1000].append(r.taken / r.size)
    near = median(SIZES) if head == 256 else sum(SIZES) / head
    assert len(target) == sources and all(abs(taken[s] - t) <= max(near, 0.02 * t) for s, t in target.items())
    assert len({rate for rate, _ in copies}) == 3
    for (rate, _), seen in copies.items():
        mean = sum(seen) / len(seen)
        spread = (sum((c - mean) ** 2 for c in seen) / len(seen)) ** 0.5
        assert abs(mean - rate) <= 4.5 * max(spread, 0.1) / len(seen) ** 0.5


def test_a_text_larger_than_its_target_keeps_its_chance(spark):
    got = _mixed(spark, [3000, 500, 300], 360)
    first = [r for r in got if r.doc_id % 1000 == 0 and r.target / r.source_size < 0.7]
    rate = first[0].target / first[0].source_size
    assert len(first) == 120
    mean = sum(r.taken / r.size for r in first) / len(first)
    assert abs(mean - rate) < 4 * (rate * (1 - rate) / 120) ** 0.5
