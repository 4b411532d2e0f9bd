"""The sweep over ranges against all pairs, with one long key, open ends, ties and empty intervals."""

import random

import pytest
from pyspark.sql import functions as F

from minutemark.operators import intervals

LEFT = "m string, seg long, s_us long, e_us long, _e string"


@pytest.mark.parametrize("n", [1, 30, 700])
def test_sweep_equals_all_pairs(spark, n):
    draw = random.Random(n)

    def some(k, far):
        out = []
        for i in range(k):
            s = draw.randrange(0, 4000)
            out.append((draw.choice(["long"] * 6 + ["b", "c", None]), i, None if i % 50 == 7 else s, far if i % 40 == 3 else s + draw.choice([0, 1, 5, 40, 900, -3]), "x"))
        return out

    lefts, rights = some(n, 2**62), some(n, 2**62)
    left = spark.createDataFrame(lefts, LEFT.replace("_e", "cluster"))
    right = spark.createDataFrame(rights, LEFT.replace("_e", "name").replace("seg", "ord"))
    got = sorted(tuple(r) for r in intervals.overlap_join(left, right, ["m"]).select("m", "seg", "s_us", "e_us", "cluster", "ord", "name", "us").collect())
    want = []
    for m, i, s, e, c in lefts:
        for m2, j, s2, e2, name in rights:
            if None not in (m, s, s2) and m == m2 and s < e and s2 < e2 and s < e2 and s2 < e:
                want.append((m, i, s, e, c, j, name, min(e, e2) - max(s, s2)))
    assert got == sorted(want)
    if n == 30:
        assert intervals.overlap_join(left, right.limit(0), ["m"]).count() == 0
        same = intervals.overlap_join_by_buckets(left.filter("s_us IS NOT NULL AND e_us < 10000"), right.filter("s_us IS NOT NULL AND m IS NOT NULL AND e_us > s_us"), ["m"], 50)
        assert {(r.seg, r.ord, r.us) for r in same.collect()} == {(w[1], w[5], w[7]) for w in want if w[3] < 10000}


def test_one_long_key_is_spread_over_the_tasks(spark):
    left = spark.range(20_000).selectExpr("'k' AS m", "id AS seg", "id * 10 AS s_us", "id * 10 + 15 AS e_us")
    right = spark.range(20_000).selectExpr("'k' AS m", "id AS ord", "id * 10 + 5 AS s_us", "id * 10 + 12 AS e_us")
    pairs = intervals.overlap_join(left, right, ["m"])
    assert pairs.count() == 20_000 + 19_999
    tasks = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) > 1 and max(tasks) < 0.8 * sum(tasks)
