"""Long tracks over many ranges against the windows by track."""

import random

from minutemark.operators import intervals, tracks

KEYS, ORDER = ["meeting"], ["t_us", "ord"]


def _reads(spark, n=4000):
    draw = random.Random(8)
    names = ["A", "B", "Other", None]
    rows, name, t = [], "A", 0
    for i in range(n):
        t += draw.choice([0, 1, 5, 400])
        name = draw.choice(names) if draw.random() < 0.3 else name
        rows.append(("long" if i % 20 else draw.choice(["x", "y", None]), t, i, name))
    return spark.createDataFrame(rows, "meeting string, t_us long, ord long, name string").repartition(5)


def _same(left, right):
    key = lambda r: str(sorted(r.asDict().items()))
    left, right = sorted(map(key, left.collect())), sorted(map(key, right.collect()))
    assert left == right and len(left) > 0


def test_one_long_track_is_as_its_windows(spark):
    reads = _reads(spark)
    for keys in (KEYS, []):
        _same(tracks.rle_changes(reads, keys, ORDER, "name"), intervals.rle_changes(reads, keys, ORDER, "name"))
        _same(tracks.islands(reads, keys, ORDER, "name", "run"), intervals.islands(reads, keys, ORDER, "name", "run"))
        _same(tracks.to_intervals(reads, keys, ORDER, lag_us=3), intervals.to_intervals(reads, keys, ORDER, lag_us=3))
    # Strictly rising times, so that intervals have no ties.
    steps = reads.selectExpr("meeting", "ord * 10 t_us", "name")
    held = intervals.to_intervals(steps, KEYS, ["t_us"], 10**6)
    _same(tracks.gap_fill(held, KEYS, "name", 300), intervals.gap_fill(held, KEYS, "name", 300))


def test_a_long_track_spreads_over_the_ranges(spark):
    rows = tracks.neighbours(_reads(spark), [], ORDER, {"b": "name"}, {}, keep_range=True)
    sizes = [r["count"] for r in rows.groupBy("_range").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 2200


def test_no_rows(spark):
    none = _reads(spark).limit(0)
    assert tracks.rle_changes(none, KEYS, ORDER, "name").count() == 0
    assert tracks.islands(none, KEYS, ORDER, "name", "run").count() == 0
