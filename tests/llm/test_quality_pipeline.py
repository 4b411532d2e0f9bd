"""The co-trained classifier by held-out accuracy, and the pipeline stage by stage against brute force."""

import os
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from minutemark.llm import quality, simhash

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    test = labels.filter("doc_id % 3 = 0")
    model = quality.train(docs, labels.filter("doc_id % 3 <> 0"))
    found = quality.score(docs, model).join(test, "doc_id").collect()
    good = [r.keep for r in found if r.quality == 1]
    bad = [r.keep for r in found if r.quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1


def test_a_weak_view_learns_from_a_strong_one():
    draw = np.random.default_rng(0)
    n = 4000
    y = draw.integers(0, 2, n)
    strong = np.column_stack([y + draw.normal(0, 0.25, n), draw.normal(0, 1, n)]).astype(np.float32)
    weak = (np.eye(300)[np.where(draw.random(n) < 0.9, y, 1 - y) * 150 + draw.integers(0, 150, n)]).astype(np.float32)
    labels = np.where(np.arange(n) < 300, y, -1)
    alone = quality.co_train(strong, weak, labels, rounds=0)
    taught = quality.co_train(strong, weak, labels, rounds=3)
    right = [np.mean((m.metadata.logit(weak[300:]) > 0) == y[300:]) for m in (alone, taught)]
    assert right[1] > right[0]
    assert np.mean((taught.scores(strong, weak)[2] > 0.5)[300:] == y[300:]) > 0.95


def test_both_views_teach_on_the_given_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    assert len(model.taught) == 3
    for turn in model.taught:
        assert turn["text taught"] > 0 and turn["metadata taught"] > 0


def test_table_and_array_pools_teach_alike(spark):
    """Counts by score and one lot for a row choose the surest rows, as many as asked for, in the classes' ratio."""
    draw = np.random.default_rng(2)
    text, meta = draw.normal(size=(3000, 5)).astype(np.float16), draw.integers(0, 192, (3000, 4))
    ones = np.zeros((3000, 192), np.float32)
    ones[np.arange(3000)[:, None], meta] = 1
    y = (text[:, 0] > 0).astype(float)
    models = [quality.Logistic.fit(text.astype(np.float32), y), quality.Logistic.fit(ones, y)]
    cuts = {(0, 1): (0.5, 1.0), (0, 0): (0.2, 1.0), (1, 1): (0.0, 0.1)}
    share = {1: 0.7, 0: 0.3}
    rows = [(i, t.tobytes(), np.sort(m).astype(np.int16).tobytes(), int(h)) for i, (t, m, h) in enumerate(zip(text, meta, draw.integers(-(2**62), 2**62, 3000)))]
    table = spark.createDataFrame(rows, "id long, text_view binary, meta_view binary, lot long").repartition(5)
    for most in (100, 10_000):
        a = quality.ArrayPool(text.astype(np.float32), ones).surest(models, cuts, share, most)
        b = quality.TablePool(table).surest(models, cuts, share, most)
        for which, (view, kind) in ((w, w) for w in cuts):
            scores = [(1 if kind else -1) * models[view].logit(x[which][view]) for x in (a, b)]
            assert all(len(x) == 0 or x.min() >= cuts[which][0] for x in scores)
            assert abs(len(scores[0]) - len(scores[1])) <= 25
        if most == 100:
            assert abs(len(b[0, 1][0]) - 70) <= 15 and abs(len(b[0, 0][0]) - 30) <= 12


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None, 5), (2, "", "s", "en", -3, 5), (None, "x " * 300_000, "s", "en", 7, 5), (2, "", "s", "en", -3, 5)],
        "doc_id long, text string, source string, lang string, n_chars long, score int",
    )
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.keep for r in quality.classify(docs, none).collect()] == [True] * 4
    assert quality.drop_rejected(docs, none).count() == 4
    assert quality.classify(docs.filter("false"), none).count() == 0
    some = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None)], "doc_id long, quality int")
    more = spark.createDataFrame([(i, "good words here" if i % 2 else "BAD!! BAD!!", "s", "en", 9, 1) for i in range(40)], docs.schema)
    model = quality.train(more, some)
    kept = quality.score(docs.unionByName(more), model).filter("doc_id > 2")
    assert all(r.keep == (r.doc_id % 2 == 1) for r in kept.collect()) and kept.count() == 37
    assert quality.drop_rejected(docs.unionByName(more), some).columns == docs.columns


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    yield out
    for df in out[1:]:
        df.unpersist()


def test_stages_return_documents(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_quality_stage(stages, spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    right = [(d in kept) == (q == 1) for d, q in labels.items()]
    assert np.mean(right) > 0.98


def test_dedup_stages(stages):
    best = {}
    for r in stages[1].collect():
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(best.values())
    prints = {r.doc_id: simhash.fingerprint(r.text) for r in stages[2].collect()}
    kept, group = [], {}
    for d in sorted(prints):
        close = {group[e] for e in group if (prints[d] ^ prints[e]).bit_count() <= 3}
        group[d] = d
        for e in group:
            if group[e] in close:
                group[e] = d
    for members in [[d for d in group if group[d] == g] for g in set(group.values())]:
        kept.append(min(members))
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(kept)


def test_mix_and_pack_stages(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    copies = Counter(r.doc_id for r in stages[4].collect())
    assert set(copies) <= set(before) and max(copies.values()) <= 3
    pieces = stages[5].collect()
    whole = Counter(r.doc_id for r in pieces if r.piece == 0)
    assert whole == copies
    fill = defaultdict(int)
    for r in pieces:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and len(fill) <= sum(fill.values()) / 2048 * 1.02 + 3
