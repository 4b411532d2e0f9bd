"""Repeated strings against brute force, with small windows and shards too."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from minutemark.llm import suffix_dedup as sd


def brute(texts, window):
    starts = Counter()
    for raw in texts:
        starts.update(raw[i : i + window] for i in range(len(raw) - window + 1))
    out = []
    for raw in texts:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - window + 1):
            if starts[raw[i : i + window]] > 1:
                gone[i : i + window] = True
        runs = int((np.diff(np.r_[False, gone]) & gone).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        out.append((len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, scale):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdé", k=draw.randint(1, 4)))
    make = lambda n: " ".join(word() for _ in range(n))
    passages = [make(int(60 * scale)) for _ in range(4)]
    texts = [make(draw.randint(0, int(120 * scale))) for _ in range(40)]
    for p in passages:
        for _ in range(draw.choice([1, 2, 12])):
            k = draw.randrange(len(texts))
            cutoff = draw.choice([0, 0, 3])
            texts[k] = texts[k] + "|" + p[cutoff:] + make(draw.randint(0, 20))
    near = make(int(200 * scale))
    texts += [near[:i] + "#" + near[i + 1 :] for i in draw.sample(range(len(near)), 8)]
    texts += [texts[3]] * 3 + ["", None, "short", "short"]
    texts += ["ab" * int(500 * scale), "aaaa" * int(300 * scale), make(5) + passages[0] + passages[0], "x\0y" * int(200 * scale)]
    return texts


@pytest.mark.parametrize("seed,shard", [(1, 2 << 20), (2, 1500), (3, 300)])
def test_small_windows(monkeypatch, seed, shard):
    """The pieces of the job, run in one process with small settings."""
    monkeypatch.setattr(sd, "WINDOW", 40)
    monkeypatch.setattr(sd, "GRAM", 20)
    monkeypatch.setattr(sd, "CHUNK", 500)
    sd._powers.cache_clear()
    texts = [(t or "").encode() for t in corpus(seed, 1)]
    texts = list(dict.fromkeys(texts))
    starts = Counter(t[i : i + 40] for t in texts for i in range(len(t) - 39))
    runs = [(int(k), d, int(a), int(b)) for d, t in enumerate(texts) for k, _, a, b, _ in zip(*sd.window_runs(t))]
    assert sorted((d, i) for _, d, a, b in runs for i in range(a, b + 1)) == [(d, i) for d, t in enumerate(texts) for i in range(len(t) - 39)]
    runs.sort()
    shards, size, group, seen = [], 0, [], []
    for key, d, a, b in runs:
        group.append((key, d, a, texts[d][a : b + 40]))
        size += len(group[-1][3])
        if size >= shard:
            shards.append(sd.Shard([g[3] for g in group], [(g[1], 0, g[2], True) for g in group]))
            size, group = 0, []
    if group:
        shards.append(sd.Shard([g[3] for g in group], [(g[1], 0, g[2], True) for g in group]))
    for a in shards:
        for b in shards:
            if a is not b:
                a.find(b)
        seen += [(d, i) for d, _, first, last in a.spans() for i in range(first, last + 1)]
    assert sorted(seen) == [(d, i) for d, t in enumerate(texts) for i in range(len(t) - 39) if starts[t[i : i + 40]] > 1]
    sd._powers.cache_clear()


def test_suffix_array_is_sorted():
    draw = random.Random(4)
    strings = [bytes(draw.choices(b"ab", k=draw.randint(1, 60))) for _ in range(50)] + [b"ab" * 40, b"a" * 90, b"\0\0\0"]
    text = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.concatenate([np.full(len(s), e) for s, e in zip(strings, np.cumsum([len(s) for s in strings]))])
    sa, rank = sd.suffix_array(text, ends)
    raw = text.tobytes()
    assert sa.tolist() == sorted(range(len(raw)), key=lambda i: (raw[i : ends[i]], i))
    assert (rank[sa] == np.arange(len(sa))).all()


@pytest.mark.parametrize("seed", [5, 6])
def test_whole_job(spark, seed):
    texts = corpus(seed, 8)
    ids = [None if i == 3 else i // 2 if i < 6 else i for i in range(len(texts))]
    docs = spark.createDataFrame(
        [(i, t, "k", 1) for i, t in zip(ids, texts)], "doc_id long, text string, key string, first int"
    ).repartition(4)
    want = [(i, *b) for i, b in zip(ids, brute([(t or "").encode() for t in texts], 400))]
    got = sd.remove_repeats(docs)
    rows = [tuple(r) for r in got.drop("spans").collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(rows, key=key) == sorted(want, key=key)
    assert 0 < sum(r[2] for r in rows) < sum(r[1] for r in rows)
    assert sd.remove_repeats(docs.filter("false")).count() == 0


def test_keys_that_fill_several_shards(spark, monkeypatch):
    """One passage in many surroundings, and shards so small that its key spans them."""
    draw = random.Random(9)
    passage = "".join(draw.choices("abcdefgh ", k=450))
    texts = ["".join(draw.choices("ijklmn ", k=300)) + passage + "".join(draw.choices("opqrst ", k=200 + i)) for i in range(25)]
    texts += [passage[:420] + "!" * i for i in range(5)]
    rows = [{"key": 7, "doc": i, "digest": 0, "first": 0, "wanted": True, "string": t.encode()} for i, t in enumerate(texts)]
    import pyarrow as pa

    monkeypatch.setattr(sd, "SHARD", 2500)
    got = {}
    for batch in sd._shards([pa.RecordBatch.from_pylist(rows[:7]), pa.RecordBatch.from_pylist(rows[7:])]):
        for r in batch.to_pylist():
            got.setdefault(r["doc"], set()).update(range(r["first"], r["last"] + 1))
    starts = Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    for d, t in enumerate(texts):
        assert got.get(d, set()) == {i for i in range(len(t) - 399) if starts[t[i : i + 400]] > 1}


def test_no_task_gets_a_hot_key_whole(spark, monkeypatch):
    """A passage in many surroundings: its strings, more than a shard holds, never come to the tasks of one key."""
    draw = random.Random(11)
    passage = "".join(draw.choices("abcdefgh ", k=450))
    texts = ["".join(draw.choices("ijklmn ", k=300)) + passage + "".join(draw.choices("opqrst ", k=200 + i)) for i in range(25)]
    texts += [passage[:420] + "!" * i for i in range(5)] + ["ab" * 400, "ab" * 400 + "c", texts[0]]
    monkeypatch.setattr(sd, "SHARD", 2500)
    sizes = []
    hot = sd.repeated_in_hot_keys
    monkeypatch.setattr(sd, "repeated_in_hot_keys", lambda strings: (sizes.append(strings.count()), hot(strings))[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in sd.remove_repeats(docs).drop("spans").collect())
    assert got == [(i, *b) for i, b in enumerate(brute([t.encode() for t in texts], 400))]
    assert sizes[0] >= 25


@pytest.mark.parametrize("seed,shard", [(7, 1 << 20), (8, 2500)])
def test_shorter_repeats_are_reported_and_stay(spark, monkeypatch, seed, shard):
    """Strings of 256 bytes that repeat are counted, those of 400 removed; small shards make keys hot."""
    monkeypatch.setattr(sd, "SHARD", shard)
    texts = corpus(seed, 8)
    draw = random.Random(seed)
    short = "".join(draw.choices("abcdefgh ", k=300))
    texts += ["".join(draw.choices("ijklmn ", k=k)) + short + "".join(draw.choices("opq ", k=k)) for k in (0, 20, 500, 90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in sd.remove_repeats(docs, report=256).drop("spans").collect())
    raws = [(t or "").encode() for t in texts]
    want = [(i, *a, b[1]) for i, (a, b) in enumerate(zip(brute(raws, 400), brute(raws, 256)))]
    assert got == want and any(r[2] == 0 and r[5] >= 300 for r in got)


def test_shards_of_one_key_find_each_other():
    """What windows share is the same, however their strings are parted."""
    draw = random.Random(3)
    base = "".join(draw.choices("ab\0", k=700)).encode()
    strings = [base[a:b] + bytes(draw.choices(b"xyz\0", k=draw.randint(0, 60))) for a, b in ((0, 500), (0, 500), (3, 620), (90, 700), (120, 600))]
    windows = [max(1, len(s) - 430) for s in strings]
    owners = [(i, 0, 0, True) for i in range(len(strings))]
    whole = sd.Shard(strings, owners, windows)
    parts = [sd.Shard([s], [o], [w]) for s, o, w in zip(strings, owners, windows)]
    for a in parts:
        for b in parts:
            if a is not b:
                a.find(b)
    for width in (256, 300, 400):
        assert sorted(whole.spans(width)) == sorted(x for p in parts for x in p.spans(width))
