"""Scores by partial matching against a plain trie of dictionaries, and the base score against SQL-like counts."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from minutemark.llm import ppm

SCHEMA = "doc_id long, text string, score string, kind int"
END = 256


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    follow, words = defaultdict(Counter), Counter()
    coded = [[None] * 5 + list(lowered(t).encode()) + [END] for _, t in rows]
    token = [[*re.findall(r"[^\x20\x09-\x0D]+", lowered(t)), "\n"] for _, t in rows]
    for h, codes, ws in zip(held, coded, token):
        if not h:
            words.update(ws)
            for i in range(5, len(codes)):
                for k in range(6):
                    follow[tuple(codes[i - k : i])][codes[i]] += 1
    n, v = sum(words.values()), len(words)
    out = []
    for (doc, _), h, codes, ws in zip(rows, held, coded, token):
        score = 0.0
        for i in range(5, len(codes)):
            banned = set()
            for k in range(5, -1, -1):
                here = {s: c for s, c in follow.get(tuple(codes[i - k : i]), {}).items() if s not in banned}
                total = sum(here.values()) + len(here)
                if codes[i] in here:
                    score += math.log10(here[codes[i]] / total)
                    break
                if here:
                    score += math.log10(len(here) / total)
                banned |= set(here)
            else:
                score += math.log10(1 / (257 - len(banned)))
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in ws)
        out.append((doc, h, len(ws), sum(words[w] > 0 for w in ws), n, base, score))
    return out


def check(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in ppm.score(df, **sizes).collect()), key=repr)
    want = sorted(brute(rows), key=repr)
    order = lambda r: (r[0] is not None, r[0] or 0, round(r[6], 6))
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return got


def sample(n):
    draw = random.Random(2)
    words = ["".join(draw.choices("abcdeé", k=draw.randint(1, 7))) for _ in range(60)]
    return [(i, " ".join(draw.choices(words, k=draw.randint(1, 40))).replace("a", "A" if i % 3 else "a") + "\t" * (i % 2)) for i in range(n)]


def test_scores_equal_a_plain_trie(spark):
    rows = sample(120) + [(500, None), (501, ""), (None, "no id"), (None, None), (7, "again"), (7, "again"), (502, "\x00 \U0001f600 z"), (503, " \n\t ")]
    whole = check(spark, rows)
    # chunks and batches of a few bytes, so that texts are cut and many batches ask
    cut = check(spark, rows, chunk=40, batch=300)
    assert [r[:5] for r in whole] == [r[:5] for r in cut]


def test_counts_add_up_however_often(monkeypatch):
    monkeypatch.setattr(ppm, "PENDING", 3)
    counter = ppm.Counter()
    for k in range(5):
        counter.add(np.array([1, 5, 9], np.uint64), np.array([k, 1, 0]), pa.array([b"x", b"y"], pa.large_binary()), np.array([1, k]))
    grams, n, words, word_n = counter.sums()
    assert dict(zip(grams.tolist(), n.tolist())) == {1: 10, 5: 5, 9: 0}
    assert dict(zip(words.to_pylist(), word_n.tolist())) == {b"x": 5, b"y": 10}


def test_no_training_texts_and_no_rows(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    check(spark, [(i, "all held out") for i in held])
    assert check(spark, []) == []


def test_learns_held_out_texts(spark):
    """On repeated phrases the model tells held-out texts better than counts of words do."""
    draw = random.Random(4)
    phrases = ["the quick brown fox jumps", "over the lazy dog tonight", "and runs away from here"]
    rows = [(i, " ".join(draw.choices(phrases, k=12))) for i in range(300)]
    got = check(spark, rows)
    held = [r for r in got if r[1]]
    assert held and sum(r[6] for r in held) > 0.6 * sum(r[5] for r in held)
