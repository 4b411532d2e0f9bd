"""Shared passages against planted ones and a brute-force comparison of all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from minutemark.llm import passages


def vocabulary(draw, n=3000):
    return ["".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(n)]


def test_seeds_of_a_shared_run():
    draw = random.Random(1)
    voc = vocabulary(draw)
    run = draw.choices(voc, k=passages.KMER + passages.PICK - 1)
    for n in (0, 3, 50):
        a = passages.seeds(draw.choices(voc, k=n) + run + draw.choices(voc, k=n))[0]
        b = passages.seeds(draw.choices(voc, k=2 * n) + run)[0]
        assert set(a.tolist()) & set(b.tolist())
    assert len(passages.seeds(["a"] * 10)[0]) == 0


def test_seeds_in_chunks(monkeypatch):
    words = random.Random(2).choices(vocabulary(random.Random(3)), k=2000)
    whole = [a.tolist() for a in passages.seeds(words)]
    monkeypatch.setattr(passages, "CHUNK", 64)
    assert [a.tolist() for a in passages.seeds(words)] == whole


def brute_score(x, y):
    best = []
    for i in range(len(x)):
        top = 0.0
        for j in range(i):
            if x[j] < x[i] and y[j] < y[i]:
                top = max(top, best[j] - passages.GAP_COST * (x[i] - x[j] + y[i] - y[j]))
        best.append(passages.KMER + top)
    return max(best)


@pytest.mark.parametrize("seed", range(20))
def test_best_chain_equals_quadratic_search(seed):
    draw = np.random.default_rng(seed)
    n = int(draw.integers(2, 40))
    points = sorted(set(zip(draw.integers(0, 120, n).tolist(), draw.integers(0, 120, n).tolist())))
    x, y = (np.array(c) for c in zip(*points))
    chains = passages.chain(x, y)
    assert sorted(i for c in chains for i in c) == sorted(set(i for c in chains for i in c))
    path = chains[0]
    score = passages.KMER * len(path) - passages.GAP_COST * sum(x[b] - x[a] + y[b] - y[a] for a, b in zip(path, path[1:]))
    assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(path, path[1:]))
    assert score == pytest.approx(brute_score(x.tolist(), y.tolist()))


def corpus(seed):
    """Clean texts, passages in several of them (exact, and with a word changed every 30), near copies and copies."""
    draw = random.Random(seed)
    voc = vocabulary(draw)
    texts = [draw.choices(voc, k=draw.randint(0, 300)) for _ in range(60)]
    planted = []
    for p in range(5):
        words = draw.choices(voc, k=draw.randint(55, 140))
        for d in draw.sample(range(50), 6):
            mine = list(words)
            if p % 2:
                mine[len(mine) // 2] = "changed%d" % d
            at = draw.randint(0, len(texts[d]))
            texts[d] = texts[d][:at] + mine + texts[d][at:]
            planted.append((p, d))
    near = draw.choices(voc, k=400)
    for _ in range(5):
        mine = list(near)
        for i in draw.sample(range(400), 4):
            mine[i] = draw.choice(voc)
        planted.append((9, len(texts)))
        texts.append(mine)
    return [" ".join(t) for t in texts], planted


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_passages(spark, seed):
    texts, planted = corpus(seed)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(500, texts[7]), (501, texts[7].upper()), (502, None), (503, ""), (504, texts[7]), (504, texts[7]), (None, texts[8])]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, kind string, seed int").repartition(3)
    got = passages.shared_passages(docs).collect()
    by = {}
    for r in got:
        by.setdefault(r.kind, []).append(r)
    assert sorted((r.doc_id or -1, r.other_id) for r in by["copy"]) == sorted([(500, 7), (504, 7), (504, 7), (503, 502), (-1, 8)])
    words = {i: passages.words_of(t) for i, t in rows}
    touched = {r.doc_id for r in by["passage"]} | {r.other_id for r in by["passage"]}
    groups = {}
    for p, d in planted:
        groups.setdefault(p, set()).add(d)
    assert touched <= {d for _, d in planted} | {7, 501}
    assert {d for _, d in planted} <= touched
    for r in by["passage"]:
        a, b = words[r.doc_id][r.start_word : r.end_word], words[r.other_id][r.other_start : r.other_end]
        assert len(a) >= passages.LEAST_WORDS and r.similarity == pytest.approx(passages.jaccard(a, b)) and r.similarity >= 0.8
    for p, members in groups.items():  # all documents with a passage hang together
        links = [(r.doc_id, r.other_id) for r in by["passage"]]
        reached, todo = set(), [min(members)]
        while todo:
            d = todo.pop()
            if d not in reached:
                reached.add(d)
                todo += [b for a, b in links if a == d] + [a for a, b in links if b == d]
        assert members <= reached
    assert passages.shared_passages(docs.filter("false")).count() == 0


def test_runs_of_many_edits_are_found_one_by_one():
    draw = random.Random(5)
    base = draw.choices(vocabulary(draw), k=600)
    other = list(base)
    for i in (0, 99, 110, 118, 127, 140, 151, 160, 250, 259, 268, 400, 408, 416, 424, 432, 599):
        other[i] = "edit%d" % i
    other[300:300] = ["inserted"] * 30
    sa, sb = passages.seeds(base), passages.seeds(other)
    spots = {h: p for h, p in zip(*(v.tolist() for v in sb))}
    pairs = sorted((p, spots[h]) for h, p in zip(*(v.tolist() for v in sa)) if h in spots)
    (path, *_) = passages.chain(*(np.array(c) for c in zip(*pairs)))
    got = list(passages.align(base, other, [pairs[i][0] for i in path], [pairs[i][1] for i in path]))
    runs = [(1, 98), (161, 249), (269, 299), (301, 399), (433, 598)]
    for lo, hi in runs:
        assert hi - lo < passages.LEAST_WORDS or any(g[0] <= lo and g[1] >= hi for g in got), (lo, hi)
    for a0, a1, b0, b1, _, likeness in got:
        assert likeness == passages.jaccard(base[a0:a1], other[b0:b1]) >= 0.8


def test_windows_that_ask():
    words = vocabulary(random.Random(3), 400)
    hashes, at = passages.seeds(words)
    start, which, asks = passages.window_places(at, [(100, 180), (170, 200)], 400)
    assert start.tolist() == list(range(351)) and asks.tolist() == [not 100 <= s <= 130 for s in range(351)]
    other, there = passages.seeds(words[37:])
    again, mine, _ = passages.window_places(there, [], 363)
    assert hashes[which[37:]].tolist() == other[mine].tolist()
    assert [h[37:].tolist() for h in passages.window_hashes(words, start)] == [h.tolist() for h in passages.window_hashes(words[37:], again)]
    assert len(passages.window_places(at[3:4], [], 400)[0]) == 0 == len(passages.window_places(at, [], 49)[0])


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_words_whose_seeds_are_taken_by_other_texts(spark, seed):
    """Texts with halves or edited variants of a passage, of lesser digests than the two that have it whole."""
    draw = random.Random(seed)
    voc = vocabulary(draw)
    fill = lambda: draw.choices(voc, k=draw.randint(30, 90))
    texts = [fill() + fill() for _ in range(10)]
    for family in range(12):
        whole = draw.choices(voc, k=draw.choice([50, 55, 60, 70, 80]))
        half = len(whole) // 2
        edited = list(whole)
        for i in range(12, len(whole), 14):
            edited[i] = "edit%d" % family
        parts = [whole[:half], whole[half:]] if family % 2 else [edited]
        made = [fill() + p + fill() for p in (*parts, whole, whole, whole)]
        for k in range(len(made)):  # digests: the parts' are among the least half of all, the others' not
            while (passages._digests(" ".join(made[k]))[0] < 0) != (k < len(parts)):
                made[k][0] = "w%d" % draw.randrange(10**9)
        texts += made
    rows = list(enumerate(" ".join(t) for t in texts))
    got = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    held = {}
    for r in got:
        a, b = texts[r.doc_id][r.start_word : r.end_word], texts[r.other_id][r.other_start : r.other_end]
        assert min(len(a), len(b)) >= passages.LEAST_WORDS and r.similarity == pytest.approx(passages.jaccard(a, b)) and r.similarity >= 0.8
        held.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
        held.setdefault(r.other_id, []).append((r.other_start, r.other_end))
    where = {}
    for d, words in enumerate(texts):
        for i in range(len(words) - passages.LEAST_WORDS + 1):
            where.setdefault(tuple(words[i : i + passages.LEAST_WORDS]), []).append((d, i))
    shared = [p for places in where.values() if len({d for d, _ in places}) > 1 for p in places]
    missed = [(d, i) for d, i in shared if not any(a <= i and i + passages.LEAST_WORDS <= b for a, b in held.get(d, []))]
    assert shared and not missed


def test_edited_passages_whose_pieces_stand_in_other_texts(spark):
    """No seed need be left for the two texts that have the whole passage, each but for few words; pairs of seeds are."""
    draw = random.Random(5)
    voc = vocabulary(draw)
    fill = lambda: draw.choices(voc, k=draw.randint(30, 90))
    texts, families = [], []
    for size in (60, 80, 100, 140, 200):
        for pieces, times in ((2, 1), (2, 12), (3, 4)):
            for _ in range(3):
                one = draw.choices(voc, k=size)
                two, edits = list(one), (size - 4) // 45
                for k in range(edits):
                    two[(k + 1) * size // (edits + 1)] = "edited"
                assert passages.jaccard(one, two) >= 0.8
                parts = [one[k * size // pieces : (k + 1) * size // pieces] for k in range(pieces)] * times
                for whole in (one, two, *parts):
                    before = fill()
                    if len(whole) == size:
                        families.append((len(texts), len(before), size))
                    texts.append(before + whole + fill())
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    held = {}
    for r in got:
        a, b = texts[r.doc_id][r.start_word : r.end_word], texts[r.other_id][r.other_start : r.other_end]
        assert min(len(a), len(b)) >= passages.LEAST_WORDS and r.similarity == pytest.approx(passages.jaccard(a, b)) and r.similarity >= 0.8
        held.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
        held.setdefault(r.other_id, set()).update(range(r.other_start, r.other_end))
    assert all(len(held.get(d, set()) & set(range(at, at + size))) >= 0.8 * size for d, at, size in families)


def test_pairs_of_seeds(monkeypatch):
    draw = np.random.default_rng(3)
    x = np.sort(draw.choice(500, 120, replace=False))
    seed = draw.integers(0, 40, 120)
    free = passages._free(x, [(100, 160), (300, 301)])
    assert [bool(f) for f in free] == [not (100 <= p and p + passages.KMER <= 160) for p in x]
    key, first, second, asks = passages.seed_pairs(x, seed, free)
    want = {}
    at = dict(zip(x.tolist(), seed.tolist()))
    for i in x.tolist():
        for j in x.tolist():
            if passages.LEAST_SPAN <= j - i <= passages.MOST_SPAN:
                want.setdefault((at[i], at[j]), (i, j))
    assert len(key) == len(want) and {(at[i], at[j]): (i, j) for i, j in zip(first.tolist(), second.tolist())} == want
    which = dict(zip(x.tolist(), free.tolist()))
    assert [which[i] and which[j] for i, j in zip(first.tolist(), second.tolist())] == asks.tolist()
    assert len(passages.seed_pairs(x[:0], seed[:0], free[:0])[0]) == 0


def test_edited_passages_whose_larger_parts_stand_in_many_texts(spark):
    """A seed's and a pair of seeds' one occurrence is mostly in a part that is no passage; no link may be lost by that."""
    draw = random.Random(11)
    voc = vocabulary(draw)
    fill = lambda: draw.choices(voc, k=draw.randint(30, 90))
    texts, families = [], []
    for size in (52, 60, 60, 60, 80):
        for kind in ("other word", "word more", "word less"):
            for _ in range(4):
                one = draw.choices(voc, k=size)
                two, at = list(one), draw.randint(8, size - 9)
                two[at : at + (kind != "word more")] = [] if kind == "word less" else ["edited"]
                if min(len(one), len(two)) < passages.LEAST_WORDS or passages.jaccard(one, two) < 0.8:
                    continue
                part = size * 3 // 4
                for whole in (one, two, *([one[:part], one[-part:]] * 6)):
                    if whole in (one, two):
                        families.append(len(texts))
                    texts.append(fill() + whole + fill())
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    group = list(range(len(texts)))

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    for r in got:
        group[root(r.doc_id)] = root(r.other_id)
    pairs = list(zip(families[::2], families[1::2]))
    assert len(pairs) > 50 and [p for p in pairs if root(p[0]) != root(p[1])] == []


def plain_pairs(around):
    found = set()
    for i in range(len(around)):
        for j in range(i):
            if len(passages.likely(around[i : i + 1], around[j : j + 1])[0]):
                found.add((j, i))
    return found


@pytest.mark.parametrize("seed", range(6))
def test_pairs_that_are_likely(seed):
    """Against runs found word by word; the index of a large group finds the same pairs as comparing all."""
    draw = random.Random(seed)
    voc = vocabulary(draw, 60)
    base = draw.choices(voc, k=160)
    rows = []
    for _ in range(40):
        mine = list(base)
        for _ in range(draw.randint(0, 4)):
            at = draw.choice([*range(10, 76), *range(84, 150)])
            mine[at] = "edit%d" % draw.randrange(5)
        if draw.random() < 0.5:  # a part of it
            lo, hi = draw.randint(30, 75), draw.randint(86, 140)
            mine = draw.choices(voc, k=lo) + mine[lo:hi] + draw.choices(voc, k=160 - hi)
        right = draw.choice([0, 0, 2, 7, 14])
        cut_at = draw.randint(88, 120)
        mine[cut_at:cut_at] = ["more%d" % draw.randrange(9)] * right
        which, _, around = passages.contexts(passages.word_hashes(" ".join(mine)), np.array([77]))
        assert which.tolist() == [0, 0] and (around[0] == around[1]).all()
        rows.append((mine, around[0]))
    around = np.stack([r[1] for r in rows])
    seed_at, near = 77, passages.SIDE
    want = set()
    for i in range(40):
        for j in range(i):
            a, b = rows[i][0][seed_at - near : seed_at + passages.KMER + near], rows[j][0][seed_at - near : seed_at + passages.KMER + near]
            run = []
            for p, q in ((a[near + passages.KMER :], b[near + passages.KMER :]), (a[:near][::-1], b[:near][::-1])):
                n = next((k for k, (u, v) in enumerate(zip(p, q)) if u != v), near)
                run.append((p[n:], q[n:], n))
            long = passages.KMER + run[0][2] + run[1][2]
            second = False
            for p, q, _ in run:
                for g, h in ((g, h) for g in range(passages.GAP + 1) for h in range(passages.GAP + 1 - g)):
                    n = next((k for k, (u, v) in enumerate(zip(p[g:], q[h:])) if u != v), 99)
                    second |= n >= 5 and long + n - 8 >= 4 * (g + h + 8)
            if long >= 45 or long >= 25 and second:
                want.add((j, i))
    assert plain_pairs(around) == want and want
    free = np.array([draw.random() < 0.5 for _ in range(40)])
    index = {tuple(sorted(divmod(p, 40))) for p in passages._indexed(around, free).tolist()}
    assert index >= {p for p in want if free[p[0]] or free[p[1]]}
    pair, x, y = passages.likely(around[[0] * 40], around)
    for p, u, v in zip(pair.tolist(), x.tolist(), y.tolist()):
        at, to = rows[0][0][seed_at + u :][:5], rows[p][0][seed_at + v :][:5]
        assert at == to


def test_word_hashes():
    """As many as words, equal for equal words only; every kind of white space, capitals that grow when lowered."""
    odd = "A\u00a0b\u2003C\u3000d\x1ce\x85\u0130x \n\t Ab aB \ud800 \U0001f600 z\u200bz end"
    draw = random.Random(4)
    for text in ("", "  ", "a", " a", odd, odd * 5, " ".join(draw.choices(vocabulary(draw), k=70_000))):
        words = passages.words_of(text)
        each = passages.word_hashes(text).tolist()
        assert len(each) == len(words) and len(set(zip(words, each))) == len(set(words)) == len(set(each))


def spread(texts, rows):
    """The texts' groups, as the rows link them."""
    group = list(range(len(texts)))

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    for r in rows:
        group[root(r.doc_id)] = root(r.other_id)
    return root


def test_rows_of_edited_passages_grow_with_the_texts(spark):
    """Each text has the passage with a word of its own, many others a part: all are linked, by few rows for each."""
    draw = random.Random(17)
    voc = vocabulary(draw)
    fill = lambda: draw.choices(voc, k=draw.randint(30, 90))
    one, texts = draw.choices(voc, k=66), []
    for k in range(60):
        mine = list(one)
        mine[28 + k % 10] = "edit%d" % k
        texts.append(fill() + mine + fill())
    for k in range(60):
        texts.append(fill() + (one[:40] if k % 2 else one[26:]) + fill())
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = passages.shared_passages(docs).collect()
    for r in got:
        a, b = texts[r.doc_id][r.start_word : r.end_word], texts[r.other_id][r.other_start : r.other_end]
        assert min(len(a), len(b)) >= passages.LEAST_WORDS and r.similarity == pytest.approx(passages.jaccard(a, b)) and r.similarity >= 0.8
    root = spread(texts, got)
    mine = [edited(t, one) for t in texts[:60]]
    alike = [(i, j) for i in range(60) for j in range(i) if passages.jaccard(mine[i], mine[j]) >= 0.8]
    assert len(alike) > 100 and [p for p in alike if root(p[0]) != root(p[1])] == []
    assert len(got) < 4 * 60


def edited(text, one):
    """The place of a text where the passage ``one`` stands, but for a word."""
    return max((text[i : i + len(one)] for i in range(len(text) - len(one) + 1)), key=lambda w: sum(map(str.__eq__, w, one)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_joined_groups(seed):
    draw = np.random.default_rng(seed)
    groups, plain = passages.Groups(60), list(range(60))
    for _ in range(4):
        i, j = draw.integers(0, 60, 12), draw.integers(0, 60, 12)
        before = len(set(plain))
        for a, b in zip(i.tolist(), j.tolist()):
            low, high = sorted((plain[a], plain[b]))
            plain = [low if p == high else p for p in plain]
        needed = groups.join(i, j)
        assert groups.name.tolist() == plain and len(needed) == before - len(set(plain))
    again = passages.Groups(60)
    assert len(again.join(*draw.integers(0, 60, (2, 0)))) == 0


@pytest.mark.parametrize("seed", range(4))
def test_sure_pairs_are_passages(seed):
    """What the words around a seed settle, the alignment of the texts gives as a passage that holds the seed."""
    draw = random.Random(seed)
    voc = vocabulary(draw)
    base = draw.choices(voc, k=240)
    rows = []
    for _ in range(40):
        mine = list(base)
        for at in draw.sample([*range(10, 117), *range(123, 230)], draw.choice([0, 2, 6, 10, 20])):
            mine[at] = "edit%d" % draw.randrange(10**6)
        if draw.random() < 0.4:
            lo, hi = draw.randint(70, 115), draw.randint(126, 170)
            mine = draw.choices(voc, k=lo) + mine[lo:hi] + draw.choices(voc, k=240 - hi)
        rows.append(mine)
    around = np.stack([passages.contexts(passages.word_hashes(" ".join(r)), np.array([117]))[2][0] for r in rows])
    assert passages._plain(around).all() and not passages._plain(np.full((1, around.shape[1]), 7, np.uint16)).any()
    n = {True: 0, False: 0}
    for i in range(40):
        for j in range(i):
            a, b = around[i : i + 1], around[j : j + 1]
            _, x, y, can, do = passages.judged(a, b, np.ones(1, bool))
            points = sorted(zip((117 + x).tolist(), (117 + y).tolist()))
            got = list(passages.align(rows[i], rows[j], *zip(*points), True)) if points else []
            held = any(g[0] <= 117 and g[1] >= 123 and g[2] <= 117 and g[3] >= 123 for g in got)
            assert held or not do[0]
            assert can[0] or not held
            n[bool(do[0])] += 1
    assert min(n.values()) > 20


def test_a_passage_is_extended_no_further_than_it_stays_alike():
    """46 equal words, and behind them so many that are half alike that all together would not be."""
    draw = random.Random(3)
    one = draw.choices(vocabulary(draw), k=300)
    two = [w if k < 46 or k % 4 else "edit%d" % k for k, w in enumerate(one)]
    two[46], two[48] = "edited", one[48]
    (got,) = passages.align(one, two, [10], [10])
    assert got[:4] == (0, 50, 0, 50) and got[5] == passages.jaccard(one[:50], two[:50]) >= 0.8


def test_rows_that_hang_together_are_not_compared(monkeypatch):
    """Once all have met the first, no pairs of a large group are looked for."""
    monkeypatch.setattr(passages, "LARGE", 10)
    monkeypatch.setattr(passages, "_indexed", None)
    groups, met = passages.Groups(30), []
    for i, j in passages._alike(np.zeros(30, np.int64), np.ones(30, bool), np.zeros((30, 1)), groups, np.arange(30)):
        groups.join(i, j)
        met += zip(i.tolist(), j.tolist())
    assert met == [(0, k) for k in range(1, 30)]


@pytest.mark.parametrize("seed", [1, 2])
def test_a_word_that_many_texts_repeat_makes_few_pairs(seed, monkeypatch):
    """Runs of one word with others before and behind: the pairs that are compared don't grow with the group's square."""
    draw, n, middle = random.Random(seed), 600, passages.SIDE
    voc, rows = vocabulary(draw), []
    for k in range(n):
        run = ["again"] * draw.randint(25, 49)
        more = draw.choice([[], ["again"] * 3 + draw.choices(voc, k=2), ["tail%d" % draw.randrange(20)] * 40])
        rows.append(draw.choices(voc, k=middle) + run + draw.choices(voc, k=draw.randrange(3)) + more + draw.choices(voc, k=middle))
    around = np.stack([passages.contexts(passages.word_hashes(" ".join(r)), np.array([middle]))[2][0] for r in rows])
    free = np.array([k % 3 > 0 for k in range(n)])
    i, j = np.triu_indices(n, 1)
    i, j = (c[free[i] | free[j]] for c in (i, j))
    *_, can, do = passages.judged(around[i], around[j], (p := passages._plain(around))[i] & p[j])
    met = []

    def counted(a, b, plain, judged=passages.judged):
        met.append(len(a))
        return judged(a, b, plain)

    monkeypatch.setattr(passages, "judged", counted)
    ids = pa.array(np.arange(n))
    columns = [pa.array(np.zeros(n, np.int64)), ids, pa.array(np.zeros(n, np.int64)), pa.array(free), ids, pa.array([a.tobytes() for a in around])]
    batch = pa.RecordBatch.from_arrays(columns, ["key", "digest", "pos", "free", "partner", "around"])
    got = {p for b in passages._likely_pairs(iter([batch])) for p in zip(b.column(1).to_pylist(), b.column(0).to_pylist())}
    groups = passages.Groups(n)
    groups.join(i[do], j[do])
    apart = groups.apart(i, j)
    assert got >= set(zip(i[can & apart].tolist(), j[can & apart].tolist())) and can.sum() > 100
    again = passages.Groups(n)
    again.join(*(np.array(c) for c in zip(*got)))
    groups.join(i[can], j[can])
    assert again.name.tolist() == groups.name.tolist()
    assert sum(met) < 60 * n < len(i) / 3
