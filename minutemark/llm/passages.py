"""Fuzzy passages that texts share: k-mer seeds, collinear chains by a Fenwick tree, alignment."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, partitions, text_or_empty

#: Words in a seed, and seeds of which one is kept: texts that share KMER + PICK - 1 words in a row share a seed.
KMER, PICK = 6, 20

#: Words in a passage at least, its shingles' words, and their least Jaccard similarity.
LEAST_WORDS, SHINGLE, SIMILARITY = 50, 5, 0.8

#: A seed adds KMER to its chain's score, each word of the gaps beside it takes off GAP_COST.
GAP_COST = 0.05

#: Words before and after a chain to which its passage can be extended.
MARGIN = 400

#: From the first word of a seed to that of another, in pairs of seeds.
LEAST_SPAN, MOST_SPAN = 20, 64

#: Words in a key around a seed, words between two runs of a passage in both texts together at most, and words on either
#: side of a seed in which two runs of less than LEAST_WORDS - SHINGLE words are seen.
WIDE = KMER + PICK // 2
GAP = 12
WEIGHT = round(SIMILARITY / (1 - SIMILARITY))
SIDE = LEAST_WORDS - SHINGLE - KMER - 1 + GAP + SHINGLE

#: Contexts that are looked at together, pairs of them compared at once, and pairs of a group above which an index chooses them.
ROWS, PAIRS, LARGE = 1 << 14, 1 << 14, 1 << 16

#: Words that are hashed at once; bounds a very long text's memory.
CHUNK = 1 << 18

_ODD, _OTHER_ODD = 0xD1342543DE82EF95, 0xBF58476D1CE4E5B9


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def seeds(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the k-mers that are least among PICK neighbours, in any window of them."""
    return seeds_of(word_hashes(" ".join(words)))


def seeds_of(each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The seeds of a text by the hashes of its words."""
    hashes, places = [], []
    for lo in range(0, max(0, len(each) - KMER - PICK + 2), CHUNK):
        some = each[lo : lo + CHUNK + KMER + PICK - 2]
        mers = np.zeros(len(some) - KMER + 1, np.uint64)
        for t in range(KMER):
            mers = mers * np.uint64(_ODD) + some[t : len(some) - KMER + 1 + t]
        mers = (mers ^ (mers >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mers ^= mers >> np.uint64(32)
        # In order of hash and then place; a k-mer is some window's least if the greatest of its windows' least ones is no less.
        order = mers & ~np.uint64(2 * CHUNK - 1) | np.arange(len(mers), dtype=np.uint64)
        least, edge = _slide(np.minimum, order), np.zeros(PICK - 1, np.uint64)
        kept = np.flatnonzero(_slide(np.maximum, np.concatenate([edge, least, edge])) == order)
        hashes.append(mers[kept].view(np.int64))
        places.append(kept + lo)
    if not hashes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[first], at


def _slide(least: np.ufunc, values: np.ndarray) -> np.ndarray:
    """``least`` of every PICK neighbours: of twice as many from two of half, then of two that overlap."""
    size = 1
    while 2 * size <= PICK:
        values, size = least(values[:-size], values[size:]), 2 * size
    return least(values[: len(values) - PICK + size], values[PICK - size :])


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, 1 << 12), base, np.uint64)
        steps[0] = 1
        _powers[base] = held = np.cumprod(steps)
    return held[:n]


def rolled(each: np.ndarray, at: np.ndarray, n: int | np.ndarray, base: int = _ODD) -> np.ndarray:
    """A hash of the ``n`` values from each of the places ``at``, the same wherever they stand."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each * _power(base, len(each)))])
    return (sums[at + n] - sums[at]) * _power(pow(base, -1, 1 << 64), len(each) + 1)[at]


_SPACE = np.array([chr(c).isspace() for c in range(0x3002)])


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of a text, as ``words_of`` gives them, without making them."""
    letters = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    edges = np.flatnonzero(np.diff(_SPACE[np.minimum(letters, len(_SPACE) - 1)], prepend=True, append=True))
    start, stop = edges[::2], edges[1::2]
    found = np.empty(len(start), np.uint64)
    for lo in range(0, len(start), 1 << 16):  # bounds a very long text's memory
        some = slice(lo, lo + (1 << 16))
        first = start[lo]
        found[some] = rolled(letters[first : stop[some][-1]].astype(np.uint64), start[some] - first, stop[some] - start[some])
    found ^= found >> np.uint64(29)
    found *= np.uint64(_OTHER_ODD)
    return found ^ (found >> np.uint64(32))


class PrefixMax:
    """Fenwick tree: the best (score, item) among ranks below a rank."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(0.0, -1)] * (n + 1)

    def put(self, rank: int, score: float, item: int) -> None:
        rank += 1
        while rank < len(self.best):
            if score > self.best[rank][0] or self.best[rank][1] < 0:
                self.best[rank] = (score, item)
            rank += rank & -rank

    def below(self, rank: int) -> tuple[float, int]:
        found = (0.0, -1)
        while rank > 0:
            if self.best[rank][1] >= 0 and (found[1] < 0 or self.best[rank][0] > found[0]):
                found = self.best[rank]
            rank -= rank & -rank
        return found


def chain(x: np.ndarray, y: np.ndarray) -> list[list[int]]:
    """Best chains of seeds (positions x in one text, y in the other, sorted by x and y), each seed in one at most.

    A chain rises in both texts. Its score is KMER for each seed less GAP_COST
    for each word between neighbours in either text: with x + y taken into
    the score, the best predecessor is a prefix maximum over y.
    """
    step_x, step_y = np.diff(x), np.diff(y)
    if (step_x > 0).all() and (step_y > 0).all() and ((step_x + step_y) * GAP_COST < KMER).all():
        return [list(range(len(x)))]  # every link pays: one chain of all
    ranks = np.unique(y, return_inverse=True)[1].tolist()
    xs, ys = x.tolist(), y.tolist()
    tree = PrefixMax(max(ranks) + 1)
    score, before = [0.0] * len(xs), [-1] * len(xs)
    at = 0
    while at < len(xs):
        stop = at
        while stop < len(xs) and xs[stop] == xs[at]:  # seeds at one place can't follow each other
            best, item = tree.below(ranks[stop])
            gain = best - GAP_COST * (xs[stop] + ys[stop])
            score[stop] = KMER + max(0.0, gain if item >= 0 else 0.0)
            before[stop] = item if item >= 0 and gain > 0 else -1
            stop += 1
        for i in range(at, stop):
            tree.put(ranks[i], score[i] + GAP_COST * (xs[i] + ys[i]), i)
        at = stop
    used, chains = [False] * len(xs), []
    for i in sorted(range(len(xs)), key=lambda i: -score[i]):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = before[i]
        if path:
            chains.append(path[::-1])
    return chains


def exact_runs(a: list[str], b: list[str], x: list[int], y: list[int]) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the runs of equal words along a chain of seeds, in order and not overlapping.

    Each seed is extended to both sides as far as the words are equal. Where the gap between two runs has as many
    words in either text, the equal words in it are runs too.
    """
    runs: list[tuple[int, int, int]] = []
    end_a = end_b = 0
    for i, j in zip(x, y):
        if runs and i - j == runs[-1][0] - runs[-1][1] and i + KMER <= end_a:
            continue  # inside the run before
        skip = max(0, end_a - i, end_b - j)
        if skip >= KMER:
            continue
        i, j, n = i + skip, j + skip, 0
        while i > end_a and j > end_b and a[i - 1] == b[j - 1]:
            i, j, n = i - 1, j - 1, n + 1
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        if not n:
            continue
        if runs and i - end_a == j - end_b:
            at = end_a
            while at < i:
                stop = at
                while stop < i and a[stop] == b[stop - end_a + end_b]:
                    stop += 1
                if stop > at:
                    runs.append((at, at - end_a + end_b, stop - at))
                at = stop + 1
        runs.append((i, j, n))
        end_a, end_b = i + n, j + n
    return runs


def _extend(a: list[str], b: list[str]) -> int:
    """How far two lists stay alike from their beginnings: the best end, 1 for a word and -2 for a difference."""
    score = best = end = 0
    for k, (x, y) in enumerate(zip(a, b), 1):
        score += 1 if x == y else -2
        if score > best:
            best, end = score, k
        elif score < best - 8:
            break
    return end


def jaccard(a: list[str], b: list[str]) -> float:
    shingled = [{tuple(w[i : i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))} for w in (a, b)]
    return len(shingled[0] & shingled[1]) / len(shingled[0] | shingled[1])


def align(a: list[str], b: list[str], x: list[int], y: list[int], parted: bool = False) -> Iterator[tuple[int, int, int, int, int, float]]:
    """Passages along a chain of seeds: (a from, a to, b from, b to, words alike, shingle similarity).

    The chain's runs of equal words are one passage if their shingles are alike enough; else it is parted at its widest
    gap and either side judged, so that a run that is long enough by itself is always found. With ``parted``, neighbours
    that were parted are judged together too, where no passage holds both. A passage is extended over differing words at
    its ends where it stays alike enough, as far as that goes or else as far as it needs to be long enough.
    """
    runs = exact_runs(a, b, x, y)
    shingles = np.cumsum([0, *(max(0, n - SHINGLE + 1) for _, _, n in runs)]).tolist()
    alike = np.cumsum([0, *(n for _, _, n in runs)]).tolist()
    gaps = [r[0] - q[0] - q[2] + r[1] - q[1] - q[2] for q, r in zip(runs, runs[1:])]
    todo, held, again = [(0, len(runs) - 1)] if runs else [], [False] * len(runs), parted
    while todo or again:
        if not todo:  # neighbours that were parted, and one of which no passage holds, by themselves
            again = False
            todo = [(k, k + 1) for k in range(len(runs) - 1) if not (held[k] and held[k + 1])]
            continue
        i, j = todo.pop()
        a0, b0 = runs[i][:2]
        a1, b1 = runs[j][0] + runs[j][2], runs[j][1] + runs[j][2]
        if min(a1 - a0, b1 - b0) < LEAST_WORDS // 2:
            continue
        shared = shingles[j + 1] - shingles[i]
        union = max(1, a1 - a0 - SHINGLE + 1) + max(1, b1 - b0 - SHINGLE + 1) - shared
        if shared < SIMILARITY * union and i < j:
            if again or not parted:
                cut_at = max(range(i, j), key=gaps.__getitem__)
                todo += [(i, cut_at), (cut_at + 1, j)]
            continue
        left = _extend(a[:a0][::-1], b[:b0][::-1])
        right = _extend(a[a1:], b[b1:])
        same = alike[j + 1] - alike[i]
        wanting = LEAST_WORDS - min(a1 - a0, b1 - b0)
        ends = [(left, right), (0, 0)]
        if 0 < wanting <= left + right:  # as far as a passage needs
            ends[1:] = [(wanting - min(right, wanting), min(right, wanting)), (min(left, wanting), wanting - min(left, wanting))]
        for more, further in ends:
            p0, p1, q0, q1 = a0 - more, a1 + further, b0 - more, b1 + further
            if min(p1 - p0, q1 - q0) >= LEAST_WORDS and (likeness := jaccard(a[p0:p1], b[q0:q1])) >= SIMILARITY:
                n = same + sum(map(str.__eq__, a[p0:a0], b[q0:b0])) + sum(map(str.__eq__, a[a1:p1], b[b1:q1]))
                yield p0, p1, q0, q1, n, likeness
                held[i : j + 1] = [True] * (j + 1 - i)
                break


def _digests(text: str | None) -> tuple[int, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(raw), np.int64).tolist())


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            keys, sizes, found = [], [], []
            for text in part.column(1):
                text = text.as_py()
                each = word_hashes(text or "")
                keys.append(_digests(text))
                sizes.append(len(each))
                found.append(seeds_of(each))
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["seed", "pos"])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(f[0]) for f in found)]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(c, pa.int64()) for c in zip(*keys)], pa.array(sizes, pa.int64()), lists],
                ["doc", "digest", "digest2", "n_words", "seeds"],
            )


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            texts = part.column(1).to_pylist()
            packed = [squeeze((t or "").encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([_digests(t)[0] for t in texts], pa.int64()), pa.array(packed, pa.binary())],
                ["doc", "digest", "packed"],
            )


def _pair_chains(batches: Iterable[pa.RecordBatch], least: int = 2) -> Iterator[pa.RecordBatch]:
    """Chains, of ``least`` seeds at least, of each pair of texts, whose seeds come together and sorted."""

    def found(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        a, b, x, y = columns
        edges = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]), True]) if len(a) else np.zeros(1, np.int64)
        rows = []
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if hi - lo >= least:
                for path in chain(x[lo:hi], y[lo:hi]):
                    if len(path) >= least:
                        rows.append((a[lo], b[lo], x[lo:hi][path].tolist(), y[lo:hi][path].tolist()))
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["a", "b", "x", "y"])

    held = [np.empty(0, np.int64)] * 4
    for batch in batches:
        columns = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)]
        a, b = columns[:2]
        other = np.flatnonzero((a != a[-1]) | (b != b[-1])) if len(a) else np.empty(0, np.int64)
        last = int(other[-1]) + 1 if len(other) else 0  # the last pair may go on in the next batch
        yield from found([c[:last] for c in columns])
        held = [c[last:] for c in columns]
    yield from found(held)


class _Texts:
    """Unpacks the words of a text, and keeps the last one: rows of one text come together."""

    def __init__(self):
        self.unpack, self.key, self.words = zstandard.ZstdDecompressor().decompress, None, []

    def get(self, packed: bytes) -> list[str]:
        if packed != self.key:
            self.key, self.words = packed, words_of(self.unpack(packed).decode("utf-8", "surrogatepass"))
        return self.words


def _take_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the first text by the words around its chain."""
    texts, squeeze = _Texts(), zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            rows = []
            for r in batch.slice(lo, 256).to_pylist():
                start = max(0, r["x"][0] - MARGIN)
                some = " ".join(texts.get(r["packed"])[start : r["x"][-1] + KMER + MARGIN])
                rows.append((r["a"], r["b"], r["x"], r["y"], start, squeeze(some.encode("utf-8", "surrogatepass"))))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
                names = ["a", "b", "x", "y", "start", "words"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def window_places(hot: np.ndarray, known: list[tuple[int, int]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of LEAST_WORDS words that may stand in another text: (start, which of the ``hot`` seeds it has, asks).

    ``hot`` has the sorted places of seeds that occur several times. Texts that share a window share the least k-mer of
    its first PICK, that of its last, and all seeds between: so the last seed among its first PICK is the same in each.
    A window asks for a partner if none of the ``known`` passages, (start, end), holds it.
    """
    at = np.arange(max(0, size - LEAST_WORDS + 1))
    seed = np.searchsorted(hot, at + PICK) - 1
    after = np.searchsorted(hot, at + LEAST_WORDS - KMER + 1) - 1
    fit = (seed >= 0) & (after > seed)
    fit[fit] = (hot[seed[fit]] >= at[fit]) & (hot[after[fit]] > at[fit] + LEAST_WORDS - KMER - PICK)
    asks = np.ones(len(at), bool)
    for start, end in known:
        asks[start : max(start, end - LEAST_WORDS + 1)] = False
    return at[fit], seed[fit], asks[fit]


def window_hashes(words: list[str], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the windows that start at the sorted places ``at``."""
    return _window_hashes(word_hashes(" ".join(words)), at)


def _window_hashes(each: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed = (each ^ (each >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return rolled(each, at, LEAST_WORDS).view(np.int64), rolled(mixed, at, LEAST_WORDS, _OTHER_ODD).view(np.int64)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lists of structs as (where each begins and the last ends, a flat array for each field); a null list is empty."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    return np.concatenate([np.zeros(1, np.int64), ends]), [c.to_numpy(zero_copy_only=False) for c in column.flatten().flatten()]


def _sorted_lists(column: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """As ``_lists``, each list in the order of its first field."""
    edges, fields = _lists(column)
    order = np.lexsort((fields[0], np.repeat(np.arange(len(edges) - 1), np.diff(edges))))
    return edges, [f[order] for f in fields]


def _ranges(edges: np.ndarray, fields: list[np.ndarray], row: int) -> list[tuple[int, ...]]:
    lo, hi = edges[row : row + 2]
    return list(zip(*(f[lo:hi].tolist() for f in fields)))


def _asked_seeds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The seeds by which windows that ask for a partner are found in other texts."""
    for batch in batches:
        edges, (x, seed) = _sorted_lists(batch.column(0))
        known, out = _lists(batch.column(1)), [np.empty(0, np.int64)]
        for r, size in enumerate(batch.column(2).to_pylist()):
            some = slice(*edges[r : r + 2])
            _, which, asks = window_places(x[some], [k[:2] for k in _ranges(*known, r)], size)
            out.append(seed[some][np.unique(which[asks])])
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(out)))], ["seed"])


def _window_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the texts that have an asked seed; of a text's equal ones the first."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            digests, packed, hot, known = batch.slice(lo, 64).columns
            edges, (places, asked_for) = _sorted_lists(hot)
            known, found = _lists(known), []
            for r, (digest, text) in enumerate(zip(digests.to_pylist(), packed.to_pylist())):
                each = word_hashes(unpack(text).decode("utf-8", "surrogatepass"))
                x, asked = places[edges[r] : edges[r + 1]], asked_for[edges[r] : edges[r + 1]]
                at, which, asks = window_places(x, [k[:2] for k in _ranges(*known, r)], len(each))
                at, asks = at[asked[which]], asks[asked[which]]
                one, two = _window_hashes(each, at)
                order = np.lexsort((at, two, one))
                new = np.ones(len(order), bool)
                new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
                first = np.sort(order[new])
                found.append((one[first], two[first], np.full(len(first), digest, np.int64), at[first], asks[first]))
            columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, ["one", "two", "digest", "pos", "asks"])


def seed_pairs(x: np.ndarray, seed: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, first place, second place, asks) of the pairs of seeds LEAST_SPAN to MOST_SPAN words apart; of equal pairs the first.

    ``x`` are the sorted places. A pair asks if both of its seeds do.
    """
    found = [tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))]
    for lo in range(0, len(x), 1 << 12):  # bounds a very long text's memory
        some = np.arange(lo, min(lo + (1 << 12), len(x)))
        begin, end = np.searchsorted(x, x[some] + LEAST_SPAN), np.searchsorted(x, x[some] + MOST_SPAN, "right")
        n = end - begin
        i = np.repeat(some, n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
        key = seed[i].view(np.uint64) * np.uint64(_ODD) + seed[j].view(np.uint64)
        key = ((key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)
        key, first = np.unique(key, return_index=True)
        i, j = i[first], j[first]
        found.append((key, x[i], x[j], asks[i] & asks[j]))
    columns = [np.concatenate(c) for c in zip(*found)]
    first = np.unique(columns[0], return_index=True)[1]
    return tuple(c[first] for c in columns)


def _free(x: np.ndarray, known: list[tuple[int, int]]) -> np.ndarray:
    """Which seeds, by their sorted places, no known passage holds."""
    free = np.ones(len(x), bool)
    for start, end in known:
        free[np.searchsorted(x, start) : np.searchsorted(x, end - KMER, "right")] = False
    return free


def _free_seeds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The seeds that no known passage holds."""
    for batch in batches:
        edges, (x, seed) = _sorted_lists(batch.column(0))
        known, free = _lists(batch.column(1)), np.ones(len(x), bool)
        for r in np.flatnonzero(np.diff(known[0])).tolist():
            free[edges[r] : edges[r + 1]] = _free(x[edges[r] : edges[r + 1]], [k[:2] for k in _ranges(*known, r)])
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(seed[free]))], ["seed"])


def contexts(each: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which of the places ``at``, key, words around) of seeds: twice each, by the WIDE words from it and up to its end.

    Texts that share KMER + PICK - 1 words in a row share a seed in them, and beside it half of the others on one side:
    so one of its keys. ``each`` are the hashes of a text's words. The words around, SIDE on either side, are hashes of two bytes, 0 beyond the text's ends.
    """
    around = np.zeros(len(each) + 2 * SIDE, np.uint16)
    around[SIDE : SIDE + len(each)] = np.maximum(each >> np.uint64(48), 1)
    right, left = np.flatnonzero(at + WIDE <= len(each)), np.flatnonzero(at + KMER >= WIDE)
    which = np.concatenate([right, left])
    key = np.concatenate([rolled(each, at[right], WIDE), ~rolled(each, at[left] + KMER - WIDE, WIDE)]).view(np.int64)
    return which, key, around[at[which, None] + np.arange(2 * SIDE + KMER)]


def _partners(x: np.ndarray, known: list[tuple[int, int, int]], digest: int) -> np.ndarray:
    """For each seed, by the sorted places, the least of the texts that known passages which hold it are shared with; ``digest`` for free ones."""
    least = np.full(len(x), np.iinfo(np.int64).max)
    for start, end, other in known:
        some = slice(np.searchsorted(x, start), np.searchsorted(x, end - KMER, "right"))
        least[some] = np.minimum(least[some], other)
    return np.where(_free(x, [k[:2] for k in known]), digest, least)


def _context_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            digests, packed, places, known = batch.slice(lo, 64).columns
            known, found = _lists(known), []
            for r, (digest, text, at) in enumerate(zip(digests.to_pylist(), packed.to_pylist(), places)):
                each = word_hashes(unpack(text).decode("utf-8", "surrogatepass"))
                at = np.sort(at.values.to_numpy())
                ranges = _ranges(*known, r)
                which, key, around = contexts(each, at)
                free = _free(at, [k[:2] for k in ranges])[which]
                order = np.lexsort((which, free, key))  # of a text's seeds with equal words the first, if one is held that
                once = order[np.r_[True, np.diff(key[order]) != 0]] if len(order) else order
                partner = _partners(at, ranges, digest)[which][once]
                found.append((key[once], np.full(len(once), digest, np.int64), at[which][once], free[once], partner, around[once]))
            *columns, around = zip(*found)
            columns = [pa.array(np.concatenate(c)) for c in columns]
            around = np.ascontiguousarray(np.concatenate(around))
            edges = pa.array(np.arange(len(around) + 1, dtype=np.int32) * (2 * around.shape[1]), pa.int32())
            around = pa.Array.from_buffers(pa.binary(), len(around), [None, edges.buffers()[1], pa.py_buffer(around)])
            yield pa.RecordBatch.from_arrays([*columns, around], ["key", "digest", "pos", "free", "partner", "around"])


def _beside(a: np.ndarray, b: np.ndarray, run: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, ...]:
    """(pair, words skipped in a, in b, can be, is) of the runs beside that of ``long`` words: in one passage with it.

    They begin a gap after the ``run`` words right of the seed. A gap costs the passages SHINGLE - 1 shingles each and its
    words, which the runs beside some gap outweigh: with SIMILARITY 0.8 four times. Both runs and the gap are a passage
    if what is seen outweighs the gap and is long enough.
    """
    pairs = np.flatnonzero(SIDE - run >= GAP + SHINGLE)
    at = SIDE + KMER + run[pairs, None] + np.arange(GAP + SHINGLE)
    sides = []
    for words, none in ((a, 0), (b, 1)):
        words = np.take_along_axis(words[pairs], at, 1).astype(np.uint64)
        mixed, real = np.zeros((len(pairs), GAP + 1), np.uint64), np.ones((len(pairs), GAP + 1), bool)
        for t in range(SHINGLE):
            mixed = mixed * np.uint64(_ODD) + words[:, t : t + GAP + 1]
            real &= words[:, t : t + GAP + 1] > 0
        sides.append(np.where(real, mixed * np.uint64(2), np.uint64(2 * none + 1)))
    gap = np.arange(GAP + 1)
    equal = (sides[0][:, :, None] == sides[1][:, None, :]) & (gap[:, None] + gap <= GAP)
    equal[:, 1:, 1:] &= ~equal[:, :-1, :-1].copy()  # only where a run begins
    pair, i, j = np.nonzero(equal)
    pair = pairs[pair]
    size, grows, cut_off = np.full(len(pair), SHINGLE), np.arange(len(pair)), np.zeros(len(pair), bool)
    while len(grows):  # a run up to the end of what is seen counts as long enough
        at, to = (SIDE + KMER + run[pair[grows]] + skipped[grows] + size[grows] for skipped in (i, j))
        seen = np.maximum(at, to) < a.shape[1]
        cut_off[grows[~seen]] = True
        grows, at, to = grows[seen], at[seen], to[seen]
        grows = grows[(a[pair[grows], at] == b[pair[grows], to]) & (a[pair[grows], at] > 0)]
        size[grows] += 1
    outweighs = long[pair] + size - 2 * (SHINGLE - 1) >= WEIGHT * (i + j + 2 * (SHINGLE - 1))
    return pair, i, j, outweighs | cut_off, outweighs & (long[pair] + size + np.minimum(i, j) >= LEAST_WORDS)


def _extends(a: np.ndarray, b: np.ndarray, run: np.ndarray) -> np.ndarray:
    """How far ``_extend`` goes over the words after the ``run`` words right of the seed; what it needs is seen."""
    at = SIDE + KMER + run[:, None] + np.arange(GAP)
    mine, other = (np.take_along_axis(words, np.minimum(at, a.shape[1] - 1), 1) for words in (a, b))
    alike = (mine == other) & (mine > 0) & (at < a.shape[1])
    score = np.cumsum(np.where(alike, 1, -2), 1)
    best = np.maximum.accumulate(np.maximum(score, 0), 1)
    score[np.logical_or.accumulate(score < best - 8, 1)] = 0
    return np.where(score.max(1) > 0, score.argmax(1) + 1, 0)


def likely(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, places in a, in b, from the seed) where two texts can share a passage around a seed: rows of ``a`` and ``b``.

    Of two passages that are alike enough the longest run of equal words has KMER + PICK - 1, and unless it has
    LEAST_WORDS - SHINGLE or more itself, another of SHINGLE or more lies beside it, past GAP words in both texts
    together at most, and both outweigh the gap. Given are the seed of the long run, at 0, and that other run.
    """
    return judged(a, b, np.zeros(len(a), bool))[:3]


def _plain(around: np.ndarray) -> np.ndarray:
    """Whether all shingles of the words around are different, so that they can be counted by words."""
    plain = np.ones(len(around), bool)
    for lo in range(0, len(around), 1 << 11):  # bounds the memory
        some = around[lo : lo + (1 << 11)]
        mixed = np.zeros((len(some), some.shape[1] - SHINGLE + 1), np.uint64)
        for t in range(SHINGLE):
            mixed = mixed * np.uint64(_ODD) + some[:, t : t + mixed.shape[1]]
        mixed[(some[:, SHINGLE - 1 :] == 0) | (some[:, : mixed.shape[1]] == 0)] = 0
        mixed.sort(1)
        plain[lo : lo + len(some)] = ((np.diff(mixed, axis=1) > 0) | (mixed[:, 1:] == 0)).all(1)
    return plain


def judged(a: np.ndarray, b: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, ...]:
    """What ``likely`` gives, and for each row of ``a``, ``b`` whether they can share a passage at all, and whether they do.

    They do if the long run is long enough by itself, or, in ``plain`` words, with a run beside it or as it is extended.
    A long run of less than LEAST_WORDS with nothing beside it is a passage only if it can be extended.
    """
    can, do = np.zeros(len(a), bool), np.zeros(len(a), bool)
    equal = (a == b) & (a > 0)
    right, left = (np.where(e.all(1), SIDE, e.argmin(1)) for e in (equal[:, SIDE + KMER :], equal[:, SIDE - 1 :: -1]))
    long = left + KMER + right
    kept = np.flatnonzero(equal[:, SIDE : SIDE + KMER].all(1) & (long >= KMER + PICK - 1))
    a, b, right, left, long = a[kept], b[kept], right[kept], left[kept], long[kept]
    after, i, j, fit, sure = _beside(a, b, right, long)
    before, k, m, fit_too, sure_too = _beside(a[:, ::-1], b[:, ::-1], left, long)
    do[kept[after[sure]]] = do[kept[before[sure_too]]] = True
    alone = long >= LEAST_WORDS - SHINGLE
    short = np.flatnonzero(alone & (long < LEAST_WORDS))
    size = long[short] + _extends(a[short], b[short], right[short]) + _extends(a[short, ::-1], b[short, ::-1], left[short])
    do[kept[short[size >= LEAST_WORDS]]] = can[kept[short[size >= LEAST_WORDS]]] = True  # LEAST_WORDS of these are alike enough
    can[kept[np.concatenate([after[fit | alone[after]], before[fit_too | alone[before]]])]] = True
    do &= plain
    do[kept[long >= LEAST_WORDS]] = True
    can |= do
    after, i, j, before, k, m = after[fit], i[fit], j[fit], before[fit_too], k[fit_too], m[fit_too]
    seeds = np.unique(np.concatenate([after, before, np.flatnonzero(alone)]))
    none = np.zeros(len(seeds), np.int64)
    pair = np.concatenate([seeds, after, before])
    at_a = np.concatenate([none, KMER + right[after] + i, -left[before] - k - SHINGLE])
    at_b = np.concatenate([none, KMER + right[after] + j, -left[before] - m - SHINGLE])
    return kept[pair], at_a, at_b, can, do


class Groups:
    """Which rows hang together, as pairs of them are joined. A group's name is the least of its rows."""

    def __init__(self, n: int):
        self.name = np.arange(n)

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self.name[i] != self.name[j]

    def join(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Join pairs of rows, and say which pairs were needed for it: as many as there are groups less."""
        needed = [np.empty(0, np.int64)]
        todo = np.flatnonzero(self.apart(i, j))
        while len(todo):
            one, two = self.name[i[todo]], self.name[j[todo]]
            low, high = np.minimum(one, two), np.maximum(one, two)
            order = np.lexsort((low, high))
            new = order[np.r_[True, np.diff(high[order]) != 0]]  # each group joins the least of its neighbours
            needed.append(todo[new])
            to = np.arange(len(self.name))
            to[high[new]] = low[new]
            while (to[to] != to).any():
                to = to[to]
            self.name = to[self.name]
            todo = todo[self.apart(i[todo], j[todo])]
        return np.concatenate(needed)


def _cross(labels: np.ndarray, free: np.ndarray, apart: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places with equal labels, one of them free, in parts; not those with equal ``apart`` too. Labels are sorted."""
    edges = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1], True])
    size = np.repeat(np.diff(edges), np.diff(edges))
    start = np.repeat(edges[:-1], np.diff(edges))
    if apart is not None:  # sorted within a label: the others are those before and after the same
        inner = np.flatnonzero(np.r_[True, (labels[1:] != labels[:-1]) | (apart[1:] != apart[:-1]), True])
        same = np.repeat(np.diff(inner), np.diff(inner))
        first = np.repeat(inner[:-1], np.diff(inner))
    else:
        same, first = np.ones(len(labels), np.int64), np.arange(len(labels))
    some = np.flatnonzero(free & (size > same))
    n = (size - same)[some]
    ends = np.cumsum(n)
    for lo in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        nth = np.arange(lo, min(lo + PAIRS, int(ends[-1])))
        k = np.searchsorted(ends, nth, "right")
        i = some[k]
        j = start[i] + nth - ends[k] + n[k]
        yield i, np.where(j < first[i], j, j + same[i])


def _hashed(words: np.ndarray) -> np.ndarray:
    """A hash of each row of words; 0 if one of them is beyond the text's ends."""
    mixed = np.zeros(len(words), np.uint64)
    for t in range(words.shape[1]):
        mixed = mixed * np.uint64(_ODD) + words[:, t]
    return np.where((words > 0).all(1), (mixed ^ (mixed >> np.uint64(29))) | np.uint64(1), np.uint64(0))


def _parted(node: np.ndarray, child: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Rows with a node that others have with another child, one of these free at least. Nodes of 0 are none."""
    order = np.lexsort((child, node))
    order = order[np.searchsorted(node[order], 1) :]
    if not len(order):
        return order
    edges = np.flatnonzero(np.r_[True, np.diff(node[order]) != 0])
    many = child[order[edges]] != child[order[np.r_[edges[1:], len(order)] - 1]]
    return order[np.repeat(many & np.logical_or.reduceat(free[order], edges), np.diff(np.r_[edges, len(order)]))]


def _index_pairs(around: np.ndarray, free: np.ndarray, alone: bool = False) -> Iterator[np.ndarray]:
    """Pairs (first * rows + second) of a large group that can share a passage, in parts, without comparing all.

    Two rows' words are equal from some place on until they part. Rows that part at the same place, behind the same
    words, share a shingle of the second run at most GAP words behind it; a line that many texts share in the same
    words, or a word that they repeat, makes no pairs. Without such a run there must be LEAST_WORDS - SHINGLE equal words
    and, to extend them, three more a few words behind: or with ``alone`` nothing more. Rows with LEAST_WORDS equal words
    meet the first free one that has them. No more than some of the pairs are held at once.
    """
    rows = len(around)

    def cross(label: np.ndarray, who: np.ndarray, child: np.ndarray | None, skipped: np.ndarray) -> Iterator[np.ndarray]:
        if not len(label):
            return
        order = np.lexsort((skipped, who, label))
        order = order[np.r_[True, (np.diff(label[order]) != 0) | (np.diff(who[order]) != 0)]]  # where a row has it first
        if child is not None:
            order = order[np.lexsort((child[order], label[order]))]
        label, who, skipped = label[order], who[order], skipped[order]
        for i, j in _cross(label, free[who], None if child is None else child[order]):
            near = skipped[i] + skipped[j] <= GAP
            if near.any():
                yield np.unique(who[i[near]] * rows + who[j[near]])

    for at in range(SIDE + KMER - LEAST_WORDS, SIDE + 1):
        label = _hashed(around[:, at : at + LEAST_WORDS])
        order = np.lexsort((~free, label))
        order = order[np.searchsorted(label[order], 1) :]
        if len(order):
            edges = np.flatnonzero(np.r_[True, np.diff(label[order]) != 0])
            first = np.repeat(order[edges], np.diff(np.r_[edges, len(order)]))
            fit = free[first] & (first != order)
            yield first[fit] * rows + order[fit]
    size = LEAST_WORDS - SHINGLE
    for side in (around, around[:, ::-1]):
        for end in range(SIDE + KMER, 2 * SIDE + KMER - GAP - SHINGLE + 1):
            node = _hashed(side[:, min(SIDE, end - KMER - PICK + 1) : end])
            some = _parted(node, side[:, end], free)
            every = ([], [], [], [])
            for skip in range(GAP + 1 if len(some) else 0):
                shingle = _hashed(side[some, end + skip : end + skip + SHINGLE])
                real = np.flatnonzero(shingle)
                values = (node[some[real]] * np.uint64(_OTHER_ODD) + shingle[real], some[real], side[some[real], end], np.full(len(real), skip))
                for kept, v in zip(every, values):
                    kept.append(v)
            if len(some):
                yield from cross(*(np.concatenate(c) for c in every))
        if not alone:
            for end in range(SIDE + KMER, SIDE + LEAST_WORDS):
                node = _hashed(side[:, min(SIDE, end - size) : end])
                some = _parted(node, side[:, end], free)
                for at in range(end + 1, min(end + GAP - 2, side.shape[1] - 3) + 1) if len(some) else ():
                    more = _hashed(side[some, at : at + 3])
                    real = np.flatnonzero(more)
                    label = node[some[real]] * np.uint64(_OTHER_ODD) + more[real]
                    yield from cross(label, some[real], side[some[real], end], np.zeros(len(real), np.int64))
    if alone:
        for at in range(SIDE + KMER - size, SIDE + 1):
            label = _hashed(around[:, at : at + size])
            real = np.flatnonzero(label)
            yield from cross(label[real], real, None, np.zeros(len(real), np.int64))


def _indexed(around: np.ndarray, free: np.ndarray) -> np.ndarray:
    """All pairs (first * rows + second) of a group that can pass ``likely``, by the index of large groups."""
    return np.unique(np.concatenate([np.empty(0, np.int64), *_index_pairs(around, free, alone=True)]))


def _alike(label: np.ndarray, free: np.ndarray, large: np.ndarray, groups: Groups, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ``rows`` with equal labels, one of them free, that are in different groups yet.

    The groups can be joined as the pairs come: first all meet the first of their label, then who is left apart. Labels
    with more than LARGE pairs left make none: their rows are marked in ``large``.
    """

    def by_label() -> tuple[np.ndarray, np.ndarray]:
        order = rows[np.lexsort((groups.name[rows], label[rows]))]
        return order, np.flatnonzero(np.r_[True, label[order][1:] != label[order][:-1], True])

    if not len(rows):
        return
    order, edges = by_label()
    first = np.repeat(order[edges[:-1]], np.diff(edges))
    fit = np.flatnonzero(groups.apart(first, order) & (free[first] | free[order]))
    for lo in range(0, len(fit), PAIRS):
        yield first[fit[lo : lo + PAIRS]], order[fit[lo : lo + PAIRS]]
    order, edges = by_label()
    name, many = groups.name[order], np.diff(edges)
    inner = np.flatnonzero(np.r_[True, (np.diff(name) != 0) | (label[order][1:] != label[order][:-1]), True])
    others = np.repeat(many, many) - np.repeat(np.diff(inner), np.diff(inner))
    left = np.repeat(np.add.reduceat(free[order] * others, edges[:-1]) > LARGE, many)
    large[order[left]] = True
    for i, j in _cross(label[order], free[order] & ~left, name):
        i, j = order[i], order[j]
        once = ~free[j] | (i < j)  # of two free ones each meets the other
        yield i[once], j[once]


def _likely_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds and second runs of pairs of texts that share a passage around a seed; rows of a key come together.

    Of the texts of a key that hang together by such pairs, and by the known passages that hold the seed, only as many
    pairs come as join them, and those of texts that are apart and about which the words around can't decide.
    """

    def found(key: np.ndarray, digest: np.ndarray, pos: np.ndarray, free: np.ndarray, partner: np.ndarray, around: np.ndarray) -> Iterator[pa.RecordBatch]:
        def points(i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
            i, j = np.where(digest[i] > digest[j], i, j), np.where(digest[i] > digest[j], j, i)  # the lower text is always b
            pair, x, y = likely(around[i], around[j])
            columns = [digest[i[pair]], digest[j[pair]], pos[i[pair]] + x, pos[j[pair]] + y]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "x", "y"])

        # Rows by key and text, and the texts of known passages that hold others' seeds; no free row is one of these.
        n, more = len(key), np.flatnonzero(~free)
        columns = np.r_[key, key[more]], np.r_[digest, partner[more]], np.r_[free, np.zeros(len(more), bool)]
        order = np.lexsort(columns[::-1])
        new = np.any([np.diff(c[order]) != 0 for c in columns], 0)
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(np.r_[False, new][: len(order)])
        everyone = Groups(len(order))
        everyone.join(place[more], place[n:])
        order = np.argsort(place[:n])
        key, digest, pos, free, around = (c[order] for c in (key, digest, pos, free, around))
        names = np.unique(everyone.name[place[:n][order]], return_index=True, return_inverse=True)
        own, plain = Groups(n), _plain(around)
        own.name = names[1][names[2]]
        chosen, unsure, large = [], [], np.zeros(n, bool)

        def check(i: np.ndarray, j: np.ndarray) -> None:
            fit = own.apart(i, j)
            i, j = i[fit], j[fit]
            *_, can, do = judged(around[i], around[j], plain[i] & plain[j])
            sure = np.flatnonzero(do)
            new = sure[own.join(i[sure], j[sure])]
            chosen.append((i[new], j[new]))
            rest = can & ~do & own.apart(i, j)
            unsure.append((i[rest], j[rest]))

        # Pairs with a long run, at the first of its places: rows that have as many equal words there.
        size = KMER + PICK - 1
        words = np.ascontiguousarray(around.T)
        label, gone = key.view(np.uint64).copy(), _power(_ODD, size + 1)[-1]
        for at in range(SIDE + KMER - size, SIDE + KMER):
            label = label * np.uint64(_ODD) + words[at]
        for at in range(SIDE + KMER - size, SIDE + 1):
            some = np.flatnonzero((words[at] > 0) & (words[at + size - 1] > 0))
            for i, j in _alike(label, free, large, own, some):
                new = (words[at - 1, i] != words[at - 1, j]) | (words[at - 1, i] == 0) | (at + size == SIDE + KMER)
                check(i[new], j[new])
            label = label * np.uint64(_ODD) + words[at + size] - words[at] * gone
        edges = np.searchsorted(key, np.unique(key[large]))
        for lo, hi in zip(edges.tolist(), np.searchsorted(key, key[edges], "right").tolist()):
            some = lo + np.flatnonzero(large[lo:hi])
            for pairs in _index_pairs(around[some], free[some]):
                for at in range(0, len(pairs), PAIRS):
                    check(*(some[k] for k in np.divmod(pairs[at : at + PAIRS], len(some))))
        for pairs, fit in ((chosen, None), (unsure, own.apart)):
            i, j = (np.concatenate([np.empty(0, np.int64), *c]) for c in zip(*pairs)) if pairs else [np.empty(0, np.int64)] * 2
            if fit:
                apart = fit(i, j)
                i, j = np.divmod(np.unique(np.minimum(i, j)[apart] * n + np.maximum(i, j)[apart]), max(n, 1))  # of a pair that was met twice one
            for lo in range(0, len(i), PAIRS):
                yield points(i[lo : lo + PAIRS], j[lo : lo + PAIRS])

    held = [(np.empty(0, np.int64),) * 3 + (np.empty(0, bool), np.empty(0, np.int64), np.empty((0, 2 * SIDE + KMER), np.uint16))]
    for batch in batches:
        if not batch.num_rows:
            continue
        around = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
        held.append((*(batch.column(c).to_numpy(zero_copy_only=False) for c in range(5)), around))
        key = held[-1][0]
        if sum(len(h[0]) for h in held) < ROWS or len(held[0][0]) and held[0][0][0] == key[-1]:
            continue  # few rows, or one key, so far
        columns = [np.concatenate(c) for c in zip(*held)]
        last = int(np.searchsorted(columns[0], columns[0][-1]))  # the last key may go on in the next batch
        yield from found(*(c[:last] for c in columns))
        held = [tuple(c[last:] for c in columns)]
    yield from found(*(np.concatenate(c) for c in zip(*held)))


def _known_ranges(known: DataFrame, tag: str) -> DataFrame:
    """digest and the places, (first, last, a text that has it), of the known passages of each text."""
    sides = known.select(F.col("a").alias("digest"), F.col("start_word").alias("first"), F.col("end_word").alias("last"), F.col("b").alias("other")).unionByName(
        known.select(F.col("b").alias("digest"), F.col("other_start").alias("first"), F.col("other_end").alias("last"), F.col("a").alias("other"))
    )
    # The least of the texts with the longest passage: not the negative, which the least number lacks.
    longest = sides.groupBy("digest", "first").agg(F.max(F.struct("last", F.bitwise_not("other").alias("other"))).alias("most"))
    known = F.struct("first", F.col("most.last").alias("last"), F.bitwise_not("most.other").alias("other"))
    return cut(longest.groupBy("digest").agg(F.collect_list(known).alias("known")), tag)


def _listed(hot: DataFrame) -> DataFrame:
    """digest and its seeds, (x, seed), of the texts with any."""
    return hot.groupBy(F.col("a").alias("digest")).agg(F.collect_list(F.struct("x", "seed")).alias("hot"))


def _left_over(hot: DataFrame, listed: DataFrame, known: DataFrame, packed: DataFrame) -> DataFrame:
    """Seeds and second runs (a, b, x, y) of pairs of texts, one of them with a seed that no known passage holds.

    A seed's one occurrence can be in a text that has only part of a passage. So each seed that no passage holds is
    compared, by the words around it, with its occurrences in other texts, and as many pairs taken as join them.
    """
    ranges = _known_ranges(known, "ranges-left-over")
    asked = cut(listed.join(ranges, "digest", "left").select("hot", "known").mapInArrow(_free_seeds, "seed long").distinct(), "free-seeds")
    around = (
        hot.join(asked, "seed")
        .groupBy(F.col("a").alias("digest"))
        .agg(F.collect_list("x").alias("at"))
        .join(ranges, "digest", "left")
        .join(packed, "digest")
        .select("digest", "packed", "at", "known")
        .mapInArrow(_context_rows, "key long, digest long, pos long, free boolean, partner long, around binary")
    )
    n = partitions(hot.sparkSession)
    found = around.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_likely_pairs, "a long, b long, x long, y long")
    return found.distinct()


def _aligned(pairs: DataFrame, packed: DataFrame, tag: str, least: int = 2, parted: bool = False) -> DataFrame:
    """Passages of the chains, of ``least`` seeds at least, of the seeds (a, b, x, y) that pairs of texts share."""
    n = partitions(pairs.sparkSession)
    chains = cut(
        pairs.repartition(n, "a", "b")
        .sortWithinPartitions("a", "b", "x", "y")
        .mapInArrow(functools.partial(_pair_chains, least=least), "a long, b long, x array<long>, y array<long>"),
        f"{tag}-chains",
    )
    first = (
        chains.join(packed.withColumnRenamed("digest", "a"), "a")
        .select("a", "b", "x", "y", "packed")
        .mapInArrow(_take_words, "a long, b long, x array<long>, y array<long>, start long, words binary")
    )
    aligned = (
        first.join(packed.withColumnRenamed("digest", "b"), "b")
        .select("a", "b", "x", "y", "start", "words", "packed")
        .mapInArrow(
            functools.partial(_align_rows, parted=parted),
            "a long, b long, start_word long, end_word long, other_start long, other_end long, words_alike long, similarity double",
        )
    )
    return cut(aligned.dropDuplicates(["a", "b", "start_word", "end_word", "other_start", "other_end"]), tag)


def _equal_passages(hot: DataFrame, listed: DataFrame, known: DataFrame, texts: DataFrame, packed: DataFrame) -> DataFrame:
    """Runs of LEAST_WORDS equal words or more that no known passage of a text holds, as passages.

    A seed's one occurrence can be in a text that has only part of a passage. So the windows of LEAST_WORDS words that
    no passage holds are paired with one occurrence too: that has the whole window. Windows of two texts that follow
    each other in both are one passage. A window that a text repeats, as one word over and over, counts once, where it
    first stands.
    """
    ranges = _known_ranges(known, "ranges")
    hot = hot.select(F.col("a").alias("digest"), "x", "seed")
    asked = cut(
        listed.filter(F.size("hot") > 1)
        .join(ranges, "digest", "left")
        .join(texts.select("digest", "n_words"), "digest")
        .select("hot", "known", "n_words")
        .mapInArrow(_asked_seeds, "seed long")
        .distinct()
        .withColumn("asked", F.lit(True)),
        "asked-seeds",
    )
    places = (
        hot.join(asked, "seed", "left")
        .groupBy("digest")
        .agg(F.collect_list(F.struct("x", F.coalesce("asked", F.lit(False)).alias("asked"))).alias("hot"), F.max("asked").alias("any"))
        .filter("any")
    )
    windows = cut(
        places.join(ranges, "digest", "left")
        .join(packed, "digest")
        .select("digest", "packed", "hot", "known")
        .mapInArrow(_window_rows, "one long, two long, digest long, pos long, asks boolean"),
        "windows",
    )
    end = F.struct("digest", "pos")
    held = (
        windows.groupBy("one", "two")
        .agg(F.max("asks").alias("asked"), F.min(end).alias("low"), F.max(end).alias("high"))
        .filter("asked AND low.digest < high.digest")
        .select("one", "two", "low", "high")
    )
    # Who asks gets the window's lowest text, and that one, if it asks, the highest.
    other = F.when(F.col("digest") == F.col("low.digest"), F.col("high")).otherwise(F.col("low"))
    matches = windows.filter("asks").join(held, ["one", "two"]).withColumn("other", other)
    line = Window.partitionBy("a", "b", "shift").orderBy("x")
    runs = (
        matches.select(F.col("digest").alias("a"), F.col("other.digest").alias("b"), (F.col("pos") - F.col("other.pos")).alias("shift"), F.col("pos").alias("x"))
        .distinct()
        .withColumn("run", F.col("x") - F.row_number().over(line))
        .groupBy("a", "b", "shift", "run")
        .agg(F.min("x").alias("start_word"), (F.max("x") + LEAST_WORDS).alias("end_word"))
    )
    return runs.select(
        "a",
        "b",
        "start_word",
        "end_word",
        (F.col("start_word") - F.col("shift")).alias("other_start"),
        (F.col("end_word") - F.col("shift")).alias("other_end"),
        (F.col("end_word") - F.col("start_word")).alias("words_alike"),
        F.lit(1.0).alias("similarity"),
    )


def _align_rows(batches: Iterable[pa.RecordBatch], parted: bool = False) -> Iterator[pa.RecordBatch]:
    texts, unpack = _Texts(), zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            rows = []
            for r in batch.slice(lo, 256).to_pylist():
                other = texts.get(r["packed"])
                mine = unpack(r["words"]).decode("utf-8", "surrogatepass").split()
                x0, y0 = r["start"], max(0, r["y"][0] - MARGIN)
                theirs = other[y0 : r["y"][-1] + KMER + MARGIN]
                for a0, a1, b0, b1, alike, likeness in align(mine, theirs, [i - x0 for i in r["x"]], [j - y0 for j in r["y"]], parted):
                    rows.append((r["a"], r["b"], a0 + x0, a1 + x0, b0 + y0, b1 + y0, alike, likeness))
            if rows:
                kinds = [pa.int64()] * 7 + [pa.float64()]
                names = ["a", "b", "start_word", "end_word", "other_start", "other_end", "words_alike", "similarity"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def shared_passages(docs: DataFrame) -> DataFrame:
    """Passages of at least LEAST_WORDS words that a document shares, but for few words, with another.

    Returns doc_id, other_id, kind, start_word, end_word, other_start, other_end,
    words_alike, similarity (Jaccard, of shingles of five words). A text that
    occurs several times is represented by its smallest doc_id: the other
    documents with it have one row of kind 'copy' that names it, whatever the
    text's length, and only the representative has rows of kind 'passage'.

    Every seed is paired with one occurrence of it, the same for all documents,
    so a passage in many documents gives a row for each, not for each two. A
    document pair's seeds are chained and the chains aligned on the texts. Where
    that leaves LEAST_WORDS words of a text that another has too in no passage,
    they are one with a text that has them all: of texts that share so many equal
    words each has a passage that holds them, where it first has them. Each seed that no passage holds then
    is compared with its occurrences in other texts until these hang together, so a passage with edits is linked,
    directly or through other texts, whatever texts its seeds were joined to. Two texts that hang together through
    others at a seed have no row of their own.

    Words are lower-cased and split at white space. Null and empty texts share
    no passages, but are copies of each other. Repeated rows are copies, null
    doc_ids too if another document has their text; else they are rows with a
    null id. Passages repeated only within one text are not reported. Other
    columns are not read. No rows in, no rows out.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"), text_or_empty().alias("text"))
    scanned = cut(
        rows.mapInArrow(_scan, "doc long, digest long, digest2 long, n_words long, seeds array<struct<seed: long, pos: long>>"),
        "seeds",
    )
    texts = cut(
        scanned.groupBy("digest", "digest2").agg(
            F.min("doc").alias("doc"), F.count(F.lit(1)).alias("copies"), F.first("n_words").alias("n_words")
        ),
        "texts",
    )
    keys = ["digest", "digest2", "doc"]
    chosen = scanned.select(*keys, "seeds").join(texts.select(*keys), keys, "left_semi").dropDuplicates(keys)
    seeded = cut(chosen.select("digest", F.explode("seeds").alias("s")).select("s.seed", "digest", "s.pos"), "chosen-seeds")
    hubs = cut(
        seeded.groupBy("seed")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("digest", "pos")).alias("hub"))
        .filter("n > 1")
        .select("seed", F.col("hub.digest").alias("b"), F.col("hub.pos").alias("y")),
        "seed-hubs",
    )
    hot = cut(seeded.join(hubs, "seed").select("seed", F.col("digest").alias("a"), "b", F.col("pos").alias("x"), "y"), "hot-seeds")
    listed = cut(_listed(hot), "listed-seeds")
    pairs = hot.filter("a <> b").drop("seed")
    ids = texts.select("digest", "doc")
    # Texts with a seed that others have too are packed and moved once, by document and digest: copies stay out of the join.
    asked = hot.select(F.col("a").alias("digest")).distinct().join(ids, "digest")
    packed = cut(
        rows.mapInArrow(_pack, "doc long, digest long, packed binary")
        .join(asked.hint("merge"), ["doc", "digest"])
        .groupBy("doc", "digest")
        .agg(F.first("packed").alias("packed"))
        .select("digest", "packed"),
        "packed-texts",
    )
    aligned = _aligned(pairs, packed, "passages")
    aligned = aligned.unionByName(cut(_equal_passages(hot, listed, aligned, texts, packed), "equal-passages"))
    span = ["a", "b", "start_word", "end_word", "other_start", "other_end"]
    further = _aligned(_left_over(hot, listed, aligned, packed), packed, "passages-left-over", least=1, parted=True).join(aligned.select(*span), span, "left_anti")
    aligned = aligned.unionByName(further.select(*aligned.columns))
    known = F.nullif(F.col("doc"), F.lit(2**63 - 1))
    passages = (
        aligned.join(ids.select(F.col("digest").alias("a"), known.alias("doc_id")), "a")
        .join(ids.select(F.col("digest").alias("b"), known.alias("other_id")), "b")
        .withColumn("kind", F.lit("passage"))
    )
    several = texts.filter("copies > 1").select("digest", "digest2", F.col("doc").alias("least"), "n_words")
    # Of each text's rows one, with the smallest doc_id, is the representative; the others are its copies.
    copies = (
        scanned.groupBy("digest", "digest2", "doc")
        .agg(F.count(F.lit(1)).alias("m"))
        .join(several, ["digest", "digest2"])
        .withColumn("m", F.col("m") - F.when(F.col("doc") == F.col("least"), 1).otherwise(0))
        .filter("m > 0")
        .select(
            known.alias("doc_id"),
            F.nullif(F.col("least"), F.lit(2**63 - 1)).alias("other_id"),
            F.lit("copy").alias("kind"),
            *[F.lit(0).cast("long").alias(c) for c in ("start_word", "other_start")],
            *[F.col("n_words").alias(c) for c in ("end_word", "other_end", "words_alike")],
            F.lit(1.0).alias("similarity"),
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("_m"),
        )
        .drop("_m")
    )
    columns = ["doc_id", "other_id", "kind", "start_word", "end_word", "other_start", "other_end", "words_alike", "similarity"]
    return passages.select(*columns).unionByName(copies.select(*columns))
