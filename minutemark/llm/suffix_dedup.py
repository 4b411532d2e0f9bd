"""Removal of long repeated strings: sharded suffix arrays over the parts of texts that can repeat at all."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions, text_or_empty

#: A string of so many bytes that also starts elsewhere is removed.
WINDOW = 400

#: Windows are keyed by the least hash of the strings of so many bytes that they hold.
GRAM = 200

#: What a report of shorter repeats, which stay in place, may ask for: strings of so many bytes, and their windows' keys.
REPORT, REPORT_GRAM = 256, 104

#: Windows that are hashed at once; bounds a very long text's memory.
CHUNK = 1 << 20

#: Bytes in one suffix array; keys with more than a quarter of it are counted by digest.
SHARD = 1 << 20

#: A digest is hot if it has more than one in so many of the windows, so there are fewer hot ones than this.
HOT_SHARE = 1000

#: Bytes that are packed into one number for sorting and comparing, nine bits each.
STEP = 7

_BASE = 0x9E3779B97F4A7C15
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the (odd) base and of its inverse modulo 2^64."""
    n = CHUNK + WINDOW + 1
    steps = np.full(n, _BASE, np.uint64)
    backs = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    steps[0] = backs[0] = 1
    return np.cumprod(steps), np.cumprod(backs)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def window_runs(raw: bytes, width: int | None = None, gram: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one key: (key, hash of the run's bytes, first window, last window, twice).

    A window is known by where it starts. Equal windows have equal keys, so a
    window can repeat only where its key comes in two runs, or where the string
    that gives the key stands twice within its run (``twice``). ``width`` is the
    windows' size (WINDOW by default, not more); the run's bytes always go on to
    WINDOW bytes after its last start, as far as the text does.
    """
    width, gram = width or WINDOW, gram or GRAM
    out = []
    octets = np.frombuffer(raw, np.uint8)
    powers, inverse = _powers()
    for lo in range(0, len(raw) - width + 1, CHUNK):
        part = octets[lo : lo + CHUNK + width - 1].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * powers[: len(part)], out=sums[1:])
        grams = _mixed((sums[gram:] - sums[:-gram]) * inverse[: len(part) - gram + 1])
        keys = _window_minima(grams, width - gram + 1)
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        last = np.r_[first[1:], len(keys)] - 1
        digest = xxhash.xxh3_64_intdigest
        whole = np.fromiter(
            (digest(raw[a : b + WINDOW], b - a) for a, b in zip((first + lo).tolist(), (last + lo).tolist())), np.uint64, len(first)
        )
        twice = np.zeros(len(first), bool)
        ordered = np.sort(grams)
        if (ordered[1:] == ordered[:-1]).any():
            for r, (a, b) in enumerate(zip(first.tolist(), last.tolist())):
                twice[r] = np.count_nonzero(grams[a : b + width - gram + 1] == keys[a]) > 1
        out.append((keys[first].view(np.int64), whole.view(np.int64), first + lo, last + lo, twice))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (*[np.empty(0, np.int64)] * 4, np.empty(0, bool))


def packed_bytes(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position its next STEP bytes as one number that sorts as they do; the end sorts before any byte."""
    at, out = np.arange(len(text)), np.zeros(len(text), np.int64)
    for t in range(STEP):
        inside = at[: len(text) - t] + t < ends[: len(text) - t]
        out[: len(text) - t] |= np.where(inside, text[t:].astype(np.int64) + 1, 0) << (9 * (STEP - 1 - t))
    return out


def suffix_array(text: np.ndarray, ends: np.ndarray, packed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of a text of several strings, each suffix ending with its string.

    ``ends`` has for each position the end of its string. Larsson and Sadakane's
    refinement: suffixes are first sorted by STEP bytes; then, in each round,
    those still in a group of several are sorted by the ranks of what follows
    the depth already sorted, which multiplies it: by three where three ranks
    fit one number, else by two. Groups of one are not touched again. Suffixes
    equal to their ends are in the order of their positions.
    """
    n = len(text)
    at = np.arange(n)
    longest = int((ends - at).max(initial=0))
    key = packed_bytes(text, ends) if packed is None else packed
    order = np.argsort(key)
    ordered, where, depth = key[order], at, STEP
    sa, rank = order, np.empty(n, np.int64)
    thrice = (n + 2) ** 3 < 2**63
    while True:
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else where
        sizes = np.diff(np.r_[starts, len(ordered)])
        rank[sa[where]] = np.repeat(where[starts], sizes)
        where = where[np.repeat(sizes > 1, sizes)]
        if not len(where) or depth >= longest:
            break
        pos = sa[where]
        keys, limit = rank[pos], ends[pos]
        for more in range(1, 3 if thrice else 2):
            after = pos + more * depth
            keys = keys * (n + 1) + np.where(after < limit, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(keys)
        sa[where], ordered = pos[order], keys[order]
        depth *= 3 if thrice else 2
    if len(where):
        pos = sa[where]
        sa[where] = pos[np.argsort(rank[pos] * (n + 1) + pos)]
        rank[sa[where]] = where
    return sa, rank


def _shared_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bytes of two packed numbers are equal."""
    out = np.zeros(len(a), np.int64)
    for t in range(1, STEP + 1):
        out += (a >> (9 * (STEP - t))) == (b >> (9 * (STEP - t)))
    return out


def common_prefixes(packed: np.ndarray, ends: np.ndarray, order: np.ndarray, starts: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Bytes, up to WINDOW, that a window shares with the one before it in ``order``, by its place there.

    ``order`` has the starts of the windows, sorted. Kasai's walk: from a
    window to the next one of its string the shared prefix shrinks by at most
    one byte, if the other string's next position is a window too; else it is
    counted anew. The strings (their ``starts`` and numbers of ``windows``) are
    walked side by side, a numpy step for all, STEP bytes at a time.
    """
    n = len(packed)
    place = np.full(n + 1, -1, np.int64)
    place[order] = np.arange(len(order))
    shared = np.zeros(len(order) + 1, np.int64)
    height = np.zeros(len(starts), np.int64)
    for t in range(int(windows.max(initial=0))):
        use = np.flatnonzero(windows > t)
        i = starts[use] + t
        r = place[i]
        j = order[np.maximum(r, 1) - 1]
        most = np.where(r > 0, np.minimum(WINDOW, np.minimum(ends[i] - i, ends[j] - j)), 0)
        h = np.minimum(height[use], most)
        going = np.flatnonzero(h < most)
        while len(going):
            a, b = packed[i[going] + h[going]], packed[j[going] + h[going]]
            same = a == b
            h[going] = np.minimum(h[going] + np.where(same, STEP, _shared_bytes(a, b)), most[going])
            going = going[same & (h[going] < most[going])]
        height[use] = np.where(place[j + 1] >= 0, np.maximum(h - 1, 0), 0)
        shared[r] = h
    return shared


class Shard:
    """Some strings that share keys, their suffix array, and how much of each window stands elsewhere too.

    A string is its windows and what follows them; ``windows`` says how many
    it has, by default as many as windows of WINDOW bytes fit.
    """

    def __init__(self, strings: list[bytes], owners: list[tuple], windows: list[int] | None = None):
        self.owners = owners
        self.text = np.frombuffer(b"".join(strings), np.uint8)
        lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(lengths) - lengths
        self.windows = lengths - WINDOW + 1 if windows is None else np.array(windows, np.int64)
        self.ends = np.repeat(self.starts + lengths, lengths)
        self.packed = packed_bytes(self.text, self.ends)
        sa, _ = suffix_array(self.text, self.ends, self.packed)
        edges = np.zeros(len(self.text) + 1, np.int64)
        np.add.at(edges, self.starts, 1)
        np.add.at(edges, self.starts + self.windows, -1)
        self.order = sa[np.cumsum(edges[:-1])[sa] > 0]
        shared = common_prefixes(self.packed, self.ends, self.order, self.starts, self.windows)
        self.common = np.zeros(len(self.text), np.int64)
        self.common[self.order] = np.maximum(shared[:-1], np.r_[shared[1:-1], 0])

    def step(self, at: np.ndarray, k: int) -> np.ndarray:
        """The k-th STEP bytes of each window, as numbers that sort as the bytes do."""
        there = at + STEP * k
        return np.where(there < self.ends[at], self.packed[np.minimum(there, len(self.packed) - 1)], 0)

    def _compare(self, mine: np.ndarray, other: Shard, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """-1, 0 or 1 as other's window is less than, equal to or greater than mine, and the bytes they share."""
        out, shared = np.zeros(len(mine), np.int8), np.zeros(len(mine), np.int64)
        open_ = np.arange(len(mine))
        for k in range(-(-WINDOW // STEP)):
            a, b = other.step(at[open_], k), self.step(mine[open_], k)
            out[open_] = np.where(a < b, -1, np.where(a > b, 1, 0))
            shared[open_] += _shared_bytes(a, b)
            open_ = open_[a == b]
            if not len(open_):
                break
        most = np.minimum(WINDOW, np.minimum(self.ends[mine] - mine, other.ends[at] - at))
        return np.where(shared >= WINDOW, 0, out), np.minimum(shared, most)

    def find(self, other: Shard) -> None:
        """Count what my windows share with those of ``other``: binary search of each in its suffix array."""
        mine = self.order[self.common[self.order] < WINDOW]
        low, high = np.zeros(len(mine), np.int64), np.full(len(mine), len(other.order), np.int64)
        while len(going := np.flatnonzero(low < high)):
            middle = (low[going] + high[going]) // 2
            less = self._compare(mine[going], other, other.order[middle])[0] < 0
            low[going[less]] = middle[less] + 1
            high[going[~less]] = middle[~less]
        for beside in (low - 1, low):  # what sorts next to a window shares most with it
            there = np.flatnonzero((beside >= 0) & (beside < len(other.order)))
            shared = self._compare(mine[there], other, other.order[beside[there]])[1]
            self.common[mine[there]] = np.maximum(self.common[mine[there]], shared)

    def spans(self, least: int | None = None) -> Iterator[tuple]:
        """(owner's document, its digest, first and last window) of runs that share ``least`` bytes (WINDOW), for owners that ask."""
        for (doc, digest, first, wanted), start, windows in zip(self.owners, self.starts.tolist(), self.windows.tolist()):
            if wanted:
                again = self.common[start : start + windows] >= (least or WINDOW)
                edge = np.diff(np.r_[0, again.astype(np.int8), 0])
                for a, b in zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist()):
                    yield doc, digest, first + a, first + b - 1


def _raw(text: pa.Scalar) -> bytes:
    return (text.as_py() or "").encode("utf-8", "surrogatepass")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id with a value for null, and the whole text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"), text_or_empty().alias("text"))


def _scan(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """A row for each document: its text's 128-bit digest, size and SHA-256, and its windows' runs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows, runs = [], []
                for text in part.column(1):
                    raw = _raw(text)
                    a, b = np.frombuffer(xxhash.xxh3_128_digest(raw), np.int64).tolist()
                    rows.append((a, b, len(raw), hashlib.sha256(raw).hexdigest()))
                    runs.append(window_runs(raw, width, gram))
                columns = [pa.array(c) for c in zip(*rows)]
                offsets = np.cumsum([0, *(len(r[0]) for r in runs)])
                flat = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*runs)], ["key", "whole", "first", "last", "twice"]
                )
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *columns, lists], ["doc", "digest", "digest2", "n_bytes", "sha", "runs"]
                )

    return _keyed(docs).mapInArrow(
        run,
        "doc long, digest long, digest2 long, n_bytes long, sha string, "
        "runs array<struct<key: long, whole: long, first: long, last: long, twice: boolean>>",
    )


def _packed(docs: DataFrame) -> DataFrame:
    """doc, digest and the compressed text, to be joined with what is known of some documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                raws = [_raw(t) for t in part.column(1)]
                digests = [np.frombuffer(xxhash.xxh3_128_digest(r), np.int64)[0] for r in raws]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.array(digests, np.int64)), pa.array([squeeze(r) for r in raws], pa.binary())],
                    ["doc", "digest", "packed"],
                )

    return _keyed(docs).mapInArrow(run, "doc long, digest long, packed binary")


def _strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the asked-for runs' strings out of the texts, with WINDOW bytes from their last window on, where there are so many."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            rows = []
            for row in batch.slice(lo, 256).to_pylist():
                raw = unpack(row["packed"])
                for ask in row["asked"]:
                    string = raw[ask["first"] : ask["last"] + WINDOW]
                    rows.append((ask["key"], ask["hot"], row["doc"], row["digest"], ask["first"], ask["last"], ask["wanted"], string))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*rows)], ["key", "hot", "doc", "digest", "first", "last", "wanted", "string"]
                )


_SPAN = ["doc", "digest", "first", "last"]


def _shards(batches: Iterable[pa.RecordBatch], report: int | None = None) -> Iterator[pa.RecordBatch]:
    """Sort strings that come in the order of their keys in shards, and report their repeated windows.

    A shard ends once it is full. Those of one key are searched for in each
    other: at most a few, as a key has less than a shard's bytes (others are hot).
    With ``report``, windows that share so many bytes come too, as spans with ``width``.
    """

    def found(shards: list[Shard]) -> Iterator[pa.RecordBatch]:
        for a in shards:
            for b in shards:
                if a is not b:
                    a.find(b)
        for width in dict.fromkeys((WINDOW, report or WINDOW)):
            rows = [r for s in shards for r in s.spans(width)]
            if rows:
                columns, names = [pa.array(c) for c in zip(*rows)], _SPAN
                if report:
                    columns, names = [*columns, pa.array([width] * len(rows), pa.int32())], [*_SPAN, "width"]
                yield pa.RecordBatch.from_arrays(columns, names)

    strings, owners, windows, size, last, open_ = [], [], [], 0, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if size >= SHARD or (open_ and row["key"] != last):
                open_.append(Shard(strings, owners, windows))
                strings, owners, windows, size = [], [], [], 0
                if row["key"] != last:
                    yield from found(open_)
                    open_ = []
            last = row["key"]
            strings.append(row["string"])
            owners.append((row["doc"], row["digest"], row["first"], row["wanted"]))
            # As many windows as the run has; where a string comes without its run, all that fit.
            windows.append(row["last"] - row["first"] + 1 if "last" in row else len(row["string"]) - WINDOW + 1)
            size += len(row["string"])
    if strings:
        open_.append(Shard(strings, owners, windows))
    yield from found(open_)


def window_digests(string: bytes, width: int | None = None) -> np.ndarray:
    """128-bit digests of a string's windows, as rows of two numbers."""
    width, digest = width or WINDOW, xxhash.xxh3_128_digest
    return np.frombuffer(b"".join(digest(string[i : i + width]) for i in range(len(string) - width + 1)), np.int64).reshape(-1, 2)


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digests of the windows of strings, and where these start."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            out = []
            for row in batch.slice(lo, 64).to_pylist():
                digests = window_digests(row["string"], row["width"])
                same = [np.full(len(digests), row[c]) for c in ("doc", "digest", "width", "wanted")]
                out.append((digests[:, 0], digests[:, 1], row["first"] + np.arange(len(digests)), *same))
            columns = [pa.array(np.concatenate(c), k) for c, k in zip(zip(*out), [*[pa.int64()] * 5, pa.int32(), pa.bool_()])]
            yield pa.RecordBatch.from_arrays(columns, ["one", "two", "at", "doc", "digest", "width", "wanted"])


def repeated_in_hot_keys(strings: DataFrame) -> DataFrame:
    """Repeated windows, of ``width`` bytes, of the strings of keys with many bytes: doc, digest, first, last, width.

    Windows are counted by digest, on the map side first, so no key's strings
    have to meet in a task, and the work grows with their bytes only. The
    digests of many windows, fewer than HOT_SHARE, are broadcast and the others
    joined, so the windows of one digest needn't meet either.
    """
    windows = cut(
        strings.mapInArrow(_windows, "one long, two long, at long, doc long, digest long, width int, wanted boolean"), "hot-windows"
    )
    twice = cut(windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated-digests")
    many = F.col("n") * HOT_SHARE > (twice.agg(F.sum("n")).first()[0] or 0)
    keys = ["one", "two"]
    hot, rest = F.broadcast(twice.filter(many).select(*keys)), twice.filter(~many).select(*keys)
    wanted = windows.filter("wanted")
    found = wanted.join(hot, keys, "left_semi").unionByName(wanted.join(hot, keys, "left_anti").join(rest, keys, "left_semi"))
    return found.select("doc", "digest", F.col("at").alias("first"), F.col("at").alias("last"), "width")


def _covered(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal runs that spans, which may overlap or touch, cover."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return merged


def _removals(batches: Iterable[pa.RecordBatch], report: int) -> Iterator[pa.RecordBatch]:
    """From each text and its repeated windows: bytes and runs removed, the rest's SHA-256, bytes reported."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            rows = []
            for row in batch.slice(lo, 256).to_pylist():
                raw = unpack(row["packed"])
                # Of a settled run all windows repeat: those of either size.
                settled = [(s["first"], min(s["last"], len(raw) - w), w) for w in (report, WINDOW) for s in row["settled"] or ()]
                spans = [(s["first"], s["last"], s["width"]) for s in row["spans"] or ()]
                parts = {w: _covered([(a, b + w) for a, b, x in settled + spans if x == w and a <= b]) for w in (report, WINDOW)}
                kept, at = hashlib.sha256(), 0
                for a, b in parts[WINDOW]:
                    kept.update(raw[at:a])
                    at = b
                kept.update(raw[at:])
                gone = sum(b - a for a, b in parts[WINDOW])
                again = sum(b - a for a, b in _covered([tuple(p) for w in parts.values() for p in w]))
                flat = [x for span in parts[WINDOW] for x in span]
                rows.append((row["doc"], row["digest"], gone, len(parts[WINDOW]), kept.hexdigest(), again, flat))
            if rows:
                kinds = [*[pa.int64()] * 4, pa.string(), pa.int64(), pa.list_(pa.int64())]
                names = ["doc", "digest", "n_removed", "n_spans", "kept_sha256", "n_repeated", "spans"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def remove_repeats(docs: DataFrame, report: int | None = None, report_gram: int = REPORT_GRAM) -> DataFrame:
    """What is left of each text without the bytes that a string of WINDOW bytes covers which also starts elsewhere.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (start and
    end of each removed run, in turn). With ``report``, fewer bytes than WINDOW,
    there is also n_repeated: the bytes that strings of so many bytes cover which
    also start elsewhere; shorter repeated passages are told by it and stay.

    Strings are compared in the whole input, across documents and within one, as
    bytes; none crosses documents. A null text is empty; repeated rows are
    documents with equal texts, so that long ones are removed whole; null doc_ids
    are doc_ids like others. No rows in, no rows out. Other columns are not read.

    1. Equal texts are found by digest; one of each stands for all.
    2. All windows of a text are keyed by the least hash of their shorter
       strings. Windows that repeat have a key that comes twice; runs of windows
       whose whole bytes (by digest) come twice are settled by that.
    3. The other runs under such keys go, as strings, to the shards of their
       keys: suffix arrays with common prefixes tell what repeats. All equal
       windows share a key, so no shard needs another's strings. The windows of a
       key with more than a quarter of a shard's bytes are counted by digest.
    4. The settled and found windows are put together with the texts again.

    Counts by key are summed on the map side, so a passage that many texts share is
    one row for each task there. Texts are packed and moved once, those with
    nothing that can repeat go no further.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    width = report or WINDOW
    if not 0 < width <= WINDOW:
        raise ValueError("reported strings are no longer than removed ones")
    scanned = cut(_scan(docs, width, report_gram if report else GRAM), "window-runs")
    by_text = cut(
        scanned.groupBy("digest", "digest2").agg(F.count(F.lit(1)).alias("copies"), F.min("doc").alias("doc")), "texts"
    )
    single = by_text.filter("copies = 1").select("digest", "digest2", "doc", F.lit(True).alias("single"))
    several = by_text.filter("copies > 1").select("digest", "digest2", "doc", F.lit(False).alias("single"))
    # One row of each text; rows that repeat doc and text come in `several`, where counting them twice changes nothing.
    chosen = scanned.select("doc", "digest", "digest2", "runs").join(
        single.unionByName(several), ["doc", "digest", "digest2"]
    )
    runs = cut(
        chosen.select("doc", "digest", "single", F.explode("runs").alias("r")).select("doc", "digest", "single", "r.*"), "runs"
    )
    by_run = cut(
        runs.groupBy("key", "whole").agg(
            F.count(F.lit(1)).alias("n"), F.max("twice").alias("twice"), F.min(F.struct("doc", "digest", "first", "last", "single")).alias("one")
        ),
        "distinct-runs",
    )
    by_key = by_run.groupBy("key").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.max("twice").alias("any_twice"),
        (F.sum(F.col("one.last") - F.col("one.first") + WINDOW) * 4 > SHARD).alias("hot"),
    )
    live = cut(by_run.join(by_key.filter("total > 1 OR any_twice"), "key"), "live-runs")
    settled = (
        runs.filter("single").join(live.filter("n > 1").select("key", "whole"), ["key", "whole"])
        .select("doc", "digest", F.struct("first", "last").alias("settled"), F.lit(None).alias("asked"))
    )
    wanted = ((F.col("n") == 1) & F.col("one.single")).alias("wanted")
    asked = live.filter("kinds > 1 OR any_twice").select(
        "one.doc", "one.digest", F.lit(None).alias("settled"), F.struct("key", "hot", "one.first", "one.last", wanted).alias("asked")
    )
    touched = settled.unionByName(asked).groupBy("doc", "digest").agg(
        F.collect_list("settled").alias("settled"), F.collect_list("asked").alias("asked")
    )
    texts = cut(_packed(docs).join(touched.hint("merge"), ["doc", "digest"]), "touched-texts")
    strings = cut(
        texts.filter(F.size("asked") > 0).select("doc", "digest", "packed", "asked").mapInArrow(
            _strings, "key long, hot boolean, doc long, digest long, first long, last long, wanted boolean, string binary"
        ),
        "strings",
    )
    # A hot key's windows of either size: a string without its last bytes has those of the smaller.
    sizes = F.array(*[F.lit(w) for w in dict.fromkeys((WINDOW, width))])
    hot = strings.filter("hot").withColumn("width", F.explode(sizes)).withColumn(
        "string", F.expr("substring(string, 1, cast(last - first + width as int))")
    )
    found = (
        strings.filter("NOT hot").drop("hot").repartition(n, "key")
        .sortWithinPartitions("key")
        .mapInArrow(lambda batches: _shards(batches, width), "doc long, digest long, first long, last long, width int")
        .unionByName(repeated_in_hot_keys(hot.select("doc", "digest", "first", "wanted", "string", "width")))
    )
    spans = (
        cut(found, "repeated-windows")
        .groupBy("doc", "digest")
        .agg(F.collect_list(F.struct("first", "last", "width")).alias("spans"))
    )
    partly = cut(
        texts.select("doc", "digest", "packed", "settled").join(spans, ["doc", "digest"], "left")
        .filter((F.size("settled") > 0) | F.col("spans").isNotNull())
        .select("doc", "digest", "packed", "settled", "spans")
        .mapInArrow(
            lambda batches: _removals(batches, width),
            "doc long, digest long, n_removed long, n_spans long, kept_sha256 string, n_repeated long, spans array<long>",
        ),
        "removals",
    )
    copied = several.select("digest", "digest2", F.lit(True).alias("copied"))
    whole = F.col("copied") & (F.col("n_bytes") >= WINDOW)
    rows = scanned.drop("runs").join(copied, ["digest", "digest2"], "left").join(partly, ["doc", "digest"], "left")
    none = F.lit(0).cast("long")
    again = F.when(F.col("copied") & (F.col("n_bytes") >= width), F.col("n_bytes")).otherwise(F.coalesce("n_repeated", none))
    return rows.select(
        F.nullif(F.col("doc"), F.lit(-(2**63))).alias("doc_id"),
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
        F.when(whole, F.lit(_EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        *([again.alias("n_repeated")] if report else []),
        F.when(whole, F.array(none, F.col("n_bytes"))).otherwise(F.coalesce("spans", F.expr("cast(array() as array<bigint>)"))).alias("spans"),
    )
