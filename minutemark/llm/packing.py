"""Best-fit packing: exact complements of lengths first, best fit for what is left."""

from __future__ import annotations

import bisect
import json
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ordered_prefix, text_or_empty

#: Words kept with their ids in each Python worker; beyond so many the older half goes.
CACHED_WORDS = 700_000

#: Bytes of text that are split and counted at once; a longer text is taken alone.
SLICE = 6 << 20

#: Where the tokenizer's normal forms and classes are those of Python and Arrow: ranges of code points, both ends in.
_RANGES = ((0x09, 0x0D), (0x20, 0x7E), (0xA1, 0xAC), (0xAE, 0x12F), (0x131, 0x24F), (0x2010, 0x2027), (0x2030, 0x205E), (0x20AC, 0x20AC))


def _other_characters() -> str:
    """A pattern for characters that are not in the ranges, or leave them in lower case."""
    inside = {c for lo, hi in _RANGES for c in range(lo, hi + 1)}
    plain = sorted(c for c in inside if all(ord(x) in inside for x in chr(c).lower()))
    parts, lo = [], plain[0]
    for c, after in zip(plain, [*plain[1:], None]):
        if after != c + 1:
            parts.append(f"\\x{{{lo:x}}}-\\x{{{c:x}}}")
            lo = after
    return f"[^{''.join(parts)}]"


class WordTokenizer:
    """Ids of whole texts by a BPE tokenizer that never merges across white space.

    The words of many texts are split, lower-cased and told apart by Arrow; each
    distinct one is encoded once and its ids gathered for all its places. Texts
    with special tokens or characters outside the plain ranges go through the
    tokenizer as they are, so the ids always equal ``encode``'s.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        split, octets = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"]
        if (split["type"], octets["type"]) != ("Split", "ByteLevel"):
            raise ValueError("this tokenizer doesn't split words by a pattern and map bytes to letters")
        self.parts = regex.compile(split["pattern"]["Regex"]).findall
        # Byte-level BPE writes printable bytes as themselves and the others, in order, as letters from 256 on.
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(printable)]
        self.letters = {b: 256 + i for i, b in enumerate(others)}
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([_other_characters(), *map(re.escape, special)])
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _keep(self, word: str, ids: bytes) -> bytes:
        if len(self.young) >= CACHED_WORDS // 2:
            self.old, self.young = self.young, {}
        self.young[word] = ids
        return ids

    def _part(self, part: str) -> bytes:
        found = self.young.get(part)
        if found is None:
            found = self.old.get(part)
            if found is None:
                letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
                found = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
            self._keep(part, found)
        return found

    def _word(self, word: str) -> bytes:
        """Ids of a word in lower case."""
        if word.isalpha():
            return self._part(word)
        if word[:-1].isalpha() and word[-1] in ".,;:!?":
            return self._part(word[:-1]) + self._part(word[-1])
        found = self.young.get(word) or self.old.get(word)
        return self._keep(word, found or b"".join(map(self._part, self.parts(word))))

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts without nulls, an id 0 after each, and where each text's ids end."""
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        plain = texts if not odd.any() else pc.if_else(pa.array(odd), "", texts)
        lists = pc.utf8_split_whitespace(pc.utf8_lower(plain))
        flat = lists.flatten()
        # Splitting leaves empty words at white space on a text's ends: they have no ids.
        coded = flat.dictionary_encode()
        words = coded.dictionary.to_pylist()
        known = list(map(self.young.get, words))
        known = [self._word(w) if k is None and w else k or b"" for w, k in zip(words, known)]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        table = np.frombuffer(b"".join(known) + b"\0\0\0\0", "<u4")
        starts, sizes = np.r_[np.cumsum(sizes) - sizes, len(table) - 1], np.r_[sizes, 1]
        counts = np.diff(lists.offsets.to_numpy())
        n = len(texts)
        place = np.full(len(flat) + n, len(known), np.int64)  # where no word is, a text ends
        place[np.arange(len(flat)) + np.repeat(np.arange(n), counts)] = coded.indices.to_numpy()
        lengths = sizes[place]
        ends = np.cumsum(lengths)
        ids = table[np.repeat(starts[place] - ends + lengths, lengths) + np.arange(ends[-1] if n else 0)]
        stops = ends[np.cumsum(counts + 1) - 1]
        if odd.any():
            parts = np.split(ids, stops[:-1])
            for i in np.flatnonzero(odd).tolist():
                found = self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids
                parts[i] = np.array([*found, 0], "<u4")
            ids, stops = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        return ids, stops

    def ids(self, text: str) -> bytes:
        """One text's ids as little-endian unsigned 32-bit numbers."""
        return self.ids_of(pa.array([text], pa.string()))[0][:-1].tobytes()


_tokenizers: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about SLICE bytes of text; a longer text is a run of its own."""
    sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
    step = np.cumsum(sizes.astype(np.int64)) // SLICE
    edges = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(edges, edges[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def token_pieces(docs: DataFrame, tokenizer_path: str, length: int = 2048, with_ids: bool = False) -> DataFrame:
    """Tokenize whole texts, end each with id 0 and cut those longer than ``length``.

    Returns doc_id, piece, start, length, ids_crc32 and, if asked for, the ids
    as little-endian unsigned 32-bit numbers. A null or empty text is the id 0
    alone.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(tokenizer_path).ids_of
        for batch in batches:
            for part in _slices(batch):
                ids, stops = encode(part.column(1))
                octets, rows, lo = ids.view(np.uint8).data, [], 0
                for doc, hi in zip(part.column(0).to_pylist(), stops.tolist()):
                    for k, at in enumerate(range(lo, hi, length)):
                        end = min(at + length, hi)
                        cut_ids = octets[4 * at : 4 * end]
                        rows.append((doc, k, at - lo, end - at, zlib.crc32(cut_ids), bytes(cut_ids) if with_ids else None))
                    lo = hi
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                use = len(names) if with_ids else 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in list(zip(columns, kinds))[:use]], names[:use]
                )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, schema)


class SumIndex:
    """Which one, two or three available lengths add up to a gap.

    Counts only fall, so a combination that has run out stays so: for each sum the index keeps the place of its first
    combination, from its longest length down, that still had pieces, and never looks behind it again. All look-ups
    together take at most ``cap ** 2`` steps for pairs and as many for triples.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        lengths = np.flatnonzero(counts)[::-1]
        self.lengths = lengths.tolist()
        self.places: tuple[dict[int, int], dict[int, int]] = ({}, {})

    def find(self, total: int, parts: int) -> list[int] | None:
        if parts == 1:
            return [total] if self.counts[total] > 0 else None
        lengths, places = self.lengths, self.places[parts - 2]
        if total not in places:
            places[total] = bisect.bisect_left(lengths, -(total - parts + 1), key=lambda x: -x)
        for at in range(places[total], len(lengths)):
            longest = lengths[at]
            if longest * parts < total:
                at = len(lengths)
                break
            if self.counts[longest] > 0 and (rest := self.find(total - longest, parts - 1)) and rest[0] <= longest:
                if all(self.counts[x] >= k for x, k in Counter([longest, *rest]).items()):
                    places[total] = at
                    return [longest, *rest]
        places[total] = len(lengths)
        return None


def plan_sequences(histogram: dict[int, int], cap: int) -> list[tuple[dict[int, int], int]]:
    """Sequence patterns (length to how often, number of sequences) that hold all pieces of a length histogram.

    First all gaps beside a length that one other length fills exactly are filled, then those that two fill, then those
    that three do; of each combination as many sequences are made as the counts allow. What finds no exact complement is
    packed best-fit, from the longest: each goes where the least room is left. A gap that takes several short pieces takes
    them from other long ones, so pairs and triples beside a length of over half a sequence take only
    what there is more of short than of long pieces. Where gaps and short pieces match badly they can still cost
    sequences: the plan is made with exact complements of up to 3, 2 and 1 lengths, and the one with the fewest
    sequences is used. The work depends on the number of distinct lengths, at most ``cap``, not on the number of pieces.
    """
    plans = (_plan(histogram, cap, most) for most in (3, 2, 1))
    return min(plans, key=lambda plan: sum(n for _, n in plan))


def _plan(histogram: dict[int, int], cap: int, most: int) -> list[tuple[dict[int, int], int]]:
    counts = np.zeros(cap + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    out: list[tuple[dict[int, int], int]] = []
    if counts[cap]:
        out.append(({cap: 1}, int(counts[cap])))
        counts[cap] = 0
    index, half = SumIndex(counts), cap // 2
    for parts in range(1, most + 1):
        # Large fillers first; a combination of three lengths or more always has a short one to start from.
        for length in index.lengths:
            while length <= half and counts[length] > 0 and (fill := index.find(cap - length, parts)):
                need = Counter([length, *fill])
                n = int(min(counts[x] // k for x, k in need.items()))
                if parts > 1 and fill[0] > half:
                    n = min(n, int(counts[: half + 1].sum() - counts[half + 1 :].sum()) // (parts - 1))
                if n <= 0:
                    break
                for x, k in need.items():
                    counts[x] -= n * k
                out.append((dict(need), n))
    return out + _best_fit(counts, cap)


def _best_fit(left: np.ndarray, cap: int) -> list[tuple[dict[int, int], int]]:
    """Patterns of what is ``left`` of each length, each piece where the least room is."""
    out: list[tuple[dict[int, int], int]] = []
    # bins: room left -> open patterns with that room; rooms is their sorted list.
    bins: dict[int, list[tuple[dict[int, int], int]]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: dict[int, int], n: int) -> None:
        if n and room == 0:
            out.append((pattern, n))
        elif n:
            if room not in bins:
                bins[room] = []
                bisect.insort(rooms, room)
            bins[room].append((pattern, n))

    for length in range(cap - 1, 0, -1):
        todo = int(left[length])
        while todo:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                pattern, n = bins[room].pop()
                if not bins[room]:
                    del bins[room], rooms[at]
                each = min(room // length, todo)
                use = min(n, todo // each)
                put(room, pattern, n - use)
                put(room - each * length, pattern | {length: pattern.get(length, 0) + each}, use)
                todo -= use * each
            else:
                each = min(cap // length, todo)
                use = todo // each
                put(cap - each * length, {length: each}, use)
                todo -= use * each
    for patterns in bins.values():
        out.extend(patterns)
    return out


def pack(pieces: DataFrame, cap: int = 2048) -> DataFrame:
    """Give each of ``token_pieces``' rows its sequence_id and its offset there.

    Only the histogram of lengths, at most ``cap`` rows, goes to the driver; the
    plan that comes back has as many slots as its patterns have distinct
    lengths. Pieces are ranked among those of their length by a global prefix
    count, and the rank says which slot is theirs. Rows with one doc_id are told
    apart by piece and checksum; rows equal in all columns are interchangeable.
    No pieces in, no rows out.
    """
    spark = pieces.sparkSession
    order = ["length", "doc_id", "piece", "ids_crc32", "start"]
    ranked = ordered_prefix(pieces, order, {}, "pieces").drop("_count")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, seen = {}, 0
    for length in sorted(histogram):
        first[length], seen = seen, seen + histogram[length]
    slots, used, next_id = [], Counter(), 0
    for pattern, n in plan_sequences(histogram, cap):
        offset = 0
        for length, each in sorted(pattern.items(), reverse=True):
            lo = first[length] + used[length]
            slots.append((length, lo, lo + n * each, next_id, each, offset))
            used[length] += n * each
            offset += each * length
        next_id += n
    table = spark.createDataFrame(
        slots, "_length long, _lo long, _hi long, _first_sequence long, _each long, _offset long"
    )
    inside = (
        (F.col("length") == F.col("_length")) & (F.col("_index") >= F.col("_lo")) & (F.col("_index") < F.col("_hi"))
    )
    place = F.col("_index") - F.col("_lo")
    return (
        ranked.join(F.broadcast(table), inside)
        .withColumn("sequence_id", F.expr("_first_sequence + (_index - _lo) div _each"))
        .withColumn("offset", F.col("_offset") + place % F.col("_each") * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, cap: int = 2048) -> DataFrame:
    """Tokenize ``docs``, cut them at ``cap`` tokens and pack the pieces into as few sequences as it can.

    A null text is empty. Repeated rows are packed each. Other columns are not read.
    """
    return pack(cut(token_pieces(docs, tokenizer_path, cap), "token-pieces"), cap)
