"""Language-model scores: prediction by partial matching over bytes, next to a smoothed count of words.

The model is a trie of byte contexts, read backwards from the byte to be told: what followed each context of up to
ORDER bytes, and how often, in the training texts. A byte unknown in a context escapes to the context that is one
byte shorter, with the probability of method C, where the bytes that were known before no longer count.

All training texts make one trie, so it grows with them and is never gathered: it is dealt out by its contexts of three bytes. Texts are kept in
batches; a batch asks once for each of its different strings and words, the parts of the trie answer, and the batch
adds up the answers by document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions, shared_dir, text_or_empty

#: Bytes of context. A string is its context, nearest byte first, and the byte that follows, nine bits each.
ORDER = 5
BITS = 9
START, END = 0, 257
SYMBOLS = 257

#: The trie is dealt out by contexts of so many bytes, each with at most 258^3 strings below it.
ROOT = 3

#: Bytes and documents that are sorted at once, and bytes of a batch, which asks the model once.
CHUNK, CHUNK_DOCS, BATCH = 1 << 20, 1023, 1 << 25

#: Strings and words that wait for being added up; as many as there are sums, if those are more.
PENDING = 1 << 20

#: The end of a text among the words; no word has a line end.
END_WORD = b"\n"

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_CUT = re.compile(rb"[\x20\x09-\x0D]")

_ASKED = "grams binary, gram_n binary, words array<binary>, word_n array<long>"


def _field(keys: np.ndarray, order: int) -> np.ndarray:
    """The contexts of so many bytes of the strings ``keys``."""
    return keys >> np.uint64(BITS * (ORDER + 1 - order))


def _strings(raws: list[bytes], context: bytes, last: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte (and end) with what stands before it, and the text it is from: sorted (string << 10 | text).

    ``context`` stands before the first text, if that is the rest of one; ``last`` tells which texts end here.
    """
    lengths = np.array([len(r) for r in raws], np.int64)
    ends = np.array(last, np.int64)
    width = lengths + ORDER + ends
    offset = np.cumsum(width) - width
    codes = np.zeros(int(width.sum()), np.uint64)
    octets = np.frombuffer(b"".join(raws), np.uint8)
    at = np.arange(len(octets)) + np.repeat(offset + ORDER - (np.cumsum(lengths) - lengths), lengths)
    codes[at] = octets
    codes[at] += np.uint64(1)
    done = np.flatnonzero(ends)
    codes[(offset + width - 1)[done]] = END
    if context:
        codes[ORDER - len(context) : ORDER] = np.frombuffer(context, np.uint8).astype(np.uint64) + np.uint64(1)
    at = np.concatenate([at, (offset + width - 1)[done]])
    text = np.concatenate([np.repeat(np.arange(len(raws)), lengths), done]).astype(np.uint64)
    keys = codes[at - 1]
    for back in range(2, ORDER + 1):
        keys = (keys << np.uint64(BITS)) | codes[at - back]
    keys = (keys << np.uint64(BITS)) | codes[at]
    both = (keys << np.uint64(10)) | text
    both.sort()
    return both >> np.uint64(10), (both & np.uint64(1023)).astype(np.int64)


def _words(raws: list[bytes], last: list[bool]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of some texts, and for each word in turn (ends included) which it is and in which text."""
    octets = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    inside = ~_SEPARATOR[octets]
    edge = np.flatnonzero(np.diff(np.r_[False, inside]))  # starts and stops by turns
    starts, stops = edge[::2], edge[1::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(stops - starts, out=offsets[1:])
    bound = np.cumsum([len(r) + 1 for r in raws])
    text = np.searchsorted(bound, starts, "right")
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(octets[inside])])
    done = np.flatnonzero(np.array(last, bool))
    words = pa.concat_arrays([words, pa.array([END_WORD] * len(done), pa.large_binary())]).dictionary_encode()
    which, text = words.indices.to_numpy(), np.concatenate([text, done])
    order = np.argsort(text, kind="stable")  # a text's end comes after its words
    return words.dictionary, which[order], text[order]


def _packed(values: np.ndarray) -> bytes:
    """Numbers as bytes; whole ones by their differences, of which sorted strings have short ones."""
    if values.dtype.kind != "f":
        values = np.diff(values.view(np.int64), prepend=0)
    octets = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T  # like bytes together
    return zstandard.ZstdCompressor(level=1).compress(octets.tobytes())


def _unpacked(blob: bytes, kind: type) -> np.ndarray:
    octets = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    values = np.ascontiguousarray(octets.T).reshape(-1).view(np.float64 if kind is np.float64 else np.int64)
    return values if kind is np.float64 else np.cumsum(values).view(kind)


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sum of each one's n."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(n, first)


class Counter:
    """Sums by string and by word; what waits is added up whenever there is as much of it as of sums."""

    def __init__(self) -> None:
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        self.words: list[pa.Table] = []
        self.waiting = self.size = 0

    def add(self, grams: np.ndarray, n: np.ndarray, words: pa.Array, word_n: np.ndarray) -> None:
        self.grams.append((grams, n))
        self.words.append(pa.table({"w": words.cast(pa.large_binary()), "n": pa.array(word_n, pa.int64())}))
        self.waiting += len(grams) + len(words)
        if self.waiting > max(PENDING, self.size):
            self.sums()

    def sums(self) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        grams, n = _added(*(np.concatenate(c) for c in zip(*self.grams)))
        table = pa.concat_tables(self.words).group_by("w").aggregate([("n", "sum")])
        self.grams, self.words, self.waiting = [(grams, n)], [table.rename_columns({"n_sum": "n"}).select(["w", "n"])], 0
        self.size = len(grams) + len(table)
        words = table["w"].combine_chunks()
        return grams, n, words.chunk(0) if isinstance(words, pa.ChunkedArray) else words, table["n_sum"].to_numpy()


def _pieces(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[list, bytes]]:
    """Chunks of ``most`` bytes of texts [(doc_id, held out, text, last)] and what stands before them; a longer text is cut where a word ends."""
    chunk, size = [], 0
    for batch in batches:
        held = batch.column(1).to_pylist()
        for k, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2))):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass").translate(_LOWER)
            if chunk and (size + len(raw) > most or len(chunk) == CHUNK_DOCS):
                yield chunk, b""
                chunk, size = [], 0
            at = 0
            while len(raw) - at > most and (stop := _CUT.search(raw, at + most)):
                yield [(doc, held[k], raw[at : stop.start()], False)], raw[max(0, at - ORDER) : at]
                at = stop.start()
            if at:
                yield [(doc, held[k], raw[at:], True)], raw[at - ORDER : at]
            else:
                chunk.append((doc, held[k], raw, True))
                size += len(raw)
    if chunk:
        yield chunk, b""


def _parts(keys: np.ndarray, n: int) -> np.ndarray:
    """The part of the trie that each context of ROOT bytes belongs to."""
    x = _field(keys, ROOT) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(7)) % np.uint64(n)


def _lists(values: pa.Array, part: np.ndarray, n: int) -> tuple[np.ndarray, pa.Array]:
    """The order by part, and the values of each part as a list."""
    order = np.argsort(part, kind="stable")
    offsets = np.searchsorted(part[order], np.arange(n + 1))
    return order, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values.take(pa.array(order)))


def _requests(batch: int, counter: Counter, n: int) -> pa.RecordBatch:
    grams, gram_n, words, word_n = counter.sums()
    by = _parts(grams, n).astype(np.int64)
    by_word = np.fromiter((zlib.crc32(w) % n for w in words.to_pylist()), np.int64, len(words))
    order = np.argsort(by, kind="stable")
    cuts = np.searchsorted(by[order], np.arange(1, n))
    packed = [pa.array([_packed(x) for x in np.split(values[order], cuts)], pa.binary()) for values in (grams, gram_n)]
    word_order, word_lists = _lists(words.cast(pa.binary()), by_word, n)
    none = lambda kind: pa.nulls(n, kind)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(["asked"] * n), pa.array([batch] * n, pa.int64()), pa.array(range(n), pa.int32()),
            *packed, word_lists, pa.ListArray.from_arrays(word_lists.offsets, pa.array(word_n[word_order])),
            none(pa.list_(pa.int64())), none(pa.list_(pa.bool_())), none(pa.list_(pa.bool_())), none(pa.list_(pa.int32())), none(pa.binary()), none(pa.binary()),
        ],
        _STORED_NAMES,
    )


_STORED = f"kind string, batch long, part int, {_ASKED}, docs array<long>, held array<boolean>, last array<boolean>, lengths array<int>, context binary, texts binary"
_STORED_NAMES = ["kind", "batch", "part", "grams", "gram_n", "words", "word_n", "docs", "held", "last", "lengths", "context", "texts"]


def _stored(docs: DataFrame, n: int, chunk: int, size_of_batch: int) -> DataFrame:
    """Batches of texts, chunk by chunk, and what each batch asks for of each part of the model, in one table by kind."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        squeeze = zstandard.ZstdCompressor(level=1).compress
        number, counter, size = TaskContext.get().partitionId() << 32, Counter(), 0
        for seq, (texts, context) in enumerate(_pieces(batches, chunk)):
            ids, held, raws, last = map(list, zip(*texts))
            teaches = ~np.array(held, bool)
            grams, text = _strings(raws, context, last)
            if len(grams):
                first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
                grams, n_grams = grams[first], np.add.reduceat(teaches[text].astype(np.int64), first)
            else:
                n_grams = np.zeros(0, np.int64)
            words, which, text = _words(raws, last)
            counter.add(grams, n_grams, words, np.bincount(which[teaches[text]], minlength=len(words)).astype(np.int64))
            one = lambda value, kind: pa.array([value], kind)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(["text"]), one(number, pa.int64()), one(seq, pa.int32()),
                    *[pa.nulls(1, k) for k in (pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()))],
                    one(ids, pa.list_(pa.int64())), one(held, pa.list_(pa.bool_())), one(last, pa.list_(pa.bool_())),
                    one([len(r) for r in raws], pa.list_(pa.int32())), one(context, pa.binary()), one(squeeze(b"".join(raws)), pa.binary()),
                ],
                _STORED_NAMES,
            )
            size += sum(map(len, raws))
            if size >= size_of_batch and last[-1]:
                yield _requests(number, counter, n)
                number, counter, size = number + 1, Counter(), 0
        if counter.grams:
            yield _requests(number, counter, n)

    # A null doc_id counts as the empty text, whose CRC is 0.
    held = F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    path = shared_dir(docs.sparkSession, "ppm-batches")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), text_or_empty().alias("text"))
    rows.mapInArrow(run, _STORED).write.partitionBy("kind").parquet(path)
    return docs.sparkSession.read.schema(_STORED).option("basePath", path).parquet(path)


def _rows(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows as values of the named columns: plain ones as they are, lists as flat arrays."""
    for batch in batches:
        columns = [batch.column(n) for n in names]
        lists = [pa.types.is_list(c.type) for c in columns]
        for i in range(batch.num_rows):
            yield tuple(c.slice(i, 1).flatten() if many else c[i].as_py() for c, many in zip(columns, lists))


def _trie(asked: DataFrame) -> DataFrame:
    """The parts of the trie: each string and word once, with its count in training texts (0: only asked for)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(part: int, counter: Counter) -> pa.RecordBatch:
            grams, n, words, word_n = counter.sums()
            lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (words.cast(pa.binary()), pa.array(word_n))]
            told = pa.array([int(word_n.sum())], pa.int64()), pa.array([int(np.count_nonzero(word_n))], pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([_packed(grams)]), pa.array([_packed(n)]), *lists, *told],
                ["part", "grams", "gram_n", "words", "word_n", "tokens", "vocabulary"],
            )

        open_, counter = None, Counter()
        for part, grams, n, words, word_n in _rows(batches, "part", "grams", "gram_n", "words", "word_n"):
            if part != open_ and open_ is not None:
                yield out(open_, counter)
                counter = Counter()
            open_ = part
            counter.add(_unpacked(grams, np.uint64), _unpacked(n, np.int64), words, word_n.to_numpy(zero_copy_only=False))
        if open_ is not None:
            yield out(open_, counter)

    dealt = asked.select("part", "grams", "gram_n", "words", "word_n").repartition(partitions(asked.sparkSession), "part").sortWithinPartitions("part")
    return cut(dealt.mapInArrow(run, f"part int, {_ASKED}, tokens long, vocabulary long"), "ppm-trie")


def _short_contexts(trie: DataFrame) -> DataFrame:
    """What followed the contexts of ROOT - 1 bytes, by part that knows them: part, context, symbol, n (0: never in training)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, grams, n in _rows(batches, "part", "grams", "gram_n"):
            keys = _unpacked(grams, np.uint64)
            both, n = _added((_field(keys, ROOT - 1) << np.uint64(BITS)) | (keys & np.uint64(511)), _unpacked(n, np.int64))
            both = both.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(both), pa.int32()), pa.array(both >> BITS), pa.array(both & 511), pa.array(n)], ["part", "context", "symbol", "n"])

    return cut(trie.select("part", "grams", "gram_n").mapInArrow(run, "part int, context long, symbol long, n long"), "ppm-short")


class Level:
    """What followed the contexts of one length: sorted (context, symbol) with counts, and by context sum and number of symbols."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """``keys`` are contexts and symbols in order, each once."""
        known = counts > 0
        self.keys, self.counts = keys[known], counts[known].astype(np.float64)
        contexts = self.keys >> np.uint64(BITS)
        first = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]]) if len(contexts) else np.zeros(0, np.int64)
        self.contexts = contexts[first]
        self.group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(contexts)]))
        self.n = np.bincount(self.group, self.counts, len(first))
        self.d = np.bincount(self.group, minlength=len(first)).astype(np.float64)

    @staticmethod
    def _find(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(sorted_):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
        return at, sorted_[at] == wanted

    def count(self, wanted: np.ndarray) -> np.ndarray:
        at, there = self._find(self.keys, wanted)
        return np.where(there, self.counts[at], 0.0) if len(self.keys) else np.zeros(len(wanted))

    def of(self, contexts: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Each context's value, 0 where it is unknown."""
        at, there = self._find(self.contexts, contexts)
        return np.where(there, values[at], 0.0) if len(values) else np.zeros(len(contexts))

    def excluded(self, shorter: Level) -> np.ndarray:
        """By context, the counts that its symbols have in the context that is one byte shorter."""
        short = (self.keys >> np.uint64(2 * BITS) << np.uint64(BITS)) | (self.keys & np.uint64(511))
        return np.bincount(self.group, shorter.count(short), len(self.contexts))


def log_probabilities(keys: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 of each string's last symbol after its context; ``levels`` by number of bytes of context, all that is needed of each.

    From the longest context down, a known symbol takes its count, an unknown one the number of known symbols, out of
    both together; the symbols of a longer context are left out of a shorter one. Last, all symbols left are alike.
    """
    symbol = keys & np.uint64(511)
    out, open_ = np.zeros(len(keys)), np.ones(len(keys), bool)
    for order in range(len(levels) - 1, -1, -1):
        level, context = levels[order], _field(keys, order)
        n, d = level.of(context, level.n), level.of(context, level.d)
        if order + 1 < len(levels):
            longer, wider = levels[order + 1], _field(keys, order + 1)
            n -= longer.of(wider, longer.excluded(level))
            d -= longer.of(wider, longer.d)
        count = level.count((context << np.uint64(BITS)) | symbol)
        total = n + d
        hit = open_ & (count > 0)
        out[hit] += np.log10(count[hit] / total[hit])
        miss = open_ & (count == 0) & (n > 0)
        out[miss] += np.log10(d[miss] / total[miss])
        open_ &= ~hit
    unknown = SYMBOLS - (levels[0].d[0] if len(levels[0].d) else 0)
    out[open_] -= np.log10(unknown) if unknown else 0.0
    return out


def _levels(keys: np.ndarray, counts: np.ndarray, short: list[tuple[np.ndarray, np.ndarray]], first: list[Level]) -> list[Level]:
    """All levels that the strings of a part need: the longest from themselves, the others as given."""
    middle = Level(*_added(*(np.concatenate(c) for c in zip(*short)))) if short else Level(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    long = [Level(*_added((_field(keys, k) << np.uint64(BITS)) | (keys & np.uint64(511)), counts)) for k in range(ROOT, ORDER + 1)]
    return [*first, middle, *long]


def _answers(trie: DataFrame, asked: DataFrame, short: DataFrame) -> DataFrame:
    """batch, grams, chances (log10), words and their counts: what the parts of the model say to each batch."""
    ones = short.groupBy((F.shiftright("context", BITS)).alias("c"), "symbol").agg(F.sum("n").alias("n")).filter("n > 0")
    # At most 258 contexts of one byte by 257 symbols, whatever the input.
    rows = np.array([tuple(r) for r in ones.collect()], np.int64).reshape(-1, 3)
    first = [Level(*_added((np.uint64(0) if k == 0 else rows[:, 0].astype(np.uint64) << np.uint64(BITS)) | rows[:, 1].astype(np.uint64), rows[:, 2])) for k in range(2)]
    followed = short.groupBy("context", "symbol").agg(F.sum("n").alias("n")).filter("n > 0").groupBy("context")
    followed = followed.agg(F.collect_list(F.struct("symbol", "n")).alias("f"))  # at most 257 symbols
    known = short.select("part", "context").distinct().join(followed, "context")
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    rows_of = [
        known.select("part", F.lit(0).alias("kind"), F.col("context").alias("id"), none("grams", "binary"), none("gram_n", "binary"), F.col("f.symbol").alias("symbols"), F.col("f.n").alias("n"), none("words", "array<binary>"), none("word_n", "array<long>")),
        trie.select("part", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("id"), "grams", "gram_n", none("symbols", "array<long>"), none("n", "array<long>"), "words", "word_n"),
        asked.select("part", F.lit(2).alias("kind"), F.col("batch").alias("id"), "grams", none("gram_n", "binary"), none("symbols", "array<long>"), none("n", "array<long>"), "words", none("word_n", "array<long>")),
    ]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, below, keys, chances, words, counts = None, [], None, None, None, None
        for part, kind, id_, grams, n, symbols, symbol_n, some, some_n in _rows(batches, "part", "kind", "id", "grams", "gram_n", "symbols", "n", "words", "word_n"):
            if part != open_:
                open_, below = part, []
            if kind == 0:
                below.append(((np.uint64(id_) << np.uint64(BITS)) | symbols.to_numpy().view(np.uint64), symbol_n.to_numpy()))
            elif kind == 1:
                keys, words, counts = _unpacked(grams, np.uint64), some, some_n
                chances = log_probabilities(keys, _levels(keys, _unpacked(n, np.int64), below, first))
            else:
                told = _packed(chances[np.searchsorted(keys, _unpacked(grams, np.uint64))])
                found = counts.take(pc.index_in(some, value_set=words))
                lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (some, found)]
                yield pa.RecordBatch.from_arrays([pa.array([id_], pa.int64()), pa.array([grams]), pa.array([told]), *lists], ["batch", "grams", "chances", "words", "word_n"])

    dealt = rows_of[0].unionByName(rows_of[1]).unionByName(rows_of[2])
    dealt = dealt.repartition(partitions(trie.sparkSession), "part").sortWithinPartitions("part", "kind", "id")
    return dealt.mapInArrow(run, "batch long, grams binary, chances binary, words array<binary>, word_n array<long>")


def score(docs: DataFrame, chunk: int = CHUNK, batch: int = BATCH) -> DataFrame:
    """Score all whole texts by a model of those whose crc32(doc_id as text) leaves another remainder by 7 than 2.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (words and an end, add-one smoothed by
    the number of different ones) and score (bytes and an end), both log10. A to Z count as a to z. A null text is empty, a null
    doc_id has the empty text's remainder and so is learned from, each repeated row counts and is scored. Without any training text all symbols are alike.
    An empty table gives an empty result; other columns play no part. ``chunk`` bytes are worked on at once, and about
    ``batch`` bytes ask the model at once; a word without end may be longer.
    """
    n = 4 * partitions(docs.sparkSession)
    stored = _stored(docs, n, chunk, batch)
    asked = stored.filter("kind = 'asked'")
    trie = _trie(asked)
    sums = trie.agg(F.sum("tokens"), F.sum("vocabulary")).first()
    tokens, vocabulary = (x or 0 for x in sums)
    answers = _answers(trie, asked, _short_contexts(trie))
    base = tokens + vocabulary + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        open_, told, ready, sums = None, [], None, np.zeros(4)
        names = ["batch", "kind", "grams", "chances", "words", "word_n", "docs", "held", "last", "lengths", "context", "texts"]
        for batch, kind, grams, chances, words, word_n, ids, held, last, lengths, context, texts in _rows(batches, *names):
            if batch != open_:
                open_, told, ready = batch, [], None
            if kind == 0:
                told.append((grams, chances, words, word_n))
                continue
            if ready is None:
                keys = np.concatenate([_unpacked(t[0], np.uint64) for t in told])
                order = np.argsort(keys)
                ready = keys[order], np.concatenate([_unpacked(t[1], np.float64) for t in told])[order], pa.concat_arrays([t[2] for t in told]), np.concatenate([t[3].to_numpy(zero_copy_only=False) for t in told])
                told = []
            blob, at, raws, last = expand(texts), 0, [], last.to_pylist()
            for length in lengths.to_pylist():
                raws.append(blob[at : at + length])
                at += length
            strings, text = _strings(raws, context, last)
            first = np.flatnonzero(np.r_[True, strings[1:] != strings[:-1]]) if len(strings) else np.zeros(0, np.int64)
            chance = np.repeat(ready[1][np.searchsorted(ready[0], strings[first])], np.diff(np.r_[first, len(strings)]))
            scores = np.bincount(text, chance, len(raws))
            known, which, text = _words(raws, last)
            c = np.zeros(len(known), np.int64)
            place = pc.fill_null(pc.index_in(ready[2], value_set=known.cast(pa.binary())), -1).to_numpy()
            c[place[place >= 0]] = ready[3][place >= 0]  # each word of the texts was asked for
            c = c[which]
            rows = np.stack([np.bincount(text, minlength=len(raws)), np.bincount(text, c > 0, len(raws)), np.bincount(text, np.log10((c + 1) / base), len(raws)), scores], 1)
            rows[0] += sums
            done = np.flatnonzero(last)
            sums = np.zeros(4) if last[-1] else rows[-1]
            rows = rows[done]
            take = pa.array(done)
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), held.take(take), pa.array(rows[:, 0].astype(np.int64)), pa.array(rows[:, 1].astype(np.int64)), pa.array(np.full(len(done), tokens)), pa.array(rows[:, 2]), pa.array(rows[:, 3])],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    both = stored.filter("kind = 'text'").select(
        "batch", F.lit(1).alias("kind"), F.col("part").alias("seq"),
        *[F.lit(None).cast(k).alias(c) for c, k in (("grams", "binary"), ("chances", "binary"), ("words", "array<binary>"), ("word_n", "array<long>"))],
        "docs", "held", "last", "lengths", "context", "texts",
    )
    told = answers.select(
        "batch", F.lit(0).alias("kind"), F.lit(0).alias("seq"), "grams", "chances", "words", "word_n",
        *[F.lit(None).cast(both.schema[c].dataType).alias(c) for c in ("docs", "held", "last", "lengths", "context", "texts")],
    )
    dealt = told.unionByName(both).repartition(n, "batch").sortWithinPartitions("batch", "kind", "seq")
    return dealt.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
