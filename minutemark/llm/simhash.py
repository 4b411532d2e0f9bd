"""SimHash near-dedup: Golay-code fuzzy hashing finds all fingerprints within three bits."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions, text_or_empty
from .components import components

#: Shingles that are hashed and counted at once; bounds a very long text's memory.
CHUNK = 200_000

#: Members of one key that are compared all against all; larger groups are first split by 16-bit blocks.
DIRECT = 20_000

#: First bit and length of the fingerprint's three segments; each is padded to the code's 23 bits with zeros.
SEGMENTS = ((0, 22), (22, 21), (43, 21))

#: Generator polynomial of the binary Golay code [23, 12, 7].
GENERATOR = 0xAE3

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the text's shingles, as an unsigned number; 0 for a text without words."""
    from xxhash import xxh64_intdigest

    parts = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()  # bytes split at space and 09 to 0D only
    if not parts:
        return 0
    size = min(words, len(parts))
    n = len(parts) - size + 1
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, CHUNK):
        some = parts[lo : lo + CHUNK + size - 1]
        joined = b" ".join(some)
        ends = np.cumsum([len(p) + 1 for p in some])
        starts = (ends - [len(p) + 1 for p in some])[: len(some) - size + 1].tolist()
        stops = (ends - 1)[size - 1 :].tolist()
        hashes = np.fromiter(
            (xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts, stops)), np.uint64, len(starts)
        )
        octets = hashes.view(np.uint8).reshape(-1, 8)
        if len(hashes) < 2000:
            ones += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
        else:
            for k in range(8):
                ones[8 * k : 8 * k + 8] += np.bincount(octets[:, k], minlength=256) @ _BITS
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint's bits as a long, of each row's whole text (null: empty)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, fp long")


@lru_cache(1)
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the 12 high bits, and for each syndrome its error patterns of weight 4 or less.

    The code is perfect: each syndrome has one pattern of weight 3 or less. Where
    that has weight 3, five patterns of weight 4 have the same syndrome. The
    first column is the decoder's pattern, -1 fills the rest.
    """
    remainder = np.arange(4096, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        remainder ^= np.where(remainder >> bit & 1, GENERATOR << (bit - 11), 0)
    patterns = np.full((2048, 6), -1, np.int64)
    filled = np.zeros(2048, np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            error = sum(1 << b for b in bits)
            syndrome = int(remainder[error >> 11]) ^ error & 0x7FF
            patterns[syndrome, filled[syndrome]] = error
            filled[syndrome] += 1
    return remainder, patterns


def codeword_keys(segment: np.ndarray) -> np.ndarray:
    """Indices of the codewords within distance 4 of 23-bit words: 6 columns, the nearest first, -1 for none."""
    remainder, patterns = _golay()
    found = patterns[remainder[segment >> 11] ^ (segment & 0x7FF)]
    return np.where(found < 0, -1, (segment[:, None] ^ np.maximum(found, 0)) >> 11)


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints, such that any two within 3 bits share one; returns (key, position of its fingerprint).

    Words one bit apart share a codeword: the one nearest to either is within 4
    of the other. Three errors over three segments leave one of two cases.
    Either some segment i is equal and another, j, has at most one error: the
    keys are segment i with each near codeword of j. Or each has exactly one:
    then the keys are codewords of all three, where one side lists the near
    codewords of the first two segments and the other side those of the third.
    """
    segments = [(prints >> np.uint64(at)).astype(np.int64) & ((1 << n) - 1) for at, n in SEGMENTS]
    near = [codeword_keys(s) for s in segments]
    keys, ids = [], []

    def add(columns: np.ndarray, valid: np.ndarray) -> None:
        row, _ = np.nonzero(valid)
        keys.append(columns[valid])
        ids.append(row)

    kind = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                add((kind << 40) | (segments[i] << 12)[:, None] | near[j], near[j] >= 0)
                kind += 1
    first, second, third = near
    both = ((first[:, :, None] << 12) | second[:, None, :]).reshape(len(prints), -1)
    valid = ((first >= 0)[:, :, None] & (second >= 0)[:, None, :]).reshape(len(prints), -1)
    add((kind << 40) | (both << 12) | third[:, :1], valid)
    # The decoder's own codeword of the third segment is listed above already.
    add((kind << 40) | ((first[:, :1] << 24) | (second[:, :1] << 12)) | third[:, 1:], third[:, 1:] >= 0)
    return np.concatenate(keys), np.concatenate(ids)


def _linked(prints: np.ndarray, bits: int) -> list[tuple[np.ndarray, int]]:
    """Components of distinct fingerprints within ``bits``: (members, one of them), single ones left out."""
    found = []
    rest = prints
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        members, todo = [], [root]
        while todo and len(rest):
            close = np.bitwise_count(rest ^ todo.pop()) <= bits
            if close.any():
                got = rest[close]
                rest = rest[~close]
                members.append(got)
                todo.extend(got)
        if members:
            found.append((np.concatenate(members), root))
    return found


def _group_links(prints: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, int]]:
    if len(prints) <= DIRECT:
        yield from _linked(prints, bits)
        return
    for block in range(bits + 1):  # of 4 blocks at least one is equal
        part = prints >> np.uint64(16 * block) & np.uint64(0xFFFF)
        order = np.argsort(part, kind="stable")
        for group in np.split(prints[order], np.flatnonzero(np.diff(part[order])) + 1):
            yield from _linked(group, bits)


def fingerprint_links(distinct: DataFrame, bits: int = 3) -> DataFrame:
    """Links (a, b) that join the column fp's distinct values just as all pairs within ``bits`` (at most 3) do.

    The fingerprints are dealt by key, sorted, and each key's members verified
    by their real distance in the task that reads them. A key's members give
    a star for each component and not all pairs, so a dense group of g
    fingerprints leaves fewer than g links a key.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the code's keys find up to 3 differing bits")

    def expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo in range(0, len(prints), 4096):
                some = prints[lo : lo + 4096]
                key, at = fuzzy_keys(some)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(some[at].view(np.int64))], ["key", "fp"])

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = np.empty(0, np.int64), np.empty(0, np.uint64)

        def links(key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
            sizes = np.diff(np.r_[starts, len(key)])
            two = starts[sizes == 2]
            close = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= bits] if len(two) else two
            a.append(prints[close])
            b.append(prints[close + 1])
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                for members, root in _group_links(prints[s : s + n], bits):
                    a.append(np.full(len(members), root, np.uint64))
                    b.append(members)
            found = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in np.ascontiguousarray(found)], ["a", "b"])

        for batch in batches:
            key = np.concatenate([held_key, batch.column(0).to_numpy()])
            prints = np.concatenate([held, batch.column(1).to_numpy().view(np.uint64)])
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last key may go on in the next batch
            yield links(key[:last], prints[:last])
            held_key, held = key[last:], prints[last:]
        yield links(held_key, held)

    n = partitions(distinct.sparkSession)
    keyed = distinct.select("fp").mapInArrow(expand, "key long, fp long").repartition(n, "key")
    return keyed.sortWithinPartitions("key").mapInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, bits: int = 3) -> DataFrame:
    """Fingerprint of each document and the component that links within ``bits`` put it in.

    Returns doc_id, fingerprint (16 hex digits) and component_id, the smallest
    doc_id in the component. Texts without words share the fingerprint zero,
    null is an empty text, repeated rows are returned each, a null doc_id is
    never a component's smallest unless it has no other. Other columns are not
    read; no rows in, no rows out.

    Only distinct fingerprints are expanded into keys, so exact copies and
    equal fingerprints cost one sum on the map side.
    """
    printed = cut(fingerprints(docs), "fingerprints")
    distinct = cut(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(fingerprint_links(distinct, bits))
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp")
    lowest = linked.groupBy("root").agg(F.min("least").alias("component"))
    of_print = distinct.join(linked.join(lowest, "root").select("fp", "component"), "fp", "left").select(
        "fp", F.coalesce("component", "least").alias("component_id")
    )
    return printed.join(cut(of_print, "fingerprint-components"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, bits: int = 3) -> DataFrame:
    """The rows of ``docs`` of which each component keeps the one with the smallest doc_id, with all columns.

    A doc_id names one document: rows that repeat the kept doc_id all stay.
    Rows with a null doc_id stay, as nothing tells them apart.
    """
    kept = near_duplicates(docs, bits).filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(kept.hint("merge"), "doc_id", "left_semi").select(*docs.columns)
    return named.unionByName(docs.filter("doc_id IS NULL"))
