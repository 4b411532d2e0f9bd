"""Exact dedup, sharding, mixing, SimHash and packing against brute force on small tables."""

import hashlib
import random
import re
import uuid
import zlib
from collections import defaultdict

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from minutemark.llm import components, exact_dedup, mixing, packing, sharding, simhash

SCHEMA = "doc_id long, text string, source string, size string, digest string, n int"
WORDS = ["alpha", "Beta", "gamma", "delta,", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]


def table(spark):
    """Nulls, empty and long texts, copies, repeated rows and columns whose names clash with the operators' own."""
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choices(WORDS, k=draw.choice([1, 3, 20, 60]))), f"s{i % 4}") for i in range(120)]
    rows += [(200 + i, rows[5][1], "s1") for i in range(40)]
    rows += [(300, None, None), (301, "", "s0"), (302, "  \n\t", None), (303, "a b " * 60_000, "s2")]
    rows += [(304, "one two three", "s2"), (304, "one two three", "s2"), (None, "null id", "s3"), (None, None, "s3")]
    rows += [(400 + i, rows[i][1] + " tail", "s9") for i in range(20)]
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def index(spark, **k):
    return exact_dedup.DigestIndex(spark, f"t_{uuid.uuid4().hex}", buckets=4, **k)


def test_exact_dedup(spark):
    docs = table(spark)
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r.text or ""].append(r.doc_id)
    expected = set()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        expected |= {(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids}
    got = index(spark).ingest(docs).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_index_outlives_a_batch(spark, tmp_path):
    docs = table(spark).filter("doc_id IS NOT NULL")
    place = f"file://{tmp_path}/index"
    first = index(spark, location=place)
    assert first.ingest(docs.filter("doc_id < 60")).filter("kept").count() == len(
        {r.text for r in docs.filter("doc_id < 60").collect()}
    )
    again = index(spark, location=place)
    later = {r.doc_id: r for r in again.ingest(docs.filter("doc_id >= 60")).collect()}
    assert not later[210].kept and later[210].keep_id == 5  # the copies of text 5 came too late
    assert again.ingest(docs).filter("kept").count() == 0
    assert spark.table(again.name).count() == len({r.text or "" for r in docs.collect()})
    plan = docs.join(spark.table(again.name).hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "SortMergeJoin" in plan


def test_drop_copies(spark):
    docs = table(spark).filter("doc_id IS NOT NULL")
    kept = exact_dedup.drop_copies(docs, index(spark)).collect()
    assert sorted(r.text or "" for r in kept) == sorted({r.text or "" for r in docs.collect()})
    assert exact_dedup.drop_copies(empty(spark), index(spark)).count() == 0


def test_sharding(spark):
    docs = table(spark)
    got = sharding.shard_by_bytes(docs, 5).collect()
    rows = docs.collect()
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((r.doc_id or -1, len((r.text or "").encode()) + 1) for r in rows)
    total = sum(r.size for r in got)
    for shard in range(5):
        mine = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        ids = [-1 if r.doc_id is None else r.doc_id for r in mine]
        assert ids == sorted(ids)
        assert abs(sum(r.size for r in mine) - total / 5) <= max(r.size for r in got)
    assert {r.text_crc32 for r in got} == {zlib.crc32((r.text or "").encode()) for r in rows}
    assert sharding.shard_by_bytes(empty(spark)).count() == 0


def brute_targets(sizes, weights=(1, 2, 3)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, free = sum(sizes.values()), {}, set(sizes)
    while free:
        left = total - sum(target.values())
        over = {s for s in free if left * weight[s] / sum(weight[x] for x in free) > 3 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        target |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    return target


def test_mixing(spark):
    docs = table(spark)
    got = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len(words(r.text))
    want = brute_targets(dict(sizes))
    assert len(got) == docs.count()
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.size == 0 and r.taken == 0 or r.taken % r.size == 0 and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], 2 * r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(empty(spark)).count() == 0
    copies = mixing.apply_mix(docs, seed=11).groupBy("doc_id").count().collect()
    assert sum(r["count"] for r in copies) == sum(r.taken // r.size for r in got if r.size)


def test_mixing_over_levels(spark, monkeypatch):
    """Small blocks, so that the tree has several levels; chances are met on average."""
    monkeypatch.setattr(mixing, "BLOCK", 4)
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "a" if i % 3 else "b") for i in range(600)], "doc_id long, text string, source string")
    runs = [{r.doc_id: r.taken / r.size for r in mixing.mix(docs, seed=s).collect()} for s in (1, 2)]
    assert runs[0] != runs[1]
    for run in runs:
        for s, rate in (("a", 1 / 2), ("b", 2)):
            mine = [i for i in range(600) if ("a" if i % 3 else "b") == s]
            size = sum(1 + i % 7 for i in mine)
            assert abs(sum(run[i] * (1 + i % 7) for i in mine) / size - rate) < 0.02


def test_golay_keys_find_all_within_three_bits():
    draw = np.random.default_rng(5)
    for _ in range(300):
        a = draw.integers(0, 2**64, dtype=np.uint64, endpoint=False)
        b = a
        for bit in draw.choice(64, draw.integers(0, 4), replace=False):
            b ^= np.uint64(1) << np.uint64(bit)
        keys, at = simhash.fuzzy_keys(np.array([a, b], np.uint64))
        assert set(keys[at == 0].tolist()) & set(keys[at == 1].tolist())


def brute_print(text):
    parts = re.findall(rb"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode())
    if not parts:
        return 0
    n = min(3, len(parts))
    shingles = [xxh64_intdigest(b" ".join(parts[i : i + n]), 42) for i in range(len(parts) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in shingles) > len(shingles))


def test_simhash(spark):
    docs = table(spark)
    rows = docs.collect()
    prints = {(r.doc_id, r.text): brute_print(r.text) for r in rows}
    nodes = list(set(prints.values()))
    parent = {p: p for p in nodes}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, p in enumerate(nodes):
        for q in nodes[:i]:
            if (p ^ q).bit_count() <= 3:
                parent[find(p)] = find(q)
    least = {}
    for (d, _), p in prints.items():
        if d is not None:
            least[find(p)] = min(d, least.get(find(p), d))
    want = sorted((-1 if r.doc_id is None else r.doc_id, f"{(p := prints[r.doc_id, r.text]):016x}", least.get(find(p), -1)) for r in rows)
    got = simhash.near_duplicates(docs).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.drop_near_duplicates(docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).count() == len(
        {c for d, _, c in want if d >= 0}
    )


def test_simhash_spans_batches_and_dense_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "DIRECT", 50)
    base = np.uint64(0x123456789ABCDEF0)
    close = {int(base)} | {int(base ^ (np.uint64(1) << np.uint64(i))) for i in range(64)}
    close |= {int(base ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j))) for i in range(20) for j in range(i)}
    far = {int(x) for x in np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64)}
    nodes = np.array(sorted(close | far), np.uint64).view(np.int64).tolist()
    links = simhash.fingerprint_links(spark.createDataFrame([(n,) for n in nodes], "fp long"))
    roots = components.components(links).collect()
    assert {r.node for r in roots} == set(np.array(sorted(close), np.uint64).view(np.int64).tolist())
    assert len({r.root for r in roots}) == 1


def test_components_on_a_chain(spark):
    links = [(i, i + 1) for i in range(1, 300)] + [(1000, 1001), (1001, 1000), (7, 7), (None, 3)]
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = defaultdict(set)
    for r in got:
        groups[r.root].add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(1, 301)), [1000, 1001]]


def test_word_tokenizer_equals_the_library(monkeypatch):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CACHED_WORDS", 16)
    mine, theirs = packing.WordTokenizer(path("word_bpe_49k.json")), Tokenizer.from_file(path("word_bpe_49k.json"))
    texts = [
        "", " \n", "It's THE end, don't! 12,345 x", "Straße ÉÀÇ œuvre Ünïcode—dash “quote”… naïve", "a<|endoftext|>b <|startoftext|>",
        "日本語 テキスト Ωμέγα ΣΑΣ", "é combining", "a\x1cb \x85 c\xa0d e f", "İstanbul ıI ﬁ ½ ² Ⅷ", "c\x01d \x7f e\x00", "'s 's's can't'll x'd 'D 'Ll",
        "soft­hyphen ŉ ǅ ĳ €5 ±3 a_b__c .... !!!", "퟿ zero​width ﻿bom", "x" * 5000, "😀 emoji👨‍👩‍👧",
    ]
    for t in texts:
        assert np.frombuffer(mine.ids(t), "<u4").tolist() == theirs.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece(seed):
    draw = np.random.default_rng(seed)
    cap = [8, 100, 2048, 2048][seed]
    lengths = draw.integers(1, cap + 1, [50, 400, 5000, 300][seed])
    values, counts = np.unique(lengths, return_counts=True)
    plan = packing.plan_sequences(dict(zip(values.tolist(), counts.tolist())), cap)
    used = defaultdict(int)
    for pattern, n in plan:
        assert n > 0 and sum(x * k for x, k in pattern.items()) <= cap
        for x, k in pattern.items():
            used[x] += n * k
    assert used == dict(zip(values.tolist(), counts.tolist()))
    least = max(-(-int(lengths.sum()) // cap), int((2 * lengths > cap).sum()))  # no two long halves share a sequence
    assert sum(n for _, n in plan) <= least * 1.03 + 3


def test_packing(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    docs = table(spark)
    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    want = []
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 64)):
            piece = np.array(ids[at : at + 64], "<u4")
            want.append((r.doc_id or -1, k, at, len(piece), zlib.crc32(piece.tobytes())))
    got = packing.pack_documents(docs, path("word_bpe_49k.json"), cap=64).collect()
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= sum(w[3] for w in want) / 64 * 1.01 + 2
    assert packing.pack_documents(empty(spark), path("word_bpe_49k.json")).count() == 0


def test_rounding_keeps_each_documents_chance(spark):
    """Many small sources are as many draws: documents of any size are taken as often as their source's rate says."""
    sizes = (7, 3, 3, 3, 1, 3)
    rows = [(100 * s + i, "w " * n, f"s{s:05d}") for s in range(1500) for i, n in enumerate(sizes)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = defaultdict(list)
    for r in got:
        by[round(r.target / r.source_size, 6), r.doc_id % 100].append(r.taken / r.size)
    assert len({rate for rate, _ in by}) == 3
    for (rate, place), taken in by.items():
        part = rate - int(rate)
        sigma = (part * (1 - part) / len(taken)) ** 0.5
        assert abs(np.mean(taken) - rate) <= 3.5 * sigma + 1e-9, (rate, place, np.mean(taken))
    per = defaultdict(int)
    for r in got:
        per[r.source] += r.taken
    target = {r.source: r.target for r in got}
    assert all(abs(per[s] - target[s]) < max(sizes) for s in per)


def test_a_batch_repeated_under_its_name_keeps_its_documents(spark, monkeypatch):
    """The driver dies after the append and repeats the batch; another batch then finds the texts known."""
    docs, held = table(spark), index(spark)
    real = exact_dedup._with_groups
    monkeypatch.setattr(exact_dedup, "_with_groups", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        held.ingest(docs, "b")
    monkeypatch.setattr(exact_dedup, "_with_groups", real)
    n = spark.table(held.name).count()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text_sha256)
    again = sorted(held.ingest(docs, "b").collect(), key=key)
    assert again == sorted(index(spark).ingest(docs).collect(), key=key)
    assert sum(r.kept for r in again) == n == spark.table(held.name).count()
    assert held.ingest(docs, "c").filter("kept").count() == 0


def test_two_parts_give_what_sql_gives(spark):
    """The second part meets a filled index; SQL on the same table, repeated rows and null ids included."""
    import duckdb

    from minutemark.llm.sql import OP7

    docs = table(spark)
    held = index(spark)
    got = held.ingest_parts(docs).collect()
    batches = {r.batch[-1] for r in spark.table(held.name).collect()}
    assert batches == {"0", "1"}
    documents = docs.select("doc_id", "text").toArrow()  # noqa: F841  read by name
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = duckdb.sql(OP7).select(*columns).fetchall()
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert held.ingest_parts(docs.filter("false")).count() == 0


def test_helper_columns_never_replace_the_callers(spark):
    names = ["_sha", "_key", "_none", "_copy", "_words", "_id", "_source", "_size", "_copies", "_COPY"]
    rows = [(i, f"{'w ' * (i + 1)}", "s", *[f"{c}{i}" for c in names[:-1]]) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in names[:-1]))
    for out in (exact_dedup.drop_copies(docs, index(spark)), mixing.apply_mix(docs)):
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.collect()} <= set(rows) and out.count() == 6
