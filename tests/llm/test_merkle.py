"""The Merkle manifest against trees built level by level, and the address arithmetic."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from minutemark.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    out = ""
    for v in (row[0], row[1], row[2], row[3], text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest(out)


def up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def way(levels, i):
    out = []
    for level in levels[:-1]:
        first = i - i % 3
        run = level[first : first + 3]
        out.append((run[: i % 3], run[i % 3 + 1 :]))
        i //= 3
    return out


def brute(rows):
    """doc_id, leaf, subroot, root, proof, folded root, verified of each row."""
    by = defaultdict(list)
    for r in rows:
        leaf = leaf_of(r, r[4])
        shown = leaf
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
            shown = leaf_of(r, r[4].replace("\n", ""))
        by[r[1]].append((r[0] is not None, r[0] or 0, leaf, shown, r[0]))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: up([m[2] for m in sorted(by[s], key=lambda m: m[:3])]) for s in sources}
    top = up([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (_, _, leaf, shown, doc) in enumerate(sorted(by[s], key=lambda m: m[:3])):
            path = way(trees[s], i) + way(top, k)
            node = shown
            for left, right in path:
                node = digest(*left, node, *right)
            proof = digest(*[x for left, right in path for x in left + right])
            out.append((doc, leaf, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


def check(spark, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string, leaf string, scope int, pos string"
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema)
    got = [tuple(r) for r in merkle.audit_tampered(df).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    return got


def test_addresses_fill_each_tree_once_and_split_at_half_height():
    for levels in range(1, 8):
        at = [merkle.address(d, i, levels) for d in range(levels) for i in range(3**d)]
        assert sorted(at) == list(range((3**levels - 1) // 2))
    # a subtree below the upper half is one stretch
    levels, top = 6, 3
    sub = sorted(merkle.address(d, i, levels) for d in range(3, 6) for i in range(2 * 3 ** (d - top), 3 * 3 ** (d - top)))
    assert sub == list(range(sub[0], sub[0] + 13))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 81, 83])
def test_blocks_equal_whole_trees(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    block = merkle.Block.build(leaves, merkle.levels_of(n))
    levels = up([x.hex() for x in leaves])
    assert block.node(0, 0).hex() == levels[-1][0]
    for i in range(n):
        assert [(a, s.hex()) for a, s in block.path(i)] == [(len(x), "".join(x + y)) for x, y in way(levels, i)]
        assert merkle.fold(leaves[i], block.path(i)) == block.node(0, 0)


def test_manifest_equals_brute_force(spark, monkeypatch):
    """Nulls everywhere, repeated ids and rows, one source with most rows, long texts, and blocks so small that tiers stack."""
    draw = random.Random(5)
    rows = [(i, draw.choice(["big"] * 5 + ["a", "é", "", None]), draw.choice(["en", None]), draw.choice([1, None]), draw.choice(["x\ny", "plain", "", None, "a\n" * 50])) for i in range(400)]
    rows += [(7, "big", "en", 1, "again"), (7, "big", "en", 1, "again"), (None, "big", None, None, None), (None, None, None, None, "t\n"), (500, "lone", "de", 3, "w\n" * 100_000)]
    rows += [(600 + i, f"s{i:03d}", "en", i, f"text {i}\n") for i in range(60)]
    check(spark, rows)
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    got = check(spark, rows)
    assert {r[6] for r in got} == {True, False}


def test_one_row_and_no_rows(spark):
    check(spark, [(3, "s", "en", 1, "one\nline")])
    assert check(spark, []) == []
