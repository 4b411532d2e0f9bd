"""Hard negatives by exact inner-product windows over cover trees.

Candidates get one more component that makes all norms equal. Then a query's distance to a candidate and their inner product say
the same, and what a tree node covers within a radius has products within |query| times that radius of its centre's.
Candidates are dealt out into blocks near common pivots, a cover tree each; all queries meet all blocks, and a block
leaves out every node whose bounds lie outside a query's windows. Leaves are verified by their exact products.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, partitions

#: Rows of a block, in the mean; points of a leaf; points that are worth a node of their own; queries of a group.
BLOCK, LEAF, NODE, GROUP = 2048, 128, 16, 1024

#: Pivots, and the rows of least hash that they are chosen from: they decide the blocks only, which hold all rows.
PIVOTS, SAMPLE = 32, 2048


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows, short ones filled up with zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lists), width))
    row = np.repeat(np.arange(len(lists)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _one(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


class CoverTree:
    """Points in the order of the leaves, and nodes: each one's centre, covering radius, and its children or its points.

    A node's children are nets: their centres lie more than half its radius apart, and each covers what lies within
    that of its centre. Points whose net is too small for a node are kept in leaves around the parent's centre.
    """

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray, nodes: np.ndarray, radius: np.ndarray):
        self.points, self.ids, self.labels, self.nodes, self.radius = points, ids, labels, nodes, radius

    @classmethod
    def build(cls, points: np.ndarray, extra: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> CoverTree:
        far = points @ points.T + np.outer(extra, extra)
        norm = far.diagonal()
        far = np.sqrt(np.maximum(norm[:, None] + norm[None, :] - 2 * far, 0.0)) + 1e-6 * (1.0 + np.sqrt(norm.max()))
        np.fill_diagonal(far, 0.0)
        queue, nodes, radius, order = [(0, np.arange(len(points)), False)], [], [], []
        size = 0
        for centre, members, whole in queue:  # children are appended, so those of a node stand together
            r = float(far[centre, members].max())
            radius.append(r)
            if whole or len(members) <= LEAF or r < 1e-3:
                nodes.append((centre, -1, -1, size, size + len(members)))
                order.append(members)
                size += len(members)
                continue
            first, rest, left, at = len(queue), [], members, centre
            while len(left):
                near = far[at, left] <= r / 2
                if np.count_nonzero(near) < NODE:
                    rest.append(left[near])
                else:
                    queue.append((at, left[near], False))
                left = left[~near]
                at = left[0] if len(left) else -1
            rest = np.concatenate(rest) if rest else members[:0]
            rest = rest[np.argsort(far[centre, rest], kind="stable")]  # near ones together: their leaves' radii differ
            queue.extend((centre, rest[i : i + LEAF], True) for i in range(0, len(rest), LEAF))
            nodes.append((centre, first, len(queue), -1, -1))
        order = np.concatenate(order)
        nodes = np.array(nodes, np.int64)
        nodes[:, 0] = np.argsort(order)[nodes[:, 0]]
        return cls(points[order], ids[order], labels[order], nodes, np.array(radius))

    def search(
        self, queries: np.ndarray, own: np.ndarray, labels: np.ndarray, same: bool, low: np.ndarray, high: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each query and window the first k points inside, by product, then id: (query, window, id, product).

        Points of the query's own id never count; ``same`` asks for those of its label, else for all others. Best
        first: each query in turn opens the node of its highest bound, and those that open the same one share a
        product of matrices. Nodes that no window of a query can use any more are never opened.
        """
        n, w = low.shape
        length = np.sqrt((queries**2).sum(1))
        best = np.zeros((4, 0), np.int64)  # query * w + window, -product, id
        least = low.astype(np.float64)  # by window, what a point must reach to count
        upper = np.full((n, len(self.nodes)), -np.inf)
        lower = np.full((n, len(self.nodes)), np.inf)

        def bound(rows: np.ndarray, at: slice) -> None:
            middle = queries[rows] @ self.points[self.nodes[at, 0]].T
            reach = np.outer(length[rows], self.radius[at]) * (1 + 1e-9) + 0.5  # products are whole numbers
            upper[rows, at], lower[rows, at] = middle + reach, middle - reach

        bound(np.arange(n), slice(0, 1))
        while True:
            chosen = upper.argmax(1)
            rows = np.flatnonzero(np.isfinite(upper[np.arange(n), chosen]))
            if not len(rows):
                break
            chosen = chosen[rows]
            useful = ((upper[rows, chosen][:, None] >= least[rows]) & (lower[rows, chosen][:, None] <= high[rows])).any(1)
            upper[rows, chosen] = -np.inf
            rows, chosen = rows[useful], chosen[useful]
            order = np.argsort(chosen, kind="stable")
            rows, chosen = rows[order], chosen[order]
            found = [best[:3]]
            for a, b in zip(cuts := np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]]) if len(chosen) else [], [*cuts[1:], len(chosen)]):
                _, first, last, start, stop = self.nodes[chosen[a]].tolist()
                mine = rows[a:b]
                if first >= 0:
                    bound(mine, slice(first, last))
                    continue
                product = queries[mine] @ self.points[start:stop].T
                fits = (labels[mine][:, None] == self.labels[None, start:stop]) == same
                fits &= own[mine][:, None] != self.ids[None, start:stop]
                for j in range(w):
                    q, p = np.nonzero(fits & (product >= least[mine, j][:, None]) & (product <= high[mine, j][:, None]))
                    found.append(np.stack([mine[q] * w + j, -product[q, p].astype(np.int64), self.ids[start + p]]))
            if len(found) > 1:
                best = np.concatenate(found, 1)
                best = best[:, np.lexsort((best[2], best[1], best[0]))]
                first = np.flatnonzero(np.r_[True, best[0, 1:] != best[0, :-1]]) if best.shape[1] else np.zeros(0, np.int64)
                place = np.arange(best.shape[1]) - np.repeat(first, np.diff(np.r_[first, best.shape[1]]))
                best, place = best[:, place < k], place[place < k]
                full = best[:, place == k - 1]
                least.ravel()[full[0]] = -full[1]  # an equal product may still win by its id
        return best[0] // w, best[0] % w, best[2], -best[1]


def eligible(rows: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label and whole-numbered vector of the rows that take part.

    Left out: a null vec_id, label or vector, and vectors with a null or non-finite component. Rows that repeat a vec_id
    count once, as the one of least label, then of least vector.
    """
    vector = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    sound = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    taken = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(sound)
    taken = taken.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(F.col("label").cast("long").alias("label"), vector.alias("vec")).alias("v"))
    return taken.groupBy("vec_id").agg(F.min("v").alias("v")).select("vec_id", "v.label", "v.vec")


def _norm2() -> Column:
    return F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


class Index:
    """All candidates (vec_id, label, vec) as cover trees, one row for each block."""

    def __init__(self, candidates: DataFrame):
        width, most = candidates.agg(F.max(F.size("vec")), F.max(_norm2())).first()
        self.spark, self.width, self.most = candidates.sparkSession, width or 0, most or 0.0
        width, most = self.width, self.most
        sample = candidates.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec").toArrow()
        pivots = self._pivots(_matrix(_one(sample["vec"]), width)) if sample.num_rows else np.zeros((1, width + 1))

        augmented = self._augmented

        def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points = augmented(_matrix(batch.column(2), width), most)
                pivot = (points @ pivots.T).argmax(1)  # norms are equal: the nearest has the largest product
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot.astype(np.int32))], ["vec_id", "label", "vec", "pivot"])

        dealt = cut(candidates.select("vec_id", "label", "vec").mapInArrow(near, "vec_id long, label long, vec array<long>, pivot int"), "negatives-rows")
        counts = {r["pivot"]: r["count"] for r in dealt.groupBy("pivot").count().collect()}  # at most PIVOTS rows
        blocks, first = {}, 0
        for pivot, count in sorted(counts.items()):
            blocks[pivot] = (first, -(-count // BLOCK))
            first += -(-count // BLOCK)
        self.blocks = first
        block = F.lit(0).cast("long")
        for pivot, (at, n) in blocks.items():
            block = F.when(F.col("pivot") == pivot, F.lit(at) + F.pmod(F.xxhash64("vec_id"), F.lit(n))).otherwise(block)

        def plant(table: pa.Table) -> pa.Table:
            points = _matrix(_one(table["vec"]), width)
            extra = np.sqrt(np.maximum(most - (points**2).sum(1), 0.0))
            tree = CoverTree.build(points, extra, table["vec_id"].to_numpy(), table["label"].to_numpy())
            return pa.table(
                {
                    "block": table["block"][:1], "ids": [tree.ids], "labels": [tree.labels], "points": [tree.points.tobytes()],
                    "nodes": [tree.nodes.ravel()], "radius": [tree.radius],
                }
            )

        schema = "block long, ids array<long>, labels array<long>, points binary, nodes array<long>, radius array<double>"
        self.trees = cut(dealt.withColumn("block", block).groupBy("block").applyInArrow(plant, schema), "negatives-trees")

    @staticmethod
    def _augmented(points: np.ndarray, most: float) -> np.ndarray:
        return np.concatenate([points, np.sqrt(np.maximum(most - (points**2).sum(1), 0.0))[:, None]], 1)

    def _pivots(self, points: np.ndarray) -> np.ndarray:
        """Points far from each other, each the farthest from those before it."""
        points = self._augmented(points, self.most)
        chosen, nearest = [0], points @ points[0]
        while len(chosen) < PIVOTS and nearest.min() < self.most * (1 - 1e-9):
            chosen.append(int(nearest.argmin()))
            nearest = np.maximum(nearest, points @ points[chosen[-1]])
        return points[chosen]

    def search(self, queries: DataFrame, same: bool, k: int) -> DataFrame:
        """The first k points of each query (vec_id, label, vec, windows) in each of its windows, by product, then id.

        ``windows`` is an array of (key, low, high). Returns query, key, found, product and rank from 1.
        """
        groups = F.pmod(F.xxhash64("vec_id", F.lit("group")), F.lit(max(1, -(-queries.count() // GROUP))))
        packed = queries.groupBy(groups.alias("_g")).agg(F.collect_list(F.struct("vec_id", "label", "vec", "windows")).alias("queries"))
        packed = packed.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(self.blocks - 1, 0)).cast("long"))).alias("block"), F.lit(1).alias("kind"), "queries")
        trees = self.trees.withColumn("kind", F.lit(0))
        for name, kind in packed.dtypes:
            if name not in trees.columns:
                trees = trees.withColumn(name, F.lit(None).cast(kind))
        for name, kind in self.trees.dtypes:
            if name not in packed.columns:
                packed = packed.withColumn(name, F.lit(None).cast(kind))
        n = max(1, min(self.blocks, 4 * partitions(self.spark)))
        both = trees.unionByName(packed).repartition(n, "block").sortWithinPartitions("block", "kind")
        width, answer = self.width, self._found

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree = None
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {name: batch.column(name).slice(i, 1) for name in batch.schema.names}
                    if row["kind"][0].as_py() == 0:
                        ids = row["ids"].flatten().to_numpy()
                        points = np.frombuffer(row["points"][0].as_py(), np.float64).reshape(len(ids), -1)
                        tree = CoverTree(points, ids, row["labels"].flatten().to_numpy(), row["nodes"].flatten().to_numpy().reshape(-1, 5), row["radius"].flatten().to_numpy())
                    elif tree is not None:  # without candidates there is none
                        yield answer(tree, row["queries"].flatten(), width, same, k)

        found = both.mapInArrow(run, "query long, key long, found long, product long")
        rank = F.row_number().over(Window.partitionBy("query", "key").orderBy(F.desc("product"), "found"))
        return found.withColumn("rank", rank).filter(F.col("rank") <= k)

    @staticmethod
    def _found(tree: CoverTree, queries: pa.StructArray, width: int, same: bool, k: int) -> pa.RecordBatch:
        ids, labels = queries.field("vec_id").to_numpy(), queries.field("label").to_numpy()
        windows = queries.field("windows")
        inside = windows.flatten()
        counts = np.diff(windows.offsets.to_numpy())
        w = max(1, int(counts.max(initial=0)))
        row = np.repeat(np.arange(len(ids)), counts)
        place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        key, low, high = np.zeros((len(ids), w), np.int64), np.full((len(ids), w), np.inf), np.full((len(ids), w), -np.inf)
        key[row, place] = inside.field("key").to_numpy()
        low[row, place], high[row, place] = inside.field("low").to_numpy(), inside.field("high").to_numpy()
        query, window, found, product = tree.search(_matrix(queries.field("vec"), width), ids, labels, same, low, high, k)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[query], key[query, window], found, product)], ["query", "key", "found", "product"])


def hard_negatives(embeddings: DataFrame, every: int = 100, noise: int = 7, classes: int = 10, positives: int = 5, negatives: int = 5) -> DataFrame:
    """For each anchor (vec_id divisible by ``every``) and each of its best positives the best negatives not much worse than it.

    Columns used: vec_id, embedding, label; see ``eligible`` for the rows that take part. Labels of ids divisible by
    ``noise`` are moved to the next of ``classes`` first. Short vectors count as filled up with zeros. Ties go to the
    smaller vec_id. Without anchors, positives or negatives the result is empty.
    """
    rows = eligible(embeddings)
    rows = rows.withColumn("label", F.when(F.col("vec_id") % noise == 0, F.pmod(F.col("label") + 1, F.lit(classes))).otherwise(F.col("label")))
    rows = cut(rows, "negatives-eligible")
    index = Index(rows)
    anchors = rows.filter(F.col("vec_id") % every == 0)
    window = lambda key, low, high: F.struct(key.cast("long").alias("key"), low.cast("long").alias("low"), high.cast("long").alias("high"))
    all_ = window(F.lit(0), F.lit(-(2**63)), F.lit(2**63 - 1))
    best = cut(index.search(anchors.withColumn("windows", F.array(all_)), True, positives), "negatives-positives")
    p = F.col("product")
    best = best.filter("product >= 0").groupBy(F.col("query").alias("vec_id")).agg(F.collect_list(window(F.col("found"), F.expr("(4 * product + 4) div 5"), p)).alias("windows"))
    found = index.search(cut(anchors.join(best, "vec_id"), "negatives-asked"), False, negatives)
    asked = best.select(F.col("vec_id").alias("query"), F.explode("windows").alias("w")).select("query", F.col("w.key").alias("key"), F.col("w.high").alias("positive_score"))
    return found.join(asked, ["query", "key"]).select(
        F.col("query").alias("anchor_id"), F.col("key").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("found").alias("negative_id"),
        "positive_score", F.col("product").alias("negative_score"),
    )
