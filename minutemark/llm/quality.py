"""Quality classifier by co-training a view of the text and a view of the page's metadata."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_or_empty

#: Hashed features of words and of word shapes.
BUCKETS = 256

#: Distinct words whose buckets a Python worker remembers.
CACHED_WORDS = 200_000

_DIGITS, _UPPER, _LOWER = re.compile(r"\d+"), re.compile(r"[^\W\d_a-zà-öø-ÿ]+"), re.compile(r"[^\W\d_]+")
_KINDS = np.zeros((256, 6), np.int64)  # upper, lower, digit, sign, beyond ASCII, white space
for _c in range(256):
    _kind = (0 if 65 <= _c <= 90 else 1 if 97 <= _c <= 122 else 2 if 48 <= _c <= 57 else 4 if _c > 127 else 5 if _c in (32, *range(9, 14)) else 3)
    _KINDS[_c, _kind] = 1

_words: dict[str, tuple[int, int]] = {}


def _buckets(word: str) -> tuple[int, int]:
    found = _words.get(word)
    if found is None:
        shape = re.sub(r"(.)\1+", r"\1\1", _LOWER.sub("a", _UPPER.sub("A", _DIGITS.sub("0", word))))
        found = zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS, zlib.crc32(shape.encode("utf-8", "replace")) % BUCKETS
        if len(_words) >= CACHED_WORDS:
            _words.clear()
        _words[word] = found
    return found


def text_view(text: str) -> np.ndarray:
    """Features of a whole text: shares of characters, repetition of words and lines, hashed words and shapes."""
    raw = text.encode("utf-8", "replace")
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _KINDS / max(1, len(raw))
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    lengths = np.fromiter(map(len, counts), np.float64, len(counts))
    weights = np.fromiter(counts.values(), np.float64, len(counts))
    mean = float(lengths @ weights) / n
    lines = [x for x in text.split("\n") if x.strip()]
    top = float(weights.max()) if len(weights) else 0.0
    same = sum(a == b for a, b in zip(words, words[1:]))
    tail = sum(c for w, c in counts.items() if not w[-1].isalnum())
    signs = sum(c for w, c in counts.items() if len(w) > 2 and not w[-1].isalnum() and w[-1] == w[-2])
    upper = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    stats = [
        np.log1p(len(words)) / 10,
        *kinds,
        mean / 10,
        (max(0.0, float((lengths * lengths) @ weights) / n - mean * mean) ** 0.5) / 10,
        len(counts) / n,
        len(counts) / n**0.8,
        top / n,
        same / n,
        tail / n,
        signs / n,
        upper / n,
        len(lines) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        float(not words),
    ]
    pairs = np.array([_buckets(w) for w in counts], np.int64).reshape(-1, 2)
    by_word = np.bincount(pairs[:, 0], weights, BUCKETS) / n
    by_shape = np.bincount(pairs[:, 1], weights, BUCKETS) / n
    return np.concatenate([stats, np.sqrt(by_word), np.sqrt(by_shape)]).astype(np.float32)


def metadata_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Features of a page's metadata: hashed source, language and both, and its stated length by steps."""
    out = np.zeros(192, np.float32)
    out[zlib.crc32(f"s{source}".encode()) % 64] = 1
    out[64 + zlib.crc32(f"l{lang}".encode()) % 32] = 1
    size = -1 if n_chars is None or n_chars < 0 else int(2 * np.log2(1 + n_chars))
    out[96 + min(size + 1, 31)] = 1
    out[128 + zlib.crc32(f"{lang}|{size // 2}".encode()) % 64] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Logistic:
    """Ridge logistic regression on scaled columns, fitted by Newton steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 3.0, steps: int = 10) -> Logistic:
        weight = np.ones(len(x)) if weight is None else weight
        mean, spread = x.mean(0), x.std(0)
        scale = np.where(spread > 1e-6, spread, 1.0)
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))]).astype(np.float64)
        w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
        penalty[-1] = 1e-3
        for _ in range(steps):
            p = _sigmoid(z @ w)
            step = np.linalg.solve((z.T * (weight * p * (1 - p) + 1e-6)) @ z + np.diag(penalty), z.T @ (weight * (y - p)) - penalty * w)
            w += step
            if np.abs(step).max() < 1e-4:
                break
        return cls(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1]


@dataclass
class CoTrained:
    """Both views' models, how each is calibrated, how they are combined, and how many rows each taught, round by round."""

    text: Logistic
    metadata: Logistic
    calibrate: list[Logistic]
    combine: Logistic
    taught: list[dict[str, int]]

    def scores(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        logits = [
            c.logit(m.logit(x)[:, None]) for c, m, x in zip(self.calibrate, (self.text, self.metadata), (text, metadata))
        ]
        return _sigmoid(logits[0]), _sigmoid(logits[1]), _sigmoid(self.combine.logit(np.column_stack(logits)))


#: The views in turn, and a class with the sign that its scores have.
VIEWS, KINDS = ("text", "metadata"), ((1, 1), (0, -1))

#: Standard errors by which a view's held-out precision is taken to be lower than it looks.
DOUBT = 1.5

#: Steps of a score by which rows beyond a threshold are counted, and how many are told apart.
FINE, BINS = 64, 4096


def _trust(scores: np.ndarray, labels: np.ndarray) -> dict[int, tuple[float, float]]:
    """For each class that held-out scores tell better than by chance: the score beyond which they do best, and how much better.

    Rows are taken from the surest on. The share that is right among the first n
    has a lower bound (Wilson's, one standard error); the n with the highest
    bound sets the threshold, and the bound's way from the class's frequency to
    1 is the weight of what the view teaches: near 1 for a strong view, small for
    a weak one. A class without any gain isn't taught.
    """
    found = {}
    for kind, sign in KINDS:
        base = float((labels == kind).mean())
        order = np.argsort(-sign * scores, kind="stable")
        n = np.arange(1, len(order) + 1)
        right = np.cumsum(labels[order] == kind) / n
        z = DOUBT * DOUBT / n
        bound = (right + z / 2 - np.sqrt(z * right * (1 - right) + z * z / 4)) / (1 + z)
        # Rows of one score are judged together.
        last = np.r_[np.diff(scores[order]) != 0, True] & (n >= 10)
        if last.any():
            best = np.flatnonzero(last)[np.argmax(bound[last])]
            gain = (bound[best] - base) / max(1e-9, 1 - base)
            if gain > 0:
                found[kind] = float(sign * scores[order[best]]), float(gain * gain)
    return found


def _bins(models: list[Logistic], views: tuple[np.ndarray, np.ndarray], cuts: dict) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray]]:
    """For each (view, class) that teaches: the rows beyond its threshold, and by how many steps."""
    scores = [m.logit(x) for m, x in zip(models, views)]
    for (view, kind), (threshold, _) in cuts.items():
        beyond = (1 if kind else -1) * scores[view] - threshold
        rows = np.flatnonzero(beyond >= 0)
        yield (view, kind), rows, np.minimum(beyond[rows] * FINE, BINS - 1).astype(np.int64)


def _quotas(counts: dict[tuple[int, int], np.ndarray], share: dict[int, float], most: int) -> dict[tuple[int, int], tuple[int, float]]:
    """From the rows in each bin: the lowest bin to take for each (view, class), and what part of that bin.

    A view teaches at most ``most`` rows, in the classes' held-out ratio where it teaches both.
    """
    out = {}
    for view in {v for v, _ in counts}:
        mine = {k: c for (v, k), c in counts.items() if v == view}
        total = min([float(most), *(c.sum() / share[k] for k, c in mine.items())])
        for kind, count in mine.items():
            want = total * share[kind]
            above = np.cumsum(count[::-1])[::-1]
            low = max(0, int(np.searchsorted(-above, -want, "right")) - 1)
            higher = above[low] - count[low]
            out[view, kind] = low, float(np.clip((want - higher) / max(1, count[low]), 0, 1))
    return out


def _taken(found: Iterator, quotas: dict, chance: np.ndarray) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    for which, rows, step in found:
        low, part = quotas[which]
        yield which, rows[(step > low) | ((step == low) & (chance[rows] < part))]


class ArrayPool:
    """Unlabelled rows in memory."""

    def __init__(self, text: np.ndarray, metadata: np.ndarray):
        self.views = text, metadata
        self.chance = np.random.default_rng(3).random(len(text))

    def surest(self, models: list[Logistic], cuts: dict, share: dict[int, float], most: int) -> dict[tuple[int, int], list[np.ndarray]]:
        counts = {w: np.bincount(step, minlength=BINS) for w, _, step in _bins(models, self.views, cuts)}
        quotas = _quotas(counts, share, most)
        return {w: [v[rows] for v in self.views] for w, rows in _taken(_bins(models, self.views, cuts), quotas, self.chance)}


class TablePool:
    """Unlabelled rows of a described table, all of them; only counts and the taught rows' features reach the driver."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def surest(self, models: list[Logistic], cuts: dict, share: dict[int, float], most: int) -> dict[tuple[int, int], list[np.ndarray]]:
        def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {w: np.zeros(BINS, np.int64) for w in cuts}
            for batch in batches:
                for which, _, step in _bins(models, _unpacked(batch), cuts):
                    sums[which] += np.bincount(step, minlength=BINS)
            for (view, kind), total in sums.items():
                at = np.flatnonzero(total)
                columns = [np.full(len(at), view), np.full(len(at), kind), at, total[at]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["view", "kind", "bin", "n"])

        counts = {w: np.zeros(BINS, np.int64) for w in cuts}
        binned = self.rows.mapInArrow(count, "view long, kind long, bin long, n long")
        for r in binned.groupBy("view", "kind", "bin").agg(F.sum("n").alias("n")).collect():  # at most 4 BINS rows
            counts[r["view"], r["kind"]][r["bin"]] = r["n"]
        quotas = _quotas(counts, share, most)

        def take(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                chance = (batch.column("lot").to_numpy().view(np.uint64) >> np.uint64(11)) / 2.0**53
                for (view, kind), rows in _taken(_bins(models, _unpacked(batch), cuts), quotas, chance):
                    part = batch.take(pa.array(rows))
                    same = [pa.array(np.full(len(rows), x), pa.int64()) for x in (view, kind)]
                    yield pa.RecordBatch.from_arrays([*same, part.column("text_view"), part.column("meta_view")], ["view", "kind", "text_view", "meta_view"])

        taken = self.rows.mapInArrow(take, "view long, kind long, text_view binary, meta_view binary").toArrow()
        taken = taken.sort_by([("text_view", "ascending"), ("meta_view", "ascending")]).combine_chunks()
        view, kind = taken["view"].to_numpy(), taken["kind"].to_numpy()
        features = _unpacked(taken)
        return {w: [x[(view == w[0]) & (kind == w[1])] for x in features] for w in cuts}


def fit_views(
    text: np.ndarray, metadata: np.ndarray, labels: np.ndarray, pool: ArrayPool | TablePool | None, rounds: int = 3, most_new: int = 1000
) -> CoTrained | None:
    """Fit both views on labelled rows, let them label rows of the pool for each other, and combine.

    A fifth of the labelled rows is held out, for calibration and to tell what a
    view may teach (``_trust``). In each round each view hands the other at most
    ``most_new`` rows of the pool, its surest ones of each class, weighted by how
    far it can be trusted; these are chosen anew each round. None if the labelled
    rows don't hold both classes in both parts.
    """
    held, fit = np.arange(0, len(labels), 5), np.setdiff1d(np.arange(len(labels)), np.arange(0, len(labels), 5))
    if min(len(set(labels[held].tolist())), len(set(labels[fit].tolist()))) < 2:
        return None
    views, y = (text, metadata), labels[held].astype(np.float64)
    share = {1: float(y.mean()), 0: 1 - float(y.mean())}
    extra: list[list[tuple[np.ndarray, int, float]]] = [[], []]
    models: list[Logistic] = []
    taught: list[dict[str, int]] = []
    for turn in range(rounds + 1):
        models = []
        for x, more in zip(views, extra):
            rows = np.concatenate([x[fit], *(m[0] for m in more)])
            target = np.concatenate([labels[fit], *(np.full(len(m[0]), m[1]) for m in more)]).astype(np.float64)
            weight = np.concatenate([np.ones(len(fit)), *(np.full(len(m[0]), m[2]) for m in more)])
            models.append(Logistic.fit(rows, target, weight))
        if turn == rounds or pool is None:
            break
        cuts = {(v, k): t for v in (0, 1) for k, t in _trust(models[v].logit(views[v][held]), labels[held]).items()}
        if not cuts:
            break
        extra = [[], []]
        for (view, kind), features in pool.surest(models, cuts, share, most_new).items():
            extra[1 - view].append((features[1 - view], kind, cuts[view, kind][1]))
        taught.append({f"{VIEWS[v]} taught": sum(len(m[0]) for m in extra[1 - v]) for v in (0, 1)})
    raw = [m.logit(x[held])[:, None] for m, x in zip(models, views)]
    calibrate = [Logistic.fit(r, y, ridge=1.0) for r in raw]
    both = np.column_stack([c.logit(r) for c, r in zip(calibrate, raw)])
    return CoTrained(models[0], models[1], calibrate, Logistic.fit(both, y, ridge=1.0), taught)


def co_train(text: np.ndarray, metadata: np.ndarray, labels: np.ndarray, rounds: int = 3, most_new: int = 1000) -> CoTrained | None:
    """``fit_views`` on rows in memory; those with label -1 are the pool."""
    known, other = labels >= 0, labels < 0
    pool = ArrayPool(text[other], metadata[other]) if other.any() else None
    return fit_views(text[known], metadata[known], labels[known], pool, rounds, most_new)


_COLUMNS = ("doc_id", "text", "source", "lang", "n_chars")


def _columns() -> list:
    return [
        F.col("doc_id").cast("long"),
        text_or_empty().alias("text"),
        F.col("source").cast("string"),
        F.col("lang").cast("string"),
        F.col("n_chars").cast("long"),
    ]


#: Features of the text are stored as 16-bit floats, those of metadata as the places of their ones.
_TEXT, _META = np.float16, np.int16


def _described(batch: pa.RecordBatch, text: pa.Array) -> list[pa.Array]:
    """Both views of a batch's rows as binary columns, with the texts given."""
    views = [text_view(t.as_py() or "").astype(_TEXT).tobytes() for t in text]
    meta = [
        np.flatnonzero(metadata_view(*x)).astype(_META).tobytes() for x in zip(*(batch.column(c).to_pylist() for c in _COLUMNS[2:]))
    ]
    return [pa.array(views, pa.binary()), pa.array(meta, pa.binary())]


def _unpacked(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    text = np.frombuffer(b"".join(batch["text_view"].to_pylist()), _TEXT).reshape(batch.num_rows, -1 if batch.num_rows else 0)
    ones = np.frombuffer(b"".join(batch["meta_view"].to_pylist()), _META).reshape(batch.num_rows, -1 if batch.num_rows else 0)
    meta = np.zeros((batch.num_rows, len(metadata_view(None, None, None))), np.float32)
    meta[np.arange(batch.num_rows)[:, None], ones] = 1
    return text.astype(np.float32), meta


def describe(docs: DataFrame, whole: bool = False) -> DataFrame:
    """id, lot (a hash of the row), text_view and meta_view of every row; with ``whole`` also the row, as ``row``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                columns = [part.column("doc_id"), *_described(part, part.column("text")), *([part.column("row")] if whole else [])]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text_view", "meta_view", *(["row"] if whole else [])])

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    inputs = docs.select(*_columns(), *([row] if whole else []))
    kind = "".join(f", row {docs.select(row).schema['row'].dataType.simpleString()}" if whole else "")
    described = inputs.mapInArrow(run, "id long, text_view binary, meta_view binary" + kind)
    return described.withColumn("lot", F.xxhash64("id", "text_view", "meta_view"))


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = 8192, most_new: int = 1000, rounds: int = 3, seed: int = 7) -> CoTrained | None:
    """Co-train on at most ``most_labelled`` labelled documents, with all other documents as the pool."""
    return train_described(cut(describe(docs), "views"), labels, most_labelled, most_new, rounds, seed)


def train_described(
    rows: DataFrame, labels: DataFrame, most_labelled: int = 8192, most_new: int = 1000, rounds: int = 3, seed: int = 7
) -> CoTrained | None:
    """Co-train on a described table (``describe``), written before: it is read twice each round.

    The labelled sample is bounded: the ids of least hash, whatever the input's
    order, one row for each. Their ids are joined as a broadcast of at most
    ``most_labelled`` rows, and their features reach the driver. All other
    documents are the pool: each round scores every one; what comes back is
    counts by score and the features of the at most 2 * ``most_new`` surest.
    Labels with a null id or quality are left out; of several labels for one id
    the lowest holds.
    """
    known = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.min(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("_label"))
    )
    ids = rows.select(F.col("id").alias("_id")).filter("_id IS NOT NULL").distinct()
    chosen = cut(known.join(ids, "_id", "left_semi").orderBy(F.xxhash64("_id", F.lit(seed)), "_id").limit(most_labelled), "labelled")
    sample = rows.join(F.broadcast(chosen), rows["id"] == chosen["_id"]).groupBy("_id").agg(
        F.min("_label").alias("label"), F.min(F.struct("text_view", "meta_view")).alias("v")
    )
    found = sample.select("_id", "label", "v.*").toArrow().sort_by("_id").combine_chunks()
    if not found.num_rows:
        return None
    pool = rows.join(F.broadcast(chosen.select("_id")), rows["id"] == chosen["_id"], "left_anti")
    text, meta = _unpacked(found)
    # An even order of ids would put one kind of document in the held-out part.
    order = np.random.default_rng(seed).permutation(found.num_rows)
    return fit_views(text[order], meta[order], found["label"].to_numpy()[order], TablePool(pool), rounds, most_new)


def _scored(rows: DataFrame, model: CoTrained | None, threshold: float) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_score", "metadata_score", "score", "keep"]
        for batch in batches:
            found = model.scores(*_unpacked(batch)) if model and batch.num_rows else (np.ones(batch.num_rows),) * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(x.astype(np.float64)) for x in found], pa.array(found[2] >= threshold)], names
            )

    return rows.mapInArrow(run, "doc_id long, text_score double, metadata_score double, score double, keep boolean")


def score(docs: DataFrame, model: CoTrained | None, threshold: float = 0.5) -> DataFrame:
    """doc_id, text_score, metadata_score, score and keep (score at least ``threshold``) of every document.

    Null texts are empty, null metadata is a value like others, repeated rows
    are scored each. Without a model (no labels of both classes) nothing is
    known against a document: all scores are 1. No rows in, no rows out.
    """
    return _scored(describe(docs), model, threshold)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``score`` of every document by a model trained on ``labels``; the features are made once.

    Nulls, empty tables and repeated rows are handled as in ``score`` and
    ``train_described``; equal rows have equal scores. Other columns are not read.
    """
    rows = cut(describe(docs), "views")
    return _scored(rows, train_described(rows, labels), threshold)


def drop_rejected(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns, of any names; the features are made once."""
    rows = cut(describe(docs, whole=True), "views")
    model = train_described(rows.drop("row"), labels)
    if model is None:
        return docs

    schema = rows.schema["row"].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                kept = part.filter(pa.array(model.scores(*_unpacked(part))[2] >= threshold))
                yield pa.RecordBatch.from_arrays([kept.column("row")], ["row"])

    kept = rows.select("text_view", "meta_view", "row").mapInArrow(run, f"row {schema.simpleString()}")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
