"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, cut, ordered_prefix, text_or_empty, unused, word_count

#: Documents that meet in one task's fold, on average; the tree has log(rows) / log(BLOCK) levels.
BLOCK = 256

#: A document of more than a HEADth of its source's words is settled before the tree; a source has fewer than HEAD of them.
HEAD = 256

#: No document is taken more often than this.
MOST_COPIES = 3

_ITEM = "struct<doc_id: bigint, size: bigint, m: bigint, room: double, mass: double>"
_DONE = "array<struct<doc_id: bigint, size: bigint, m: bigint, up: int>>"


def _settled(item: str, up: int) -> str:
    return (
        f"array(named_struct('doc_id', {item}.doc_id, 'size', {item}.size, 'm', {item}.m, 'up', {up}))"
    )


def _moved(item: str, mass: str) -> str:
    return (
        f"named_struct('doc_id', {item}.doc_id, 'size', {item}.size, 'm', {item}.m, "
        f"'room', {item}.room, 'mass', {mass})"
    )


def _fold(seed: str) -> str:
    """Pivotal rounding of an array of items: all but one become integral, and their expected masses stay.

    Item a is the one carried along and b the next. Either a gives b the mass
    ``alpha`` or b gives a the mass ``beta``, the most that leaves both between 0
    and their size; the odds beta to alpha keep both expectations. After that at
    least one of the two is empty or full.
    """
    a, b = "acc.cur", "b"
    alpha = f"least({a}.mass, {b}.room - {b}.mass)"
    beta = f"least({b}.mass, {a}.room - {a}.mass)"
    chance = (
        f"(shiftrightunsigned(xxhash64({a}.doc_id, {a}.size, {b}.doc_id, {b}.size, {seed}), 11) / 9007199254740992D)"
    )

    def after(cur: str, done: str) -> str:
        return f"named_struct('cur', {cur}, 'done', concat(acc.done, {done}))"

    to_b = (
        f"if({a}.mass <= {b}.room - {b}.mass, {after(_moved(b, f'{b}.mass + {a}.mass'), _settled(a, 0))}, "
        f"{after(_moved(a, f'{a}.mass - ({b}.room - {b}.mass)'), _settled(b, 1))})"
    )
    to_a = (
        f"if({b}.mass <= {a}.room - {a}.mass, {after(_moved(a, f'{a}.mass + {b}.mass'), _settled(b, 0))}, "
        f"{after(_moved(b, f'{b}.mass - ({a}.room - {a}.mass)'), _settled(a, 1))})"
    )
    return (
        f"aggregate(slice(items, 2, size(items)), "
        f"named_struct('cur', cast(items[0] as {_ITEM}), 'done', cast(array() as {_DONE})), "
        f"(acc, b) -> if({chance} * ({alpha} + {beta}) < {beta}, {to_b}, {to_a}))"
    )


def _head_fold(seed: str) -> str:
    """Rounding of a source's large documents, each paired with the pool of all smaller ones; ``rate`` is left to the pool.

    The documents of the pool are all taken at one rate, so that words move between document a and the pool by changing
    it. Document a gets the rate rounded down or, with the chance ``f`` of its fraction, up; the pool gives the
    ``(1 - f) * room`` words that a gains then, or takes the ``f * room`` that it loses. What the pool can't balance
    between no and MOST_COPIES copies shrinks both by the same ``part``, so that expectations stay in any case.
    """
    rate, room, rest = "acc.rate", "a.room", "(acc.rest - a.room)"
    f = f"({rate} - floor({rate}))"
    part = (
        f"least(1D, coalesce({rate} * {rest} / nullif((1 - {f}) * {room}, 0), 1D), "
        f"coalesce(({MOST_COPIES} - {rate}) * {rest} / nullif({f} * {room}, 0), 1D))"
    )
    up = f"(shiftrightunsigned(xxhash64(a.doc_id, a.size, source, {seed}), 11) / 9007199254740992D) < {f}"
    after = f"{rate} + if({up}, {f} - 1, {f}) * {room} * {part} / {rest}"
    return (
        f"aggregate(items, named_struct('rate', rate, 'rest', cast(source_size as double), 'done', cast(array() as {_DONE})), "
        f"(acc, a) -> named_struct("
        f"'rate', if({rest} <= 0, {rate}, greatest(0D, least({MOST_COPIES}D, {after}))), 'rest', {rest}, "
        f"'done', concat(acc.done, array(named_struct("
        f"'doc_id', a.doc_id, 'size', a.size, 'm', a.m, 'up', int(floor({rate}) - base + int({up})))))))"
    )


#: Large documents first; ties by doc_id, null first.
_LARGE_FIRST = (
    "array_sort(items, (x, y) -> CASE WHEN x.room > y.room THEN -1 WHEN x.room < y.room THEN 1 "
    "WHEN x.doc_id < y.doc_id THEN -1 WHEN x.doc_id > y.doc_id THEN 1 "
    "WHEN x.doc_id IS NULL AND y.doc_id IS NOT NULL THEN -1 "
    "WHEN y.doc_id IS NULL AND x.doc_id IS NOT NULL THEN 1 "
    "WHEN x.mass < y.mass THEN -1 WHEN x.mass > y.mass THEN 1 ELSE 0 END)"
)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """A row for each source of ``sizes`` (source, size, m): source_size, target.

    Sources in the order of their code points, null last, have the weights in
    turn and share the sum of all sizes; no target exceeds MOST_COPIES times its
    source's size, and the excess goes to the others by weight. With targets
    ``min(cap, level * weight)``, the level is the largest of (total - caps of the
    first k sources) / (weights of the rest) over all k, the sources being in the
    order of cap / weight: two prefix sums, however many sources there are.
    """
    by_source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    by_source = by_source.withColumn("_last", F.col("source").isNull()).withColumn("_cap", MOST_COPIES * F.col("source_size"))
    ranked = ordered_prefix(by_source, ["_last", "source"], {}, "sources")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_index") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("_full_at", F.col("_cap") / F.col("weight"))
    ranked = ranked.drop("_count", "_index")
    filled = ordered_prefix(
        ranked, ["_full_at", "_last", "source"], {"_caps": "_cap", "_weights": "weight"}, "source-levels"
    )
    total = F.col("_caps_total") / MOST_COPIES
    level = filled.agg(
        F.max((total - F.col("_caps")) / (F.col("_weights_total") - F.col("_weights"))).alias("level")
    ).first()["level"]
    return filled.select(
        "source",
        "source_size",
        F.least(F.col("_cap").cast("double"), F.lit(float(level or 0.0)) * F.col("weight")).alias("target"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), seed: int = 11) -> DataFrame:
    """How many words of each document the mix takes.

    Returns doc_id, size (words of the text, null: 0), source_size, target (of
    its source), taken (size times the number of copies, 0 to 3) and source.

    A source's rate is target / source_size: a document is taken floor(rate)
    times, and the rest of the rate is its chance of one copy more. Pivotal
    rounding decides these. Documents with more than a HEADth of their source's
    words, fewer than HEAD in a source, come first, from the largest, each
    against all smaller ones of the source, whose common rate takes what it
    gains or loses. Beside large documents that rate can leave the two copies
    next to the source's, between 0 and MOST_COPIES; expected copies stay. Of the others blocks of about BLOCK documents of one source are
    folded, each leaves one undecided document, and these form the next level's
    blocks, until one is left for each source; it goes up with the chance that
    its mass has reached. So each document keeps its chance whatever the source's
    size. Mass moves between documents without loss: a source's taken words differ
    from its target by less than the size of the one document that is left, which has at
    most a HEADth of the source's words or is its smallest. Only what all smaller documents
    together can't balance is missed beyond that, as where one text is larger than the target.

    The block and the chances come from hashes of doc_id, size and ``seed``: reruns
    agree on any partitioning. Rows that repeat doc_id, source and size are
    decided together, as one document of their joint size, and each is
    returned. Documents without words are returned with taken 0, sources
    without words have target 0. A null doc_id is a doc_id like others; a null
    source is a source, with the last weight. No rows in, no rows out. Other
    columns are not read.
    """
    sizes = cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(text_or_empty()).cast("long").alias("size"),
        )
        .groupBy("doc_id", "source", "size")
        .agg(F.count(F.lit(1)).alias("m")),
        "sizes",
    )
    targets = cut(source_targets(sizes, weights), "targets").withColumnRenamed("source", "_source")
    # Spark broadcasts this side if it is below its size threshold, and else splits a hot source's rows.
    rated = sizes.join(targets, sizes["source"].eqNullSafe(targets["_source"]), "inner").drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = cut(rated.withColumn("base", F.floor(rate).cast("int")).withColumn("part", rate - F.floor(rate)), "rated")
    open_ = (F.col("part") > 0) & (F.col("size") > 0)
    info = ["source", "source_size", "target", "base"]
    settled = [rated.filter(~open_).select(*info, "doc_id", "size", "m", F.lit(0).alias("up"))]

    room = (F.col("size") * F.col("m")).cast("double")
    large = room * HEAD > F.col("source_size")
    item = F.struct("doc_id", "size", "m", room.alias("room"), (room * F.col("part")).alias("mass"))
    heads = (
        rated.filter(open_)
        .groupBy(*info, (F.col("base") + F.col("part")).alias("rate"))
        .agg(F.collect_list(F.when(large, item)).alias("items"), F.count(F.when(~large, 1)).alias("n_items"))
        .withColumn("items", F.expr(_LARGE_FIRST))
        .withColumn("out", F.expr(_head_fold(str(seed))))
    )
    heads = cut(heads.select(*info, "n_items", F.col("out.rate").alias("rate"), "out.done"), "heads")
    settled.append(heads.select(*info, F.explode("done").alias("d")).select(*info, "d.*"))
    pools = heads.select(F.col("source").alias("_source"), "n_items", "rate")
    rest = (
        rated.filter(open_ & ~large)
        .join(pools, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("base", F.floor("rate").cast("int"))
        .withColumn("part", F.col("rate") - F.floor("rate"))
    )
    settled.append(rest.filter("part = 0").select(*info, "doc_id", "size", "m", F.lit(0).alias("up")))
    level = rest.filter("part > 0").select(*info, "n_items", item.alias("item"))
    most = heads.agg(F.max("n_items")).first()[0] or 0
    depth = 0
    while True:
        most = -(-most // BLOCK)
        last = most <= 1
        blocks = F.ceil(F.col("n_items") / BLOCK).cast("long")
        place = F.pmod(F.xxhash64("item.doc_id", "item.size", F.lit(seed + depth)), blocks)
        folded = (
            level.groupBy(*info, blocks.alias("n_items"), place.alias("block"))
            .agg(F.collect_list("item").alias("items"))
            .withColumn("items", F.expr(_LARGE_FIRST))
        )
        folded = folded.withColumn("out", F.expr(_fold(str(seed + depth)))).select(*info, "n_items", "out.cur", "out.done")
        folded = cut(folded, f"level{depth}")
        settled.append(folded.select(*info, F.explode("done").alias("d")).select(*info, "d.*"))
        if last:
            break
        level = folded.select(*info, "n_items", F.col("cur").alias("item"))
        depth += 1
    # What is left of a source is one document's mass: its share of the room is the document's chance.
    chance = F.shiftrightunsigned(F.xxhash64("cur.doc_id", "cur.size", "source", F.lit(seed + depth + 1)), 11) / F.lit(float(2**53))
    settled.append(
        folded.select(
            *info, "cur.doc_id", "cur.size", "cur.m", (chance * F.col("cur.room") < F.col("cur.mass")).cast("int").alias("up")
        )
    )
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("base") + F.col("up"))).cast("long").alias("taken"),
        "source",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("_copy"),
    ).drop("_copy")


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), seed: int = 11) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; its columns, of any names, stay as they are.

    A document without words can fill no target: it is left out, as one that is taken 0 times.
    """
    plan = mix(docs, weights, seed).filter("taken > 0").select(
        F.col("doc_id").alias("_id"),
        F.col("source").alias("_source"),
        F.col("size").alias("_size"),
        (F.col("taken") / F.col("size")).cast("int").alias("_copies"),
    ).distinct()
    names = {c: unused(docs, c) for c in ("id", "source", "size", "copies")}
    plan = plan.select(*[F.col(f"_{c}").alias(name) for c, name in names.items()])
    mine = docs.withColumn(words := unused(docs, "words"), word_count(text_or_empty()).cast("long"))
    joined = mine.join(
        plan,
        mine["doc_id"].cast("long").eqNullSafe(plan[names["id"]])
        & mine["source"].cast("string").eqNullSafe(plan[names["source"]])
        & (mine[words] == plan[names["size"]]),
    )
    again = F.explode(F.sequence(F.lit(1), F.col(names["copies"])))
    return joined.withColumn(unused(docs, "copy"), again).select(*docs.columns)
