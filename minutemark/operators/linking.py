"""Spellings of one person linked within a scope: blocked pairs, named rules, guards, clusters.

An identity is a row (scope, key, tokens, us, truncated_us, n_titles, held),
``held`` being an array of (meeting, us). A scope is a meeting or a collection;
nothing is compared across scopes.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..shared import cut, cut_all
from . import strings

#: Rules by strength. All but the first complete a partial form; the first four are about spelling.
PRIORITY = {"ocr_variant": 1, "truncation": 2, "tail_noise": 2, "left_clip": 3, "initial": 4, "surname": 5, "given_name": 6}
SPELLING = ["ocr_variant", "truncation", "tail_noise", "left_clip"]
NAMING = ["initial", "surname", "given_name"]
THRESHOLD = 0.88
CANNOT_LINK_US = 5_000_000
ROUNDS = 6
#: Links and held meetings of a scope that one task merges; larger scopes take rounds until so many are left.
SMALL = 20_000


def described(pool: DataFrame) -> DataFrame:
    """Identities with what the rules look at."""
    return pool.withColumns(
        {
            "skel": scalars.skeleton(F.col("key")),
            "surname": scalars.surname(F.col("tokens")),
            "given": scalars.given(F.col("tokens")),
            "cuts": scalars.boundaries(F.col("key"), F.col("tokens")),
            "clipped": F.col("truncated_us") > 0.5 * F.col("us"),
            "n_full": F.size(scalars.full_words(F.col("tokens"))),
        }
    ).withColumn("blocks", _blocks())


def _blocks() -> Column:
    """What identities that may be linked share one of: head, tail or a name part."""
    single, s = F.size("tokens") == 1, F.col("skel")
    short_first = (F.size("tokens") == 2) & (F.length(F.try_element_at("tokens", F.lit(1))) == 1)
    when = lambda test, kind, what: F.when(test, F.concat(F.lit(kind), what))
    blocks = F.array(
        F.concat(F.lit("h"), F.left(s, F.lit(2))),
        F.concat(F.lit("t"), F.right(s, F.lit(4))),
        when(F.col("surname") != "", "s", scalars.skeleton(F.col("surname"))),
        when(F.col("given") != "", "g", scalars.skeleton(F.col("given"))),
        when(single, "s", s),
        when(single, "g", s),
        when(single & (F.length("key") >= 5), "s", scalars.skeleton(F.substring("key", 2, 1000))),
        when(short_first, "s", scalars.skeleton(F.try_element_at("tokens", F.lit(2)))),
    )
    return F.array_distinct(F.filter(blocks, lambda b: b.isNotNull()))


def candidate_pairs(identities: DataFrame) -> DataFrame:
    """scope, a, b with a < b: all pairs that share a block, each once.

    Their number grows with the square of a block. Linking doesn't need them: see ``Index``.
    """
    blocks = identities.select("scope", "key", F.explode("blocks").alias("block"))
    left, right = blocks.withColumnRenamed("key", "a"), blocks.withColumnRenamed("key", "b")
    return left.join(right, ["scope", "block"]).filter("a < b").select("scope", "a", "b").distinct()


_FIELDS = ["key", "tokens", "us", "n_titles", "skel", "surname", "given", "cuts", "clipped", "blocks"]


def _sided(pairs: DataFrame, identities: DataFrame) -> DataFrame:
    one = lambda side: identities.select("scope", F.col("key").alias(side), F.struct(*_FIELDS).alias(f"i{side}"))
    return pairs.join(one("a"), ["scope", "a"]).join(one("b"), ["scope", "b"])


def pair_rule(pairs: DataFrame, identities: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Add to (scope, a, b) the strongest rule by which the two may be one person: rule, score, partial, full.

    Pairs that no rule links have a null rule; ``together`` says whether the two share a block. Only built-in
    expressions are used.
    """
    rows = _sided(pairs, identities)
    sa, sb = F.col("ia.skel"), F.col("ib.skel")
    longest = F.greatest(F.length(sa), F.length(sb))
    allowed = F.when(longest < 10, 0).when(longest < 18, 1).otherwise(2)
    alike = scalars.similarity(sa, sb)
    same_head = F.left(F.col("a"), F.lit(3)) == F.left(F.col("b"), F.lit(3))
    rows = rows.withColumns(
        {"alike": alike, "variant": (allowed > 0) & (F.levenshtein(sa, sb) <= allowed) & (alike >= threshold), "same_head": same_head}
    )
    a_short = (F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    rows = rows.withColumn("s", F.when(a_short, F.col("ia")).otherwise(F.col("ib"))).withColumn(
        "f", F.when(a_short, F.col("ib")).otherwise(F.col("ia"))
    )
    short, full = F.length("s.key"), F.length("f.key")
    ratio = short / full
    cut_into = full - short
    first = F.length(F.coalesce(F.try_element_at("f.tokens", F.lit(1)), F.lit("")))
    one_more = (F.size(F.filter("f.cuts", lambda c: c >= short)) == 1) & (F.size("s.tokens") >= 2) & (ratio >= 0.6)
    ends_inside = F.col("s.clipped") | ~F.array_contains("f.cuts", short) | one_more
    clipped = (short >= 6) & (short < full)
    prefix = clipped & scalars.prefix_match(F.col("s.skel"), F.col("f.skel")) & F.col("same_head") & ends_inside
    suffix = clipped & (ratio >= 0.6) & scalars.suffix_match(F.col("s.skel"), F.col("f.skel")) & (first > cut_into)
    at = F.instr(F.col("f.skel"), F.col("s.skel")) - 1
    inner = (short >= 8) & (short < full) & (ratio >= 0.6) & (at > 0) & (first > at) & (at + F.length("s.skel") < F.length("f.skel"))
    out = lambda rule, score, part, whole: F.struct(
        F.lit(rule).alias("rule"), score.cast("double").alias("score"), part.alias("partial"), whole.alias("full")
    )
    one = F.lit(1.0)
    rule = (
        F.when(sa == sb, out("ocr_variant", one, F.col("a"), F.col("b")))
        .when(F.col("variant") & F.col("same_head"), out("ocr_variant", F.col("alike"), F.col("a"), F.col("b")))
        .when(prefix & (F.col("s.clipped") | (F.col("s.us") <= F.col("f.us"))), out("truncation", ratio, F.col("s.key"), F.col("f.key")))
        .when(prefix, out("tail_noise", ratio, F.col("f.key"), F.col("s.key")))
        .when(suffix | inner, out("left_clip", ratio, F.col("s.key"), F.col("f.key")))
        .when(F.col("variant"), out("ocr_variant", F.col("alike"), F.col("a"), F.col("b")))
    )
    for x, y in (("ia", "ib"), ("ib", "ia")):
        key, size = F.col(f"{x}.key"), F.length(f"{x}.key")
        named = (F.col(f"{y}.surname") != "") & (F.col(f"{y}.given") != "") & ~F.col(f"{y}.clipped") & (size >= 5)
        initial = (
            named & (F.length(f"{y}.surname") >= 4) & (F.left(key, F.lit(1)) == F.left(F.col(f"{y}.given"), F.lit(1)))
            & (size < F.length(f"{y}.key")) & (scalars.skeleton(F.substring(key, 2, 1000)) == scalars.skeleton(F.col(f"{y}.surname")))
        )
        single = named & (F.size(f"{x}.tokens") == 1)
        rule = (
            rule.when(initial, out("initial", one, key, F.col(f"{y}.key")))
            .when(single & (F.col(f"{x}.skel") == scalars.skeleton(F.col(f"{y}.surname"))), out("surname", one, key, F.col(f"{y}.key")))
            .when(single & (F.col(f"{x}.skel") == scalars.skeleton(F.col(f"{y}.given"))), out("given_name", one, key, F.col(f"{y}.key")))
        )
    return rows.withColumn("_r", rule).select("scope", "a", "b", "_r.*", F.arrays_overlap("ia.blocks", "ib.blocks").alias("together"))


@dataclass
class Index:
    """What the keys of a pool have to do with each other by their letters alone, which merging doesn't change.

    ``pairs`` (scope, a, b): all pairs that a rule can link, and few others. ``heads`` and ``tails`` (scope, short,
    long): the skeletons of keys of six letters or more that begin or end a longer skeleton.
    """

    pairs: DataFrame
    heads: DataFrame
    tails: DataFrame

    @classmethod
    def of(cls, identities: DataFrame) -> Index:
        """Equal skeletons and name parts by equi-joins, clipped forms by sorted ranges, slips by deleted letters."""
        rows = identities.select("scope", "key", F.col("skel").alias("text"))
        opens, all_ = F.length("key") >= 6, F.lit(True)
        # A form clipped at both ends begins a rest of the full one that starts inside its first word.
        first = F.least(F.length(F.try_element_at("tokens", F.lit(1))), F.length("skel")) - 1
        starts = F.when(first >= 1, F.sequence(F.lit(1), first)).otherwise(F.expr("cast(array() as array<int>)"))
        rests = identities.select("scope", "key", F.explode(F.transform(starts, lambda i: F.substring("skel", i + 1, F.length("skel")))).alias("text"))
        flagged = lambda df, opens, takes: df.withColumns({"opens": opens, "takes": takes})
        texts = [
            (flagged(rows, opens, all_), "heads"),
            (flagged(rows.withColumn("text", F.reverse("text")), opens, all_), "tails"),
            (flagged(rows, F.length("key") >= 8, ~all_).unionByName(flagged(rests, ~all_, all_)), "rests"),
        ]
        with ThreadPoolExecutor(len(texts)) as pool:
            heads, tails, inner = pool.map(lambda t: cut(strings.prefix_join(t[0], F.col("opens"), F.col("takes"), t[1]).distinct(), t[1]), texts)
        clipped = [
            strings.clip_join(rows.filter(F.length("key") >= 6), "left", F.left("key", F.lit(3))),
            strings.clip_join(rows.filter(F.length("key") >= 6), "right", F.lit("")),
        ]
        near = strings.edit_join(rows.filter(F.length("text") >= 9), F.when(F.length("text") >= 16, 2).otherwise(1))
        named = identities.filter("surname <> '' AND given <> ''")
        one = F.size("tokens") == 1
        by = lambda df, short, *keys: df.select("scope", F.col("key").alias(short), *[k.alias(f"k{i}") for i, k in enumerate(keys)])
        left = F.left("key", F.lit(1))
        initial = by(identities.filter(F.length("key") >= 5), "short", scalars.skeleton(F.substring("key", 2, 1000)), left).join(
            by(named, "long", scalars.skeleton(F.col("surname")), F.left("given", F.lit(1))), ["scope", "k0", "k1"]
        )
        alone = by(identities.filter(one & (F.length("key") >= 5)), "short", F.col("skel"))
        surname = alone.join(by(named, "long", scalars.skeleton(F.col("surname"))), ["scope", "k0"])
        given = alone.join(by(named, "long", scalars.skeleton(F.col("given"))), ["scope", "k0"])
        equal = by(identities, "short", F.col("skel")).join(by(identities, "long", F.col("skel")), ["scope", "k0"]).filter("short < long")
        two = near.select("scope", F.col("a").alias("short"), F.col("b").alias("long"))
        for more in (heads, tails, inner, *clipped, initial, surname, given, equal):
            two = two.unionByName(more.select("scope", "short", "long"))
        two = two.filter("short <> long").select("scope", F.least("short", "long").alias("a"), F.greatest("short", "long").alias("b"))
        return cls(cut(two.distinct(), "linkable"), heads, tails)

    def judged(self, identities: DataFrame, threshold: float = THRESHOLD, was: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
        """The pairs of ``identities`` that a rule links: see ``pair_rule``.

        ``was``: the pairs as judged before, and the (scope, key) of identities that have changed or gone since; only their
        pairs are judged again.
        """
        pairs = self.pairs
        if was is not None:
            changed = [was[1].withColumnRenamed("key", side) for side in ("a", "b")]
            kept = was[0].join(changed[0], ["scope", "a"], "left_anti").join(changed[1], ["scope", "b"], "left_anti")
            pairs = pairs.join(changed[0], ["scope", "a"], "left_semi").unionByName(pairs.join(changed[1], ["scope", "b"], "left_semi")).distinct()
        ruled = pair_rule(pairs, identities, threshold).filter("rule IS NOT NULL")
        return cut(ruled if was is None else ruled.unionByName(kept), "judged")


def _priority(rule: Column) -> Column:
    table = F.create_map(*[F.lit(x) for item in PRIORITY.items() for x in item])
    return F.element_at(table, rule)


def _completions(options: DataFrame, identities: DataFrame, index: Index) -> DataFrame:
    """scope, partial, full: all keys that a partial form could stand for, close in length or not."""
    alive = identities.select("scope", F.col("key").alias("full"), F.length("skel").alias("_n"))
    by = lambda rule: options.filter(F.col("rule") == rule).select("scope", "partial").distinct()
    longer = lambda pairs: pairs.select("scope", F.col("short").alias("partial"), F.col("long").alias("full"))
    shorter = index.heads.select("scope", F.col("long").alias("partial"), F.col("short").alias("full"))
    found = by("truncation").join(longer(index.heads), ["scope", "partial"]).unionByName(by("left_clip").join(longer(index.tails), ["scope", "partial"]))
    found = found.join(alive, ["scope", "full"]).drop("_n")
    noisy = by("tail_noise").join(shorter, ["scope", "partial"]).join(alive.filter("_n >= 6"), ["scope", "full"]).drop("_n")
    return options.select("scope", "partial", "full").unionByName(found).unionByName(noisy).filter("partial <> full").distinct()


def _incoherent(fulls: DataFrame, spelt: DataFrame) -> DataFrame:
    """scope, partial: the partial forms whose completions aren't all spellings of each other.

    The first completion is compared with the others; of the forms that pass, the linked pairs among their completions are
    counted. So the work follows the links that there are, not the pairs that there could be.
    """
    sizes = fulls.groupBy("scope", "partial").agg(F.count(F.lit(1)).alias("n"), F.min("full").alias("a")).filter("n > 1")
    others = fulls.withColumnRenamed("full", "b")
    first = others.join(sizes, ["scope", "partial"]).join(spelt, ["scope", "a", "b"]).groupBy("scope", "partial").agg(F.count(F.lit(1)).alias("linked"))
    passed = cut(sizes.join(first, ["scope", "partial"]).filter("linked = n - 1").select("scope", "partial", "n"), "passed")
    some = fulls.join(passed.filter("n > 2"), ["scope", "partial"])
    pairs = some.withColumnRenamed("full", "a").join(spelt, ["scope", "a"]).join(some.select("scope", "partial", F.col("full").alias("b")), ["scope", "partial", "b"])
    whole = pairs.groupBy("scope", "partial").agg(F.count(F.lit(1)).alias("linked"), F.first("n").alias("n")).filter("linked = n * (n - 1) / 2")
    coherent = passed.filter("n = 2").select("scope", "partial").unionByName(whole.select("scope", "partial"))
    return sizes.select("scope", "partial").join(coherent, ["scope", "partial"], "left_anti")


def candidate_links(
    identities: DataFrame, rules: list[str], threshold: float = THRESHOLD, within_meeting: bool = False,
    index: Index | None = None, judged: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Links (scope, priority, score, partial, full, rule), and those refused (scope, partial, fulls, rule, n).

    A partial form is linked only if all keys that it could stand for are spellings of each other; of its
    options the strongest is taken. Across meetings a lone surname needs a title, a lone given name is never linked.
    ``index`` and ``judged`` are made where they aren't given.
    """
    index = index or Index.of(identities)
    judged = index.judged(identities, threshold) if judged is None else judged
    ruled = judged.filter(F.col("together") & F.col("rule").isin(rules))
    titled = identities.select("scope", F.col("key").alias("partial"), "n_titles")
    ruled = ruled.join(titled, ["scope", "partial"])
    if not within_meeting:
        ruled = ruled.filter("NOT (rule = 'surname' AND n_titles = 0) AND rule <> 'given_name'")
    ruled = ruled.withColumn("priority", _priority(F.col("rule"))).drop("a", "b", "n_titles", "together")
    options = ruled.filter("rule <> 'ocr_variant'")
    fulls = cut(_completions(options, identities, index), "completions")
    spelt = judged.filter(F.col("rule").isin(SPELLING)).select("scope", "a", "b")
    apart = cut(_incoherent(fulls, spelt), "apart")
    seconds = identities.select("scope", F.col("key").alias("full"), F.col("us").alias("full_us"))
    w = Window.partitionBy("scope", "partial").orderBy("priority", F.desc("score"), F.desc("full_us"), "full")
    best = options.join(seconds, ["scope", "full"]).withColumn("_rank", F.row_number().over(w)).filter("_rank = 1")
    columns = ["scope", "priority", "score", "partial", "full", "rule"]
    links = ruled.filter("rule = 'ocr_variant'").select(*columns).unionByName(best.join(apart, ["scope", "partial"], "left_anti").select(*columns))
    told = fulls.join(apart, ["scope", "partial"], "left_semi")
    few = told.withColumn("_rank", F.row_number().over(Window.partitionBy("scope", "partial").orderBy("full"))).filter("_rank <= 5")
    listed = few.groupBy("scope", "partial").agg(F.sort_array(F.collect_list("full")).alias("fulls"))
    sizes = told.groupBy("scope", "partial").agg(F.count(F.lit(1)).cast("int").alias("n"))
    refused = best.join(sizes, ["scope", "partial"]).join(listed, ["scope", "partial"])
    return links, refused.select("scope", "partial", "rule", "score", "fulls", "n")


def credibility(i: str | None = None) -> Column:
    """Not clipped, then of two full words or more, then long on screen, then the larger key."""
    c = lambda name: F.col(f"{i}.{name}" if i else name)
    return F.struct((~c("clipped")).alias("whole"), (c("n_full") >= 2).alias("full"), F.bround(c("us") / 1000, 0).alias("ms"), c("key").alias("key"))


def cluster(
    identities: DataFrame, links: DataFrame, judged: DataFrame, cannot_link_us: int | None = CANNOT_LINK_US, small: int = SMALL
) -> tuple[DataFrame, DataFrame]:
    """Merge by links: returns the mapping (scope, key, canonical) of linked keys, and the evidence.

    Links apply strongest first. Two clusters stay apart if both hold the screen for ``cannot_link_us`` in one meeting
    (None: no such guard), or if no rule of ``judged`` links the names that would stand for them.

    Scopes of up to ``small`` links and held meetings are done one by one, each in a task. In larger ones the order is kept in
    rounds over tables, until what is left is small: a link can be decided once nothing stronger touches either cluster. A
    cluster takes in a row all clusters whose strongest link leads to it (see ``_decided``), so a person with many
    spellings needs few rounds.
    """
    open_ = links.select(
        "scope", F.struct("priority", (-F.col("score")).alias("less"), "partial", "full").alias("o"), "rule", "score", F.col("partial").alias("ca"), F.col("full").alias("cb")
    )
    open_ = cut(open_, "open")
    ends = open_.select("scope", F.col("ca").alias("key")).unionByName(open_.select("scope", F.col("cb").alias("key"))).distinct()
    mine = identities.join(ends, ["scope", "key"])
    members = mine.select("scope", "key", F.col("key").alias("cluster"), credibility().alias("head"))
    lasting = F.filter("held", lambda h: h["us"] >= (cannot_link_us or 0))
    held = mine.select("scope", F.col("key").alias("cluster"), F.explode(lasting).alias("h")).select("scope", "cluster", F.col("h.meeting").alias("meeting"))
    held = held if cannot_link_us is not None else held.limit(0)
    fits = judged.select("scope", F.col("a").alias("low"), F.col("b").alias("high"))
    members, held = cut_all((members, "members"), (held, "held"))
    logs = []
    while True:
        heads = members.groupBy("scope", "cluster").agg(F.max("head").alias("head"))
        busy = open_.select("scope", F.lit(1).alias("n")).unionByName(held.join(open_.select("scope").distinct(), "scope", "left_semi").select("scope", F.lit(1).alias("n")))
        large = busy.groupBy("scope").agg(F.sum("n").alias("n")).filter(F.col("n") > small).select("scope")
        done = large.isEmpty()
        if done:
            decided = cut(_one_by_one(open_, heads, held, fits), "decided")
        else:
            large = cut(large, "large")
            decided = cut(_decided(open_.join(large, "scope", "left_semi"), heads, held, fits), "decided")
        logs.append(decided.filter("o IS NOT NULL"))
        into = decided.filter("reason IS NULL AND leaf IS NOT NULL").select("scope", F.col("leaf").alias("cluster"), F.col("hub").alias("to"))
        moved = lambda df, c: df.join(into.withColumnRenamed("cluster", c), ["scope", c], "left").withColumn(c, F.coalesce("to", c)).drop("to")  # noqa: E731, B023
        if done:
            members = moved(members, "cluster")
            break
        left = open_.join(decided.select("scope", "o"), ["scope", "o"], "left_anti")
        open_, members, held = cut_all((moved(moved(left, "ca"), "cb").filter("ca <> cb"), "open"), (moved(members, "cluster"), "members"), (moved(held, "cluster").distinct(), "held"))
    name = members.groupBy("scope", "cluster").agg(F.max("head")["key"].alias("canonical"))
    mapping = members.select("scope", "key", "cluster").join(name, ["scope", "cluster"]).select("scope", "key", "canonical")
    told = None
    for log in logs:
        log = log.select("scope", F.col("o.partial").alias("a"), F.col("o.full").alias("b"), "rule", "score", "reason", "meetings")
        told = log if told is None else told.unionByName(log)
    return mapping, told


def _one_by_one(open_: DataFrame, heads: DataFrame, held: DataFrame, fits: DataFrame) -> DataFrame:
    """All links of scopes that fit a task, in their order: what ``_decided`` returns, and rows (hub, leaf) without o of what became one."""
    ends = cut(open_.select("scope", F.col("ca").alias("cluster")).unionByName(open_.select("scope", F.col("cb").alias("cluster"))).distinct(), "ends")
    mine = heads.join(ends, ["scope", "cluster"], "left_semi")
    names = mine.select("scope", F.col("head.key").alias("k"))
    pairs = fits.join(names.withColumnRenamed("k", "low"), ["scope", "low"], "left_semi").join(names.withColumnRenamed("k", "high"), ["scope", "high"], "left_semi")
    kinds = {"x": "string", "y": "string", "head": heads.schema["head"].dataType.simpleString(), "o": open_.schema["o"].dataType.simpleString(), "rule": "string", "score": "double"}

    def rows(df: DataFrame, kind: int, **columns: str) -> DataFrame:
        return df.select("scope", F.lit(kind).alias("kind"), *[(F.col(columns[c]) if c in columns else F.lit(None).cast(t)).alias(c) for c, t in kinds.items()])

    every = (
        rows(mine, 0, x="cluster", head="head")
        .unionByName(rows(held.join(ends, ["scope", "cluster"], "left_semi"), 1, x="cluster", y="meeting"))
        .unionByName(rows(pairs, 2, x="low", y="high"))
        .unionByName(rows(open_, 3, x="ca", y="cb", o="o", rule="rule", score="score"))
    )

    def merge(table: pa.Table) -> pa.Table:
        head, seen, linkable, links = {}, defaultdict(set), set(), []
        for r in table.to_pylist():
            if r["kind"] == 0:
                h = r["head"]
                head[r["x"]] = (h["whole"], h["full"], h["ms"], h["key"])
            elif r["kind"] == 1:
                seen[r["x"]].add(r["y"])
            elif r["kind"] == 2:
                linkable.add((r["x"], r["y"]))
            else:
                links.append(r)
        root = {c: c for c in head}

        def find(c: str) -> str:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        out = []
        for r in sorted(links, key=lambda r: (r["o"]["priority"], r["o"]["less"], r["o"]["partial"], r["o"]["full"])):
            a, b = find(r["x"]), find(r["y"])
            if a == b:
                continue
            names, shared = [head[a][3], head[b][3]], sorted(seen[a] & seen[b])
            reason = None
            if shared:
                reason = "both on screen in the same meeting"
            elif names != [r["o"]["partial"], r["o"]["full"]] and tuple(sorted(names)) not in linkable:
                reason = f"cluster names disagree ({names[0]} / {names[1]})"
            else:
                root[a] = b
                head[b] = max(head[a], head[b])
                seen[b] |= seen[a]
            out.append((r["scope"], r["o"], r["rule"], r["score"], None, None, reason, shared[:5]))
        scope = table["scope"][0].as_py()
        out += [(scope, None, None, None, find(c), c, None, []) for c in root if find(c) != c]
        columns = list(zip(*out)) or [()] * 8
        kinds = [pa.string(), table.schema.field("o").type, pa.string(), pa.float64(), *[pa.string()] * 3, pa.list_(pa.string())]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["scope", "o", "rule", "score", "hub", "leaf", "reason", "meetings"])

    schema = f"scope string, o {kinds['o']}, rule string, score double, hub string, leaf string, reason string, meetings array<string>"
    return every.groupBy("scope").applyInArrow(merge, schema)


def _decided(open_: DataFrame, heads: DataFrame, held: DataFrame, fits: DataFrame) -> DataFrame:
    """Links whose outcome is certain now: scope, o, rule, score, hub, leaf, reason (null: merged), meetings.

    A hub is a cluster whose strongest link is its other end's strongest too, and which has more links than that end. Its
    leaves are the clusters whose strongest link leads to it; none is a leaf of two or a hub. Their strongest links are
    decided in their order, up to the first link from any of them to elsewhere; as long as no leaf shares a
    meeting with an earlier one, and none before it brings a more credible name; and up to the next link of a leaf that was refused.
    """
    one_way = lambda me, other: open_.select("scope", "o", F.col(me).alias("me"), F.col(other).alias("other"))
    ends = one_way("ca", "cb").unionByName(one_way("cb", "ca"))
    first = ends.groupBy("scope", "me").agg(F.min_by(F.struct("o", "other"), "o").alias("f"), F.count(F.lit(1)).alias("degree"))
    first = cut(first.select("scope", "me", F.col("f.o").alias("first"), F.col("f.other").alias("other"), "degree"), "first")
    back = first.select("scope", F.col("me").alias("other"), F.col("first").alias("_first"), F.col("degree").alias("_degree"))
    hubs = first.join(back, ["scope", "other"]).filter("first = _first AND struct(degree, me) > struct(_degree, other)").select("scope", F.col("me").alias("hub"))
    leaves = first.join(hubs.withColumnRenamed("hub", "other"), ["scope", "other"]).select("scope", F.col("me").alias("leaf"), F.col("other").alias("hub"), F.col("first").alias("o"))
    owners = leaves.select("scope", F.col("leaf").alias("c"), F.col("hub").alias("owner"), "o").unionByName(
        hubs.select("scope", F.col("hub").alias("c"), F.col("hub").alias("owner"), F.lit(None).cast(open_.schema["o"].dataType).alias("o"))
    )
    owners, leaves = cut_all((owners, "owners"), (leaves, "leaves"))
    of = lambda side: owners.select("scope", F.col("c").alias(f"c{side}"), F.col("owner").alias(f"o{side}"), F.col("o").alias(f"f{side}"))
    marked = open_.select("scope", "o", "ca", "cb").join(of("a"), ["scope", "ca"], "left").join(of("b"), ["scope", "cb"], "left")
    inside = F.coalesce(F.col("oa") == F.col("ob"), F.lit(False))
    stop = marked.filter(~inside).select("scope", "o", F.explode(F.array("oa", "ob")).alias("hub")).filter("hub IS NOT NULL").groupBy("scope", "hub").agg(F.min("o").alias("stop"))
    again = marked.filter(inside).select("scope", "o", F.explode(F.array(F.struct(F.col("ca").alias("leaf"), F.col("fa").alias("f")), F.struct(F.col("cb").alias("leaf"), F.col("fb").alias("f")))).alias("e"))
    again = again.filter("e.f <> o").groupBy("scope", F.col("e.leaf").alias("leaf")).agg(F.min("o").alias("again"))
    of_head = lambda side: heads.select("scope", F.col("cluster").alias(side), F.col("head").alias(f"{side}_head"))
    ready = leaves.join(stop, ["scope", "hub"], "left").filter("stop IS NULL OR o < stop").drop("stop").join(of_head("hub"), ["scope", "hub"]).join(of_head("leaf"), ["scope", "leaf"])
    ready = cut(ready.join(open_.select("scope", "o", "rule", "score", "ca"), ["scope", "o"]), "ready")
    here = ready.select("scope", "o", "hub", "leaf").join(held.withColumnRenamed("cluster", "leaf"), ["scope", "leaf"])
    earliest = here.groupBy("scope", "hub", "meeting").agg(F.min("o").alias("earliest"))
    later = here.join(earliest, ["scope", "hub", "meeting"]).filter("earliest < o").groupBy("scope", "hub").agg(F.min("o").alias("waits"))
    risen = ready.filter("leaf_head > hub_head").groupBy("scope", "hub").agg(F.min("o").alias("rises"))
    ready = ready.join(later, ["scope", "hub"], "left").join(risen, ["scope", "hub"], "left").filter("(waits IS NULL OR o < waits) AND (rises IS NULL OR o <= rises)")
    shared = here.join(held.withColumnRenamed("cluster", "hub"), ["scope", "hub", "meeting"])
    few = F.row_number().over(Window.partitionBy("scope", "o").orderBy("meeting"))
    shared = shared.withColumn("_rank", few).filter("_rank <= 5").groupBy("scope", "o").agg(F.sort_array(F.collect_list("meeting")).alias("meetings"))
    # The link's ends belong to the leaf and the hub in either order; the heads are named in that of the link.
    a_hub, of_hub, of_leaf = F.col("ca") == F.col("hub"), F.col("hub_head.key"), F.col("leaf_head.key")
    ready = ready.withColumns({"ha": F.when(a_hub, of_hub).otherwise(of_leaf), "hb": F.when(a_hub, of_leaf).otherwise(of_hub)})
    ready = ready.withColumns({"low": F.least("ha", "hb"), "high": F.greatest("ha", "hb")})
    ready = ready.join(fits.withColumn("fits", F.lit(True)), ["scope", "low", "high"], "left").join(shared, ["scope", "o"], "left")
    drift = ~((F.col("ha") == F.col("o.partial")) & (F.col("hb") == F.col("o.full"))) & F.col("fits").isNull()
    reason = F.when(F.col("meetings").isNotNull(), "both on screen in the same meeting").when(
        drift, F.concat(F.lit("cluster names disagree ("), "ha", F.lit(" / "), "hb", F.lit(")"))
    )
    none = F.expr("cast(array() as array<string>)")
    told = cut(ready.select("scope", "o", "rule", "score", "hub", "leaf", reason.alias("reason"), F.coalesce("meetings", none).alias("meetings")), "told")
    tried = told.filter("reason IS NOT NULL").join(again, ["scope", "leaf"]).groupBy("scope", "hub").agg(F.min("again").alias("again"))
    return told.join(tried, ["scope", "hub"], "left").filter("again IS NULL OR o < again").drop("again")


def aggregate(pool: DataFrame, mapping: DataFrame) -> DataFrame:
    """The pool rolled up to canonical keys: times and titles add up, tokens are the canonical's own."""
    mapped = pool.join(mapping, ["scope", "key"], "left").withColumn("canonical", F.coalesce("canonical", "key"))
    own = pool.select("scope", F.col("key").alias("canonical"), F.col("tokens").alias("own_tokens"))
    sums = mapped.groupBy("scope", "canonical").agg(
        F.sum("us").alias("us"), F.sum("truncated_us").alias("truncated_us"), F.sum("n_titles").alias("n_titles")
    )
    held = mapped.select("scope", "canonical", F.explode("held").alias("h")).groupBy("scope", "canonical", "h.meeting").agg(F.sum("h.us").alias("us"))
    held = held.groupBy("scope", "canonical").agg(F.sort_array(F.collect_list(F.struct("meeting", "us"))).alias("held"))
    rolled = sums.join(own, ["scope", "canonical"]).join(held, ["scope", "canonical"], "left")
    none = F.expr("cast(array() as array<struct<meeting: string, us: bigint>>)")
    return rolled.select(
        "scope", F.col("canonical").alias("key"), F.col("own_tokens").alias("tokens"), "us", "truncated_us", "n_titles", F.coalesce("held", none).alias("held")
    )


def _then(mapping: DataFrame, step: DataFrame) -> DataFrame:
    """First one mapping, then the next."""
    after = step.select("scope", F.col("key").alias("canonical"), F.col("canonical").alias("_next"))
    return mapping.join(after, ["scope", "canonical"], "left").select("scope", "key", F.coalesce("_next", "canonical").alias("canonical"))


def link_identities(
    pool: DataFrame, threshold: float = THRESHOLD, cannot_link_us: int | None = CANNOT_LINK_US, within_meeting: bool = False, rounds: int = ROUNDS
) -> tuple[DataFrame, DataFrame]:
    """Cluster a pool: (scope, key, canonical) of every key, and the evidence of merges and refusals.

    Spelling rules run until a round merges nothing, at most ``rounds`` times, each round judging uniqueness among the
    clusters of the one before; then the name rules run once. A cluster is named by its most credible key that was not
    merged as a partial form. All scopes go through each round together. What keys have to do with each other by their
    letters is found once; after a round only the pairs of identities that it changed are judged again.
    """
    pool = cut(pool, "pool")
    first = pool.select("scope", "key", F.col("key").alias("canonical"))
    whole = cut(described(pool), "identities")
    index = Index.of(whole)
    reduced, logs, judged = whole, [], index.judged(whole, threshold)

    def refusals(refused: DataFrame) -> DataFrame:
        return refused.select(
            "scope", F.col("partial").alias("a"), F.array_join("fulls", ",").alias("b"), "rule", "score",
            F.concat(F.lit("ambiguous: "), F.col("n").cast("string"), F.lit(" candidates")).alias("reason"),
            F.expr("cast(array() as array<string>)").alias("meetings"),
        )

    for _ in range(rounds):
        links, refused = candidate_links(reduced, SPELLING, threshold, within_meeting, index, judged)
        step, evidence = cluster(reduced, links, judged, cannot_link_us)
        merged = evidence.filter("reason IS NULL")
        if merged.isEmpty():
            logs += [refusals(refused), evidence]
            break
        logs.append(merged)
        first = cut(_then(first, step), "mapping")
        reduced = cut(described(aggregate(pool, first)), "identities")
        joined = step.filter("key <> canonical")
        changed = joined.select("scope", "key").unionByName(joined.select("scope", F.col("canonical").alias("key"))).distinct()
        judged = index.judged(reduced, threshold, (judged, changed))
    links, refused = candidate_links(reduced, NAMING, threshold, within_meeting, index, judged)
    second, evidence = cluster(reduced, links, judged, cannot_link_us)
    logs += [refusals(refused), evidence]
    told = logs[0]
    for log in logs[1:]:
        told = told.unionByName(log)
    told = cut(told, "evidence")
    partial = told.filter("reason IS NULL AND rule <> 'ocr_variant'").select("scope", F.col("a").alias("key"), F.lit(True).alias("absorbed")).distinct()
    grouped = whole.join(_then(first, second), ["scope", "key"]).join(partial, ["scope", "key"], "left")
    order = F.struct(F.col("absorbed").isNull().alias("stands"), credibility().alias("c"))
    name = grouped.groupBy("scope", "canonical").agg(F.max_by("key", order).alias("name"))
    mapping = grouped.select("scope", "key", "canonical").join(name, ["scope", "canonical"]).select("scope", "key", F.col("name").alias("canonical"))
    return cut(mapping, "linked"), told
