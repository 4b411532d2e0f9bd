"""Joins on strings, guarded merging in rounds and coherence against plain loops over all pairs."""

import random
from collections import defaultdict
from itertools import combinations

from pyspark.sql import functions as F

from minutemark.operators import linking, strings

from .test_linking import POOL

ROWS = "scope string, key string, text string"
GIVEN = ["patricia", "wayne", "jo", "maria", "christopher", "ann", "bernadette"]
FAMILY = ["ocanaolivarez", "christian", "smith", "li", "garcialopez", "vanderbiltson", "moore", "oneil"]


def spelt(draw, n):
    """Names with slips, cut heads and tails, initials and lone parts; some are very long."""
    out = {}
    while len(out) < n:
        words = [draw.choice(GIVEN), *draw.sample(FAMILY, draw.choice([1, 1, 1, 2, 3]))]
        kind = draw.random()
        text = " ".join(words)
        if kind < 0.35:
            for _ in range(draw.choice([1, 1, 2, 3])):
                i = draw.randrange(len(text))
                text = draw.choice([text[:i] + text[i + 1 :], text[:i] + draw.choice("abiloe1") + text[i:], text[:i] + draw.choice("abilo0") + text[i + 1 :]])
        elif kind < 0.55:
            text = text[: draw.randrange(6, len(text) + 1)]
        elif kind < 0.7:
            text = text[draw.randrange(0, 5) :]
        elif kind < 0.75:
            text = text[draw.randrange(1, 4) : -draw.randrange(1, 4)]
        elif kind < 0.82:
            text = words[0][0] + " " + words[-1]
        elif kind < 0.9:
            text = draw.choice(words)
        tokens = text.split()
        if tokens and "".join(tokens):
            out["".join(tokens)] = tokens
    return out


def pool(spark, draw, scopes, n):
    rows = []
    for s in range(scopes):
        for key, tokens in spelt(draw, n).items():
            us = draw.choice([1, 3, 9, 40]) * 1_000_000
            held = sorted((f"m{m}", us // 2) for m in draw.sample(range(6), 2))
            rows.append((f"s{s}", key, tokens, us, draw.choice([0, 0, 0, us]), draw.choice([0, 1]), held))
    return spark.createDataFrame(rows, POOL)


def test_string_joins_find_all_pairs(spark):
    draw = random.Random(1)
    texts = {k: v for k, v in ((k, "".join(t)) for k, t in spelt(draw, 260).items())}
    texts |= {f"x{k}": v for k, v in list(texts.items())[:20]}  # equal texts
    rows = [(s, k, t) for s in ("a", "b") for k, t in texts.items()] + [("c", "one", "p"), ("c", "two", "pé"), ("c", "three", "p\U0001f600")]
    df = spark.createDataFrame(rows, ROWS)
    by = defaultdict(list)
    for s, k, t in rows:
        by[s].append((k, t))
    got = {tuple(r) for r in strings.prefix_join(df, F.length("text") >= 1, F.lit(True)).collect()}
    assert got == {(s, x, y) for s, ks in by.items() for x, tx in ks for y, ty in ks if len(tx) < len(ty) and ty.startswith(tx)}
    some = strings.prefix_join(df, F.length("text") >= 8, F.length("text") % 2 == 0).collect()
    assert {tuple(r) for r in some} == {(s, x, y) for s, x, y in got if len(dict(by[s])[x]) >= 8 and len(dict(by[s])[y]) % 2 == 0}
    edits = lambda a, b: F.levenshtein(a, b)
    sides = df.select("scope", F.col("key").alias("a"), F.col("text").alias("ta")).join(df.select("scope", F.col("key").alias("b"), F.col("text").alias("tb")), "scope").filter("a <> b")
    long = F.col("text")
    near = {tuple(r) for r in strings.edit_join(df.filter(F.length(long) >= 9), F.when(F.length(long) >= 16, 2).otherwise(1)).collect()}
    least = F.least(F.length("ta"), F.length("tb"))
    within = sides.filter((least >= 9) & (edits("ta", "tb") <= F.when(F.greatest(F.length("ta"), F.length("tb")) >= 18, F.when(least >= 16, 2).otherwise(1)).otherwise(1)))
    assert {tuple(r) for r in within.filter("a < b").select("scope", "a", "b").collect()} <= near
    for side, of in (("left", F.left), ("right", F.right)):
        want = sides.filter((F.length("ta") >= 10) & (F.length("ta") < F.length("tb")) & (edits(F.col("ta"), of(F.col("tb"), F.length("ta"))) * 10 <= F.length("ta")))
        assert {tuple(r) for r in strings.clip_join(df, side, F.lit("")).collect()} == {tuple(r) for r in want.select("scope", "a", "b").collect()}


def test_index_loses_no_pair_that_a_rule_links(spark):
    identities = linking.described(pool(spark, random.Random(2), 3, 220)).cache()
    keys = identities.select("scope", "key")
    everything = keys.withColumnRenamed("key", "a").join(keys.withColumnRenamed("key", "b"), "scope").filter("a < b")
    want = {tuple(r) for r in linking.pair_rule(everything, identities).filter("rule IS NOT NULL").collect()}
    index = linking.Index.of(identities)
    judged = index.judged(identities)
    assert {tuple(r) for r in judged.collect()} == want
    assert len({r[3] for r in want}) == 7  # every rule is met
    assert index.pairs.count() < everything.count() / 4
    blocked = {tuple(r) for r in linking.candidate_pairs(identities).collect()}
    assert {r[:3] for r in want if r[7]} == {r[:3] for r in want} & blocked
    # only what has changed is judged again
    changed = identities.filter("length(key) % 5 = 0").select("scope", "key")
    longer = identities.withColumn("us", F.when(F.length("key") % 5 == 0, F.lit(10**9)).otherwise(F.col("us")))
    again = index.judged(longer, was=(judged, changed))
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in index.judged(longer).collect()}


def greedy(people, links, fits, least):
    """Links one by one, strongest first: clusters and what was said."""
    team = {k: {k} for k in people}
    said = []
    for _, _, a, b, rule, score in sorted((p, -s, a, b, r, s) for p, s, a, b, r in links):
        if team[a] is team[b]:
            continue
        seen = [set().union(*({m for m, us in people[k][1] if us >= least} for k in team[x])) if least is not None else set() for x in (a, b)]
        shared = sorted(seen[0] & seen[1])
        heads = [max(team[x], key=lambda k: people[k][0]) for x in (a, b)]
        reason = None
        if shared:
            reason = "both on screen in the same meeting"
        elif heads != [a, b] and tuple(sorted(heads)) not in fits:
            reason = f"cluster names disagree ({heads[0]} / {heads[1]})"
        else:
            both = team[a] | team[b]
            team.update(dict.fromkeys(both, both))
        said.append((a, b, rule, score, reason, tuple(shared[:5]) if reason else ()))
    return {k: max(t, key=lambda x: people[x][0]) for k, t in team.items()}, said


def test_merging_in_rounds_keeps_the_order_of_one_by_one(spark):
    """Random pools and links: chains, hubs, meetings that clash and names that disagree."""
    draw = random.Random(3)
    rows, links, fits, plain = [], [], [], {}
    for s in range(16):
        n, scope = [2, 5, 7, 9][s % 4], f"s{s}"
        keys = [f"{draw.choice('abcdefgh') * draw.randint(1, 3)}{i:02d}" for i in range(n)]
        own = [(scope, k, [k, "x"], draw.randint(1, 9) * 1_000_000, 0, 0, [(f"m{m}", draw.choice([1, 6]) * 1_000_000) for m in draw.sample(range(40), draw.choice([0, 1, 2]))]) for k in keys]
        rows += own
        hub = draw.choice(keys)
        pairs = set(draw.sample(list(combinations(sorted(keys), 2)), min(n * (n - 1) // 2, draw.choice([n, 2 * n])))) | {tuple(sorted((hub, k))) for k in keys if k != hub and s % 2}
        mine = [(scope, draw.choice([1, 2, 3]), draw.choice([0.8, 0.9, 1.0]), *draw.sample(p, 2), "truncation") for p in sorted(pairs)]
        fit = {p for p in combinations(sorted(keys), 2) if draw.random() < 0.6}
        links += mine
        fits += [(scope, a, b) for a, b in fit]
        plain[scope] = (own, mine, fit)
    identities = linking.described(spark.createDataFrame(rows, POOL))
    named = {(r.scope, r.key): (r.c.whole, r.c.full, r.c.ms, r.c.key) for r in identities.select("scope", "key", linking.credibility().alias("c")).collect()}
    df = spark.createDataFrame(links, "scope string, priority int, score double, partial string, full string, rule string")
    judged = spark.createDataFrame(fits, "scope string, a string, b string")
    few = ("s0", "s1", "s2")
    # in rounds alone, in rounds until few links are left, and scope by scope
    for least, scopes, small in ((5_000_000, list(plain), 0), (5_000_000, list(plain), 18), (5_000_000, list(plain), 10**6), (None, few, 10**6)):
        mapping, evidence = linking.cluster(identities, df.filter(F.col("scope").isin(*scopes)), judged, least, small)
        got, said = defaultdict(dict), defaultdict(list)
        for r in mapping.collect():
            got[r.scope][r.key] = r.canonical
        for r in evidence.collect():
            said[r.scope].append((r.a, r.b, r.rule, r.score, r.reason, tuple(r.meetings)))
        for scope, (own, mine, fit) in ((x, plain[x]) for x in scopes):
            ends = {k for x in mine for k in x[3:5]}
            people = {r[1]: (named[scope, r[1]], r[6]) for r in own if r[1] in ends}
            clusters, told = greedy(people, [x[1:] for x in mine], fit, least)
            assert got[scope] == clusters
            assert sorted(said[scope], key=repr) == sorted(told, key=repr)


def test_partial_forms_with_many_completions(spark):
    """2000 names begin with one form: it is refused; where all completions spell one person it is linked."""
    people = [("c", f"patriciaocana{i:04d}x", ["patricia", f"ocana{i:04d}x"], 5_000_000, 0, 0, []) for i in range(2000)]
    people += [("c", "patriciaoca", ["patricia", "oca"], 1_000_000, 1_000_000, 0, [])]
    people += [("d", k, ["wayne", k[5:]], 9_000_000 - 1000 * i, 0, 0, []) for i, k in enumerate(["waynechristian", "waynechristiam", "waynechristiar"])]
    people += [("d", "waynechrist", ["wayne", "christ"], 1_000_000, 1_000_000, 0, [])]
    identities = linking.described(spark.createDataFrame(people, POOL))
    links, refused = linking.candidate_links(identities, ["truncation"])
    assert [(r.scope, r.partial, r.full) for r in links.collect()] == [("d", "waynechrist", "waynechristian")]
    assert [(r.partial, r.n, r.fulls[0], len(r.fulls)) for r in refused.collect()] == [("patriciaoca", 2000, "patriciaocana0000x", 5)]
    fulls = spark.createDataFrame([("s", p, f) for p, n in (("one", 1), ("two", 2), ("all", 6), ("most", 6), ("pivot", 6)) for f in [f"{p}{i}" for i in range(n)]], "scope string, partial string, full string")
    spelt_ = [("s", f"{p}{i}", f"{p}{j}") for p, n in (("two", 2), ("all", 6), ("most", 6), ("pivot", 6)) for i, j in combinations(range(n), 2)]
    spelt_ = [x for x in spelt_ if x not in {("s", "most3", "most5"), ("s", "pivot0", "pivot4")}]
    got = linking._incoherent(fulls, spark.createDataFrame(spelt_, "scope string, a string, b string"))
    assert sorted(r.partial for r in got.collect()) == ["most", "pivot"]
