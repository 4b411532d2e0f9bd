"""Rules, guards and clusters on small pools."""

import pytest

from minutemark.operators import linking

POOL = "scope string, key string, tokens array<string>, us long, truncated_us long, n_titles long, held array<struct<meeting: string, us: long>>"


def person(key, tokens, seconds=1, clipped=False, meeting="m1", scope="c", titles=0):
    us = int(seconds * 1_000_000)
    return (scope, key, tokens.split(), us, us if clipped else 0, titles, [(meeting, us)])


def pool(spark, *people):
    return spark.createDataFrame(list(people), POOL)


PAIRS = [
    (person("billdobson", "bill dobson"), person("lldobson", "ll dobson"), ("left_clip", "lldobson", "billdobson")),
    (person("robertjtorr", "robert j torr", clipped=True), person("robertjtorres", "robert j torres"), ("truncation", "robertjtorr", "robertjtorres")),
    (person("achen", "a chen"), person("alicechen", "alice chen"), ("initial", "achen", "alicechen")),
    (person("johnsmith", "john smith"), person("joansmith", "joan smith"), None),
    (person("waynechristian", "wayne christian"), person("waynechristians", "wayne christians"), ("ocr_variant", "waynechristian", "waynechristians")),
    (person("waynechristian", "wayne christian", 9e4), person("waynechristiasu", "wayne christiasu"), ("tail_noise", "waynechristiasu", "waynechristian")),
    (person("ichaelgrana", "ichael grana"), person("michaelgrana", "michael grana"), ("left_clip", "ichaelgrana", "michaelgrana")),
    (person("aynechristi", "ayne christi"), person("waynechristian", "wayne christian"), ("left_clip", "aynechristi", "waynechristian")),
    (person("gardi", "gardi"), person("annagardi", "anna gardi"), ("surname", "gardi", "annagardi")),
    (person("brandy", "brandy"), person("brandykeller", "brandy keller"), ("given_name", "brandy", "brandykeller")),
]


@pytest.mark.parametrize("x,y,want", PAIRS, ids=[p[0][1] for p in PAIRS])
def test_pair_rule(spark, x, y, want):
    identities = linking.described(pool(spark, x, y))
    a, b = sorted((x[1], y[1]))
    (row,) = linking.pair_rule(spark.createDataFrame([("c", a, b)], "scope string, a string, b string"), identities).collect()
    assert ((row.rule, row.partial, row.full) if row.rule else None) == want


def test_two_candidates_are_refused(spark):
    identities = linking.described(pool(spark, person("achen", "a chen"), person("alicechen", "alice chen"), person("adamchen", "adam chen")))
    links, refused = linking.candidate_links(identities, linking.NAMING)
    assert links.count() == 0
    assert [(r.partial, r.fulls, r.n) for r in refused.collect()] == [("achen", ["adamchen", "alicechen"], 2)]


def test_surname_needs_a_title_across_meetings(spark):
    two = [person("annagardi", "anna gardi")]
    for titles, within, n in ((0, False, 0), (1, False, 1), (0, True, 1)):
        identities = linking.described(pool(spark, person("gardi", "gardi", titles=titles), *two))
        assert linking.candidate_links(identities, linking.NAMING, within_meeting=within)[0].count() == n


def test_clusters(spark):
    people = [
        person("patriciaocanaolivarez", "patricia ocanaolivarez", 900, meeting="m1"),
        person("patriciaocanaoli", "patricia ocanaoli", 300, True, "m2"),
        person("patriciaocanaoliv", "patricia ocanaoliv", 200, True, "m3"),
        person("johnwall", "john wall", 60, meeting="m1"),
        person("johnwali", "john wali", 60, meeting="m1"),
        person("patriciaocanaoli", "patricia ocanaoli", 300, True, "m2", scope="other"),
    ]
    mapping, evidence = linking.link_identities(pool(spark, *people))
    rows = mapping.collect()
    assert len(rows) == len(people)
    assert {r.canonical for r in rows if r.scope == "c"} == {"johnwali", "johnwall", "patriciaocanaolivarez"}
    assert {r.canonical for r in rows if r.scope == "other"} == {"patriciaocanaoli"}
    assert [r.reason for r in evidence.collect() if r.reason] == ["both on screen in the same meeting"]
    free, _ = linking.link_identities(pool(spark, *people), cannot_link_us=None)
    assert len({r.canonical for r in free.collect() if r.scope == "c"}) == 2


def test_input_order_does_not_matter(spark):
    people = [person(k, t, s, c) for k, t, s, c in [
        ("waynechristian", "wayne christian", 500, False), ("waynechristians", "wayne christians", 20, False), ("waynechristia", "wayne christia", 5, True),
        ("waynechristiasu", "wayne christiasu", 3, False), ("wchristian", "w christian", 9, False), ("johnmoore", "john moore", 50, False), ("johnmo", "john mo", 4, True),
    ]]
    results = []
    for order in (people, people[::-1]):
        mapping, _ = linking.link_identities(pool(spark, *order), cannot_link_us=None)
        results.append(sorted((r.key, r.canonical) for r in mapping.collect()))
    assert results[0] == results[1]
    assert dict(results[0])["waynechristia"] == "waynechristian" and dict(results[0])["johnmo"] == "johnmoore"
