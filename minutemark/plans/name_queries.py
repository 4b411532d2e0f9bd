"""Queries of the name, label and linking operators, each with its SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as lex
from ..functions import scalars
from ..operators import labels, linking, registry
from ..shared import cut, ranked, shared_dir
from ..streaming.changes import changes_stream, run_available
from . import linking_sql
from . import recipes as r


def _words(spark: SparkSession, d: str) -> DataFrame:
    """Distinct words of the documents."""
    return r.table(spark, d, "documents").select(F.explode(F.split("text", r"\s+")).alias("word")).distinct()


def fold_text(spark: SparkSession, d: str) -> DataFrame:
    return _words(spark, d).select("word", scalars.fold(F.col("word")).alias("folded"))


def skeleton_keys(spark: SparkSession, d: str) -> DataFrame:
    keys = r.table(spark, d, "customer").select(F.lower("c_name").alias("key")).union(r.table(spark, d, "part").select(F.replace("p_name", F.lit(" "), F.lit(""))))
    return keys.distinct().select("key", scalars.skeleton(F.col("key")).alias("skeleton"))


def _sightings(spark: SparkSession, d: str) -> DataFrame:
    p = r.people(spark, d)
    return p.withColumns(
        {
            "ord": F.lit(0),
            "key": F.replace("name", F.lit(" "), F.lit("")),
            "tokens": F.split("name", " "),
            "titles": F.when(F.col("title").isNotNull(), F.array("title")).otherwise(F.expr("cast(array() as array<string>)")),
        }
    )


def _pool(spark: SparkSession, d: str) -> DataFrame:
    return registry.pool(_sightings(spark, d))


def pool_accumulate(spark: SparkSession, d: str) -> DataFrame:
    return _pool(spark, d).select("scope", "key", "us", "truncated_us", "n_titles", F.size("held").alias("n_meetings"), F.array_join("tokens", " ").alias("tokens"))


def name_parts(spark: SparkSession, d: str) -> DataFrame:
    i = linking.described(_pool(spark, d))
    return i.select("scope", "key", "surname", "given", F.array_join("cuts", ",").alias("cuts"), "clipped")


def credibility_rank(spark: SparkSession, d: str) -> DataFrame:
    """Each identity's place in its scope by credibility; a scope spreads over many ranges."""
    c = linking.described(_pool(spark, d)).select("scope", "key", linking.credibility().alias("c"))
    return ranked(c, ["scope"], [F.desc("c")], "credibility").select("scope", "key", (F.col("pos") + 1).cast("int").alias("place"))


def candidate_pairs(spark: SparkSession, d: str) -> DataFrame:
    return linking.candidate_pairs(linking.described(_pool(spark, d)))


def normalized_similarity(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return candidate_pairs(spark, d).select(
        "scope", "a", "b", scalars.similarity(a, b).alias("similarity"), F.coalesce(scalars.within_edits(a, b, 2), F.lit(False)).alias("within_two")
    )


def prefix_suffix_match(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return candidate_pairs(spark, d).select("scope", "a", "b", scalars.prefix_match(a, b).alias("prefix"), scalars.suffix_match(a, b).alias("suffix"))


def pair_rule(spark: SparkSession, d: str) -> DataFrame:
    """The pairs that a rule links; the index finds them without comparing whole blocks."""
    i = cut(linking.described(_pool(spark, d)), "identities")
    return linking.Index.of(i).judged(i).filter("together").drop("together")


def best_links(spark: SparkSession, d: str) -> DataFrame:
    return linking.candidate_links(cut(linking.described(_pool(spark, d)), "identities"), linking.SPELLING)[0]


def refused_links(spark: SparkSession, d: str) -> DataFrame:
    refused = linking.candidate_links(cut(linking.described(_pool(spark, d)), "identities"), linking.SPELLING)[1]
    return refused.withColumn("fulls", F.array_join("fulls", ","))


def link_identities(spark: SparkSession, d: str) -> DataFrame:
    return linking.link_identities(_pool(spark, d))[0]


def link_evidence(spark: SparkSession, d: str) -> DataFrame:
    return linking.link_identities(_pool(spark, d))[1].withColumn("meetings", F.array_join("meetings", ","))


def registry_people(spark: SparkSession, d: str) -> DataFrame:
    """The registry of the linked people."""
    seen = _sightings(spark, d)
    pool = registry.pool(seen)
    mapping, evidence = linking.link_identities(pool)
    people = registry.identities(pool, mapping, registry.renderings(seen), registry.words(seen, "titles"), registry.words(seen.withColumn("roles", F.array(F.lit("member"))), "roles"), evidence)
    return people.withColumns({"titles": F.array_join("titles", ","), "roles": F.array_join("roles", ","), "variants": F.size("variants")})


def display_names(spark: SparkSession, d: str) -> DataFrame:
    """Each key as its own person."""
    seen = _sightings(spark, d)
    mapping = registry.pool(seen).select("scope", "key", F.col("key").alias("canonical"))
    return registry.display_names(mapping, registry.renderings(seen), registry.words(seen, "titles"))


def token_class(spark: SparkSession, d: str) -> DataFrame:
    none = F.expr("cast(array('erent', 'thand') as array<string>)")
    folded = _words(spark, d).select(scalars.fold(F.col("word")).alias("folded")).distinct()
    return folded.select("folded", labels.token_class(F.col("folded"), none, F.lit(False)).alias("class"))


def parse_labels(spark: SparkSession, d: str) -> DataFrame:
    parsed = labels.parse_labels(r.raw_changes(spark, d).select("label").distinct())
    return parsed.select("label", "kind", "key", "truncated", F.array_join("titles", ",").alias("titles"))


def label_kinds(spark: SparkSession, d: str) -> DataFrame:
    return registry.label_kinds(labels.with_parsed(r.raw_changes(spark, d)))


def stream_rle_changes(spark: SparkSession, d: str) -> DataFrame:
    """The changes of the frame reads, found by a stream over them."""
    source = f"{shared_dir(spark, 'reads')}"
    r.frame_reads(spark, d).select("meeting", "ord", "t_us", "name").write.parquet(source)
    reads = spark.readStream.schema("meeting long, ord long, t_us long, name string").parquet(source)
    return run_available(changes_stream(reads), shared_dir(spark, "stream"))


_FOLD = "regexp_replace(lower(strip_accents({0})), '[^a-z0-9]', '', 'g')"


def _skel(x: str) -> str:
    chars = f"string_split(translate({x}, 'i1|05', 'lllos'), '')"
    return f"array_to_string(list_filter({chars}, lambda c, i: i = 1 OR c <> {chars}[i - 1]), '')"


_WORDS = r"words AS (SELECT DISTINCT unnest(string_split_regex(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents)"

def _described(pool: str, n: str) -> str:
    """Common table expressions, ending with ``i``: the identities of a pool with what the rules look at; ``n`` ends their names."""
    return f""", parts{n} AS (SELECT *, string_split(name, ' ') AS tokens, list_filter(string_split(name, ' '), lambda t: length(t) > 1) AS fw, {_skel('key')} AS skel,
  truncated_us > 0.5 * us AS clipped FROM {pool}),
named{n} AS (SELECT *, CASE WHEN len(fw) >= 2 THEN fw[-1] ELSE '' END AS surname, CASE WHEN len(tokens) >= 2 THEN tokens[1] ELSE '' END AS given,
  CASE WHEN len(fw) >= 2 AND array_to_string(fw, '') = key THEN fw ELSE tokens END AS cw FROM parts{n}),
i{n} AS MATERIALIZED (SELECT *, CASE WHEN len(cw) > 1 THEN list_transform(range(1, len(cw)), lambda n: length(array_to_string(cw[1:n], ''))) ELSE [] END AS cuts,
  {_skel('surname')} AS ssur, {_skel('given')} AS sgiv, {_skel('key[2:]')} AS stail, {_skel("coalesce(tokens[2], '')")} AS stwo FROM named{n})"""


_POOL = (
    r.SQL
    + f""", sightings AS (SELECT *, replace(name, ' ', '') AS key FROM people),
bm AS (SELECT scope, key, meeting::VARCHAR AS meeting, sum(us) AS us, sum(CASE WHEN truncated THEN us ELSE 0 END) AS tus, count(title) AS nt,
  min(name) AS name FROM sightings GROUP BY ALL),
pool AS (SELECT scope, key, arg_min(name, meeting) AS name, sum(us)::BIGINT AS us, sum(tus)::BIGINT AS truncated_us, sum(nt)::BIGINT AS n_titles, count(*) AS n_meetings
  FROM bm GROUP BY ALL)
"""
    + _described("pool", "")
    + f""", blocks AS (SELECT DISTINCT scope, key, block FROM (
  SELECT scope, key, 'h' || left(skel, 2) AS block FROM i UNION ALL SELECT scope, key, 't' || right(skel, 4) FROM i
  UNION ALL SELECT scope, key, 's' || ssur FROM i WHERE surname <> '' UNION ALL SELECT scope, key, 'g' || sgiv FROM i WHERE given <> ''
  UNION ALL SELECT scope, key, 's' || skel FROM i WHERE len(tokens) = 1 UNION ALL SELECT scope, key, 'g' || skel FROM i WHERE len(tokens) = 1
  UNION ALL SELECT scope, key, 's' || stail FROM i WHERE len(tokens) = 1 AND length(key) >= 5
  UNION ALL SELECT scope, key, 's' || stwo FROM i WHERE len(tokens) = 2 AND length(tokens[1]) = 1)),
cand AS MATERIALIZED (SELECT DISTINCT x.scope, x.key AS a, y.key AS b FROM blocks x JOIN blocks y ON x.scope = y.scope AND x.block = y.block AND x.key < y.key)
"""
)


def _sim(a: str, b: str) -> str:
    return f"(1 - levenshtein({a}, {b}) / greatest(length({a}), length({b})))"


def _pre(s: str, f: str, side: str) -> str:
    part = f"{side}({f}, length({s}))"
    return f"(length({s}) < length({f}) AND ({part} = {s} OR (length({s}) >= 10 AND {_sim(s, part)} >= 0.9)))"


def _rules(pairs: str, n: str = "", i: str = "i") -> str:
    """Common table expressions that judge a table of pairs; ``n`` ends their names, so that one query can hold two."""
    return f""", sides{n} AS (
  SELECT c.scope, c.a, c.b, x AS xa, y AS xb,
    CASE WHEN length(c.a) < length(c.b) OR (length(c.a) = length(c.b) AND c.a < c.b) THEN x ELSE y END AS s,
    CASE WHEN length(c.a) < length(c.b) OR (length(c.a) = length(c.b) AND c.a < c.b) THEN y ELSE x END AS f
  FROM {pairs} c JOIN {i} x ON c.scope = x.scope AND c.a = x.key JOIN {i} y ON c.scope = y.scope AND c.b = y.key),
facts{n} AS (
  SELECT *, {_sim('xa.skel', 'xb.skel')} AS alike, length(s.key) / length(f.key) AS ratio, length(f.key) - length(s.key) AS gone,
    left(a, 3) = left(b, 3) AS same_head, length(s.key) >= 6 AND length(s.key) < length(f.key) AS shorter, length(f.tokens[1]) AS first,
    levenshtein(xa.skel, xb.skel) <= CASE WHEN greatest(length(xa.skel), length(xb.skel)) < 10 THEN -1
      WHEN greatest(length(xa.skel), length(xb.skel)) < 18 THEN 1 ELSE 2 END AND {_sim('xa.skel', 'xb.skel')} >= 0.88 AS variant
  FROM sides{n}),
judged{n} AS (
  SELECT *, shorter AND same_head AND {_pre('s.skel', 'f.skel', 'left')} AND (s.clipped OR NOT list_contains(f.cuts, length(s.key))
      OR (len(list_filter(f.cuts, lambda c: c >= length(s.key))) = 1 AND len(s.tokens) >= 2 AND ratio >= 0.6)) AS pre,
    shorter AND ratio >= 0.6 AND {_pre('s.skel', 'f.skel', 'right')} AND first > gone AS suf,
    length(s.key) >= 8 AND shorter AND ratio >= 0.6 AND instr(f.skel, s.skel) > 1 AND first > instr(f.skel, s.skel) - 1
      AND instr(f.skel, s.skel) - 1 + length(s.skel) < length(f.skel) AS inn,
    xb.surname <> '' AND xb.given <> '' AND NOT xb.clipped AND length(a) >= 5 AS okb,
    xa.surname <> '' AND xa.given <> '' AND NOT xa.clipped AND length(b) >= 5 AS oka
  FROM facts{n}),
ruled{n} AS MATERIALIZED (
  SELECT scope, a, b, CASE
    WHEN xa.skel = xb.skel THEN {{'r': 'ocr_variant', 'v': 1.0::DOUBLE, 'p': a, 'f': b}}
    WHEN variant AND same_head THEN {{'r': 'ocr_variant', 'v': alike, 'p': a, 'f': b}}
    WHEN pre AND (s.clipped OR s.us <= f.us) THEN {{'r': 'truncation', 'v': ratio, 'p': s.key, 'f': f.key}}
    WHEN pre THEN {{'r': 'tail_noise', 'v': ratio, 'p': f.key, 'f': s.key}}
    WHEN suf OR inn THEN {{'r': 'left_clip', 'v': ratio, 'p': s.key, 'f': f.key}}
    WHEN variant THEN {{'r': 'ocr_variant', 'v': alike, 'p': a, 'f': b}}
    WHEN okb AND length(xb.surname) >= 4 AND left(a, 1) = left(xb.given, 1) AND length(a) < length(b) AND xa.stail = xb.ssur
      THEN {{'r': 'initial', 'v': 1.0, 'p': a, 'f': b}}
    WHEN okb AND len(xa.tokens) = 1 AND xa.skel = xb.ssur THEN {{'r': 'surname', 'v': 1.0, 'p': a, 'f': b}}
    WHEN okb AND len(xa.tokens) = 1 AND xa.skel = xb.sgiv THEN {{'r': 'given_name', 'v': 1.0, 'p': a, 'f': b}}
    WHEN oka AND length(xa.surname) >= 4 AND left(b, 1) = left(xa.given, 1) AND length(b) < length(a) AND xb.stail = xa.ssur
      THEN {{'r': 'initial', 'v': 1.0, 'p': b, 'f': a}}
    WHEN oka AND len(xb.tokens) = 1 AND xb.skel = xa.ssur THEN {{'r': 'surname', 'v': 1.0, 'p': b, 'f': a}}
    WHEN oka AND len(xb.tokens) = 1 AND xb.skel = xa.sgiv THEN {{'r': 'given_name', 'v': 1.0, 'p': b, 'f': a}} END AS x
  FROM judged{n})
"""


_RULES = _POOL + _rules("cand")

#: The spelling links of whole scopes.
_LINKS = _POOL + linking_sql.links("", "i", linking.SPELLING, _rules)

#: Linking from the first round to the last.
_LINKED = linking_sql.linking(_POOL, _described, _rules)


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_CLASS = f"""CASE WHEN folded = '' THEN 'empty'
  WHEN folded IN {_in(lex.DEVICE_WORDS)} OR {' OR '.join(f"(folded LIKE '%{e}' AND length(folded) > {len(e) + 2})" for e in lex.DEVICE_ENDINGS)} THEN 'device'
  WHEN regexp_matches(folded, '[0-9]') THEN 'digit' WHEN folded IN {_in(lex.SUFFIXES)} THEN 'suffix' WHEN folded IN {_in(lex.TITLES)} THEN 'title'
  WHEN folded IN {_in(lex.ROLE_WORDS)} OR folded IN ('erent', 'thand') THEN 'role' ELSE 'name' END"""

_KIND = "CASE WHEN label LIKE 'iPad%' THEN 'device' WHEN label = 'No Speaker' THEN 'noise' ELSE 'person' END"

ORACLES = {
    "fold_text": f"WITH {_WORDS} SELECT word, {_FOLD.format('word')} AS folded FROM words",
    "skeleton_keys": f"WITH k AS (SELECT lower(c_name) AS key FROM customer UNION SELECT replace(p_name, ' ', '') FROM part) SELECT key, {_skel('key')} AS skeleton FROM k",
    "pool_accumulate": _POOL + "SELECT scope, key, us, truncated_us, n_titles, n_meetings, name AS tokens FROM pool",
    "name_parts": _POOL + "SELECT scope, key, surname, given, array_to_string(cuts, ',') AS cuts, clipped FROM i",
    "credibility_rank": _POOL + """SELECT scope, key, row_number() OVER (PARTITION BY scope
        ORDER BY NOT clipped DESC, len(fw) >= 2 DESC, round_even(us / 1000, 0) DESC, key DESC) AS place FROM i""",
    "candidate_pairs": _POOL + "SELECT * FROM cand",
    "normalized_similarity": _POOL + f"SELECT scope, a, b, {_sim('a', 'b')} AS similarity, levenshtein(a, b) <= 2 AS within_two FROM cand",
    "prefix_suffix_match": _POOL + f"SELECT scope, a, b, {_pre('a', 'b', 'left')} AS prefix, {_pre('a', 'b', 'right')} AS suffix FROM cand",
    "pair_rule": _RULES + "SELECT scope, a, b, x.r AS rule, x.v AS score, x.p AS partial, x.f AS \"full\" FROM ruled WHERE x IS NOT NULL",
    "best_links": _LINKS + linking_sql.best(""),
    "refused_links": _LINKS + linking_sql.refusals(""),
    "link_identities": _LINKED + "SELECT * FROM mapping",
    "link_evidence": _LINKED + "SELECT * FROM evidence",
    "registry_people": _LINKED + linking_sql.REGISTRY,
    "display_names": _POOL + """, top AS (SELECT scope, key, name FROM (SELECT scope, key, name, sum(us) AS us FROM sightings GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY scope, key ORDER BY us DESC, name) = 1)
        SELECT scope, key AS canonical, CASE WHEN key || scope IN (SELECT key || scope FROM sightings WHERE title IS NOT NULL) THEN 'Judge ' ELSE '' END || name AS display FROM top""",
    "token_class": f"WITH {_WORDS}, f AS (SELECT DISTINCT {_FOLD.format('word')} AS folded FROM words) SELECT folded, {_CLASS} AS class FROM f",
    "parse_labels": r.SQL + f"""SELECT DISTINCT label, {_KIND} AS kind,
        CASE WHEN {_KIND} = 'person' THEN lower(replace(replace(replace(label, 'Judge ', ''), '..', ''), ' ', '')) ELSE '' END AS key,
        label LIKE '%..' AS truncated, CASE WHEN label LIKE 'Judge %' THEN 'judge' ELSE '' END AS titles FROM raw_changes""",
    "label_kinds": r.SQL + f"SELECT {_KIND} AS kind, count(*) AS n FROM raw_changes GROUP BY ALL",
    "stream_rle_changes": r.SQL + """SELECT meeting, ord, t_us, label AS name FROM raw_changes
        QUALIFY row_number() OVER (PARTITION BY meeting ORDER BY t_us, ord) = 1 OR label <> lag(label) OVER (PARTITION BY meeting ORDER BY t_us, ord)""",
}

QUERIES = {
    f.__name__: f
    for f in (
        fold_text, skeleton_keys, pool_accumulate, name_parts, credibility_rank, candidate_pairs, normalized_similarity,
        prefix_suffix_match, pair_rule, best_links, refused_links, link_identities, link_evidence, registry_people,
        display_names, token_class, parse_labels, label_kinds, stream_rle_changes,
    )
}
