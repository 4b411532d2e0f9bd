"""DuckDB SQL of whole linking: spelling rounds, the name round, and what comes of them.

Each round is a block of common table expressions of its own number. Links are applied one by one by a recursion
with a row for each scope, whose ``team`` has each node's cluster; nodes are numbered by credibility.
"""

from __future__ import annotations

from collections.abc import Callable

from ..operators.linking import CANNOT_LINK_US, NAMING, PRIORITY, ROUNDS, SPELLING


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def links(n: str, i: str, rules: list[str], judge: Callable[[str, str, str], str]) -> str:
    """Links of the identities ``i``: each partial form, all that it could stand for, its strongest option, and whether those agree."""
    priority = " ".join(f"WHEN '{r}' THEN {p}" for r, p in PRIORITY.items())
    return (
        judge(f"cand{n}", f"_l{n}", i)
        + f""", linked{n} AS MATERIALIZED (SELECT r.scope, x.r AS rule, x.v AS score, x.p AS partial, x.f AS "full", CASE x.r {priority} END AS priority, p.skel AS ps
  FROM ruled_l{n} r JOIN {i} p ON r.scope = p.scope AND x.p = p.key
  WHERE x.r IN {_in(rules)} AND NOT (x.r = 'surname' AND p.n_titles = 0) AND x.r <> 'given_name'),
options{n} AS MATERIALIZED (SELECT * FROM linked{n} WHERE rule <> 'ocr_variant'),
fulls{n} AS MATERIALIZED (SELECT scope, partial, "full" FROM options{n}
  UNION SELECT o.scope, o.partial, k.key FROM options{n} o JOIN {i} k ON o.scope = k.scope AND k.key <> o.partial AND (
    rule = 'truncation' AND length(k.skel) > length(ps) AND starts_with(k.skel, ps)
    OR rule = 'left_clip' AND length(k.skel) > length(ps) AND ends_with(k.skel, ps)
    OR rule = 'tail_noise' AND length(k.skel) BETWEEN 6 AND length(ps) - 1 AND starts_with(ps, k.skel))),
two{n} AS MATERIALIZED (SELECT x.scope, x.partial, x."full" AS a, y."full" AS b FROM fulls{n} x JOIN fulls{n} y ON x.scope = y.scope AND x.partial = y.partial AND x."full" < y."full"),
asked{n} AS MATERIALIZED (SELECT DISTINCT scope, a, b FROM two{n})
"""
        + judge(f"asked{n}", f"_c{n}", i)
        + f""", apart{n} AS MATERIALIZED (SELECT DISTINCT t.scope, t.partial FROM two{n} t JOIN ruled_c{n} r ON t.scope = r.scope AND t.a = r.a AND t.b = r.b
  WHERE x IS NULL OR x.r NOT IN {_in(SPELLING)}),
strongest{n} AS MATERIALIZED (SELECT o.* FROM options{n} o JOIN {i} k ON o.scope = k.scope AND o."full" = k.key
  QUALIFY row_number() OVER (PARTITION BY o.scope, o.partial ORDER BY priority, score DESC, k.us DESC, o."full") = 1)
"""
    )


def refusals(n: str) -> str:
    return f"""SELECT s.scope, s.partial, s.rule, s.score, array_to_string(list_sort(list(f."full"))[1:5], ',') AS fulls, count(*) AS n
  FROM strongest{n} s SEMI JOIN apart{n} USING (scope, partial) JOIN fulls{n} f ON s.scope = f.scope AND s.partial = f.partial
  GROUP BY s.scope, s.partial, s.rule, s.score"""


def best(n: str) -> str:
    return f"""SELECT scope, priority, score, partial, "full", rule FROM linked{n} WHERE rule = 'ocr_variant'
  UNION ALL SELECT scope, priority, score, partial, "full", rule FROM strongest{n} ANTI JOIN apart{n} USING (scope, partial)"""


def _merging(n: str, i: str, judge: Callable[[str, str, str], str]) -> str:
    """The links of round ``n`` one by one: what came of each (told), and each key's new name (step)."""
    team = lambda x: f"list_filter(range(1, len(w.team) + 1), lambda j: w.team[j] = w.team[l.{x}])"
    seen = lambda x: f"flatten(list_transform({team(x)}, lambda j: g.helds[j]))"
    return (
        f""", best{n} AS MATERIALIZED ({best(n)}),
ends{n} AS (SELECT scope, partial AS key FROM best{n} UNION SELECT scope, "full" FROM best{n}),
nodes{n} AS MATERIALIZED (SELECT scope, key, row_number() OVER (PARTITION BY scope ORDER BY NOT clipped, len(fw) >= 2, round_even(us / 1000, 0), key) AS idx
  FROM {i} SEMI JOIN ends{n} USING (scope, key)),
both{n} AS MATERIALIZED (SELECT x.scope, x.key AS a, y.key AS b FROM nodes{n} x JOIN nodes{n} y ON x.scope = y.scope AND x.key < y.key)
"""
        + judge(f"both{n}", f"_f{n}", i)
        + f""", fits{n} AS (SELECT scope, list(a || '|' || b) AS fits FROM ruled_f{n} WHERE x IS NOT NULL GROUP BY scope),
long{n} AS (SELECT scope, key, list(meeting) AS meetings FROM held{n} WHERE us >= {CANNOT_LINK_US} GROUP BY scope, key),
all{n} AS MATERIALIZED (SELECT scope, list(key ORDER BY idx) AS keys, list(coalesce(meetings, []) ORDER BY idx) AS helds, coalesce(any_value(fits), []) AS fits
  FROM nodes{n} LEFT JOIN long{n} USING (scope, key) LEFT JOIN fits{n} USING (scope) GROUP BY scope),
order{n} AS MATERIALIZED (SELECT b.*, x.idx AS ai, y.idx AS bi, row_number() OVER (PARTITION BY b.scope ORDER BY priority, score DESC, partial, "full") AS seq
  FROM best{n} b JOIN nodes{n} x ON b.scope = x.scope AND b.partial = x.key JOIN nodes{n} y ON b.scope = y.scope AND b."full" = y.key),
walk{n} AS (
  SELECT scope, 0::BIGINT AS seq, range(1, len(keys) + 1) AS team, '' AS act, []::VARCHAR[] AS shared, '' AS heads FROM all{n}
  UNION ALL
  SELECT scope, seq, CASE WHEN act = 'merge' THEN list_transform(team, lambda t: CASE WHEN t = ta THEN tb ELSE t END) ELSE team END, act, shared, keys[ha] || ' / ' || keys[hb]
  FROM (SELECT *, CASE WHEN ta = tb THEN 'same' WHEN len(shared) > 0 THEN 'meet'
      WHEN (ha <> ai OR hb <> bi) AND NOT list_contains(fits, least(keys[ha], keys[hb]) || '|' || greatest(keys[ha], keys[hb])) THEN 'drift' ELSE 'merge' END AS act
    FROM (SELECT w.scope, l.seq, w.team, l.ai, l.bi, w.team[l.ai] AS ta, w.team[l.bi] AS tb, g.keys, g.fits, list_max({team('ai')}) AS ha, list_max({team('bi')}) AS hb,
        list_sort(list_distinct(list_intersect({seen('ai')}, {seen('bi')}))) AS shared
      FROM walk{n} w JOIN order{n} l ON l.scope = w.scope AND l.seq = w.seq + 1 JOIN all{n} g ON g.scope = w.scope))),
told{n} AS MATERIALIZED (SELECT o.scope, o.partial AS a, o."full" AS b, o.rule, o.score,
    CASE act WHEN 'meet' THEN 'both on screen in the same meeting' WHEN 'drift' THEN 'cluster names disagree (' || heads || ')' END AS reason,
    CASE act WHEN 'meet' THEN array_to_string(shared[1:5], ',') ELSE '' END AS meetings
  FROM walk{n} w JOIN order{n} o ON o.scope = w.scope AND o.seq = w.seq WHERE act <> 'same'),
last{n} AS (SELECT scope, arg_max(team, seq) AS team FROM walk{n} GROUP BY scope),
step{n} AS MATERIALIZED (SELECT scope, keys[j] AS key, keys[list_max(list_filter(range(1, len(team) + 1), lambda k: team[k] = team[j]))] AS canonical
  FROM (SELECT l.scope, l.team, g.keys, unnest(range(1, len(l.team) + 1)) AS j FROM last{n} l JOIN all{n} g ON g.scope = l.scope)),
merges{n} AS MATERIALIZED (SELECT count(*) AS m FROM told{n} WHERE reason IS NULL)
"""
    )


def _next(n: int, described: Callable[[str, str], str]) -> str:
    """The pool as round ``n`` leaves it: the next round's identities, times by meeting, and pairs."""
    was, now = n, n + 1
    return f""", first{now} AS MATERIALIZED (SELECT f.scope, f.key, coalesce(s.canonical, f.canonical) AS canonical
  FROM first{was} f LEFT JOIN step{was} s ON f.scope = s.scope AND f.canonical = s.key),
held{now} AS MATERIALIZED (SELECT b.scope, f.canonical AS key, b.meeting, sum(b.us)::BIGINT AS us FROM bm b JOIN first{now} f ON b.scope = f.scope AND b.key = f.key GROUP BY ALL),
sums{now} AS (SELECT p.scope, f.canonical AS key, sum(us)::BIGINT AS us, sum(truncated_us)::BIGINT AS truncated_us, sum(n_titles)::BIGINT AS n_titles
  FROM pool p JOIN first{now} f ON p.scope = f.scope AND p.key = f.key GROUP BY ALL),
pool{now} AS (SELECT s.*, p.name FROM sums{now} s JOIN pool p ON p.scope = s.scope AND p.key = s.key)
{described(f"pool{now}", str(now))}, cand{now} AS MATERIALIZED (SELECT c.* FROM cand c SEMI JOIN i{now} x ON c.scope = x.scope AND c.a = x.key SEMI JOIN i{now} y ON c.scope = y.scope AND c.b = y.key)
"""


def linking(pool: str, described: Callable[[str, str], str], judge: Callable[[str, str, str], str]) -> str:
    """Everything up to ``mapping`` (scope, key, canonical) and ``evidence``."""
    out = pool.replace("WITH ", "WITH RECURSIVE ", 1)
    out += """, first1 AS (SELECT scope, key, key AS canonical FROM pool), held1 AS (SELECT scope, key, meeting, us FROM bm), i1 AS MATERIALIZED (SELECT * FROM i), cand1 AS MATERIALIZED (SELECT * FROM cand)
"""
    for n in range(1, ROUNDS + 1):
        out += links(str(n), f"i{n}", SPELLING, judge) + _merging(str(n), f"i{n}", judge) + _next(n, described)
    z = str(ROUNDS + 1)
    out += links(z, f"i{z}", NAMING, judge) + _merging(z, f"i{z}", judge)
    told = lambda n: f"SELECT scope, partial AS a, fulls AS b, rule, score, 'ambiguous: ' || n || ' candidates' AS reason, '' AS meetings FROM ({refusals(n)})"
    parts = [f"SELECT * FROM told{n} WHERE reason IS NULL" for n in range(1, ROUNDS + 1)]
    for n in range(1, ROUNDS + 1):  # only the first round that merges nothing tells what it refused
        here = f"(SELECT m FROM merges{n}) = 0" + (f" AND (SELECT m FROM merges{n - 1}) > 0" if n > 1 else "")
        parts += [f"SELECT * FROM ({told(str(n))}) WHERE {here}", f"SELECT * FROM told{n} WHERE reason IS NOT NULL AND {here}"]
    parts += [told(z), f"SELECT * FROM told{z}"]
    return out + f""", evidence AS MATERIALIZED ({" UNION ALL ".join(parts)}),
absorbed AS (SELECT DISTINCT scope, a AS key FROM evidence WHERE reason IS NULL AND rule <> 'ocr_variant'),
grouped AS (SELECT f.scope, f.key, coalesce(s.canonical, f.canonical) AS canonical FROM first{z} f LEFT JOIN step{z} s ON f.scope = s.scope AND f.canonical = s.key),
named_ AS (SELECT g.scope, g.canonical, g.key FROM grouped g JOIN i1 k ON g.scope = k.scope AND g.key = k.key LEFT JOIN absorbed x ON g.scope = x.scope AND g.key = x.key
  QUALIFY row_number() OVER (PARTITION BY g.scope, g.canonical ORDER BY x.key IS NULL DESC, NOT clipped DESC, len(fw) >= 2 DESC, round_even(us / 1000, 0) DESC, g.key DESC) = 1),
mapping AS MATERIALIZED (SELECT g.scope, g.key, n.key AS canonical FROM grouped g JOIN named_ n USING (scope, canonical))
"""


#: Of the people: time, meetings, titles and role of all their keys, and how many keys those are.
REGISTRY = """, keyed AS (SELECT m.canonical, s.* FROM sightings s JOIN mapping m ON s.scope = m.scope AND s.key = m.key),
own AS (SELECT scope, key, name FROM (SELECT scope, key, name, sum(us) AS us FROM sightings GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY scope, key ORDER BY us DESC, name) = 1)
SELECT k.scope, canonical AS speaker, CASE WHEN count(title) > 0 THEN 'Judge ' ELSE '' END || any_value(o.name) AS display, sum(us)::BIGINT AS us,
  count(DISTINCT meeting)::INT AS meetings, coalesce(string_agg(DISTINCT title, ','), '') AS titles, 'member' AS roles, count(DISTINCT k.key)::INT AS variants
FROM keyed k JOIN own o ON k.scope = o.scope AND k.canonical = o.key GROUP BY k.scope, canonical
"""
