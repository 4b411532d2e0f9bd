"""Evidence pools from parsed labels, and the registry of people that linking makes of them.

Ties among equally frequent renderings, titles and roles go to the one first in the alphabet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as lex

BODY = ["scope", "key"]


def label_kinds(parsed_changes: DataFrame) -> DataFrame:
    """How many changes (not distinct labels) are of each kind."""
    return parsed_changes.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def pool(sightings: DataFrame) -> DataFrame:
    """Identities of (scope, meeting, ord, key, tokens, us, truncated, titles): see linking for the columns."""
    by_meeting = sightings.groupBy("scope", "key", F.col("meeting").cast("string").alias("meeting")).agg(
        F.sum("us").alias("us"),
        F.sum(F.when(F.col("truncated"), F.col("us")).otherwise(0)).alias("truncated_us"),
        F.sum(F.size("titles")).cast("long").alias("n_titles"),
        F.min_by("tokens", F.struct("ord")).alias("tokens"),
    )
    return by_meeting.groupBy("scope", "key").agg(
        F.min_by("tokens", "meeting").alias("tokens"),
        F.sum("us").alias("us"),
        F.sum("truncated_us").alias("truncated_us"),
        F.sum("n_titles").alias("n_titles"),
        F.sort_array(F.collect_list(F.struct("meeting", "us"))).alias("held"),
    )


def renderings(sightings: DataFrame) -> DataFrame:
    """scope, key, name, us: how long each spelling as displayed was on screen."""
    return sightings.groupBy("scope", "key", "name").agg(F.sum("us").alias("us"))


def words(sightings: DataFrame, column: str) -> DataFrame:
    """scope, key, word, n: titles or roles, counted once for each interval."""
    return sightings.select("scope", "key", F.explode(column).alias("word")).groupBy("scope", "key", "word").agg(F.count(F.lit(1)).alias("n"))


def top_k(rows: DataFrame, keys: list[str], measure: str, value: str, k: int, name: str) -> DataFrame:
    """The ``k`` values of the largest measures of each key, as an array."""
    w = Window.partitionBy(*keys).orderBy(F.desc(measure), value)
    ranked = rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k)
    listed = ranked.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_rank", F.col(value).alias("v")))).alias("l"))
    return listed.select(*keys, F.col("l.v").alias(name))


def display_names(mapping: DataFrame, names: DataFrame, titles: DataFrame) -> DataFrame:
    """scope, canonical, display: the canonical key's most seen rendering, after the cluster's most frequent title if that is shown."""
    own = top_k(names, BODY, "us", "name", 1, "top").select("scope", F.col("key").alias("canonical"), F.col("top")[0].alias("name"))
    of_cluster = titles.join(mapping, BODY).groupBy("scope", "canonical", "word").agg(F.sum("n").alias("n"))
    title = top_k(of_cluster, ["scope", "canonical"], "n", "word", 1, "top").select("scope", "canonical", F.col("top")[0].alias("title"))
    rows = mapping.select("scope", "canonical").distinct().join(own, ["scope", "canonical"], "left").join(title, ["scope", "canonical"], "left")
    name = F.coalesce("name", "canonical")
    shown = F.when(F.col("title").isin(lex.SHOWN_TITLES), F.concat(F.initcap("title"), F.lit(" "), name)).otherwise(name)
    return rows.select("scope", "canonical", shown.alias("display"))


def variants(body: DataFrame, mapping: DataFrame, names: DataFrame, evidence: DataFrame) -> DataFrame:
    """Each key of a cluster: scope, canonical, key, us, meetings, names (three), and the rule, score and key that it was merged by last."""
    merged = evidence.filter("reason IS NULL").groupBy("scope", F.col("a").alias("key")).agg(F.max_by(F.struct("rule", "score", F.col("b").alias("via")), F.struct("score", "b")).alias("m"))
    rows = body.join(mapping, BODY).join(top_k(names, BODY, "us", "name", 3, "names"), BODY, "left").join(merged, BODY, "left")
    return rows.select("scope", "canonical", "key", "us", F.size("held").alias("meetings"), "names", "m.rule", "m.score", "m.via")


def identities(body: DataFrame, mapping: DataFrame, names: DataFrame, titles: DataFrame, roles: DataFrame, evidence: DataFrame) -> DataFrame:
    """The people: scope, speaker, display, us, meetings, titles, roles (five), variants (longest on screen first)."""
    keyed = ["scope", "canonical"]
    rows = body.join(mapping, BODY)
    sums = rows.groupBy(*keyed).agg(F.sum("us").alias("us"), F.size(F.array_distinct(F.flatten(F.collect_list("held.meeting")))).alias("meetings"))
    all_titles = titles.join(mapping, BODY).groupBy(*keyed).agg(F.sort_array(F.collect_set("word")).alias("titles"))
    of_cluster = roles.join(mapping, BODY).groupBy(*keyed, "word").agg(F.sum("n").alias("n"))
    spelt = variants(body, mapping, names, evidence)
    each = F.struct((-F.col("us")).alias("_by"), "key", "us", "meetings", "names", "rule", "score", "via")
    listed = spelt.groupBy(*keyed).agg(F.transform(F.array_sort(F.collect_list(each)), lambda v: v.dropFields("_by")).alias("variants"))
    none = F.expr("cast(array() as array<string>)")
    return (
        sums.join(display_names(mapping, names, titles), keyed)
        .join(all_titles, keyed, "left")
        .join(top_k(of_cluster, keyed, "n", "word", 5, "roles"), keyed, "left")
        .join(listed, keyed)
        .select("scope", F.col("canonical").alias("speaker"), "display", "us", "meetings", F.coalesce("titles", none).alias("titles"), F.coalesce("roles", none).alias("roles"), "variants")
    )


def merges_per_rule(evidence: DataFrame) -> DataFrame:
    return evidence.filter("reason IS NULL").groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
