"""From raw label tracks to people: each meeting on its own, then all meetings of a collection together."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import GIVEN_NAMES
from ..functions.scalars import layout, microseconds
from ..operators import intervals as iv
from ..operators import labels, linking, registry
from ..shared import cut, ranked
from ..sources import meetings as src


@dataclass
class Cleaned:
    """tracks (meeting, ord, t_us, label), raw_to_speaker (meeting, raw, speaker), identities, evidence, kinds, stats, on_screen."""

    tracks: DataFrame
    raw_to_speaker: DataFrame
    identities: DataFrame
    evidence: DataFrame
    kinds: DataFrame
    on_screen: DataFrame
    stats: DataFrame
    body: DataFrame


def clean_collection(
    files: DataFrame,
    collection: str,
    context: list[str] | None = None,
    threshold: float = linking.THRESHOLD,
    cannot_link_us: int = linking.CANNOT_LINK_US,
    fill_gap_us: int = 2_000_000,
    cross_meeting: bool = True,
    given_names: list[str] = GIVEN_NAMES,
) -> Cleaned:
    """Resolve the OCR files (one row for each meeting, as ``sources.meetings.read_ocr`` returns them) of one collection.

    Within a meeting no guard keeps two names apart that are both on screen; across meetings it does.
    A gap is any interval without a person, so a short room or device tile is filled too.
    """
    words = context if context is not None else labels.context_words(collection.replace("_", " "))
    duration = files.select("meeting", microseconds(F.col("duration")).alias("duration_us"))
    raw = src.exploded_changes(files, "raw_speaker_changes").withColumn("context", F.array(*[F.lit(w) for w in words]).cast("array<string>"))
    parsed = cut(labels.with_parsed(raw, given_names).drop("context"), "parsed")
    held = iv.dwell_intervals(parsed.join(duration, "meeting"), ["meeting"], ["t_us", "ord"], F.col("duration_us"))
    held = held.withColumn("person", F.col("kind") == "person").withColumn("us", F.col("e_us") - F.col("s_us"))
    held = cut(held, "held")
    seen = held.filter("person").withColumn("scope", F.col("meeting").cast("string"))
    own_pool = cut(registry.pool(seen), "meeting-pools")
    within, _ = linking.link_identities(own_pool, threshold, None, within_meeting=True)
    here = within.select(F.col("scope").alias("_scope"), F.col("key").alias("_key"), F.col("canonical").alias("_name"))
    named = held.join(here, (held["meeting"].cast("string") == F.col("_scope")) & (held["key"] == F.col("_key")) & held["person"], "left")
    named = cut(
        named.select("meeting", "ord", "s_us", "e_us", F.col("label").alias("raw"), F.when(F.col("person"), F.coalesce("_name", "key")).otherwise("Other").alias("label"), "person"),
        "named",
    )
    filled = iv.gap_fill(named, ["meeting"], "label", fill_gap_us)
    changes = iv.coalesce_runs(filled.select("meeting", "ord", F.col("s_us").alias("t_us"), "label"), ["meeting"], ["t_us"], "label")

    # The collection's pool: each meeting's canonical keys, with the evidence of all keys behind them.
    canonical = seen.join(within, ["scope", "key"]).select(
        F.lit(collection).alias("scope"), "meeting", "ord", "key", "canonical", "name", "tokens", "us", "truncated", "titles", "roles"
    )
    canonical = cut(canonical, "sightings")
    own = canonical.filter("key = canonical")
    tokens = own.groupBy("scope", "canonical").agg(F.min_by("tokens", F.struct("meeting", "ord")).alias("own_tokens"))
    body = registry.pool(canonical.withColumn("key", F.col("canonical")))
    body = body.join(tokens.withColumnRenamed("canonical", "key"), ["scope", "key"]).withColumn("tokens", F.col("own_tokens")).drop("own_tokens")
    body = cut(body, "body-pool")
    if cross_meeting:
        alias, evidence = linking.link_identities(body, threshold, cannot_link_us)
    else:
        alias = body.select("scope", "key", F.col("key").alias("canonical"))
        evidence = files.sparkSession.createDataFrame([], "scope string, a string, b string, rule string, score double, reason string, meetings array<string>")
    renamed = canonical.withColumn("key", F.col("canonical"))
    people = registry.identities(body, alias, registry.renderings(own), registry.words(renamed, "titles"), registry.words(renamed, "roles"), evidence)

    final = alias.select(F.col("key").alias("label"), F.col("canonical").alias("_final"))
    tracks = changes.join(final, "label", "left").withColumn("label", F.coalesce("_final", "label")).drop("_final")
    tracks = cut(iv.coalesce_runs(tracks, ["meeting"], ["t_us"], "label").select("meeting", "ord", "t_us", "label"), "tracks")
    # Every read becomes a speaker, those too that were on screen for no time at all.
    reads = parsed.select("meeting", F.col("label").alias("raw"), "kind", "key").distinct()
    to = reads.join(here, (reads["meeting"].cast("string") == F.col("_scope")) & (reads["key"] == F.col("_key")), "left")
    to = to.withColumn("label", F.coalesce("_name", "key")).join(final, "label", "left")
    to = to.select("meeting", "raw", F.when(F.col("kind") == "person", F.coalesce("_final", "label")).otherwise("Other").alias("speaker"))
    on = iv.time_on(tracks.join(duration, "meeting"), ["meeting"], ["t_us", "ord"], "label", F.col("duration_us"))
    sampled = F.coalesce(F.nullif("frames_sampled", F.lit(0)), F.lit(1))
    grid = F.coalesce("frames_grid", F.lit(0)) / sampled
    stats = files.select(
        "meeting", "video", "duration", "frames_sampled", "frames_named", "frames_grid", "frames_overlay",
        F.round(grid, 3).alias("grid_fraction"),
        F.round(F.coalesce("frames_named", F.lit(0)) / sampled, 3).alias("named_fraction"),
        layout(grid).alias("layout"),
        "sampling_rate",
    )
    return Cleaned(tracks, cut(to, "raw-to-speaker"), cut(people, "people"), evidence, registry.label_kinds(parsed), on, stats, body)


def _json(value) -> F.Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def speakers_files(files: DataFrame, c: Cleaned) -> DataFrame:
    """(meeting, value): each meeting's speakers file."""
    display = c.identities.select(F.col("speaker").alias("label"), "display")
    shown = c.on_screen.join(display, "label", "left").select(
        "meeting", F.struct("label", F.struct(F.coalesce("display", "label").alias("display"), F.round(F.col("us") / 1e6, 1).alias("seconds_on_screen")).alias("v")).alias("e")
    )
    shown = shown.groupBy("meeting").agg(F.map_from_entries(F.array_sort(F.collect_list("e"))).alias("speakers"))
    to = c.raw_to_speaker.filter("raw IS NOT NULL").groupBy("meeting").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("raw", "speaker")))).alias("raw_to_speaker"))
    raw = src.exploded_changes(files, "raw_speaker_changes")
    counts = ["frames_sampled", "frames_named", "frames_grid", "frames_overlay", "grid_fraction", "named_fraction", "layout", "sampling_rate"]
    rows = (
        c.stats.join(shown, "meeting", "left").join(to, "meeting", "left")
        .join(src.pairs_json(c.tracks, "label", "_changes"), "meeting", "left")
        .join(src.pairs_json(raw, "label", "_raw"), "meeting", "left")
    )
    head = _json(F.struct("meeting", "video", "duration"))
    tail = _json(F.struct("raw_to_speaker", "speakers", F.struct(*counts).alias("stats")))
    value = F.concat(
        F.regexp_replace(head, r"\}$", ""), F.lit(',"changes":'), F.coalesce("_changes", F.lit("[]")),
        F.lit(',"raw_changes":'), F.coalesce("_raw", F.lit("[]")), F.lit(","), F.substring(tail, 2, 2**31 - 1),
    )
    return rows.select("meeting", value.alias("value"))


def registry_file(c: Cleaned, parameters: dict) -> DataFrame:
    """One row (meeting 'registry', value): people, merges and refusals of the collection; they are one file, so one row."""
    people = c.identities.withColumn("seconds", F.round(F.col("us") / 1e6, 1))
    listed = people.agg(F.array_sort(F.collect_list(F.struct((-F.col("seconds")).alias("_by"), "speaker", "display", "seconds", "meetings", "titles", "roles", "variants"))).alias("p"))
    kinds = c.kinds.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("label_kinds"))
    merges = registry.merges_per_rule(c.evidence).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("rule", "n")))).alias("merges"))
    refused = c.evidence.filter("reason IS NOT NULL").agg(
        F.array_sort(F.collect_list(F.struct(F.concat(F.array("a"), F.split("b", ",")).alias("kept_apart"), "rule", F.round("score", 3).alias("score"), "reason", "meetings"))).alias("refused")
    )
    ids = c.stats.agg(F.sort_array(F.collect_set(F.col("meeting").cast("string"))).alias("meetings"))
    one = listed.join(kinds).join(merges).join(refused).join(ids)  # one row each
    fields = F.struct(
        F.lit("1.0.0").alias("version"), F.from_json(F.lit(json.dumps(parameters)), "variant_threshold DOUBLE, cannot_link_seconds DOUBLE, fill_gap_seconds DOUBLE, no_cross_meeting BOOLEAN, context ARRAY<STRING>").alias("parameters"),
        "meetings", "label_kinds", "merges", F.transform("p", lambda x: x.dropFields("_by")).alias("identities"), "refused",
    )
    return one.select(F.lit("registry").alias("meeting"), _json(fields).alias("value"))


def registry_parts(c: Cleaned, parameters: dict) -> DataFrame:
    """(section, pos, value): the same file in pieces, one for each person, refusal and meeting, between those that frame them.

    Pieces carry their commas: all but the first of a list have one before them. No task holds a whole list.
    """
    people = c.identities.withColumn("seconds", F.round(F.col("us") / 1e6, 1))
    person = _json(F.struct("speaker", "display", "seconds", "meetings", "titles", "roles", "variants"))
    refused = c.evidence.filter("reason IS NOT NULL").select(
        F.struct(F.concat(F.array("a"), F.split("b", ",")).alias("kept_apart"), "rule", F.round("score", 3).alias("score"), "reason", "meetings").alias("r")
    )
    quoted = lambda x: F.substring(_json(F.struct(x.alias("x"))), 6, 2**31 - 1)  # noqa: E731  of {"x":"..."} all but the first five
    meetings = c.stats.select(F.col("meeting").cast("string").alias("m")).distinct()
    lists = [
        meetings.select(F.lit(1).alias("section"), F.lit(0.0).alias("by"), F.col("m").alias("then"), F.rtrim(quoted(F.col("m")), F.lit("}")).alias("value")),
        people.select(F.lit(3).alias("section"), (-F.col("seconds")).alias("by"), F.col("speaker").alias("then"), person.alias("value")),
        refused.select(F.lit(5).alias("section"), F.lit(0.0).alias("by"), F.to_json("r").alias("then"), _json(F.col("r")).alias("value")),
    ]
    items = ranked(lists[0].unionByName(lists[1]).unionByName(lists[2]), ["section"], [F.col("by"), F.col("then")], "registry")
    items = items.select("section", "pos", F.concat(F.when(F.col("pos") > 0, ",").otherwise(""), "value").alias("value"))
    kinds = c.kinds.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("label_kinds"))  # a few kinds and rules
    merges = registry.merges_per_rule(c.evidence).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("rule", "n")))).alias("merges"))
    middle = F.regexp_replace(_json(F.struct("label_kinds", "merges")), r"^\{|\}$", "")
    frames = [
        items.sparkSession.createDataFrame([(0, 0, f'{{"version":"1.0.0","parameters":{json.dumps(parameters)},"meetings":[')], "section int, pos long, value string"),
        kinds.join(merges).select(F.lit(2).alias("section"), F.lit(0).cast("long").alias("pos"), F.concat(F.lit("],"), middle, F.lit(',"identities":[')).alias("value")),  # one row each
        items.sparkSession.createDataFrame([(4, 0, '],"refused":['), (6, 0, "]}")], "section int, pos long, value string"),
    ]
    for frame in frames:
        items = items.unionByName(frame)
    return items


def summary(evidence: DataFrame) -> DataFrame:
    """rule, merged, refused: how many links of each rule were followed and how many not."""
    return evidence.groupBy("rule").agg(F.count_if(F.col("reason").isNull()).alias("merged"), F.count_if(F.col("reason").isNotNull()).alias("refused")).orderBy("rule")
