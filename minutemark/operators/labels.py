"""On-screen labels parsed into people, devices, roles and noise.

A label's words are classified in one pass over an array; everything is a
built-in expression but Unicode's compatibility form. Parse distinct labels and
join the result back: ``with_parsed`` does both.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import lexicon as lex
from ..functions.scalars import fold, skeleton, within_edits

# ---- Fixed values: the forms that decide how a label is read ----

LETTER = r"[\p{L}\p{Nl}\p{No}]"
TOKEN = rf"{LETTER}+(?:'{LETTER}+)?|\p{{Nd}}+"
CLIPPED = r"(\s*[.…]){2,}\s*$|…\s*$"
PRONOUN = (
    r"(?i)[\(\[]?\s*\b(?:she|he|they|ze|xe)\s*/\s*(?:her|hers|him|his|them|theirs|they|she|he)?"
    r"(?:\s*/\s*[a-z]*)?\.*\s*[\)\]]?"
)
DEVICE_TAIL = (
    r"(?iU)(?:'s|’s)?\s*(?:i\s?phone|i\s?pad|galaxy[\w ]*|android|macbook[\w ]*|chromebook|laptop|thinq)"
    r"\s*(?:\(\d+\)|\d+)?\s*$"
)
SEPARATOR = r"\s+[-–—]+\s+|[–—]+|\||,|;|\(|\)|\[|\]|\s+/\s+| {2,}"
CAMEL = r"(?<=[a-z]{2})(?=[A-Z])|(?<=[A-Z]{2})(?=[A-Z][a-z])"

# ---- End of the fixed values ----

_WORD = "struct<display: string, folded: string, kind: string>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _none(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


def split_camel(word: Column) -> Column:
    """Words run together, at their capitals; a particle such as Mc stays with what follows."""
    def glue(done: Column, part: Column) -> Column:
        last = F.element_at(done, -1)
        sticks = (F.size(done) > 0) & fold(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(""))).isin(lex.PARTICLES)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.concat(F.try_element_at(done, F.lit(-1)), part)))
        return F.when(sticks, joined).when(part != "", F.concat(done, F.array(part))).otherwise(done)

    return F.aggregate(F.split(word, CAMEL, -1), _none("string"), glue)


def token_class(folded: Column, context: Column, clipped_last: Column) -> Column:
    """What a folded word is by itself: empty, device, digit, suffix, title, role or name."""
    device = folded.isin(lex.DEVICE_WORDS)
    for ending in lex.DEVICE_ENDINGS:
        device |= folded.endswith(ending) & (F.length(folded) > len(ending) + 2)
    begins = lambda w: w.startswith(folded) & (F.length(w) > F.length(folded))
    known = F.exists(_strings(lex.ROLE_WORDS), begins) | F.exists(context, begins)
    return (
        F.when(folded == "", "empty")
        .when(device, "device")
        .when(folded.rlike("[0-9]"), "digit")
        .when(folded.isin(lex.SUFFIXES), "suffix")
        .when(folded.isin(lex.TITLES), "title")
        .when(folded.isin(lex.ROLE_WORDS) | F.array_contains(context, folded), "role")
        .when(clipped_last & (F.length(folded) >= 5) & known, "role")
        .otherwise("name")
    )


def _misread_title(folded: Column) -> Column:
    """One edit from a long title, or a title whose beginning was cut off."""
    size = F.length(folded)
    out = (size >= 5) & F.exists(_strings(lex.MISREAD_TITLES), lambda t: within_edits(folded, t, 1))
    for title, least in lex.CLIPPED_TITLES.items():
        out |= F.lit(title).endswith(folded) & (size >= least)
    return out | ((size == 4) & within_edits(folded, F.lit("judge"[-4:]), 1))


def segment_words(segment: Column, context: Column, clipped: Column) -> Column:
    """Array of (display, folded, kind) of a segment's words; what a word is depends on the names before it."""
    plain = F.regexp_replace(segment, r"(?U)(?<=\w)[.:_/](?=\w)", " ")
    words = F.flatten(F.transform(F.regexp_extract_all(plain, F.lit(TOKEN), F.lit(0)), split_camel))
    shouting = ~plain.rlike(r"\p{Ll}")

    def classify(ws: Column) -> Column:
        n = F.size(ws)

        def add(done: Column, word: Column) -> Column:
            i, names = F.size(done), F.size(F.filter(done, lambda d: d["kind"] == "name"))
            last = i == n - 1
            size, upper = F.length(word), F.length(F.regexp_replace(word, r"[^\p{Lu}]", ""))
            tag = ((names >= 2) & (size <= 4) & (upper >= 2)) | (
                (names >= 1) & size.between(2, 3) & (word == F.upper(word)) & (upper >= 1)
            )

            def kind(folded: Column) -> Column:
                begins = lambda w: w.startswith(folded) & (F.length(w) > F.length(folded) + 1)
                own = token_class(folded, context, clipped & last)
                return _let(
                    own,
                    lambda k: F.when(k != "name", k)
                    .when((i == 0) & (n > 1) & _misread_title(folded), "title")
                    .when((names >= 2) & skeleton(folded).isin(lex.SUFFIX_SKELETONS), "suffix")
                    .when(~shouting & tag, "role")
                    .when((names >= 2) & last & (F.length(folded) >= 5) & F.exists(_strings(lex.ROLE_WORDS), begins), "role")
                    .otherwise("name"),
                )

            entry = _let(fold(word), lambda f: F.struct(word.alias("display"), f.alias("folded"), kind(f).alias("kind")))
            return F.concat(done, F.array(entry))

        return F.aggregate(ws, _none(_WORD), add)

    return _let(words, classify)


def _resolved(words: Column) -> Column:
    """Words such as Hall are names, unless a plain role word stands beside them or they lead as a title."""
    ambiguous = lambda w: w["folded"].isin(lex.AMBIGUOUS_WORDS)
    place = F.exists(words, lambda w: (w["kind"] == "role") & ~ambiguous(w))

    def add(done: Column, w: Column) -> Column:
        leading = F.forall(done, lambda d: d["kind"] == "title")
        stays = (w["kind"] == "title") & leading & (F.size(words) > 1)
        name = ambiguous(w) & w["kind"].isin("role", "title") & ~place & ~stays
        kind = F.when(name, "name").otherwise(w["kind"])
        return F.concat(done, F.array(F.struct(w["display"].alias("display"), w["folded"].alias("folded"), kind.alias("kind"))))

    return F.aggregate(words, _none(_WORD), add)


def _role_only(words: Column) -> Column:
    return (F.size(words) > 0) & F.forall(words, lambda w: w["kind"].isin("role", "title", "digit", "device"))


def _kind_at(words: Column, place: int) -> Column:
    return F.coalesce(F.try_element_at(words, F.lit(place))["kind"], F.lit(""))


def _compounds(segments: Column, context: Column) -> Column:
    """A tight hyphen or slash parts a segment only beside a role; else it holds a compound name together."""
    no = F.lit(False)

    def parts(segment: Column) -> Column:
        def add(done: Column, piece: Column) -> Column:
            def judge(current: Column) -> Column:
                return _let(
                    F.struct(segment_words(current, context, no).alias("l"), segment_words(piece, context, no).alias("r")),
                    lambda s: F.when(
                        _role_only(s["l"]) | _role_only(s["r"]) | _kind_at(s["l"], -1).isin("role", "device")
                        | _kind_at(s["r"], 1).isin("role", "device", "title"),
                        F.concat(done, F.array(piece)),
                    ).otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.concat(current, piece)))),
                )

            return F.when(F.size(done) == 0, F.array(piece)).otherwise(_let(F.try_element_at(done, F.lit(-1)), judge))

        return F.aggregate(F.split(segment, rf"(?<={LETTER})[-/](?={LETTER})", -1), _none("string"), add)

    return F.flatten(F.transform(segments, parts))


def _is_given(folded: Column, given_names: list[str]) -> Column:
    return folded.isin(given_names) | (folded.startswith("l") & F.concat(F.lit("i"), F.substring(folded, 2, 1000)).isin(given_names))


def _uninverted(text: Column, segments: Column, context: Column, truncated: Column, given_names: list[str]) -> Column:
    """'Surname, Given' in reading order."""
    no = F.lit(False)

    def swap(s: Column) -> Column:
        left, right = s["l"], s["r"]
        first = F.try_element_at(right, F.lit(1))["folded"]
        second = F.try_element_at(right, F.lit(2))["folded"]
        own = F.try_element_at(left, F.lit(1))["folded"]
        fits = (
            (F.size(left) == 1) & (_kind_at(left, 1) == "name") & (F.length(own) >= 2)
            & F.size(right).between(1, 2) & F.forall(right, lambda w: w["kind"] == "name")
            & (F.length(first) >= 2) & ((F.size(right) == 1) | (F.length(second) <= 1))
        )
        written = _is_given(own, given_names) & ~_is_given(first, given_names)
        a, b = F.try_element_at(segments, F.lit(1)), F.try_element_at(segments, F.lit(2))
        turned = F.array(F.when(written, F.concat_ws(" ", a, b)).otherwise(F.concat_ws(" ", b, a)))
        return F.when(F.coalesce(fits, no), turned).otherwise(segments)

    may = ~truncated & (F.size(segments) == 2) & text.rlike(r"^[^,]+,[^,]+$")
    words = F.struct(
        segment_words(F.try_element_at(segments, F.lit(1)), context, no).alias("l"),
        segment_words(F.try_element_at(segments, F.lit(2)), context, no).alias("r"),
    )
    return F.when(may, _let(words, swap)).otherwise(segments)


def _rehyphened(display: Column, raw: Column) -> Column:
    """The displayed name with the compound names' hyphens as written."""
    one = rf"{LETTER}+(?:'{LETTER}+)?"

    def put(shown: Column, compound: Column) -> Column:
        tight, apart = F.replace(compound, F.lit("-"), F.lit("")), F.replace(compound, F.lit("-"), F.lit(" "))
        return F.when(F.contains(shown, tight), F.replace(shown, tight, compound)).otherwise(F.replace(shown, apart, compound))

    return F.aggregate(F.regexp_extract_all(raw, F.lit(rf"{one}(?:-{one})+"), F.lit(0)), display, put)


@F.pandas_udf(StringType())
def _compatible(raw: pd.Series) -> pd.Series:
    """Unicode's compatibility form, with single spaces; Spark has no function for it."""
    import unicodedata

    return raw.map(lambda t: None if t is None else unicodedata.normalize("NFKC", " ".join(t.split())))


def context_words(*texts: str | None) -> list[str]:
    """A collection's own words, folded, of four letters or more: tiles made of them are the body's, not a person's."""
    import re
    import unicodedata

    found = set()
    for word in re.findall(r"[^\W\d_]+", " ".join(t for t in texts if t)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))
        found.add(re.sub("[^a-z0-9]", "", plain.lower()))
    return sorted(w for w in found if len(w) >= 4)


def parse_labels(labels: DataFrame, given_names: list[str] = lex.GIVEN_NAMES) -> DataFrame:
    """Parse the column ``label`` (with ``context``, an array of a collection's own words, if there is one).

    Adds kind (person, device, role, runon, noise), name, tokens, key, titles,
    roles, truncated. A null label is noise.
    """
    if "context" not in labels.columns:
        labels = labels.withColumn("context", _none("string"))
    context = F.coalesce("context", _none("string"))
    states = "|".join(sorted(lex.STATES, key=len, reverse=True))
    rows = labels.withColumn("_t", F.coalesce(_compatible(F.col("label").cast("string")), F.lit("")))
    rows = rows.withColumn("_nothing", F.lower(F.btrim("_t", F.lit(" ."))).isin(lex.NO_LABEL))
    text = F.btrim(F.regexp_replace("_t", rf"(?i)^(?:{states})(?=\s*$|[:;.,|])[:;.,|]*\s*", ""))
    words = F.transform(
        F.split(text, " ", -1),
        lambda w: F.when(w.rlike(r".@."), F.concat(F.translate(F.regexp_extract(w, r"^(\S+)@\S+", 1), "._", "  "))).otherwise(w),
    )
    rows = rows.withColumn("_t", F.array_join(words, " "))
    rows = rows.withColumn("truncated", F.col("_t").rlike(CLIPPED))
    rows = rows.withColumn("_t", F.regexp_replace(F.regexp_replace("_t", CLIPPED, ""), PRONOUN, " "))
    rows = rows.withColumn("_bare", F.regexp_replace("_t", DEVICE_TAIL, ""))
    rows = rows.withColumn("_device", F.col("_bare") != F.col("_t"))
    rows = rows.withColumn("_t", F.when(F.col("_device"), F.btrim("_bare")).otherwise(F.col("_t")))
    pieces = F.filter(F.transform(F.split("_t", SEPARATOR, -1), lambda s: F.btrim(s)), lambda s: s != "")
    rows = rows.withColumn("_s", _compounds(pieces, context))
    rows = rows.withColumn("_s", _uninverted(F.col("_t"), F.col("_s"), context, F.col("truncated"), given_names))
    clipped = lambda i: F.col("truncated") & (i == F.size("_s") - 1)
    rows = rows.withColumn("_w", F.transform("_s", lambda s, i: _let(segment_words(s, context, clipped(i)), _resolved)))

    def read(ws: Column) -> Column:
        kinds = F.transform(ws, lambda w: w["kind"])
        leading = F.array_position(F.concat(F.transform(ws, lambda w: w["kind"] != "title"), F.array(F.lit(True))), True) - 1
        name, device = F.array_position(kinds, "name"), F.array_position(kinds, "device")
        device_first = (device > 0) & ((name == 0) | (device < name))
        after = F.slice(ws, F.greatest(name, F.lit(1)).cast("int"), F.greatest(F.size(ws), F.lit(1)))
        length = F.array_position(F.concat(F.transform(after, lambda w: w["kind"] != "name"), F.array(F.lit(True))), True) - 1
        run = F.when((name > 0) & ~device_first, F.slice(after, F.lit(1), length.cast("int"))).otherwise(_none(_WORD))
        rest = F.filter(ws, lambda w, i: (i >= leading) & w["kind"].isin("role", "digit", "title"))
        return F.struct(
            F.transform(F.filter(ws, lambda w, i: i < leading), lambda w: w["folded"]).alias("titles"),
            F.transform(rest, lambda w: w["folded"]).alias("roles"),
            (device > 0).alias("device"),
            device_first.alias("device_first"),
            run.alias("run"),
        )

    rows = rows.withColumn("_r", F.transform("_w", read))
    rows = rows.withColumn("titles", F.flatten("_r.titles")).withColumn("roles", F.flatten("_r.roles"))
    rows = rows.withColumn("_device", F.col("_device") | F.exists("_r", lambda r: r["device"]))
    rows = rows.withColumn("_device_first", F.exists("_r", lambda r: r["device_first"]))
    runs = F.filter(
        F.transform(
            "_r",
            lambda r, i: F.struct(
                F.least(F.size(F.filter(r["run"], lambda w: F.length(w["folded"]) > 1)), F.lit(3)).alias("words"),
                (F.length(F.array_join(F.transform(r["run"], lambda w: w["folded"]), "")) > 3).alias("long"),
                (-i).alias("place"),
                r["run"].alias("run"),
            ),
        ),
        lambda c: F.size(c["run"]) > 0,
    )
    rows = rows.withColumn("_run", F.array_max(runs)["run"])
    rows = rows.withColumn("tokens", F.filter(F.transform("_run", lambda w: w["folded"]), lambda f: f != ""))
    full = F.filter("tokens", lambda t: F.length(t) > 1)
    rows = rows.withColumn("_full", F.size(full)).withColumn(
        "key", F.when(F.size(full) >= 2, F.array_join(full, "")).otherwise(F.array_join("tokens", ""))
    )
    shown = _rehyphened(F.array_join(F.transform("_run", lambda w: w["display"]), " "), F.coalesce(F.col("label").cast("string"), F.lit("")))
    found = F.col("_run").isNotNull() & ~F.col("_nothing")
    kind = (
        F.when(F.col("_nothing"), "noise")
        .when(F.col("_run").isNull() & F.col("_device"), "device")
        .when(F.col("_run").isNull() & (F.size("titles") + F.size("roles") > 0), "role")
        .when(F.col("_run").isNull(), "noise")
        .when(F.col("_device") & ((F.col("_full") <= 1) | F.col("_device_first")), "device")
        .when(F.length("key") < lex.LEAST_KEY, "noise")
        .when((F.size("tokens") > lex.MOST_TOKENS) | (F.length("key") > lex.LONGEST_KEY), "runon")
        .otherwise("person")
    )
    empty = _none("string")
    spoke = ~F.col("_nothing") & (found | F.col("_device") | (F.size("titles") + F.size("roles") > 0))
    return rows.select(
        *labels.columns,
        kind.alias("kind"),
        F.when(found, shown).otherwise("").alias("name"),
        F.when(found, F.col("tokens")).otherwise(empty).alias("tokens"),
        F.when(found, F.col("key")).otherwise("").alias("key"),
        F.when(spoke, F.col("titles")).otherwise(empty).alias("titles"),
        F.when(spoke, F.col("roles")).otherwise(empty).alias("roles"),
        (spoke & F.col("truncated")).alias("truncated"),
    )


def with_parsed(rows: DataFrame, given_names: list[str] = lex.GIVEN_NAMES) -> DataFrame:
    """``rows`` with their label's parse: each distinct label (and context) is parsed once."""
    on = ["label"] + [c for c in ("context",) if c in rows.columns]
    parsed = parse_labels(rows.select(*on).distinct(), given_names)
    renamed = parsed.withColumnsRenamed({c: f"_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same &= rows[c].eqNullSafe(renamed[f"_{c}"])
    return rows.join(renamed, same, "left").drop(*[f"_{c}" for c in on])
