"""Column functions on names, keys and times. All are built-in expressions, so they stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import ACCENTED, PLAIN

#: Times are whole microseconds inside the engine: sums don't depend on their order.
SECOND = 1_000_000


def fold(text: Column) -> Column:
    """Lower-case letters a to z and digits of ``text``; accents go, other letters vanish.

    Accented Latin letters are mapped by a table made from Unicode's decompositions.
    """
    return F.regexp_replace(F.lower(F.translate(text, ACCENTED, PLAIN)), "[^a-z0-9]", "")


def skeleton(key: Column) -> Column:
    """The key with characters that OCR confuses mapped to one of them and runs collapsed."""
    return F.regexp_replace(F.translate(key, "i1|05", "lllos"), r"(.)\1+", "$1")


def similarity(a: Column, b: Column) -> Column:
    """1 less the edit distance over the longer length; 1 for two empty strings."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def within_edits(a: Column, b: Column, most: int) -> Column:
    """Whether the edit distance is at most ``most``; the bounded distance is -1 beyond it."""
    return F.levenshtein(a, b, most) >= 0


def _clipped(short: Column, part: Column, long: Column) -> Column:
    nearly = (F.length(short) >= 10) & (similarity(short, part) >= 0.9)
    return (F.length(short) < F.length(long)) & ((part == short) | nearly)


def prefix_match(short: Column, long: Column) -> Column:
    """``short`` is ``long`` with its end cut off, but for a slip in a long kept part."""
    return _clipped(short, F.left(long, F.length(short)), long)


def suffix_match(short: Column, long: Column) -> Column:
    """``short`` is ``long`` with its beginning cut off, but for a slip in a long kept part."""
    return _clipped(short, F.right(long, F.length(short)), long)


def full_words(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: F.length(t) > 1)


def surname(tokens: Column) -> Column:
    """Last word of two or more full words, else the empty string."""
    full = full_words(tokens)
    return F.when(F.size(full) >= 2, F.element_at(full, -1)).otherwise("")


def given(tokens: Column) -> Column:
    """First of two or more tokens, else the empty string."""
    return F.when(F.size(tokens) >= 2, F.element_at(tokens, 1)).otherwise("")


def boundaries(key: Column, tokens: Column) -> Column:
    """Offsets in ``key`` at which one word ends and the next begins; none if the tokens don't spell the key."""
    full = full_words(tokens)
    words = F.when((F.size(full) >= 2) & (F.array_join(full, "") == key), full).otherwise(tokens)
    ends = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - 1)),
        lambda i: F.length(F.array_join(F.slice(words, 1, i), "")),
    )
    return F.when((F.array_join(words, "") == key) & (F.size(words) > 1), ends).otherwise(F.expr("cast(array() as array<int>)"))


def timestamp(micros: Column, separator: str) -> Column:
    """``HH:MM:SS<separator>mmm``, to the nearest millisecond."""
    ms = F.expr("0L") + F.bround(micros / 1000, 0).cast("long")
    part = lambda per, of: (F.floor(ms / per) % of).cast("int")
    return F.format_string(
        f"%02d:%02d:%02d{separator}%03d",
        F.floor(ms / 3_600_000).cast("int"),
        part(60_000, 60),
        part(1000, 60),
        (ms % 1000).cast("int"),
    )


def microseconds(seconds: Column) -> Column:
    return F.bround(seconds.cast("double") * SECOND, 0).cast("long")


def seconds(micros: Column) -> Column:
    return micros / F.lit(float(SECOND))


def file_id(name: Column) -> Column:
    """A meeting's id: the file name without the first matching output suffix, or without its extension."""
    base = F.regexp_replace(name, r"^.*/", "")
    return F.when(
        base.endswith(".json"), F.regexp_replace(base, r"(\.(ocr|video|asr|speakers|attribution))?\.json$", "")
    ).otherwise(F.regexp_replace(base, r"(?<=.)\.[^.]*$", ""))


def layout(grid_fraction: Column) -> Column:
    return F.when(grid_fraction >= 0.8, "gallery").when(grid_fraction >= 0.3, "mixed").otherwise("screen-share")
