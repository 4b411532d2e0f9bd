"""Chat formatting in budgeted windows, with a loss mask that covers each target once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ordered_prefix

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"

#: Tokens that a turn's marks count for.
MARK_TOKENS = 4

_TOKEN = r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


def escape(text: Column) -> Column:
    """Put one more backslash between ``<`` and ``|``: no text then holds a control string, and none is lost."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _turn(part: Column) -> Column:
    return F.concat(_head(part), escape(part["text"]), F.lit(CLOSE + "\n"))


def _head(part: Column) -> Column:
    return F.concat(F.lit(OPEN), F.url_encode(part["role"]), F.lit("\n"))


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def format_windows(turns: DataFrame, budget: int = 512, history: int = 128) -> DataFrame:
    """Format conversations as windows of at most ``budget`` tokens.

    Returns conv_id, first_index (orders the windows), n_repeated (leading turns
    that an earlier window has as its own), n_turns (its own), tokens,
    over_budget, formatted and loss_spans (start and length, in code points, of
    the text of the window's own assistant turns).

    A system turn that opens a conversation opens each of its windows. Prefix
    sums of the turns' tokens cut the rest at turns: a window's own turns are
    those whose last token falls in one stride of half the budget that is left
    beside the system turn, so they fit it; a turn longer than a stride
    has a window of its own, whole, and over_budget tells if that is too much.
    What is left of the budget, but at most ``history`` tokens, is filled with
    the turns just before, whose targets are masked here.

    A turn's tokens are its words, digits and runs of other signs, plus the
    marks. Turns are in the order of turn, role, text, null first; null text and
    role are empty; repeated rows are turns each; rows with a null conv_id are
    one conversation. Other columns are not read. No rows in, no rows out.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tokens", (MARK_TOKENS + F.regexp_count("text", F.lit(_TOKEN))).cast("long"))
    placed = cut(ordered_prefix(rows, ["conv_id", "turn", "role", "text"], {}, "turns").drop("_count"), "turns")
    first = placed.groupBy("conv_id").agg(F.min(F.struct("_index", "role", "tokens")).alias("first"))
    opening = F.col("first.role") == "system"
    conversations = first.select(
        F.col("conv_id").alias("_conv"),
        F.col("first._index").alias("start_index"),
        opening.alias("has_system"),
        F.when(opening, F.col("first.tokens")).otherwise(_long(0)).alias("system_tokens"),
    ).withColumn("stride", F.greatest(_long(1), F.expr(f"({budget} - system_tokens) div 2")))
    marked = placed.join(conversations, placed["conv_id"].eqNullSafe(conversations["_conv"])).drop("_conv")
    is_system = F.col("has_system") & (F.col("_index") == F.col("start_index"))
    marked = marked.withColumns(
        {"own": F.when(is_system, _long(0)).otherwise(F.col("tokens")), "is_system": is_system}
    ).withColumn("long", (F.col("own") > F.col("stride")).cast("long"))
    marked = marked.withColumn("short", F.when(F.col("long") == 1, _long(0)).otherwise(F.col("own")))
    # All sums run over the whole table; what stood at a conversation's first turn is taken off.
    summed = ordered_prefix(
        marked, ["_index"], {"own_before": "own", "short_before": "short", "long_before": "long"}, "turn-tokens"
    ).drop("_count", "own_before_total", "short_before_total", "long_before_total")
    summed = cut(summed, "turn-tokens")
    base = summed.filter(F.col("_index") == F.col("start_index")).select(
        F.col("_index").alias("start_index"),
        F.col("own_before").alias("own0"),
        F.col("short_before").alias("short0"),
        F.col("long_before").alias("long0"),
    )
    relative = summed.join(base, "start_index").withColumns(
        {
            "own_before": F.col("own_before") - F.col("own0"),
            "short_end": F.col("short_before") - F.col("short0") + F.col("short"),
            "long_before": F.col("long_before") - F.col("long0"),
        }
    )
    relative = cut(
        relative.withColumn("bucket", F.expr("greatest(short_end - 1, 0) div stride")).drop("own0", "short0", "long0"),
        "turn-places",
    )
    part = F.struct("_index", "role", "text")
    windows = relative.groupBy(
        "conv_id", "start_index", "has_system", "system_tokens", "long_before", "long", "bucket"
    ).agg(
        F.sort_array(F.collect_list(part)).alias("parts"),
        F.min("_index").alias("first_index"),
        F.min("own_before").alias("begins"),
        F.sum("own").alias("own_tokens"),
    )
    windows = cut(windows.drop("long_before", "long", "bucket"), "windows")
    # The turns just before a window begin at most `history` tokens earlier: in its bucket of that width or the one before.
    near = windows.filter("first_index > start_index").select(
        "start_index",
        "first_index",
        "begins",
        F.least(_long(history), _long(budget) - F.col("system_tokens") - F.col("own_tokens")).alias("room"),
        F.explode(F.expr(f"array(begins div {history}, begins div {history} - 1)")).alias("step"),
    )
    earlier = relative.filter(~F.col("is_system")).select(
        F.col("start_index").alias("_start"),
        F.expr(f"own_before div {history}").alias("_step"),
        F.col("own_before").alias("_begins"),
        F.struct("_index", "role", "text", F.col("own").alias("tokens")).alias("_part"),
    )
    inside = (
        (near["start_index"] == earlier["_start"])
        & (near["step"] == earlier["_step"])
        & (F.col("_part._index") < F.col("first_index"))
        & (F.col("_begins") >= F.col("begins") - F.col("room"))
    )
    before = (
        near.join(earlier, inside)
        .groupBy(F.col("first_index").alias("_first"))
        .agg(F.sort_array(F.collect_list("_part")).alias("_before"))
    )
    system = placed.join(
        conversations.filter("has_system").select(F.col("start_index").alias("_index")), "_index"
    ).select(F.col("_index").alias("_system"), F.struct("_index", "role", "text").alias("_system_part"))
    later = F.col("has_system") & (F.col("first_index") > F.col("start_index"))
    full = (
        windows.join(before, F.col("first_index") == F.col("_first"), "left")
        .join(system, later & (F.col("start_index") == F.col("_system")), "left")
        .withColumn("_before", F.coalesce("_before", F.expr("cast(array() as array<struct<_index: bigint, role: string, text: string, tokens: bigint>>)")))
    )
    bare = lambda p, loss: F.struct(p["role"].alias("role"), p["text"].alias("text"), loss.alias("loss"))
    repeated = F.concat(
        F.when(F.col("_system_part").isNotNull(), F.array(bare(F.col("_system_part"), F.lit(False)))).otherwise(
            F.expr("cast(array() as array<struct<role: string, text: string, loss: boolean>>)")
        ),
        F.transform("_before", lambda p: bare(p, F.lit(False))),
    )
    full = full.withColumn("_repeated", repeated).withColumn(
        "_all", F.concat("_repeated", F.transform("parts", lambda p: bare(p, p["role"] == "assistant")))
    )
    full = full.withColumn("_turns", F.transform("_all", _turn))
    full = full.withColumn("_lengths", F.transform("_turns", lambda t: F.length(t)))
    spans = F.transform(
        "_all",
        lambda p, i: F.struct(
            (F.aggregate(F.slice("_lengths", 1, i), F.lit(0), lambda a, n: a + n) + F.length(_head(p))).alias("start"),
            F.length(escape(p["text"])).alias("length"),
            p["loss"].alias("loss"),
        ),
    )
    tokens = (
        F.col("system_tokens") + F.col("own_tokens") + F.aggregate("_before", _long(0), lambda a, p: a + p["tokens"])
    )
    return full.select(
        "conv_id",
        "first_index",
        F.size("_repeated").alias("n_repeated"),
        F.size("parts").alias("n_turns"),
        tokens.alias("tokens"),
        (tokens > budget).alias("over_budget"),
        F.array_join("_turns", "").alias("formatted"),
        F.transform(
            F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))
        ).alias("loss_spans"),
    )


def parse_windows(windows: DataFrame) -> DataFrame:
    """Read windows back from their formatted text: conv_id, first_index, turns (role, text) and targets (text).

    Only a window's own turns are returned, so all windows together hold each turn once.
    """
    pieces = F.slice(
        F.split("formatted", r"<\|im_start\|>", -1), F.col("n_repeated") + 2, F.greatest(F.lit(0), F.col("n_turns"))
    )
    closing = len(CLOSE) + 1

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        start = F.length(role) + 2
        return F.struct(
            F.url_decode(role).alias("role"),
            unescape(F.substring(piece, start, F.length(piece) - start + 1 - closing)).alias("text"),
        )

    return windows.select(
        "conv_id",
        "first_index",
        F.transform(pieces, turn).alias("turns"),
        F.transform(
            "loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))
        ).alias("targets"),
        F.length("formatted").alias("formatted_chars"),
    )


def digest_conversations(windows: DataFrame) -> DataFrame:
    """Digests of what ``parse_windows`` reads back, a row for each conversation.

    A digest needs its conversation's whole text in one place, as any hash of
    it does; windows send theirs as one row each.
    """
    parsed = parse_windows(windows).select(
        "conv_id",
        F.struct(
            "first_index",
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
            F.array_join("targets", "").alias("targets"),
        ).alias("w"),
        F.size("turns").alias("n"),
        "formatted_chars",
    )
    whole = parsed.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list("w")).alias("w"),
        F.sum(F.col("formatted_chars").cast("long")).alias("formatted_chars"),
    )
    targets = F.array_join(F.col("w.targets"), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.col("w.turns"), ""), 256).alias("turns_sha256"),
        F.length(targets).cast("long").alias("loss_chars"),
        F.sha2(targets, 256).alias("loss_sha256"),
        "formatted_chars",
    )
