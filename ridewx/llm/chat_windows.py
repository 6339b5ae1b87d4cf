"""Chat formatting in budgeted windows, in DataFrame functions only.

Turns are rendered as ``<|role|>`` line, escaped text, ``<|end|>`` line.
Inside roles and texts ``\\`` becomes ``\\e``, ``<`` becomes ``\\l`` and
``[`` becomes ``\\b``, so no control string of this or a bracketed template
can occur there, and undoing ``\\l``, ``\\b``, ``\\e`` in this order gives
the text back.

Running sums of turn tokens choose windows: a window takes whole turns
while their sum stays within the budget less the system turn and the
repeated history. Every window starts with the conversation's system turn
(the first turn, if its role is system), then repeats at most
``HISTORY_TURNS`` turns and ``HISTORY`` tokens from before its first turn,
then holds its own turns. The loss mask covers the texts of the window's
own assistant turns; repeated turns are masked. A turn that is longer than
the room by itself has a window of its own, marked ``over_budget``.

Tokens of a turn are, unless a column of counts is named, its UTF-8 bytes as
rendered: no byte-level tokenizer makes more, in any script, so no window
that is not marked passes the budget. Text that a tokenizer packs well fills
windows better with true counts, taken over the rendered turn (``rendered``).

Conversations are worked on in segments of ``SEGMENT`` turns (a window does
not cross one), so a long conversation is many small groups. Turns are
numbered in two levels, inside ranges of ``RANGE`` turn values and over the
ranges' counts, so no task sorts a whole conversation.

Defined results: null text and role are empty; turns are ordered by turn,
role, text (null turns first); repeated rows are turns of their own; null
ids are one conversation; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, HISTORY, HISTORY_TURNS, SEGMENT = 2048, 256, 2, 128
RANGE = 1024
SYSTEM, TARGET = "system", "assistant"
END = "<|end|>\n"


def escape(text: Column) -> Column:
    for a, b in (("\\", "\\e"), ("<", "\\l"), ("[", "\\b")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def unescape(text: Column) -> Column:
    for a, b in (("<", "\\l"), ("[", "\\b"), ("\\", "\\e")):
        text = F.replace(text, F.lit(b), F.lit(a))
    return text


def _head(role: Column) -> Column:
    return F.concat(F.lit("<|"), escape(role), F.lit("|>\n"))


def _fold(values: Column, zero: Column, step) -> Column:
    return F.aggregate(values, zero, step)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``at``, their place in their conversation from 0."""
    # One struct as the key: it is never null, and joins and windows by it
    # share a partitioning.
    rows = rows.withColumn("range", F.struct("conv_id", F.floor(F.col("turn") / RANGE).alias("k")))
    earlier = Window.partitionBy("range.conv_id").orderBy("range.k").rowsBetween(Window.unboundedPreceding, -1)
    counts = (rows.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
              .select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("turn", "role", "text"))
    return (rows.withColumn("at", inside).join(counts, "range")
            .withColumn("at", (F.col("before") + F.col("at") - 1)).drop("range", "before"))


def rendered(role: Column, text: Column) -> Column:
    """A turn as windows hold it, end mark included."""
    return F.concat(_head(F.coalesce(role, F.lit(""))), escape(F.coalesce(text, F.lit(""))), F.lit("\n" + END))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY,
            history_turns: int = HISTORY_TURNS, tokens: str | None = None) -> DataFrame:
    """conv_id, segment, span (order of the windows), text, turns, repeated
    (leading turns that an earlier window holds too), loss (array of start,
    length in code points), over_budget. ``tokens`` names a column of
    ``turns`` with the tokens of each rendered turn; a null counts its bytes."""
    text, role = (F.coalesce(turns[c], F.lit("")) for c in ("text", "role"))
    bound = F.octet_length(rendered(turns["role"], turns["text"])).cast("long")
    count = bound if tokens is None else F.coalesce(turns[tokens].cast("long"), bound)
    rows = numbered(turns.select(turns["conv_id"].alias("conv_id"), turns["turn"].alias("turn"),
                                 role.alias("role"), text.alias("text"), count.alias("tokens")))
    is_system = (F.col("at") == 0) & (F.col("role") == SYSTEM)
    system = rows.filter(is_system).select(
        F.col("conv_id").alias("sys_conv"), F.struct("role", "text", "tokens").alias("system"))
    # The last turns of a segment are history for the next one too.
    segment = F.floor(F.col("at") / SEGMENT)
    tail = (F.col("at") % SEGMENT) >= SEGMENT - history_turns
    body = (rows.filter(~is_system)
            .withColumn("segment", F.explode(F.when(tail, F.array(segment, segment + 1))
                                             .otherwise(F.array(segment)))))
    turn = F.struct("at", "role", "text", "tokens", (segment == F.col("segment")).alias("own"))
    groups = (body.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
              .filter(F.exists("turns", lambda t: t["own"]))
              .join(system, F.col("conv_id").eqNullSafe(F.col("sys_conv")), "left").drop("sys_conv"))
    # A conversation of a system turn alone still has one window.
    alone = (rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("last"),
                                         F.max_by(F.struct("role", "text", "tokens"), "at").alias("system"))
             .filter((F.col("n") == 1) & (F.col("system.role") == SYSTEM))
             .select("conv_id", F.lit(0).cast("long").alias("segment"),
                     F.array().cast(groups.schema["turns"].dataType).alias("turns"), "system"))
    groups = groups.select("conv_id", "segment", "turns", "system").unionByName(alone)

    # Spans: (index of the first own turn, number of turns).
    room = F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0))

    def step(acc: Column, t: Column) -> Column:
        total = acc["total"] + t["tokens"]
        fresh = F.size(acc["firsts"]) == 0
        cut = t["own"] & (fresh | (total - acc["base"] > acc["room"]))
        return F.struct(
            total.alias("total"), F.when(cut, acc["total"]).otherwise(acc["base"]).alias("base"),
            acc["room"].alias("room"), (acc["i"] + 1).alias("i"),
            F.when(cut, F.concat(acc["firsts"], F.array(acc["i"]))).otherwise(acc["firsts"]).alias("firsts"))

    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("base"),
                    room.cast("long").alias("room"), F.lit(0).alias("i"),
                    F.array().cast("array<int>").alias("firsts"))
    groups = groups.withColumn("firsts", _fold(F.col("turns"), zero, step)["firsts"])
    groups = groups.withColumn("firsts", F.when(F.size("firsts") == 0, F.array(F.lit(0))).otherwise(F.col("firsts")))
    spans = groups.select("conv_id", "segment", "turns", "system", "firsts",
                          F.posexplode("firsts").alias("span", "first"))
    stop = F.coalesce(F.get("firsts", F.col("span") + 1), F.size("turns"))
    spans = spans.withColumn("own", F.slice("turns", F.col("first") + 1, stop - F.col("first")))
    # History: the longest run of turns before the span within both limits.
    low = F.greatest(F.col("first") - history_turns, F.lit(0))
    spans = spans.withColumn("back", F.slice("turns", low + 1, F.col("first") - low))

    def within(back: Column) -> Column:
        return F.filter(back, lambda t, i: _fold(F.slice(back, i + 1, F.size(back)), F.lit(0).cast("long"),
                                                 lambda a, x: a + x["tokens"]) <= history)

    def render(t: Column, target: Column) -> Column:
        head = _head(t["role"])
        return F.struct(head.alias("head"), escape(t["text"]).alias("body"), target.alias("target"))

    opening = F.when(F.col("system").isNull(), F.array().cast("array<struct<role:string,text:string,tokens:bigint>>")) \
        .otherwise(F.array("system"))
    pieces = F.concat(
        F.transform(opening, lambda t: render(t, (F.col("segment") + F.col("span") == 0) & (t["role"] == TARGET))),
        F.transform(within(F.col("back")), lambda t: render(t, F.lit(False))),
        F.transform(F.col("own"), lambda t: render(t, t["role"] == TARGET)))
    later = (F.col("segment") > 0) | (F.col("span") > 0)
    repeated = F.size(within(F.col("back"))) + F.when(later & F.col("system").isNotNull(), 1).otherwise(0)
    done = spans.select("conv_id", "segment", "span", pieces.alias("pieces"), repeated.alias("repeated"),
                        (_fold(F.col("own"), F.lit(0).cast("long"), lambda a, t: a + t["tokens"])
                         + F.coalesce(F.col("system.tokens"), F.lit(0)) > budget - history).alias("over_budget"))

    def mark(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.char_length(p["head"])
        size = F.char_length(p["body"])
        return F.struct((start + size + len(END) + 1).alias("at"),
                        F.when(p["target"], F.concat(acc["loss"], F.array(F.struct(start.alias("start"), size.alias("length")))))
                        .otherwise(acc["loss"]).alias("loss"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))
    return done.select(
        "conv_id", "segment", "span",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n" + END))), "").alias("text"),
        F.size("pieces").alias("turns"), "repeated", _fold(F.col("pieces"), zero, mark)["loss"].alias("loss"),
        "over_budget")


def read_back(formatted: DataFrame) -> DataFrame:
    """The conversations' digests, from the windows alone: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    pieces = F.slice(F.split("text", "\\n<\\|end\\|>\\n"), F.col("repeated") + 1, F.col("turns") - F.col("repeated"))

    def turn(p: Column) -> Column:
        # <|role|>, a line end, the text.
        at = F.instr(p, "|>\n")
        return F.concat(unescape(F.substring(p, F.lit(3), at - 3)), F.lit("\n"),
                        unescape(F.substring(p, at + 3, F.char_length(p))), F.lit("\n"))

    turns = F.array_join(F.transform(pieces, turn), "")
    loss = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["length"]))), "")
    each = formatted.select(
        "conv_id", F.struct("segment", "span", turns.alias("turns"), loss.alias("loss")).alias("w"),
        (F.col("turns") - F.col("repeated")).alias("n"), F.char_length("text").alias("chars"))
    whole = each.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.array_sort(F.collect_list("w")).alias("w"),
        F.sum("chars").alias("formatted_chars"))

    def joined(part: str) -> Column:
        return F.array_join(F.transform("w", lambda x: x[part]), "")

    digest = lambda s: F.sha2(s.cast("binary"), 256)
    return whole.select(
        "conv_id", F.col("n_turns").cast("long"), digest(joined("turns")).alias("turns_sha256"),
        F.char_length(joined("loss")).cast("long").alias("loss_chars"), digest(joined("loss")).alias("loss_sha256"),
        F.col("formatted_chars").cast("long"))
