"""Chat formatting: event logs are folded into final messages, then rendered with a loss mask. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Every control string of this and other templates holds one of these characters, so escaping them escapes all.
ESCAPES = {"&": "&amp;", "<": "&lt;", "[": "&lsqb;"}


def escape(c: Column) -> Column:
    for plain, safe in ESCAPES.items():
        c = F.replace(c, F.lit(plain), F.lit(safe))
    return c


def unescape(c: Column) -> Column:
    for plain, safe in reversed(ESCAPES.items()):
        c = F.replace(c, F.lit(safe), F.lit(plain))
    return c


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&nl;"))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&nl;"), F.lit("\n")))


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, turn, role, text)`` of an event log ``(conv_id, seq, kind, turn, role, text)``.

    Events apply in the order of ``seq`` (ties: by kind, then text). ``message`` sets a turn's text, ``delta`` appends to
    it, ``edit`` sets it and withdraws what was said in later turns before, ``regenerate`` does the same and starts from
    its own text, mostly empty, to which deltas are appended. A turn whose events were all withdrawn is gone. The role is
    the last that isn't null, or empty; a null text is empty; other kinds count as ``message``.
    """
    one = F.struct("seq", F.coalesce("kind", F.lit("message")).alias("kind"), F.coalesce("text", F.lit("")).alias("text"), "role")
    cuts = F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq")))
    turns = events.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(one)).alias("log"), cuts.alias("cut"))  # one message's events
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    alive = turns.withColumn("gone", F.max("cut").over(before)).withColumn("log", F.filter("log", lambda e: F.col("gone").isNull() | (e["seq"] > F.col("gone"))))
    resets = F.filter("log", lambda e: e["kind"] != "delta")
    start = F.coalesce(F.array_max(F.transform(resets, lambda e: F.struct(e["seq"], e["kind"], e["text"]))), F.lit(None))
    alive = alive.where(F.size("log") > 0).withColumn("start", start)
    parts = F.filter("log", lambda e: F.col("start").isNull() | (F.struct(e["seq"], e["kind"], e["text"]) >= F.col("start")))
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return alive.select("conv_id", "turn", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"), F.array_join(F.transform(parts, lambda e: e["text"]), "").alias("text"))


def render(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, loss_spans)``: one row per conversation.

    Each turn is the opening mark, the role, a line end, the text, the closing mark and a line end, with control strings
    escaped. ``loss_spans`` are the texts of role ``trained``, as offsets in characters and in UTF-8 bytes. A
    conversation is one string, so its turns meet in one row; what one turn gathers was folded before.
    """
    role, text = _escape_role(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    pieces = messages.select("conv_id", "turn", (F.coalesce(F.col("role") == trained, F.lit(False))).alias("loss"), F.concat(F.lit(OPEN), role, F.lit("\n")).alias("head"), text.alias("body"))
    tail = len(CLOSE) + 1
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    at = lambda size: F.coalesce(F.sum(size("head") + size("body") + tail).over(before), F.lit(0)) + size("head")
    placed = pieces.withColumns({"start": at(F.char_length), "byte_start": at(F.octet_length)})
    span = F.struct("start", (F.col("start") + F.char_length("body")).alias("end"), "byte_start", (F.col("byte_start") + F.octet_length("body")).alias("byte_end"))
    row = F.struct("turn", "start", F.concat("head", "body", F.lit(CLOSE + "\n")).alias("piece"), F.when(F.col("loss"), span).alias("span"))
    grouped = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("t"))
    spans = F.filter(F.transform("t", lambda x: x["span"]), lambda s: s.isNotNull())
    return grouped.select("conv_id", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_back(rendered: DataFrame) -> DataFrame:
    """``(conv_id, turns array<struct<role,text>>, loss_text)`` read from the formatted string and its mask alone."""
    parts = F.filter(F.split("formatted", r"\Q" + CLOSE + r"\E\n"), lambda p: p != "")
    cut = F.transform(parts, lambda p: F.struct(F.substring_index(p, "\n", 1).alias("head"), p.alias("all")))
    turns = F.transform(cut, lambda s: F.struct(
        _unescape_role(F.substr(s["head"], F.lit(len(OPEN) + 1))).alias("role"), unescape(F.substr(s["all"], F.char_length(s["head"]) + 2)).alias("text")))
    raw = F.col("formatted").cast("binary")
    masked = F.transform("loss_spans", lambda s: unescape(F.decode(F.substring(raw, s["byte_start"] + 1, s["byte_end"] - s["byte_start"]), "UTF-8")))
    return rendered.select("conv_id", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def rows_as_events(conversations: DataFrame) -> DataFrame:
    """A table of finished rows ``(conv_id, turn, role, text)`` as an event log, a message each.

    Rows of equal turn are ordered by role and text and become turns of their own; a null turn comes first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select("conv_id", F.row_number().over(order).cast("long").alias("turn"), "role", "text").withColumns({"seq": F.col("turn"), "kind": F.lit("message")})


def as_streamed(conversations: DataFrame) -> DataFrame:
    """A table of finished rows ``(conv_id, turn, role, text)`` as the event log that a client may have left.

    A hash of conversation and turn decides how a row came about: as one message; in two deltas after an opening; as a draft
    that was edited; or as a draft that was regenerated in two deltas. Folded again, each row has its text. Turns are numbered
    as by :func:`rows_as_events`.
    """
    rows = rows_as_events(conversations).drop("seq", "kind")
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    one, two = F.left(text, half), F.substr(text, half + 1)
    draft = F.concat(F.lit("draft of "), one)
    logs = [
        [("message", text)], [("message", F.lit("")), ("delta", one), ("delta", two)],
        [("message", draft), ("edit", text)], [("message", draft), ("delta", two), ("regenerate", F.lit("")), ("delta", one), ("delta", two)],
    ]
    event = lambda i, kind, said: F.struct(F.lit(i).alias("i"), F.lit(kind).alias("kind"), said.alias("text"))
    way = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(len(logs)))
    log = F.when(way == 0, F.array(*[event(i, *e) for i, e in enumerate(logs[0])]))
    for k, own in enumerate(logs[1:], 1):
        log = log.when(way == k, F.array(*[event(i, *e) for i, e in enumerate(own)]))
    each = rows.select("conv_id", "turn", "role", F.explode(log).alias("e"))
    return each.select("conv_id", "turn", "role", (F.col("turn") * 8 + F.col("e.i")).alias("seq"), "e.kind", "e.text")


def format_chats(events: DataFrame, trained: str = "assistant") -> DataFrame:
    """Fold an event log and render it; see :func:`fold` and :func:`render`. An empty log gives no row."""
    return render(fold(events), trained)
