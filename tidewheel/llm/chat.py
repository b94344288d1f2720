"""Chat formatting from an event log. Spark SQL functions only.

Events of a conversation carry a sequence number, the turn they concern, a kind and text:

- ``message``: the turn's whole text; a later one replaces it
- ``delta``: appended to the turn's text
- ``edit``: replaces the turn's text
- ``regenerate``: discards the turn's text and all later turns begun before; deltas that follow build it anew

The log is partitioned by conversation and folded in order of sequence: windows find the events that later resets or
regenerations leave alive, and the live texts of a turn are joined. Turns are then rendered:

    <|im_start|>role
    text<|im_end|>

each with a newline at the end. In texts and roles a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can
look like a control string and ``unescape`` gives it back; a newline in a role becomes ``<\\n``. The loss mask is the
spans, in code points of the formatted text, of what assistants wrote.

Nulls: a null text is empty, a null role is the role ``null``; events of a null conversation form one conversation; a
null sequence comes first, a null turn is turn -1. Events equal in sequence are ordered by turn, kind and text. Rows
that repeat are one more event each: a repeated message changes nothing. An empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def fold(events: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: the final messages of an event log conv_id, seq, turn, kind, role, text."""
    e = events.select("conv_id", F.coalesce("seq", F.lit(-(1 << 62))).alias("seq"), F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"), F.coalesce("kind", F.lit("message")).alias("kind"), F.coalesce("role", F.lit("null")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ("seq", "turn", "kind", "role", "text")
    later = Window.partitionBy("conv_id").orderBy(*(F.col(c).desc() for c in order)).rowsBetween(Window.unboundedPreceding, -1)
    cut = F.min(F.when(F.col("kind") == "regenerate", F.col("turn"))).over(later)
    alive = e.withColumn("cut", cut).filter("cut is null or turn <= cut")
    upto = Window.partitionBy("conv_id", "turn").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    resets = F.sum((F.col("kind") != "delta").cast("long")).over(upto)
    last = F.max("reset").over(Window.partitionBy("conv_id", "turn"))
    live = alive.withColumn("reset", resets).withColumn("last", last).filter("reset = last")
    said = F.when(F.col("kind") == "regenerate", "").otherwise(F.col("text"))
    parts = live.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct(*order[:4], said.alias("said")))).alias("parts"))
    return parts.select("conv_id", "turn", F.element_at("parts", -1)["role"].alias("role"), F.array_join(F.transform("parts", lambda p: p["said"]), "").alias("text"))


def render(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (start and length in code points) from final messages."""
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    pieces = turns.select("conv_id", "turn", "role", head.alias("head"), body.alias("body"))
    size = F.length("head") + F.length("body") + len(END)
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    span = F.struct(F.col("at").alias("start"), F.length("body").cast("long").alias("length"))
    grouped = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", F.concat("head", "body", F.lit(END)).alias("piece")))).alias("pieces"),
        F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", span))).alias("loss_spans"),
    )
    return grouped.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "loss_spans")


def read_back(rendered: DataFrame) -> DataFrame:
    """conv_id, pos, role, text, in_loss of every turn, from formatted text and mask alone.

    in_loss: a span of the mask covers exactly this turn's text.
    """
    segment = rendered.select("conv_id", F.posexplode(F.split("formatted", r"<\|im_end\|>\n")).alias("pos", "segment")).filter("segment <> ''")
    header = F.locate("\n", F.col("segment"))
    role = F.substr(F.col("segment"), F.lit(len(START) + 1), header - len(START) - 1)
    body = F.substr(F.col("segment"), header + 1)
    before = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("segment") + len(END)).over(before), F.lit(0)) + header
    turns = segment.select("conv_id", "pos", unescape_role(role).alias("role"), unescape(body).alias("text"), start.alias("start"), F.length(body).cast("long").alias("length"))
    spans = rendered.select(F.col("conv_id").alias("c"), F.explode("loss_spans").alias("span"))
    on = turns.conv_id.eqNullSafe(spans.c) & (turns.start == spans.span["start"]) & (turns.length == spans.span["length"])
    return turns.join(spans, on, "left").select("conv_id", "pos", "role", "text", F.col("span").isNotNull().alias("in_loss"))


def digest(rendered: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from what was rendered."""
    turns = read_back(rendered)
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "text", "in_loss"))).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["in_loss"]), lambda t: t["text"]), "")
    sizes = rendered.select(F.col("conv_id").alias("c"), F.length("formatted").cast("long").alias("formatted_chars"))
    found = grouped.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"))
    return found.join(sizes, found.conv_id.eqNullSafe(sizes.c)).drop("c")
