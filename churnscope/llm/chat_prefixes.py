"""Chat formatting by prefix-target expansion, with built-in functions only.

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``; a conversation's
text is its turns one after the other. Every assistant turn becomes an example of
its own: its context is all that precedes it, and only its reply is trainable.
All examples of a conversation are prefixes of one text, so ``expand`` gives
them as positions in it: a row a turn with the turn's part of the text and
where it starts; on an assistant's row also the example's number, the length of its
context and the span of its loss mask. A long conversation is thus written once,
not once a reply. ``examples`` writes the texts out, one row an example.

Texts can't forge marks: a control string inside a text or role (CONTROLS) gets
a backslash after its first character, ``<\\|im_end|>``; one that has backslashes
there already gets one more, so taking one away gives the text back. Control
strings have their opening character only in front, so two never overlap. In
roles, backslashes become ``\\s`` and line ends ``\\n``.

Starts are running totals over two levels: within chunks of CHUNK turn
numbers, and over the chunks' sums, so that a conversation of any length is spread
over tasks. Only ``read_back`` gathers a conversation in one row, because a
digest of a whole conversation is one value of one string; it is limited by
what one row can hold. It writes out every example of the conversation, one after
the other, and reads each: work that grows with the square of a conversation's turns.

Defined results: a null text or role is empty; a null conv_id is a conversation of
its own; a null turn comes first. Turns of one number go by role, then text, and
repeated rows are turns of their own. Only the role ``assistant`` is trained on.
An empty table gives no rows; extra columns are ignored. Positions count code
points from 0, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: What may not stand in a text as it is: the marks here and other templates' marks.
CONTROLS = [START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]"]
CHUNK = 1024
TRAINED = "assistant"

_tails = "|".join(c[1:].replace("|", r"\|").replace("]", r"\]") for c in CONTROLS)
CONTROL = r"([<\[])(\\*)(" + _tails + ")"
ESCAPED = r"([<\[])\\(\\*)(" + _tails + ")"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("$1$2$3"))


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def expand(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, position, segment, start, example, context_chars, loss_start,
    loss_chars: a row a turn, its part of the conversation's text and where it
    starts. The last four are null but for assistant turns, which are the
    examples: the text before ``loss_start`` is the context with the reply's
    opening, ``context_chars`` of it belong to the turns before."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 empty("role").alias("role"), empty("text").alias("text"))
    head, reply = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")), escape(F.col("text"))
    turns = turns.select("conv_id", "turn", "role", "text", head.alias("head"), reply.alias("reply")).select(
        "conv_id", "turn", "role", "text", F.concat("head", "reply", F.lit(END + "\n")).alias("segment"),
        F.length("head").cast("long").alias("head_chars"), F.length("reply").cast("long").alias("loss_chars"),
        (F.col("role") == TRAINED).cast("long").alias("trained"),
        F.coalesce(F.floor(F.col("turn") / chunk), F.lit(-(1 << 62))).alias("chunk"))
    turns = turns.withColumn("chars", F.length("segment").cast("long"))

    sums = turns.groupBy("conv_id", "chunk").agg(F.sum("chars").alias("c"), F.count("*").alias("n"), F.sum("trained").alias("t"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("conv_id").alias("at_conv"), F.col("chunk").alias("at_chunk"),
                       *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in "cnt"])
    before = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    inside = turns.withColumns({"c1": so_far("chars"), "n1": so_far(F.lit(1)), "t1": so_far("trained")})
    placed = inside.join(sums, F.col("conv_id").eqNullSafe(F.col("at_conv")) & (F.col("chunk") == F.col("at_chunk")))
    start, trained = F.col("c0") + F.col("c1"), F.col("trained") == 1
    return placed.select(
        "conv_id", (F.col("n0") + F.col("n1")).alias("position"), "segment", start.alias("start"),
        F.when(trained, F.col("t0") + F.col("t1")).alias("example"), F.when(trained, start).alias("context_chars"),
        F.when(trained, start + F.col("head_chars")).alias("loss_start"), F.when(trained, F.col("loss_chars")).alias("loss_chars"))


def examples(expanded: DataFrame) -> DataFrame:
    """conv_id, example, text, loss_start, loss_chars: the texts written out, all
    preceding turns and the reply. They grow with the square of a conversation's turns."""
    e, s = expanded.where("example is not null").alias("e"), expanded.alias("s")
    parts = e.join(s, F.col("e.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("s.position") <= F.col("e.position")))
    pieces = F.sort_array(F.collect_list(F.struct("s.position", "s.segment")))
    return parts.groupBy("e.conv_id", "e.example", "e.loss_start", "e.loss_chars").agg(pieces.alias("pieces")).select(
        "conv_id", "example", F.array_join(F.col("pieces.segment"), "").alias("text"), "loss_start", "loss_chars")


def read_back(expanded: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all
    read from the output: the turns by the marks of the conversation's text, the replies
    by writing out every example, one at a time, and reading it by its numbers and by its
    marks. A reply that the two don't agree on is not in the digest."""
    row = F.struct("position", "segment", "example", "context_chars", "loss_start", "loss_chars")
    held = expanded.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    asked = F.transform(F.filter("rows", lambda r: r["example"].isNotNull()), lambda r: r.dropFields("segment"))
    texts = held.select("conv_id", F.array_join(F.col("rows.segment"), "").alias("formatted"), asked.alias("asked"))
    pieces = F.filter(F.split("formatted", START.replace("|", r"\|")), lambda p: p != "")
    texts = texts.select("conv_id", "formatted", "asked", pieces.alias("pieces"))

    def turn(p: Column) -> Column:
        at = F.locate("\n", p)
        last = F.length(p) - at - len(END) - 1
        return F.concat(unescape_role(p.substr(F.lit(1), at - 1)), F.lit("\n"), unescape(p.substr(at + 1, last)), F.lit("\n"))

    turns = texts.select(
        "conv_id", F.size("pieces").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("pieces", turn), ""), 256).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "formatted", F.explode_outer("asked").alias("e"))

    def part(text: Column, start: Column, chars: Column) -> Column:
        return text.substr((start + 1).cast("int"), chars.cast("int"))

    start, context = F.col("e.loss_start"), F.col("e.context_chars")
    # the example as it is trained on: all turns before the reply, the reply and its closing mark
    text = part(F.col("formatted"), F.lit(0), start + F.col("e.loss_chars") + len(END) + 1)
    told = turns.select("conv_id", "n_turns", "turns_sha256", "formatted_chars", "e", text.alias("text"))
    told = told.withColumns({"before": part(F.col("text"), F.lit(0), context), "last": part(F.col("text"), context, F.lit((1 << 31) - 1))})
    told = told.withColumns({"opening": part(F.col("last"), F.lit(0), start - context), "reply": part(F.col("last"), start - context, F.col("e.loss_chars"))})
    marks = (F.octet_length("text") - F.octet_length(F.replace("text", F.lit(START), F.lit("")))) / len(START)
    agreed = (marks == F.col("e.position") + 1) & (F.col("last") == F.concat(F.col("opening"), F.col("reply"), F.lit(END + "\n")))
    agreed &= F.substring_index("text", START, -1) == F.substring_index("last", START, -1)
    agreed &= (F.col("opening") == START + TRAINED + "\n") & ((context == 0) | F.col("before").endswith(END + "\n"))
    found = told.groupBy("conv_id").agg(*[F.first(c).alias(c) for c in ("n_turns", "turns_sha256", "formatted_chars")], F.sort_array(
        F.collect_list(F.struct("e.example", F.when(agreed, unescape(F.col("reply"))).alias("reply")))).alias("replies"))
    masked = found.withColumn("masked", F.array_join("replies.reply", ""))
    return masked.select("conv_id", "n_turns", "turns_sha256", F.length("masked").cast("long").alias("loss_chars"),
                         F.sha2(F.col("masked"), 256).alias("loss_sha256"), "formatted_chars")
