"""Chat formatting with typed content parts, in DataFrame functions only.

A turn has parts: text, image, audio or document. The visitor flattens them in order into one
string; a part that is not text becomes a numbered placeholder, recorded as an attachment with its
reference and the tokens it expands to. Turns are marked by control strings, and whatever
looks like one inside a text is escaped reversibly by a backslash after its
first character. The loss mask is a list of spans over the formatted string, one per assistant text.

A conversation is one string and so one row in the end; its turns are numbered by a window and gathered once.

Defined results: null texts, roles, part lists and references are empty; turns order by ``turn`` (null first),
then role, then content, so ties and repeated rows have one order; an unknown part type is a document; null sizes
count as zero, with one token at least; rows of a null conv_id are one conversation; no rows give no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END, PART = "<|turn|>", "<|end|>\n", "<|{}:{}|>"
ASSISTANT = "assistant"
PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
#: Pixels of an image token's side, audio tokens a second, tokens of a document page.
IMAGE_SIDE, AUDIO_RATE, PAGE_TOKENS = 28, 25, 512
#: First character, backslashes of earlier escapes, rest of a control string.
_OPEN, _REST = r"([<\[])", r"(\||/?s>|/?INST\]|/?SYS>>|<SYS>>|</SYS>>)"
_CONTROL = _OPEN + r"(\\*)" + _REST
_ESCAPED = _OPEN + r"\\(\\*)" + _REST


def escaped(text: Column) -> Column:
    """No control string is left in the text; ``unescaped`` restores it."""
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _role_in(role: Column) -> Column:
    """A role on one line: a line break and a backslash in it are written as two characters."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """A plain text as one part."""
    fields = [F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text")]
    rest = [("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int")]
    return F.array(F.struct(*fields, *(F.lit(None).cast(k).alias(n) for n, k in rest)))


def _tokens(p: Column) -> Column:
    """Tokens that a part's placeholder expands to."""

    def whole(x: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.coalesce(x, F.lit(0.0)))).cast("bigint")

    image = whole(p.width / IMAGE_SIDE) * whole(p.height / IMAGE_SIDE)
    return F.when(p.type == "image", image).when(p.type == "audio", whole(p.seconds * AUDIO_RATE)).otherwise(whole(p.pages * F.lit(float(PAGE_TOKENS))))


def _is_text(p: Column) -> Column:
    return F.coalesce(p.type, F.lit("text")) == "text"


def _kind(p: Column) -> Column:
    return F.when(p.type.isin("image", "audio"), p.type).otherwise(F.lit("document"))


def flattened(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, parts) with ``content`` and ``attachments``, in order ``place``.

    The placeholders of a conversation are numbered from 1 through all its turns.
    """
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("parts", F.array().cast(PARTS)).alias("parts"))
    media = F.filter("parts", lambda p: ~_is_text(p))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", F.to_json("parts"))
    numbered = turns.withColumn("place", F.row_number().over(order)).withColumn("n_media", F.size(media))
    before = F.sum("n_media").over(Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    numbered = numbered.withColumn("before", F.coalesce(before, F.lit(0)))

    def number(i: Column) -> Column:
        return F.col("before") + F.size(F.filter(F.slice("parts", F.lit(1), i + 1), lambda p: ~_is_text(p)))

    def visit(p: Column, i: Column) -> Column:
        mark = F.concat(F.lit("<|"), _kind(p), F.lit(":"), number(i).cast("string"), F.lit("|>"))
        return F.when(_is_text(p), escaped(F.coalesce(p.text, F.lit("")))).otherwise(mark)

    def attach(p: Column, i: Column) -> Column:
        return F.struct(
            (F.col("before") + i + 1).alias("number"), _kind(p).alias("type"), F.coalesce(p.ref, F.lit("")).alias("ref"), _tokens(p).alias("tokens")
        )

    return numbered.select(
        "conv_id", "place", "role", F.array_join(F.transform("parts", visit), "").alias("content"), F.transform(media, attach).alias("attachments")
    )


def formatted(turns: DataFrame) -> DataFrame:
    """One row per conversation: its string, loss spans, attachments and expanded tokens.

    ``loss_spans`` are (start, length) in characters of ``formatted``.
    """
    rows = flattened(turns)
    head = F.concat(F.lit(TURN), _role_in(F.col("role")), F.lit("\n"))
    rows = rows.withColumn("head", head).withColumn("piece", F.concat("head", "content", F.lit(END)))
    ahead = F.sum(F.char_length("piece")).over(Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(ahead, F.lit(0)) + F.char_length("head")
    span = F.when(F.col("role") == ASSISTANT, F.struct(start.alias("start"), F.char_length("content").cast("bigint").alias("length")))
    rows = rows.select("conv_id", F.struct("place", "piece", span.alias("span"), "attachments").alias("t"))
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    spans = F.filter(F.transform("t", lambda x: x.span), lambda s: s.isNotNull())
    attachments = F.flatten(F.transform("t", lambda x: x.attachments))
    return gathered.select(
        "conv_id", F.array_join(F.transform("t", lambda x: x.piece), "").alias("formatted"), spans.alias("loss_spans"), attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda s, a: s + a.tokens).alias("media_tokens"),
    )


def parsed(formatted_rows: DataFrame) -> DataFrame:
    """Read back from the strings alone: ``turns`` (role, text) and ``loss_texts``, unescaped."""
    pieces = F.slice(F.split("formatted", r"<\|turn\|>"), 2, 1 << 30)

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, "\n")
        body = F.substring(piece, cut + 1, F.char_length(piece) - cut - len(END))
        return F.struct(_role_out(F.substring(piece, F.lit(1), cut - 1)).alias("role"), unescaped(body).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), (s.start + 1).cast("int"), s.length.cast("int"))))
    return formatted_rows.select("*", F.transform(pieces, turn).alias("turns"), loss.alias("loss_texts"))
