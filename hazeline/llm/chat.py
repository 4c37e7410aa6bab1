r"""Chat formatting of typed content parts, with a loss mask, and reading it back.

A turn's parts are visited in order: text is escaped and goes in as it is, while an image,
audio or document part leaves a placeholder with its number and is recorded as an
attachment with the count of tokens it will expand to. A turn is written

    <|turn|>role<|text|>content<|end|>

and the mask holds the code points of every assistant content. Control strings in roles and
texts are broken up reversibly: a backslash doubles, and the bracket that begins a control
string (of this template or another common one) becomes ``\l`` or ``\b``. Inside escaped
content no control string is left, so reading back needs only the template's own marks.

Edge cases: a null text is empty; a null role is the empty role; a null turn comes first;
rows of one turn are ordered by role, then text, and repeated ones all count; very long texts
stay whole; a null conversation id is a conversation of
its own; unknown part types are errors of the input and are written as text placeholders;
other columns are not read. A conversation is one output row, so its rows meet in one task;
they are gathered by a map-side aggregation.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import sha256

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Begin control strings of this and other templates.
ANGLE = r"<(?=\||/?s>|</?SYS>>)"
SQUARE = r"\[(?=/?INST\])"
#: Tokens of an attachment: per image tile of this edge, per second of audio, per page.
TILE, TILE_TOKENS, SECOND_TOKENS, PAGE_TOKENS = 336, 144, 25, 600
LEARNT = "assistant"


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.regexp_replace(text, ANGLE, "\\\\l")
    return F.regexp_replace(text, SQUARE, "\\\\b")


def unescaped(text: Column) -> Column:
    """Between doubled backslashes, which are cut from the left, the two codes stand for brackets."""
    pieces = F.split(text, r"\\\\", -1)
    plain = F.transform(
        pieces, lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))
    )
    return F.array_join(plain, "\\")


def part_tokens(part: Column) -> Column:
    """Tokens a part expands to; a text's are not known here and count 0."""
    side = lambda name: F.ceil(F.coalesce(part[name], F.lit(TILE)) / TILE)
    return (
        F.when(part["kind"] == "image", side("width") * side("height") * TILE_TOKENS)
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * SECOND_TOKENS))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(1)) * PAGE_TOKENS)
        .otherwise(0)
        .cast("long")
    )


def visited(parts: Column) -> Column:
    """A turn's content: ordered texts and placeholders, and its attachments."""
    attached = F.filter(parts, lambda p: p["kind"] != "text")
    number = lambda i: F.size(F.filter(F.slice(parts, F.lit(1), i + 1), lambda p: p["kind"] != "text"))
    content = F.transform(
        parts,
        lambda p, i: F.when(p["kind"] == "text", escaped(F.coalesce(p["text"], F.lit("")))).otherwise(
            F.concat(F.lit("<|"), escaped(p["kind"]), F.lit(" "), number(i).cast("string"), F.lit("|>"))
        ),
    )
    return F.struct(
        F.array_join(content, "").alias("content"),
        F.transform(
            attached,
            lambda p, i: F.struct(
                (i + 1).alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"), part_tokens(p).alias("tokens")
            ),
        ).alias("attachments"),
    )


#: What a part of each kind has besides its kind and text.
DETAILS = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}


def text_part(text: Column) -> Column:
    """A turn of one plain text as an array of parts."""
    details = [F.lit(None).cast(kind).alias(name) for name, kind in DETAILS.items()]
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *details))


def formatted(turns: DataFrame, parts: Column | None = None) -> DataFrame:
    """One row per conversation: ``formatted``, its loss mask, attachments and their tokens.

    ``turns`` has ``conv_id, turn, role, text``; ``parts``, if given, is an array of
    structs (kind, text and DETAILS) that is used instead of ``text``. ``loss_spans`` are ``{start, length}`` in code
    points from 0.
    """
    parts = text_part(F.coalesce("text", F.lit(""))) if parts is None else parts
    role = F.coalesce("role", F.lit(""))
    row = F.struct(F.col("turn").alias("turn"), role.alias("role"), visited(parts).alias("flat"))
    ordered = F.sort_array(F.collect_list("row"))  # fields in order, nulls first
    gathered = turns.select("conv_id", row.alias("row")).groupBy("conv_id").agg(ordered.alias("rows"))
    head = lambda r: F.concat(F.lit(TURN), escaped(r["role"]), F.lit(TEXT))
    body = lambda r: r["flat"]["content"]
    whole = F.array_join(F.transform("rows", lambda r: F.concat(head(r), body(r), F.lit(END))), "")
    pieces = F.transform(
        "rows", lambda r: F.struct(F.length(head(r)).alias("head"), F.length(body(r)).alias("body"), (r["role"] == LEARNT).alias("learnt"))
    )
    spans = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, length: int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + p["head"] + p["body"] + len(END)).alias("at"),
            F.when(
                p["learnt"],
                F.concat(
                    acc["spans"],
                    F.array(F.struct((acc["at"] + p["head"]).alias("start"), p["body"].alias("length"))),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    with_turn = lambda a, i: F.struct(i.alias("turn"), *[a[n].alias(n) for n in ("number", "kind", "ref", "tokens")])
    attachments = F.flatten(
        F.transform("rows", lambda r, i: F.transform(r["flat"]["attachments"], lambda a: with_turn(a, i)))
    )
    tokens = F.aggregate("attachments", F.lit(0).cast("long"), lambda t, a: t + a["tokens"])
    return gathered.select(
        "conv_id", whole.alias("formatted"), spans.alias("loss_spans"), attachments.alias("attachments")
    ).withColumn("attachment_tokens", tokens)


def read_back(chats: DataFrame) -> DataFrame:
    """The turns and the learnt text of formatted conversations, from the output alone."""
    pieces = F.split("formatted", r"<\|end\|>", -1)
    turns = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            unescaped(F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), TEXT, 1)).alias("role"),
            unescaped(F.substr(p, F.length(F.substring_index(p, TEXT, 1)) + len(TEXT) + 1)).alias("text"),
        ),
    )
    learnt = F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    return chats.select("conv_id", turns.alias("turns"), F.array_join(learnt, "").alias("learnt"), F.length("formatted").cast("long").alias("formatted_chars"))


def digests(chats: DataFrame) -> DataFrame:
    back = read_back(chats)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256(said).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        sha256(F.col("learnt")).alias("loss_sha256"),
        "formatted_chars",
    )
