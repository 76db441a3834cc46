r"""Chat formatting: conversations of typed parts become one text with a loss mask and attachments.

A message holds parts of kind text, image, audio or document. A visitor turns each part into text:
a text part into itself with control strings escaped, every other part into its placeholder, while
its reference and the number of tokens its placeholder expands to are recorded in order. A turn is

    <s>role[INST]body[/INST]</s>

Escaping doubles every backslash and puts one after the first character of a control string, so a
body never holds a control string of its own and `unescaped` gives back what went in.

A null text, role or part counts as empty, a part of unknown kind as text. Turns are ordered by turn
(null first), role and text as it came in; repeated rows stay turns of their own. Messages without conversation id
form one conversation. An empty table gives no conversations. A conversation is one row of the
result, so its messages meet in one task however many they are; all else is done before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What marks turns and attachments in a formatted text.
TURN, BODY, BODY_END, TURN_END = "<s>", "[INST]", "[/INST]", "</s>"
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
_CONTROL = r"(<|\[)(/?s>|image>|audio>|document>|/?INST\])"

PART = "struct<kind: string, text: string, uri: string, width: int, height: int, seconds: double, pages: int>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


class PartVisitor:
    """What each kind of part becomes in the text, and how many tokens its placeholder expands to."""

    def __init__(self, patch: int = 28, tokens_per_second: float = 25.0, tokens_per_page: int = 512):
        self.patch, self.tokens_per_second, self.tokens_per_page = patch, tokens_per_second, tokens_per_page

    def text(self, part: Column) -> Column:
        return escaped(F.coalesce(part["text"], F.lit("")))

    def image_tokens(self, part: Column) -> Column:
        def tiles(side):
            return F.greatest(F.ceil(F.coalesce(part[side], F.lit(0)) / self.patch), F.lit(1))

        return tiles("width") * tiles("height")

    def audio_tokens(self, part: Column) -> Column:
        return F.greatest(F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.tokens_per_second), F.lit(1))

    def document_tokens(self, part: Column) -> Column:
        return F.greatest(F.coalesce(part["pages"], F.lit(0)) * self.tokens_per_page, F.lit(1))

    def visit(self, part: Column) -> Column:
        shown = self.text(part)
        for kind, placeholder in PLACEHOLDERS.items():
            shown = F.when(part["kind"] == kind, F.lit(placeholder)).otherwise(shown)
        return shown

    def attachment(self, part: Column) -> Column:
        tokens = F.lit(None).cast("long")
        for kind in PLACEHOLDERS:
            tokens = F.when(part["kind"] == kind, getattr(self, f"{kind}_tokens")(part).cast("long")).otherwise(tokens)
        return F.struct(part["kind"].alias("kind"), part["uri"].alias("uri"), tokens.alias("n_tokens"))


def text_part(text: Column) -> Column:
    """A message that is one text."""
    empty = {"kind": F.lit("text"), "text": text}
    fields = [f.split(":") for f in PART[len("struct<"):-1].split(", ")]
    return F.array(F.struct(*[empty.get(n, F.lit(None)).cast(k.strip()).alias(n) for n, k in fields]))


def formatted_chats(messages: DataFrame, visitor: PartVisitor | None = None, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation of messages (conv_id, turn, role, content: array of PART).

    conv_id, n_turns, formatted, loss_spans (begin and length in code points of the formatted text),
    attachments in order (position of the turn, kind, uri, tokens) and expanded_tokens, their sum.
    """
    visitor = visitor or PartVisitor()
    content = F.filter(F.coalesce("content", F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = messages.select(
        F.col("conv_id"), F.col("turn"), role.alias("role"),
        F.concat(F.lit(TURN), escaped(role), F.lit(BODY)).alias("head"),
        F.array_join(F.transform(content, visitor.visit), "").alias("body"),
        F.transform(F.filter(content, lambda p: p["kind"].isin(*PLACEHOLDERS)), visitor.attachment).alias("attached"),
    )
    tail = BODY_END + TURN_END
    length = F.char_length("head") + F.char_length("body") + len(tail)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", unescaped(F.col("body")), "body")
    placed = rows.select(
        "conv_id", F.row_number().over(order).alias("at"),
        F.concat("head", "body", F.lit(tail)).alias("shown"),
        F.when(F.col("role") == loss_role, F.struct(
            (F.coalesce(F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.char_length("head")).alias("begin"),
            F.char_length("body").cast("long").alias("length"),
        )).alias("loss"),
        "attached",
    )
    turns = F.array_sort(F.collect_list(F.struct("at", "shown", "loss", "attached")))
    whole = placed.groupBy("conv_id").agg(turns.alias("turns"))
    attachments = F.flatten(F.transform("turns", lambda t: F.transform(t["attached"], lambda a: F.struct(
        t["at"].alias("turn_at"), a["kind"].alias("kind"), a["uri"].alias("uri"), a["n_tokens"].alias("n_tokens")))))
    return whole.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["loss"]), lambda x: x.isNotNull()).alias("loss_spans"),
        attachments.alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["n_tokens"]))


def read_turns(formatted: Column) -> Column:
    """Array of role and text, unescaped, as they stand in a formatted text."""
    pieces = F.split(formatted, TURN_END)

    def turn(piece):
        parts = F.split(piece, r"\[/?INST\]")
        return F.struct(unescaped(F.substr(parts[0], F.lit(len(TURN) + 1))).alias("role"), unescaped(parts[1]).alias("text"))

    return F.transform(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescaped(
        F.substring(formatted, (s["begin"] + 1).cast("int"), s["length"].cast("int")))), "")
