"""Chat formatting: turns to one marked text with a loss mask, and back. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, BREAK, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"

#: Strings that must not appear in a text as they are: this template's own, and those of another common one.
CONTROLS = ["<|im_start|>", "<|im_sep|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]"]


def _code(control: str) -> str:
    return f"%{ord(control[0]):02X}"


def _firsts(controls: list[str]) -> list[str]:
    firsts = sorted({c[0] for c in controls})
    for c in controls:
        if "%" in c or any(x in c[1:] for x in firsts):
            raise ValueError(f"a control string may not hold % or begin anew inside: {c!r}")
    return firsts


def escape(text: Column, controls: list[str] = CONTROLS) -> Column:
    """``%`` becomes ``%25``; the first character of every control string becomes its code."""
    _firsts(controls)
    text = F.replace(text, F.lit("%"), F.lit("%25"))
    for c in sorted(controls, key=len, reverse=True):
        text = F.replace(text, F.lit(c), F.lit(_code(c) + c[1:]))
    return text


def unescape(text: Column, controls: list[str] = CONTROLS) -> Column:
    """Undo ``escape``: every ``%`` in an escaped text begins a code, so the order of the steps is safe."""
    for first in _firsts(controls):
        text = F.replace(text, F.lit(_code(first)), F.lit(first))
    return F.replace(text, F.lit("%25"), F.lit("%"))


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("%0A"))


def format_chats(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row ``conv_id, formatted, loss_spans`` per conversation.

    Turns are sorted by ``turn``, then role and text. Adjacent turns of one role become one block
    ``<|im_start|>role\\n text <|im_sep|> text <|im_end|>\\n``, whose inner break keeps the turns apart.
    ``loss_spans`` holds the start and end (code points of ``formatted``) of each text of role ``trained``.

    Null text and null role count as empty; a null ``conv_id`` is a conversation of its own; turns without a
    number come first; repeated rows are repeated turns. An empty table gives no rows, other columns are not read.
    The result is one text per conversation, so a conversation's turns meet in one row and nothing more does.
    """
    turns = conversations.select(
        "conv_id",
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"),
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # a block begins where the role changes
    begins = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: (i == 1) | (F.element_at("turns", i)["role"] != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"]),
    )
    begun = turns.select("conv_id", "turns", begins.alias("begins"))
    merged = begun.select("conv_id", F.transform(
        "begins",
        lambda b, i: F.struct(
            F.element_at("turns", b)["role"].alias("role"),
            F.transform(
                F.slice("turns", b, F.coalesce(F.get("begins", i + 1), F.size("turns") + 1) - b), lambda t: escape(t["text"])
            ).alias("texts"),
        ),
    ).alias("blocks"))
    pieces = merged.select("conv_id", F.flatten(F.transform(
        "blocks",
        lambda b: F.flatten(F.array(
            F.array(F.struct(F.concat(F.lit(START), _role(b["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss"))),
            F.flatten(F.transform(b["texts"], lambda t, i: F.array(
                F.struct(F.when(i > 0, BREAK).otherwise("").alias("text"), F.lit(False).alias("loss")),
                F.struct(t.alias("text"), (b["role"] == trained).alias("loss")),
            ))),
            F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss"))),
        )),
    )).alias("pieces"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    marked = F.aggregate(
        "pieces", start,
        lambda a, p: F.struct(
            (a["at"] + F.length(p["text"])).alias("at"),
            F.when(p["loss"], F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), (a["at"] + F.length(p["text"])).alias("end")))))
            .otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return pieces.select("conv_id", F.array_join(F.col("pieces.text"), "").alias("formatted"), marked.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as ``array<struct<role, text>>``."""
    blocks = F.split(formatted, r"\Q" + END + r"\E")
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        body = F.substring(block, F.lit(len(START) + 1), F.length(block))
        head = F.substring_index(body, "\n", 1)
        role = unescape(F.replace(head, F.lit("%0A"), F.lit("\n")))
        text = F.substring(body, F.length(head) + 2, F.length(body))
        return F.transform(F.split(text, r"\Q" + BREAK + r"\E"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def chat_digest(chats: DataFrame) -> DataFrame:
    """Digest columns read back from the output of ``format_chats``."""
    back = chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
