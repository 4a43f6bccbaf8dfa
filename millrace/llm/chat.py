r"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs, sorted by turn, adjacent turns of one
role are merged with array aggregation, and everything is concatenated to one text:

    <|start|>role<|text|>turn<|next|>turn of the same role<|end|>\n ...

Roles and texts are escaped so that no control string can occur inside them and the
escape can be undone: a backslash becomes two, and ``<|`` becomes ``<\|``.  ``<|next|>``
stands between merged turns, so the turns can be read back one by one.

The loss mask is an array of (begin, end) code point spans of the formatted text: the
escaped texts of the assistant's turns, without any control string.

Defined cases.  Null text or role: empty.  A null turn comes first.  Rows that
agree in conversation and turn are ordered by role, then text (as they are, before any
escape); repeated rows are turns of their own.  A null conv_id is one
conversation.  Only the named columns are read.  No rows: no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, TEXT, NEXT, END = "<|start|>", "<|text|>", "<|next|>", "<|end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _merge(turns: Column) -> Column:
    """Blocks {role, texts}: sorted turns, adjacent ones of one role together.

    What is aggregated are the places where a role changes; the texts are copied once, from
    each such place to the next.
    """
    role = lambda i: F.try_element_at(turns, i.cast("int")).role
    starts = F.filter(F.sequence(F.lit(1), F.size(turns)), lambda i: (i == 1) | (role(i) != role(F.greatest(i - 1, F.lit(1)))))
    end = lambda starts, k: F.coalesce(F.try_element_at(starts, (k + 2).cast("int")), F.size(turns) + 1)
    return F.transform(starts, lambda s, k: F.struct(role(s).alias("role"), F.transform(F.slice(turns, s, end(starts, k) - s), lambda t: t.text).alias("texts")))


def format_conversations(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Per conversation: its id, formatted, and loss_mask (spans of the turns of `learn`)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = rows.select(F.col(conv).alias("conv"), F.struct(F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text")).alias("t"))
    per = turns.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    escaped = F.transform("turns", lambda t: F.struct(escape(t.role).alias("role"), escape(t.text).alias("text")))
    per = per.select("conv", escaped.alias("turns")).select("conv", _merge(F.col("turns")).alias("blocks"))
    body = F.array_join(F.transform("blocks", lambda b: F.concat(F.lit(START), b.role, F.lit(TEXT), F.array_join(b.texts, NEXT), F.lit(END))), "")
    learned = [escape(F.lit(x)) for x in learn]

    def spans(state: Column, b: Column) -> Column:
        """Walks the blocks, keeping the place in the formatted text and the spans so far."""
        begin = state.at + F.lit(len(START) + len(TEXT)) + F.length(b.role)
        inner = F.aggregate(
            b.texts,
            F.struct(begin.alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans")),
            lambda z, t: F.struct((z.at + F.length(t) + F.lit(len(NEXT))).alias("at"), F.concat(z.spans, F.array(F.struct(z.at.alias("begin"), (z.at + F.length(t)).alias("end")))).alias("spans")),
        )
        return F.struct((inner.at + F.lit(len(END) - len(NEXT))).alias("at"), F.when(b.role.isin(*learned), F.concat(state.spans, inner.spans)).otherwise(state.spans).alias("spans"))

    mask = F.aggregate("blocks", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans")), spans).spans
    return per.select(F.col("conv").alias(conv), body.alias("formatted"), mask.alias("loss_mask"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns, read back from a formatted text."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda b: b != "")

    def turns(b: Column) -> Column:
        role = unescape(F.substring_index(F.substring(b, len(START) + 1, 1 << 30), TEXT, 1))
        texts = F.split(F.substring(b, F.instr(b, TEXT) + len(TEXT), F.lit(1 << 30)), r"<\|next\|>")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substring(formatted, s.begin + 1, s.end - s.begin))), "")
