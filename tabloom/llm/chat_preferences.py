"""Preference pairs for training: what two conversations share becomes the prompt.

The longest common prefix of whole turns (equal role and text) is rendered once. The rest of each
conversation is its completion, with the spans of the assistant's words marked: only those are to
be learned, the turns of others in it are masked out.

Defined results: a null role or text is empty, a null conversation has no turns. Conversations
without a common first turn have an empty prompt; equal ones have empty completions. A turn of
any length is rendered whole. Columns other than the two conversations are left as they are.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import fresh


class Template(NamedTuple):
    """What stands around a turn's text; ``open`` holds {role}."""

    open: str = "<|{role}|>\n"
    close: str = "<|end|>\n"
    learned: str = "assistant"


def _header(role: Column, template: Template) -> Column:
    before, _, after = template.open.partition("{role}")
    return F.concat(F.lit(before), role, F.lit(after))


def _render(turns: Column, template: Template) -> Column:
    return F.array_join(
        F.transform(turns, lambda t: F.concat(_header(t["role"], template), t["text"], F.lit(template.close))), ""
    )


def _spans(turns: Column, template: Template) -> Column:
    """(start, end) in characters of each learned text with the mark that closes it."""
    spans = "array<struct<start:int,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("spans"))

    def walk(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_header(turn["role"], template))
        end = begin + F.length(turn["text"]) + F.lit(len(template.close))
        found = F.array(F.struct(begin.alias("start"), end.alias("end")))
        none = F.array().cast(spans)
        learned = F.when(turn["role"] == template.learned, found).otherwise(none)
        return F.struct(end.alias("at"), F.concat(state["spans"], learned).alias("spans"))

    return F.aggregate(turns, start, walk, lambda state: state["spans"])


def format_preferences(
    pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected", template: Template = Template()
) -> DataFrame:
    """Replace two conversations (arrays of structs with role and text) by their rendering.

    Adds prompt, prompt_turns, ``chosen`` and ``rejected`` as texts, and their spans as
    ``<name>_spans``. A projection without a shuffle.
    """
    left, right, shared = fresh(pairs, "turns_chosen", "turns_rejected", "shared")

    def plain(name: str) -> Column:
        empty = F.array().cast("array<struct<role:string,text:string>>")
        turn = lambda t: F.struct(
            F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")
        )
        return F.coalesce(F.transform(F.col(name), turn), empty)

    differs = F.array_position(
        F.zip_with(left, right, lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False))),
        False,
    )
    df = pairs.withColumn(left, plain(chosen)).withColumn(right, plain(rejected))
    df = df.withColumn(shared, F.when(differs == 0, F.size(left)).otherwise(differs.cast("int") - 1))

    def rest(turns: str) -> Column:
        return F.slice(turns, F.col(shared) + 1, F.greatest(F.size(turns) - F.col(shared), F.lit(0)))

    others = [pairs[c] for c in pairs.columns if c not in (chosen, rejected)]
    return df.select(
        *others,
        _render(F.slice(left, F.lit(1), F.col(shared)), template).alias("prompt"),
        F.col(shared).alias("prompt_turns"),
        _render(rest(left), template).alias(chosen),
        _spans(rest(left), template).alias(f"{chosen}_spans"),
        _render(rest(right), template).alias(rejected),
        _spans(rest(right), template).alias(f"{rejected}_spans"),
    )


def paired_answers(conversations: DataFrame, learned: str = "assistant") -> DataFrame:
    """Pairs out of plain conversations, where no preferences are recorded: (conv_id, chosen, rejected).

    The chosen side is a conversation up to its last answer; in the rejected one that answer is
    the last answer of its neighbour (conv_id 2k and 2k + 1 are neighbours). Without an answer in
    the neighbour, or in the conversation, the rejected side has no turns. Turns go by turn,
    then role, then text, nulls first. Turns without a conv_id are of no conversation. Neighbours meet in one shuffle on half the conv_id, so a
    common first turn or repeated conversation gathers nowhere.
    """
    turn = F.struct("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    named = conversations.where(F.col("conv_id").isNotNull())
    both = named.groupBy(F.shiftright("conv_id", 1).alias("pair")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.array_sort(F.collect_set("conv_id")).alias("ids")
    )
    each = both.select("turns", F.explode_outer("ids").alias("conv_id"))
    own = each.select(
        "conv_id",
        F.filter("turns", lambda t: t["conv_id"].eqNullSafe(F.col("conv_id"))).alias("own"),
        F.filter("turns", lambda t: ~t["conv_id"].eqNullSafe(F.col("conv_id")) & (t["role"] == learned)).alias("answers"),
    )
    backwards = F.array_position(F.transform(F.reverse("own"), lambda t: t["role"] == learned), True).cast("int")
    cut = own.withColumn("last", F.when(backwards > 0, F.size("own") + 1 - backwards))
    bare = lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    chosen = F.slice("own", F.lit(1), F.coalesce("last", F.size("own")))
    before = F.slice("own", F.lit(1), F.coalesce(F.col("last") - 1, F.lit(0)))
    answer = F.slice("answers", F.size("answers"), F.lit(1))
    usable = F.col("last").isNotNull() & (F.size("answers") > 0)
    return cut.select(
        "conv_id",
        F.transform(chosen, bare).alias("chosen"),
        F.when(usable, F.transform(F.concat(before, answer), bare)).alias("rejected"),
    )
