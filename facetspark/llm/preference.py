"""Preference formatting, in DataFrame functions only.

A pair is two conversations, arrays of struct(role, text). Their longest
common prefix of turns is rendered once, as the prompt; what follows is
rendered for each, as a completion with a mask: the spans (code points, end
exclusive) that a loss should count, which are the assistant turns' texts and
their end marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetspark.llm.common import col, with_columns

HEAD, MID, TAIL = "<|im_start|>", "\n", "<|im_end|>\n"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(id, turns): one row per conversation, turns ordered by number (equal
    ones by role and text, repeated rows kept). A null role or text is empty;
    turns without a conversation id belong to none and are left out. A
    conversation becomes one record, so it must fit a task, as its rendering
    must."""
    one = F.struct(col(turn_col).alias("turn"), F.coalesce(col(role_col), F.lit("")).alias("role"),
                   F.coalesce(col(text_col), F.lit("")).alias("text"))
    grouped = turns.where(col(id_col).isNotNull()).groupBy(col(id_col).alias("__id")).agg(
        F.array_sort(F.collect_list(one)).alias("t"))
    return grouped.select(F.col("__id").alias(id_col), F.transform(
        "t", lambda x: F.struct(x["role"], x["text"])).alias("turns"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(HEAD), t["role"], F.lit(MID), t["text"], F.lit(TAIL))), "")


def _mask(turns: Column) -> Column:
    """Spans of the assistant turns' texts and end marks in the rendering."""
    head, tail = len(HEAD) + len(MID), len(TAIL)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("m"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + head + F.length(t["role"])
        end = begin + F.length(t["text"]) + tail
        return F.struct(end.alias("at"), F.when(t["role"] == "assistant", F.concat(acc["m"], F.array(F.struct(
            begin.alias("start"), end.alias("end"))))).otherwise(acc["m"]).alias("m"))

    return F.aggregate(turns, start, step, lambda acc: acc["m"])


def format_pairs(df: DataFrame, chosen_col: str = "chosen", rejected_col: str = "rejected") -> DataFrame:
    """Adds n_prompt_turns, prompt, chosen_text, chosen_mask, rejected_text and
    rejected_mask; columns of these names in the input give way.

    A null conversation is empty. Equal conversations have everything in the
    prompt and empty completions; if one is a prefix of the other its
    completion is empty.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    a, b = F.coalesce(col(chosen_col), empty), F.coalesce(col(rejected_col), empty)
    shorter = F.least(F.size(a), F.size(b))
    differ = F.filter(F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>")),
                      lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i)))
    df = with_columns(df, {"n_prompt_turns": F.coalesce(F.array_min(differ), shorter).cast("long")})
    n = F.col("n_prompt_turns").cast("int")
    rest = lambda x: F.slice(x, n + 1, F.greatest(F.size(x) - n, F.lit(0)))
    return with_columns(df, {
        "prompt": _rendered(F.slice(a, F.lit(1), n)), "chosen_text": _rendered(rest(a)), "chosen_mask": _mask(rest(a)),
        "rejected_text": _rendered(rest(b)), "rejected_mask": _mask(rest(b))})


def reply_pairs(convs: DataFrame, replyless: bool = False) -> DataFrame:
    """Pairs from single conversations: chosen is the conversation up to its
    last assistant turn, rejected the same with that turn's text replaced by
    the assistant's turn before it (a reply to something else; empty if there
    is none). Conversations without an assistant turn give no pair, or with
    ``replyless`` a pair of two whole copies, all of it prompt."""
    t = F.col("turns")
    replies = F.filter(F.transform(t, lambda x, i: F.struct(i.alias("i"), x["role"].alias("role"), x["text"].alias(
        "text"))), lambda x: x["role"] == "assistant")
    df = convs.select("*", replies.alias("__r"))
    some = F.size("__r") > 0
    if not replyless:
        df = df.where(some)
    last = F.get("__r", F.size("__r") - 1)["i"]
    wrong = F.when(F.size("__r") > 1, F.get("__r", F.size("__r") - 2)["text"]).otherwise(F.lit(""))
    chosen = F.slice(t, F.lit(1), last + 1)
    rejected = F.concat(F.slice(t, F.lit(1), last), F.array(F.struct(
        F.lit("assistant").alias("role"), wrong.alias("text"))))
    return df.select(*[col(c) for c in convs.columns if c != "turns"], F.when(some, chosen).otherwise(t).alias("chosen"),
                     F.when(some, rejected).otherwise(t).alias("rejected"))
