"""Preference pairs from conversations, in DataFrame operations.

A pair is a chosen and a rejected conversation. Their longest common prefix of
whole turns (same role, same text, in order of turn number) is rendered once
as the prompt; what follows in each is rendered as its completion, with the
spans of code points that carry loss: the text of the assistant's turns in
the completion and the mark that ends each. The rest is masked.

Defined cases: turns without a conversation id are left out; of rows that
repeat a turn number the first in (role, text) order counts; a null role is a
user's, a null text is empty, a null turn number comes first. A pair that lacks
one side has no row. If both sides are equal, both completions are empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The template's marks.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turns(rows: DataFrame, key: str, name: str) -> DataFrame:
    """One row a key: its turns in order, as array of (role, text) with the template's marks taken from the texts."""
    clean = rows.where(F.col(key).isNotNull()).select(
        F.col(key).alias("pair_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), F.lit("user")).alias("role"),
        F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"))
    one = clean.groupBy("pair_id", "turn").agg(F.min(F.struct("role", "text")).alias("t"))
    return one.groupBy("pair_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "t"))),
                                                  lambda x: x["t"]).alias(name))


def _rendered(turns: str) -> str:
    return (f"array_join(transform({turns}, t -> concat('{OPEN}', t.role, '\\n', t.text, '{CLOSE}', '\\n')), '')")


def _spans(turns: str) -> str:
    """``start:end`` of the assistant's texts and their end marks in the rendered ``turns``, comma-joined."""
    head = f"{len(OPEN) + 1} + length(t.role)"
    return f"""aggregate({turns},
        named_struct('at', 0, 'out', cast(array() as array<string>)),
        (s, t) -> named_struct('at', s.at + {head} + length(t.text) + {len(CLOSE) + 1}, 'out',
            if(t.role = 'assistant', array_append(s.out, concat(s.at + {head}, ':',
                s.at + {head} + length(t.text) + {len(CLOSE)})), s.out)),
        s -> array_join(s.out, ','))"""


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """(pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans) of each pair.

    ``chosen`` and ``rejected`` hold one row a turn: the pair's ``key``, turn, role, text.
    """
    both = _turns(chosen, key, "c").join(_turns(rejected, key, "r"), "pair_id")
    # the first place that differs; a side that is shorter is padded with null, which differs
    both = both.withColumn("_at", F.expr("array_position(zip_with(c, r, (x, y) -> x <=> y), false)"))
    both = both.withColumn("n", F.expr("cast(if(_at = 0, size(c), _at - 1) as int)"))
    split = both.select("pair_id", "n", F.expr("slice(c, 1, n)").alias("p"),
                        F.expr("slice(c, n + 1, size(c))").alias("c"), F.expr("slice(r, n + 1, size(r))").alias("r"))
    return split.select("pair_id", F.col("n").alias("n_prompt_turns"), F.expr(_rendered("p")).alias("prompt"),
                        F.expr(_rendered("c")).alias("chosen"), F.expr(_rendered("r")).alias("rejected"),
                        F.expr(_spans("c")).alias("chosen_spans"), F.expr(_spans("r")).alias("rejected_spans"))


def swapped_replies(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides made of a plain table of conversations.

    Chosen is every conversation with an assistant's turn, as it is. Rejected
    is the same with its last assistant's text replaced by that of its
    neighbour (ids 2n and 2n + 1 are neighbours; without one, by no text).
    """
    last = (conversations.where("conv_id is not null and role = 'assistant'").groupBy("conv_id")
            .agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("l")))
    other = last.select(F.expr("conv_id ^ 1").alias("conv_id"), F.col("l.text").alias("other"))
    swap = last.join(other, "conv_id", "left").select(
        "conv_id", F.col("l.turn").alias("at"), F.coalesce("other", F.lit("")).alias("other"))
    sides = conversations.select("conv_id", "turn", "role", "text").join(swap, "conv_id")
    chosen = sides.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    new = F.when(F.col("turn").eqNullSafe(F.col("at")) & (F.col("role") == "assistant"), F.col("other")).otherwise(F.col("text"))
    return chosen, sides.select(F.col("conv_id").alias("pair_id"), "turn", "role", new.alias("text"))
