"""Preference formatting of conversations for training on chosen and rejected answers.

Of each pair the longest common prefix of turns (same role and text) is rendered once as the prompt;
what follows of the chosen and of the rejected conversation are the two completions. A completion
comes with a mask in runs, (trained, length in code points), which tile it: answers with their end mark
are trained on, role headers and other roles' turns are not.

Edge cases: a null role or text is an empty one, and equal to an empty one; turns are ordered by turn, role and text, so
repeated and tied rows have a fixed order, null turns first; identical conversations leave both completions empty; a
pair of which one side is missing has an empty common prefix and no completion on that side; turns without a
pair id belong to no pair and give no row; an empty table gives no rows; other columns are not read. A conversation is one
row of the result, so its turns meet in one task; nothing larger does.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modlake.llm.store import parts_for, stored, text_size


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def _mask(turns: Column, trained_role: str) -> Column:
    def runs(t: Column) -> Column:
        header = F.char_length(t["role"]) + len("<||>\n")
        return F.array(
            F.struct(F.lit(False).alias("trained"), header.cast("long").alias("length")),
            F.struct((t["role"] == trained_role).alias("trained"), (F.char_length(t["text"]) + len("<|end|>\n")).cast("long").alias("length")),
        )

    return F.flatten(F.transform(turns, runs))


def format_preferences(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Of turns (pair_id, side: 'chosen' or 'rejected', turn, role, text) one row for each pair:

    pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    side = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == s, turn))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    pairs = turns.where("pair_id IS NOT NULL").groupBy("pair_id").agg(side("chosen").alias("c"), side("rejected").alias("r"))
    shorter = F.least(F.size("c"), F.size("r"))
    apart = F.array_position(F.zip_with(F.slice("c", 1, shorter), F.slice("r", 1, shorter), lambda a, b: a != b), True).cast("int")
    common = F.when(apart > 0, apart - 1).otherwise(shorter)
    pairs = pairs.withColumn("n_prompt_turns", common)
    rest = lambda s: F.slice(s, F.col("n_prompt_turns") + 1, F.greatest(F.size(s), F.lit(1)))
    return pairs.select(
        "pair_id", "n_prompt_turns", _text(F.slice("c", F.lit(1), F.col("n_prompt_turns"))).alias("prompt"),
        _text(rest("c")).alias("chosen"), _text(rest("r")).alias("rejected"),
        _mask(rest("c"), trained_role).alias("chosen_mask"), _mask(rest("r"), trained_role).alias("rejected_mask"),
    )


def paired_with_next_answered(conversations: DataFrame, part_bytes: int = 16 << 20) -> DataFrame:
    """Pairs out of plain conversations (conv_id, turn, role, text), for format_preferences(): one of each that has an answer.

    The chosen side is the conversation. The rejected side has its last answer replaced by the last answer of
    the next conversation with an answer in the order of ids, whatever lies between; after
    the last comes the first, so one alone is paired with itself. Conversations without any answer and turns
    without a conv_id make no pair. Answers are sorted by ranges of ids; the edges of the ranges are joined afterwards.
    """
    rows = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text")
    answers = rows.where("role = 'assistant'").groupBy("conv_id").agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("a"))
    last = answers.select("conv_id", F.col("a.turn").alias("last_turn"), F.col("a.text").alias("last_text"))
    n_parts = parts_for(text_size(last, "last_text")[1], part_bytes)
    ranged = stored(last.repartitionByRange(n_parts, "conv_id").withColumn("part", F.spark_partition_id()), "answers")
    within = ranged.withColumn("other", F.lead("last_text").over(Window.partitionBy("part").orderBy("conv_id")))
    firsts = ranged.groupBy("part").agg(F.min_by("last_text", "conv_id").alias("first_text"))
    # one number a partition; the partition after the last is the first
    after = firsts.select("part", F.lead("part").over(Window.orderBy("part")).alias("then"))
    after = after.crossJoin(F.broadcast(firsts.agg(F.min("part").alias("lowest")))).select("part", F.coalesce("then", "lowest").alias("then"))
    edges = after.join(firsts.withColumnRenamed("part", "then"), "then").select("part", "first_text")
    pairs = within.join(edges, "part").select("conv_id", "last_turn", "last_text", F.coalesce("other", "first_text").alias("other"))
    return _sides(rows, pairs)


def _sides(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Both sides of pairs (conv_id, last_turn, last_text, other) out of the turns of rows."""
    both = rows.join(pairs.withColumnRenamed("conv_id", "of"), F.col("conv_id") == F.col("of"))
    replaced = (F.col("role") == "assistant") & F.col("turn").eqNullSafe(F.col("last_turn")) & (F.coalesce("text", F.lit("")) == F.col("last_text"))
    sides = F.explode(
        F.array(
            F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")),
            F.struct(F.lit("rejected").alias("side"), F.when(replaced, F.col("other")).otherwise(F.col("text")).alias("text")),
        )
    )
    return both.select(F.col("conv_id").alias("pair_id"), "turn", "role", sides.alias("s")).select("pair_id", "s.side", "turn", "role", "s.text")
