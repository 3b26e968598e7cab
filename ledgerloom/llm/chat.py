"""Chat formatting: every dialogue once for each participant, with that speaker as the assistant.

One row for each perspective and turn.  A dialogue's rendering is the concatenation
of its rows' ``text`` by ``position``; ``start`` and ``end`` (code points) are the
place of the row's ``content`` in it, and ``trained`` marks the perspective's own turns.
Long form keeps a dialogue of any length out of a single task; ``assembled`` puts
together those that are short enough to be examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.skew import UNCUT, split_hot_groups

#: turns of one block of offsets; rows above which a conversation is cut by its whole order instead
BLOCK, LONG = 1024, 100_000
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _header(role: Column, name: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.when(name.isNotNull(), F.concat(F.lit(" name="), name)).otherwise(""), F.lit("\n"))


def perspectives(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
                 scene: str = "system", long: int = LONG) -> DataFrame:
    """(conv_id, perspective, turn, position, role, name, text, start, end, trained).

    Participants are the distinct speakers of a conversation but for ``scene``, whose
    turns stay instructions.  Others than the perspective are users named by their
    speaker.  Turns are ordered by number, then speaker, then text, missing values
    first; repeated rows stay repeated turns.  A missing text is empty, a missing
    speaker is the participant "unknown", and rows without a conversation id form one
    conversation.  A conversation of scene turns alone has no perspective and no row.
    A conversation of more than ``long`` rows is sorted by range over its whole order, so
    that missing or tied turns, and rows without an id, don't meet in one task.
    """
    said = turns.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{speaker}`"), F.lit("unknown")).alias("who"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("content"))
    order = [F.asc_nulls_first("turn"), "who", "content"]
    said, _ = split_hot_groups(said, ["conv"], [F.asc_nulls_first("turn"), F.asc("who"), F.asc("content")], long)
    people = said.where(F.col("who") != scene).select(F.col("conv").alias("c"), F.col("who").alias("perspective")).distinct()
    seen = said.join(people, F.col("conv").eqNullSafe(F.col("c")))
    own = F.col("who") == F.col("perspective")
    role = F.when(own, "assistant").when(F.col("who") == scene, "system").otherwise("user")
    cast = seen.select("conv", "perspective", "turn", "__piece", "who", "content", role.alias("role")).withColumn(
        "name", F.when(F.col("role") == "user", F.col("who")))
    head = _header(F.col("role"), F.col("name"))
    sized = cast.withColumn("rendered", F.concat(head, "content", F.lit(CLOSE))).withColumn("lead", F.length(head)).withColumn(
        "block", F.when(F.col("__piece") == UNCUT, F.floor(F.col("turn") / BLOCK)).otherwise(F.col("__piece"))).drop("__piece")
    # places are added up within blocks of turns, and blocks by their totals
    within = Window.partitionBy("conv", "perspective", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("at", F.coalesce(F.sum(F.length("rendered")).over(within), F.lit(0))).withColumn(
        "k", F.count(F.lit(1)).over(within))
    totals = sized.groupBy("conv", "perspective", "block").agg(F.sum(F.length("rendered")).alias("chars"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv", "perspective").orderBy(F.asc_nulls_first("block")).rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select(F.col("conv").alias("c"), F.col("perspective").alias("p"), F.col("block").alias("b"),
                            F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    both = placed.join(earlier, F.col("conv").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & F.col("block").eqNullSafe(F.col("b")))
    start = F.col("chars") + F.col("at") + F.col("lead")
    return both.select(
        F.col("conv").alias(conv), "perspective", F.col("turn").alias("turn"), (F.col("n") + F.col("k")).alias("position"), "role", "name",
        F.col("rendered").alias("text"), start.cast("long").alias("start"), (start + F.length("content")).cast("long").alias("end"),
        (F.col("role") == "assistant").alias("trained"))


def assembled(rows: DataFrame, conv: str = "conv_id", longest: int = 10_000) -> DataFrame:
    """(conv_id, perspective, text, mask) of the dialogues of at most ``longest`` turns; mask: spans to train on.

    Longer dialogues stay in long form; ``longest`` bounds what one task puts together.
    """
    part = rows.groupBy(conv, "perspective", F.floor(F.col("position") / longest).alias("part"))
    turns = part.agg(F.array_sort(F.collect_list(F.struct("position", "text", "start", "end", "trained"))).alias("t"))
    whole = turns.withColumn("more", F.max("part").over(Window.partitionBy(conv, "perspective"))).where("more = 0")
    return whole.select(conv, "perspective", F.array_join(F.transform("t", lambda x: x.text), "").alias("text"),
                        F.transform(F.filter("t", lambda x: x.trained), lambda x: F.struct(x.start, x.end)).alias("mask"))
