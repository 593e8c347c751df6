"""Chat formatting by perspective rotation, in built-in functions only.

For every participant of a conversation the whole dialogue is rendered with
that speaker as the assistant, all others as named users, and system turns as
they are. The loss mask covers what the chosen speaker says, with the end
marker.

A conversation of any length is never gathered into one row: the result has a
row for each perspective and turn, with the rendered segment and its place in
the dialogue (code points). Turn numbers come from ``ordered_index``, which
splits a hot conversation over tasks; places are summed inside runs of
``RUN`` turns, then over the runs.

Defined cases: turns are ordered by turn (NULL last), role, text; equal rows
follow each other; a NULL or blank role is the speaker ``unknown``; NULL text
is empty; marker openings in a text are broken up; a conversation of system
turns only has no perspective; a NULL conversation id is a conversation of its
own; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import stage
from vitrine.operators.keys import ordered_index

RUN = 256
SYSTEM = "system"
UNKNOWN = "unknown"
END = "<|end|>"


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, perspective, position, turn, speaker, label, segment, start, end,
    mask_start, mask_end) for each perspective and turn."""
    speaker = F.coalesce(F.nullif(F.trim(F.col(role_col)), F.lit("")), F.lit(UNKNOWN))
    text = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        speaker.alias("speaker"), text.alias("text"))
    rows = ordered_index(rows, [F.col("turn").asc_nulls_last(), F.col("speaker"), F.col("text")],
                         "position", by=["conv_id"])
    rows = stage(rows, "chat-turns")
    conv = F.struct("conv_id").alias("conv")  # a struct of NULL joins with itself
    people = (rows.where(F.col("speaker") != SYSTEM).select(conv, F.col("speaker").alias("perspective"))
              .distinct())
    both = rows.select(conv, "position", "turn", "speaker", "text").join(people, "conv")
    own = F.col("speaker") == F.col("perspective")
    label = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    name = F.when(label == "user", F.concat(F.col("speaker"), F.lit(": "))).otherwise(F.lit(""))
    head = F.concat(F.lit("<|"), label, F.lit("|>\n"), name)
    both = both.withColumn("label", label).withColumn("_head", F.length(head)).withColumn(
        "segment", F.concat(head, F.col("text"), F.lit(END + "\n")))
    size = F.length("segment").cast("long")
    both = both.withColumn("_run", F.floor((F.col("position") - 1) / RUN)).withColumn("_size", size)

    before = Window.unboundedPreceding, -1
    runs = both.groupBy("conv", "perspective", "_run").agg(F.sum("_size").alias("n"))
    over_runs = Window.partitionBy("conv", "perspective").orderBy("_run").rowsBetween(*before)
    runs = runs.select("conv", "perspective", "_run",
                       F.coalesce(F.sum("n").over(over_runs), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("conv", "perspective", "_run").orderBy("position").rowsBetween(*before)
    placed = (both.withColumn("_at", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
              .join(runs, ["conv", "perspective", "_run"])
              .withColumn("start", F.col("_at") + F.col("_base")))
    mine = F.col("label") == "assistant"
    return placed.select(
        F.col("conv.conv_id").alias("conv_id"), "perspective", "position", "turn", "speaker", "label",
        "segment", "start", (F.col("start") + F.col("_size")).alias("end"),
        F.when(mine, F.col("start") + F.col("_head")).alias("mask_start"),
        F.when(mine, F.col("start") + F.col("_size") - 1).alias("mask_end"))
