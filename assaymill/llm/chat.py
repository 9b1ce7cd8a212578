"""Multi-party dialogues rendered once for every participant.

From each participant's perspective, that speaker is the assistant, the others are users
under their own names, and directives (system turns) stay what they are. The spans that
a model is to learn from are the perspective's own turns with their end marks.

A dialogue is rendered in segments of at most ``SEGMENT`` turns, numbered along the
dialogue, so one very long conversation spreads over many tasks and rows. Turns are
ordered by turn, then speaker, then text; numbering does not gather a conversation in a task.

Defined cases: a null or blank role is the speaker ``unknown``; a null text is empty; null turns
come first; rows without a conversation id form one conversation without an id; repeated
rows are repeated turns; a conversation of directives alone has no participant and so no
row. Marks inside texts are broken up, so that no text can open or close a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.operators.ordered import row_numbers

SEGMENT = 64
DIRECTIVES = ("system",)
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _head(speaker: Column, perspective: Column, directives: tuple[str, ...]) -> Column:
    return F.when(speaker.isin(*directives), speaker).when(speaker == perspective, F.lit("assistant")).otherwise(
        F.concat(F.lit("user name="), speaker))


def perspectives(turns: DataFrame, segment: int = SEGMENT, directives: tuple[str, ...] = DIRECTIVES) -> DataFrame:
    """conv_id, perspective, segment, n_turns, text, and trained: the spans to learn, in code points."""
    plain = turns.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.when(F.trim("role") != "", F.trim("role")).otherwise("unknown").alias("speaker"),
        F.regexp_replace(F.coalesce("text", F.lit("")), r"<\|(im_start|im_end)\|>", "< |$1| >").alias("text"))
    numbered = row_numbers(plain, ["conv_id"], [F.col("turn"), F.col("speaker"), F.col("text")], "_at")
    segments = numbered.groupBy("conv_id", F.floor((F.col("_at") - 1) / segment).alias("segment")).agg(
        F.array_sort(F.collect_list(F.struct("_at", "speaker", "text"))).alias("turns"))
    speakers = plain.where(~F.col("speaker").isin(*directives)).groupBy(
        F.col("conv_id").alias("_of")).agg(F.array_sort(F.collect_set("speaker")).alias("speakers"))
    each = segments.join(speakers, F.col("conv_id").eqNullSafe(F.col("_of"))).select(
        "conv_id", "segment", "turns", F.explode("speakers").alias("perspective"))

    def rendered(turn: Column) -> Column:
        head = F.concat(F.lit(OPEN), _head(turn["speaker"], F.col("perspective"), directives), F.lit("\n"))
        return F.struct(
            F.concat(head, turn["text"], F.lit(CLOSE + "\n")).alias("text"), F.length(head).alias("skip"),
            (turn["speaker"] == F.col("perspective")).alias("own"))

    parts = each.withColumn("parts", F.transform("turns", rendered))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    spans = F.aggregate("parts", zero, lambda acc, p: F.struct(
        (acc["at"] + F.length(p["text"])).alias("at"),
        F.when(p["own"], F.concat(acc["spans"], F.array(F.struct(
            (acc["at"] + p["skip"]).alias("start"), (acc["at"] + F.length(p["text"]) - 1).alias("end")))))
        .otherwise(acc["spans"]).alias("spans")), lambda acc: acc["spans"])
    return parts.select(
        "conv_id", "perspective", "segment", F.size("turns").alias("n_turns"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"), spans.alias("trained"))
