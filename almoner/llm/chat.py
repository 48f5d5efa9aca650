"""Chat formatting by perspective rotation.

Every participant of a dialogue is once the assistant; the others are users under their names, and only
the assistant's turns are trained on. A dialogue is rendered in blocks of turn numbers, so that a very long one is
many rows and never one value or one task; an ordinary one is a single row per perspective.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"
_NO_TURN = 1 << 62


def _header(speaker: Column, perspective: Column, fixed: tuple[str, ...]) -> Column:
    name = F.when(speaker.isin(*fixed), speaker).when(speaker == perspective, F.lit("assistant"))
    return F.concat(F.lit("<|"), name.otherwise(F.concat(F.lit("user name="), speaker)), F.lit("|>\n"))


def rotate_perspectives(
    turns: DataFrame,
    conversation_col: str = "conv_id",
    turn_col: str = "turn",
    speaker_col: str = "role",
    text_col: str = "text",
    fixed: tuple[str, ...] = ("system",),
    block_turns: int = 256,
) -> DataFrame:
    """One row per conversation, participant and block: conv_id, perspective, block, n_turns, text, mask.

    A turn is rendered as <|assistant|>, <|system|> (any of `fixed`) or <|user name=...|>, a line feed, its
    text, <|end|> and a line feed. `mask` holds the spans (start, end) in code points of `text`, ends exclusive,
    that are trained on: the assistant's texts with their end marks. block is turn div block_turns; the blocks
    of a dialogue, joined in order, are the whole rendering. Speakers in `fixed` are no participants, and a
    dialogue of only these gives no row. The opening "<|" within texts and names becomes "< |".

    Turns are ordered by number, then speaker and text. A repeated row (same conversation, number, speaker
    and text) counts once. A null speaker is "unknown", a null text empty. Turns without a number come last,
    ordered by a hash of speaker and text, in blocks of their own. A turn without a conversation is a dialogue of
    its own. An empty table gives an empty result; other columns are ignored.
    """
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    rows = turns.select(
        F.col(conversation_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        safe(F.coalesce(F.col(speaker_col).cast("string"), F.lit(UNKNOWN))).alias("speaker"),
        safe(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("body"),
    )
    own = F.xxhash64("speaker", "body")
    rows = rows.withColumns(
        {
            "dialogue": F.coalesce(
                F.concat(F.lit("c"), F.col("conv_id").cast("string")),
                F.concat_ws(":", F.lit("n"), F.col("turn").cast("string"), own.cast("string")),
            ),
            "block": F.coalesce(
                F.floor(F.col("turn") / block_turns).cast("long"), F.lit(_NO_TURN) + F.pmod(own, F.lit(1 << 20))
            ),
        }
    )
    # collect_set drops repeated rows before the shuffle; a block holds block_turns numbers
    blocks = rows.groupBy("dialogue", "conv_id", "block").agg(
        F.array_sort(F.collect_set(F.struct("turn", "speaker", "body"))).alias("turns")
    )
    people = (
        rows.where(~F.col("speaker").isin(*fixed)).select("dialogue", F.col("speaker").alias("perspective")).distinct()
    )
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            _header(t["speaker"], F.col("perspective"), fixed).alias("head"),
            F.concat(t["body"], F.lit("<|end|>\n")).alias("said"),
            ((t["speaker"] == F.col("perspective")) & ~t["speaker"].isin(*fixed)).alias("own"),
        ),
    )
    span = "struct<start: bigint, end: bigint>"
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(s: Column, p: Column) -> Column:
        start = s["at"] + F.length(p["head"])
        end = start + F.length(p["said"])
        # the line feed after the end mark is not trained on
        new = F.array(F.struct(start.cast("long").alias("start"), (end - 1).cast("long").alias("end")))
        return F.struct(end.cast("long").alias("at"), F.when(p["own"], F.concat(s["spans"], new)).otherwise(s["spans"]).alias("spans"))

    return (
        blocks.join(people, "dialogue")
        .withColumn("parts", parts)
        .select(
            "conv_id",
            "perspective",
            "block",
            F.size("turns").cast("long").alias("n_turns"),
            F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["said"])), "").alias("text"),
            F.aggregate("parts", state, step)["spans"].alias("mask"),
        )
    )
