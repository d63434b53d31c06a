"""Multi-party perspective rotation of dialogues, in DataFrame functions only.

For every participant the dialogue is rendered with that speaker as assistant, all other
speakers as named users and system turns as they are; only the assistant's own words are
trained on. The rendered dialogue is kept as its turns, each with its place in the whole,
so a conversation of any length is never gathered into one row or task; its text is the
turns' segments one after the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import running_total

SLOT_TURNS = 256
BEFORE_ALL = -(1 << 62)  # slot of turns without a number
UNNAMED = "unknown"
CLOSE = "<|im_end|>\n"


def rotate_perspectives(turns: DataFrame, slot_turns: int = SLOT_TURNS) -> DataFrame:
    """One row per conversation, participant and turn of ``turns`` (conv_id, turn, role, text):
    conv_id, perspective, turn, role, name, segment, seg_start, seg_end, mask.

    Positions count code points of the whole rendered dialogue, ends exclusive; the mask is
    ``start:end`` of the text and end mark of the assistant's turns and empty elsewhere. A participant is any
    role but ``system``; a null role is ``unknown``; a dialogue of system turns only has no
    perspective. A null text is empty. Turns go by number, nulls first, then role, then text;
    repeated turns stay repeated, a null conv_id is a conversation of its own. Other columns
    are ignored; an empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    said = turns.select("conv_id", F.coalesce(F.concat(F.lit("id:"), F.col("conv_id").cast("string")), F.lit("null")).alias("key"), "turn",
                        F.coalesce("role", F.lit(UNNAMED)).alias("speaker"), text.alias("text"), F.length(text).alias("n"))
    present = (said.where("speaker <> 'system'").groupBy("key")
               .agg(F.array_sort(F.collect_set("speaker")).alias("speakers")))
    seen = said.join(present, "key").select(*said.columns, F.explode("speakers").alias("perspective"))
    own = F.col("speaker") == F.col("perspective")
    system = F.col("speaker") == "system"
    role = F.when(system, "system").when(own, "assistant").otherwise("user")
    name = F.when(~own & ~system, F.col("speaker"))
    head = F.concat(F.lit("<|im_start|>"), F.col("role"), F.when(F.col("name").isNotNull(), F.concat(F.lit(" name="), F.col("name"))).otherwise(F.lit("")), F.lit("\n"))
    seen = seen.withColumns({"role": role, "name": name}).withColumn("head", head)
    seen = seen.withColumns({"size": F.length("head") + F.col("n") + len(CLOSE), "slot": F.coalesce(F.floor(F.col("turn") / slot_turns), F.lit(BEFORE_ALL))})
    order = [F.col("turn").asc_nulls_first(), F.col("speaker"), F.col("text")]
    placed = running_total(seen, ["key", "perspective"], "slot", order, "size", "seg_end")
    segment = F.concat("head", "text", F.lit(CLOSE)).alias("segment")
    start = F.col("seg_end") - F.col("size")
    own = F.col("role") == "assistant"
    return placed.select("conv_id", "perspective", "turn", "role", "name", segment, start.alias("seg_start"), "seg_end",
                         F.when(own, F.concat_ws(":", start + F.length("head"), F.col("seg_end") - 1)).otherwise("").alias("mask"))
