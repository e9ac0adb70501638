"""What the review page shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxtable.functions.scalars import colour, lane_left, lane_width, or_default

UNCERTAIN = "— uncertain —"
CAPTION = "Caption"
#: Colours of speakers, taken in turn, and that of the uncertain.
PALETTE = [
    "#f97066", "#60a5fa", "#fbbf24", "#a78bfa", "#34d399", "#f472b6", "#fb923c", "#38bdf8",
    "#c084fc", "#4ade80", "#facc15", "#f87171", "#22d3ee", "#e879f9", "#a3e635", "#fb7185",
]
GREY = "#565b68"


def review_rows(df: DataFrame, source: str, kind: str) -> DataFrame:
    """source, kind, start, end, text, speaker, status from a table of kind transcript, assigned or final."""
    name = {"transcript": F.lit(None), "assigned": F.col("assigned_speaker") if kind == "assigned" else None, "final": F.col("final_speaker") if kind == "final" else None}[kind]
    status = {"transcript": F.lit(None), "assigned": F.col("status") if kind == "assigned" else None, "final": F.col("final_status") if kind == "final" else None}[kind]
    speaker = name.cast("string") if kind == "transcript" else or_default(name, UNCERTAIN)
    return df.select(
        F.lit(source).alias("source"), F.lit(kind).alias("kind"), F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), F.coalesce("text_pt", F.lit("")).alias("text"), speaker.alias("speaker"), status.cast("string").alias("status")
    )


def lane(speaker: Column, kind: Column) -> Column:
    return F.when(kind == "transcript", CAPTION).otherwise(speaker)


def speakers(rows: DataFrame, source: str = "source", pos: str = "pos") -> DataFrame:
    """speaker, rank (by first appearance over sources in turn, the uncertain last) and colour."""
    firsts = rows.where("speaker is not null").groupBy("speaker").agg(F.min(F.struct(source, pos)).alias("vx_first"))
    unsure = F.col("speaker") == UNCERTAIN
    ranked = firsts.withColumn("rank", F.row_number().over(Window.orderBy(unsure, "vx_first")) - 1)
    return ranked.select("speaker", "rank", colour("rank", PALETTE, unsure, GREY).alias("colour"))


def lanes(rows: DataFrame) -> DataFrame:
    """rows with left and width in percent of the greatest end over all sources."""
    total = rows.agg(F.max("end")).scalar()
    return rows.select(*rows.columns, lane_left("start", total).alias("left"), lane_width("start", "end", total).alias("width"))


def overlay(rows: DataFrame, t: float, pos: str = "pos") -> DataFrame:
    """One row for what is on at a time: the first text that isn't blank, and each attribution's first speaker."""
    on = rows.where(F.lit(t).between(F.col("start"), F.col("end")))
    first = on.groupBy("source").agg(
        F.min(F.when(F.length(F.trim("text")) > 0, F.struct("source", pos, "text"))).alias("t"),
        F.min(F.when(F.col("kind") != "transcript", F.struct(F.col(pos), F.col("speaker"), F.col("status")))).alias("c"),
    )
    chips = F.sort_array(F.collect_list(F.when(F.col("c").isNotNull(), F.struct("source", F.col("c.speaker").alias("speaker"), F.col("c.status").alias("status")))))
    return first.agg(F.coalesce(F.min("t")["text"], F.lit("")).alias("text"), chips.alias("chips"))
