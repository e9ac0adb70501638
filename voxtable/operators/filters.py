"""Predicates and keyed lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def every(df: DataFrame, step: int, frame: str = "frame_idx") -> DataFrame:
    """Rows of every step-th frame."""
    return df.where(F.col(frame) % step == 0)


def caption_present(df: DataFrame, count_glyphs, mask: str = "mask", density: str = "density", least: float = 0.012, glyphs: int = 10) -> DataFrame:
    """df with n_text_like and present; glyphs are counted only in frames that are white enough.

    The Python function gets a null in place of every other mask, which it passes over, so the input is read once.
    """
    dense = F.coalesce(F.col(density) >= least, F.lit(False))
    counted = df.withColumn("n_text_like", F.coalesce(count_glyphs(F.when(dense, F.col(mask)))["n_like"], F.lit(0)))
    return counted.withColumn("present", dense & (F.col("n_text_like") >= glyphs))


def long_enough(df: DataFrame, frame_seconds: Column | float, least: float = 0.3, start: str = "start", end: str = "end") -> DataFrame:
    seconds = frame_seconds if isinstance(frame_seconds, Column) else F.lit(frame_seconds)
    return df.where(F.col(end) - F.col(start) + seconds >= least)


def readable_captions(df: DataFrame, text: str = "text", confidence: str = "confidence", least: float = 60.0) -> DataFrame:
    return df.where((F.length(text) > 0) & (F.col(confidence) >= least))


def having(df: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Rows of groups of at least so many rows."""
    n = Window.partitionBy(*keys)
    return df.withColumn("vx_n", F.count("*").over(n)).where(F.col("vx_n") >= least).drop("vx_n")


def without(df: DataFrame, excluded: DataFrame, on: list[str]) -> DataFrame:
    """Anti join: rows whose key isn't excluded."""
    return df.join(excluded.select(*on).distinct(), on, "left_anti")


def last_wins(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Of rows with equal keys the one with the greatest position."""
    last = Window.partitionBy(*keys).orderBy(F.desc(pos))
    return df.withColumn("vx_nth", F.row_number().over(last)).where("vx_nth = 1").drop("vx_nth")


def identity_or_key(df: DataFrame, identities: DataFrame, key: str = "track_key") -> DataFrame:
    """df with identity: the mapped one, else the key itself."""
    names = identities.select(key, F.col("identity").alias("vx_identity"))
    return df.join(names, key, "left").withColumn("identity", F.coalesce("vx_identity", key)).drop("vx_identity")


def singletons(members: DataFrame, group: list[str]) -> DataFrame:
    """Keys of groups with exactly one row."""
    return members.groupBy(*group).agg(F.count("*").alias("vx_n")).where("vx_n = 1").drop("vx_n")


def drop_counts(df: DataFrame, **kept: Column) -> DataFrame:
    """For each named condition how many rows fail it (null fails), in one row."""
    return df.agg(*[F.coalesce(F.sum(F.when(F.coalesce(c, F.lit(False)), 0).otherwise(1)), F.lit(0)).cast("long").alias(n) for n, c in kept.items()])
