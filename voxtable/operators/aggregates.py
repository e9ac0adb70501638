"""Grouped measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.functions.scalars import pyround, unit


def segment_stats(df: DataFrame, keys: list[str], t: str, density: str) -> DataFrame:
    """start, end, mean_density (4 places) and n_samples of each group."""
    return df.groupBy(*keys).agg(F.min(t).alias("start"), F.max(t).alias("end"), pyround(F.avg(density), 4).alias("mean_density"), F.count("*").alias("n_samples"))


def mean_vector(df: DataFrame, keys: list[str], vector: str, normalised: bool = True) -> DataFrame:
    """Element-wise mean of each group's vectors, of unit length if asked for."""
    parts = df.select(*keys, F.posexplode(vector).alias("vx_i", "vx_x")).groupBy(*keys, "vx_i").agg(F.avg(F.col("vx_x").cast("double")).alias("vx_x"))
    means = parts.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("vx_i", "vx_x"))), lambda s: s["vx_x"]).alias(vector))
    return means.withColumn(vector, unit(vector)) if normalised else means


def members(df: DataFrame, group: list[str], item: str, pos: str) -> DataFrame:
    """Each group's items in order, and how many."""
    rows = F.sort_array(F.collect_list(F.struct(pos, item)))
    return df.groupBy(*group).agg(F.transform(rows, lambda r: r[item]).alias("members"), F.count("*").alias("n_members"))


def durations(df: DataFrame, keys: list[str], start: str, end: str, item: str, least: float = 3.0) -> DataFrame:
    """total_duration_sec (2 places), n_segments, segment_ids in order, enrolled, and the reason if not."""
    g = df.groupBy(*keys).agg(F.sum(F.col(end) - F.col(start)).alias("vx_total"), F.count("*").alias("n_segments"), F.sort_array(F.collect_list(item)).alias("segment_ids"))
    enrolled = F.col("vx_total") >= least
    return g.select(
        *keys, enrolled.alias("enrolled"), pyround("vx_total", 2).alias("total_duration_sec"), "n_segments", F.when(enrolled, F.col("segment_ids")).alias("segment_ids"), F.when(~enrolled, "insufficient_duration").alias("reason")
    )


def status_histogram(df: DataFrame, status: str, confident: tuple[str, ...]) -> DataFrame:
    """status, n, and whether it counts as confident."""
    return df.groupBy(status).agg(F.count("*").alias("n")).withColumn("confident", F.col(status).isin(*confident))


def confident_percent(df: DataFrame, status: str, confident: tuple[str, ...]) -> DataFrame:
    """One row: n_total, n_confident and the whole percentage, null without rows."""
    n = F.count("*")
    sure = F.coalesce(F.sum(F.when(F.col(status).isin(*confident), 1).otherwise(0)), F.lit(0)).cast("long")
    return df.agg(n.alias("n_total"), sure.alias("n_confident"), F.floor(F.try_divide(sure * 100, n)).cast("long").alias("percent"))


def counts_by_source(df: DataFrame, speaker: str, source: str, sources: list[str]) -> DataFrame:
    """A row for each speaker, a column of counts for each source."""
    return df.groupBy(speaker).agg(*[F.count(F.when(F.col(source) == s, 1)).alias(f"n_{s}") for s in sources])


def identity_counts(members: DataFrame, excluded: DataFrame, keys: list[str], identity: str = "identity") -> DataFrame:
    """keys, n_identities (different ones) and n_excluded of every video that is in either table."""
    n = members.groupBy(*keys).agg(F.countDistinct(identity).alias("n_identities"))
    x = excluded.groupBy(*keys).agg(F.count("*").alias("n_excluded"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return n.join(x, keys, "full").select(*keys, zero("n_identities"), zero("n_excluded"))
