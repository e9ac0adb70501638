"""Joins on intervals.  All ends are closed unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlap_join(left: DataFrame, right: DataFrame, on: list[str], l: tuple[str, str] = ("start", "end"), r: tuple[str, str] = ("lo", "hi"), how: str = "inner") -> DataFrame:
    """Pairs of equal keys whose intervals overlap or touch: an equi-join with the overlap as its residue."""
    a, b = left.alias("vx_l"), right.alias("vx_r")
    same = [F.col(f"vx_l.{k}") == F.col(f"vx_r.{k}") for k in on]
    cond = (F.col(f"vx_r.{r[0]}") <= F.col(f"vx_l.{l[1]}")) & (F.col(f"vx_r.{r[1]}") >= F.col(f"vx_l.{l[0]}"))
    for c in same:
        cond = c & cond
    return a.join(b, cond, how).select("vx_l.*", *[F.col(f"vx_r.{c}") for c in right.columns if c not in on])


def bucketed_overlap_join(left: DataFrame, right: DataFrame, on: list[str], width: float, l: tuple[str, str] = ("start", "end"), r: tuple[str, str] = ("lo", "hi")) -> DataFrame:
    """overlap_join() for keys with many intervals: the join is also on buckets of the line.

    Each interval is entered into all buckets that it touches; a pair counts only in the bucket where its
    overlap starts, so that none appears twice.
    """
    bucket = lambda c: F.floor(F.col(c) / width).cast("long")
    spread = lambda df, ends: df.where((F.col(ends[0]) <= F.col(ends[1]))).withColumn("vx_b", F.explode(F.sequence(bucket(ends[0]), bucket(ends[1]))))
    pairs = overlap_join(spread(left, l), spread(right, r), [*on, "vx_b"], l, r)
    return pairs.where(F.col("vx_b") == F.floor(F.greatest(l[0], r[0]) / width).cast("long")).drop("vx_b")


def points_in(points: DataFrame, spans: DataFrame, on: list[str], at: str = "frame", s: tuple[str, str] = ("f0", "f1"), width: float | None = None) -> DataFrame:
    """Pairs of a span and a point within it; with a width by buckets, a point being in one bucket only."""
    if width is not None:
        points = points.withColumn("vx_b", F.floor(F.col(at) / width).cast("long"))
        spans = spans.where(F.col(s[0]) <= F.col(s[1])).withColumn("vx_b", F.explode(F.sequence(F.floor(F.col(s[0]) / width).cast("long"), F.floor(F.col(s[1]) / width).cast("long"))))
        on = [*on, "vx_b"]
    a, b = spans.alias("vx_s"), points.alias("vx_p")
    cond = (F.col(f"vx_p.{at}") >= F.col(f"vx_s.{s[0]}")) & (F.col(f"vx_p.{at}") <= F.col(f"vx_s.{s[1]}"))
    for k in on:
        cond = (F.col(f"vx_s.{k}") == F.col(f"vx_p.{k}")) & cond
    return a.join(b, cond).select("vx_s.*", *[F.col(f"vx_p.{c}") for c in points.columns if c not in on]).drop("vx_b")


def stab(spans: DataFrame, t: Column | float, start: str = "start", end: str = "end") -> DataFrame:
    """The spans that are on at a time."""
    t = t if isinstance(t, Column) else F.lit(t)
    return spans.where(t.between(F.col(start), F.col(end)))


def half_open_slice(values: Column | str, start: Column, end: Column) -> Column:
    """values[start:end] of an array, cut to its ends."""
    v = F.col(values) if isinstance(values, str) else values
    a = F.least(F.greatest(start, F.lit(0)), F.size(v)).cast("int")
    b = F.least(F.greatest(end, F.lit(0)), F.size(v)).cast("int")
    return F.slice(v, a + 1, F.greatest(b - a, F.lit(0)))


def samples_of(spans: DataFrame, chunks: DataFrame, on: list[str], rate: int, chunk: int, start: str = "start", end: str = "end") -> DataFrame:
    """Each span with its audio, samples [int(start * rate), int(end * rate)), from chunks of `chunk` samples.

    chunks: on, chunk_idx, samples.  Only chunks that a span touches are joined to it.
    """
    a, b = (F.col(start) * rate).cast("long"), (F.col(end) * rate).cast("long")
    wanted = spans.withColumn("vx_a", a).withColumn("vx_e", b)
    wanted = wanted.where("vx_e > vx_a").withColumn("chunk_idx", F.explode(F.sequence(F.expr(f"vx_a div {chunk}"), F.expr(f"(vx_e - 1) div {chunk}"))))
    got = wanted.join(chunks, [*on, "chunk_idx"])
    own = half_open_slice("samples", F.col("vx_a") - F.col("chunk_idx") * chunk, F.col("vx_e") - F.col("chunk_idx") * chunk)
    parts = F.sort_array(F.collect_list(F.struct("chunk_idx", own.alias("part"))))
    return got.groupBy(*spans.columns).agg(F.flatten(F.transform(parts, lambda p: p["part"])).alias("samples"))
