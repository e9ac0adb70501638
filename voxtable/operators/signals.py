"""Operators over regularly and irregularly sampled signals.  A missing value is null, never NaN."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtable.functions.scalars import pyround


def interpolate_to_grid(df: DataFrame, keys: list[str], t: str, value: str, step: float, index: str = "hop_idx") -> DataFrame:
    """keys, index, value at the grid times index * step between each group's first and last sample.

    Each pair of neighbouring samples makes its own grid points, so there is no join and only one shuffle;
    groups of fewer than two samples have none.  Samples without a value are passed over; of samples of one
    time the later one (by value) ends the pair.
    """
    w = Window.partitionBy(*keys).orderBy(t, value)
    pair = (
        df.where(F.col(value).isNotNull() & F.col(t).isNotNull())
        .select(*keys, F.col(t).alias("t0"), F.col(value).alias("v0"), F.lead(t).over(w).alias("t1"), F.lead(value).over(w).alias("v1"), F.lead(t, 2).over(w).isNull().alias("last"))
        .where("t1 > t0")
    )
    at = pair.withColumn(index, F.explode(F.sequence(F.floor(F.col("t0") / step).cast("long") - 1, F.ceil(F.col("t1") / step).cast("long") + 1))).withColumn("x", F.col(index) * F.lit(step))
    inside = (F.col("x") >= F.col("t0")) & ((F.col("x") < F.col("t1")) | (F.col("last") & (F.col("x") <= F.col("t1"))))
    return at.where(inside).select(*keys, index, ((F.col("v1") - F.col("v0")) / (F.col("t1") - F.col("t0")) * (F.col("x") - F.col("t0")) + F.col("v0")).alias(value))


def dense_frames(df: DataFrame, keys: list[str], t: str, values: list[str], fps: int = 25, detections: int = 2, frames: int = 10) -> DataFrame:
    """keys, frame and values at every frame from round(first * fps) to round(last * fps).

    Linear between samples, and the end samples' values beyond them (rounding may lie outside).  Groups of
    too few samples or frames are left out.
    """
    w = Window.partitionBy(*keys)
    o = w.orderBy(t)
    rows = df.select(
        *keys, F.col(t).alias("t0"), *[F.col(v).alias(f"{v}0") for v in values], F.lead(t).over(o).alias("t1"), *[F.lead(v).over(o).alias(f"{v}1") for v in values],
        F.count("*").over(w).alias("n"), F.min(t).over(w).alias("first"), F.max(t).over(w).alias("end"),
    )
    f0, f1 = pyround(F.col("first") * fps).cast("long"), pyround(F.col("end") * fps).cast("long")
    pair = rows.where((F.col("n") >= detections) & (f1 - f0 + 1 >= frames) & (F.col("t1") > F.col("t0"))).withColumns({"f0": f0, "f1": f1})
    low = F.when(F.col("t0") == F.col("first"), F.col("f0")).otherwise(F.ceil(F.col("t0") * fps).cast("long"))
    high = F.when(F.col("t1") == F.col("end"), F.col("f1")).otherwise(F.ceil(F.col("t1") * fps).cast("long") - 1)
    at = pair.withColumn("lo", low).withColumn("up", high).where("up >= lo").withColumn("frame", F.explode(F.sequence("lo", "up")))
    x = F.least(F.greatest(F.col("frame") / F.lit(float(fps)), F.col("t0")), F.col("t1"))
    lerp = lambda v: (F.col(f"{v}1") - F.col(f"{v}0")) / (F.col("t1") - F.col("t0")) * (x - F.col("t0")) + F.col(f"{v}0")
    return at.select(*keys, "frame", *[lerp(v).alias(v) for v in values])


def median_filter(df: DataFrame, keys: list[str], order: list[str], value: str, width: int = 13, name: str = "smooth") -> DataFrame:
    """df with the median of the `width` values around each, zeros beyond the ends; short groups stay as they are."""
    w = Window.partitionBy(*keys)
    near = F.collect_list(value).over(w.orderBy(*order).rowsBetween(-(width // 2), width // 2))
    zeros = F.array_repeat(F.lit(0.0), width - F.size(near))
    median = F.get(F.sort_array(F.concat(near, zeros)), F.lit(width // 2))
    return df.withColumn(name, F.when(F.count("*").over(w) >= width, median).otherwise(F.col(value)))


def rms_hops(df: DataFrame, keys: list[str], order: str, value: str, hop: int = 320, frame: int = 640) -> DataFrame:
    """keys, hop_idx, rms: root mean square of the frame centred on every hop-th sample, zeros beyond the ends.

    order counts the samples from 0; a frame is an even number of hops.  Squares are summed hop by hop, and a frame
    adds the sums of its hops: so samples are combined before they are shuffled.
    """
    side, odd = divmod(frame, 2 * hop)
    if odd or not side:
        raise ValueError("a frame must be an even number of hops")
    sums = df.groupBy(*keys, F.expr(f"`{order}` div {hop}").alias("hop_idx")).agg(F.sum(F.col(value) * F.col(value)).alias("vx_s"))
    w = Window.partitionBy(*keys).orderBy("hop_idx").rangeBetween(-side, side - 1)
    return sums.withColumn("rms", F.sqrt(F.coalesce(F.sum("vx_s").over(w), F.lit(0.0)) / frame)).drop("vx_s")


def pearson(a: str, b: str, least: int = 3, flat: float = 1e-8):
    """Aggregate expression: correlation of what is jointly present.

    Null below `least` joint samples; 0.0 if either hardly varies; cut to -1 .. 1.
    """
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    sx, sy = F.stddev_pop(x), F.stddev_pop(y)
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(F.covar_pop(x, y), sx * sy)))
    return F.when(F.count(x) < least, F.lit(None)).when((sx < flat) | (sy < flat), 0.0).otherwise(r)


def joint_count(a: str, b: str):
    return F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1))


def chunk_scores(df: DataFrame, keys: list[str], frame: str, score, durations: tuple[int, ...], fps: int = 25) -> DataFrame:
    """keys, frame, score: the mean over all durations of the score of the chunk that the frame is in.

    score is an aggregate expression over a chunk.  Equal durations give equal scores, so each is worked
    out once and weighted with how often it is listed.
    """
    weight = {d: durations.count(d) for d in durations}
    kinds = F.explode(F.array(*[F.struct(F.lit(d).alias("duration"), F.lit(n).alias("weight")) for d, n in weight.items()]))
    cut = df.withColumn("vx_d", kinds).select(*df.columns, "vx_d.*").withColumn("chunk", F.floor(F.col(frame) / (F.col("duration") * fps)).cast("long"))
    chunks = cut.groupBy(*keys, "duration", "weight", "chunk").agg(score.alias("s"), F.collect_list(frame).alias("frames"))
    return chunks.select(*keys, "weight", "s", F.explode("frames").alias(frame)).groupBy(*keys, frame).agg((F.sum(F.col("s") * F.col("weight")) / F.sum("weight")).alias("score"))
