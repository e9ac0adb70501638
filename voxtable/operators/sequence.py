"""Operators over ordered rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxtable.functions.python_udfs import text_ratio
from voxtable.functions.scalars import pyround


def numbered(df: DataFrame, keys: list[str], order: list[str | Column], name: str) -> DataFrame:
    """df with 0, 1, ... in order within the keys."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1)


def islands(df: DataFrame, keys: list[str], t: str, gap: float, name: str = "island", ties: tuple[str, ...] = ()) -> DataFrame:
    """Runs of rows with no gap above `gap` between neighbours, numbered from 0."""
    w = Window.partitionBy(*keys).orderBy(t, *ties)
    new = F.when(F.col(t) - F.lag(t).over(w) > gap, 1).otherwise(0)
    return df.withColumn("vx_new", new).withColumn(name, F.sum("vx_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("vx_new")


def folded(df: DataFrame, keys: list[str], order: list[str], values: list[str], start: Callable[[], list], step: Callable, name: str, kind: str = "long") -> DataFrame:
    """df with what step(state, *values) gives for each row, in order within the keys, from a state that start() makes.

    Rows are dealt by the keys and sorted there; a task folds over Arrow batches and holds one state, so that
    thousands of small groups cost no more than one large one, and a large one needs no memory.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    names, n = [*df.columns, name], len(keys)
    at = [df.columns.index(c) for c in (*keys, *values)]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, last = None, None
        for batch in it:
            out = []
            for row in zip(*(batch.column(i).to_pylist() for i in at), strict=True):
                if row[:n] != last or state is None:
                    state, last = start(), row[:n]
                out.append(step(state, *row[n:]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64() if kind == "double" else pa.int64())], names=names)

    # by the keys and a constant: a union of parts that lie by the keys counts as dealt by them, and is left so, though
    # adaptive execution joins each part's partitions in its own way
    return df.repartition(*keys, F.lit(0)).sortWithinPartitions(*keys, *order).mapInArrow(batches, f"{fields}, `{name}` {kind}")


def anchored_sessions(df: DataFrame, keys: list[str], order: list[str], same: Callable[[object, object], bool], value: str, present: str, name: str = "session") -> DataFrame:
    """df with session numbers from 0; null where nothing is present.

    A session starts where something is present after an absence, or where it is no longer the same as the
    session's *first* value; so slow drift away from the anchor starts a session though neighbours agree.
    """

    def step(state: list, on: bool | None, v: object) -> int | None:
        if not on:
            state[2] = False
            return None
        if not state[2] or not same(state[1], v):
            state[:] = state[0] + 1, v, True
        return state[0]

    return folded(df, keys, order, [present, value], lambda: [-1, None, False], step, name)


def masks_alike(least: float = 0.55) -> Callable[[object, object], bool]:
    def same(a: object, b: object) -> bool:
        a, b = np.asarray(a, bool), np.asarray(b, bool)
        union = (a | b).sum()
        return bool(union == 0 or (a & b).sum() / union >= least)

    return same


def shot_cuts(df: DataFrame, keys: list[str], frame: str, score: str, threshold: float = 27.0, least: int = 8, name: str = "shot_id") -> DataFrame:
    """df with shot numbers: a score above the threshold opens a shot if the present one has `least` frames.

    The score of a frame is its change against the frame before.  Frames are numbered without holes; whether
    a cut counts depends on the last one that did, so the fold runs over the few frames with a high score.
    """
    at, first = F.col(frame).cast("long"), F.min(frame).over(Window.partitionBy(*keys))
    few = df.select(*keys, at.alias("vx_at"), (at == first).alias("vx_first"), F.col(score).alias("vx_score")).where(F.col("vx_first") | (F.col("vx_score") > threshold)).drop("vx_score")

    def step(state: list, at: int, opens: bool) -> int | None:
        if opens or at - state[1] >= least:
            state[:] = state[0] + 1, at
            return state[0]
        return None

    cuts = folded(few, keys, ["vx_at"], ["vx_at", "vx_first"], lambda: [-1, 0], step, "vx_shot").where("vx_shot is not null")
    opened = cuts.select(*(F.col(k).alias(f"vx_{i}") for i, k in enumerate(keys)), "vx_at", F.col("vx_shot").cast("int").alias(name))
    w = Window.partitionBy(*keys).orderBy(frame)
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"vx_{i}")) for i, k in enumerate(keys)], at == F.col("vx_at"))
    marked = df.join(opened, same, "left").drop("vx_at", *(f"vx_{i}" for i in range(len(keys))))
    return marked.withColumn(name, F.last(name, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def sampling_grid(spans: DataFrame, step: float, start: str = "start", end: str = "end", name: str = "t") -> DataFrame:
    """A row for each time from start that lies before end, each `step` after the one before; times to 3 places.

    The times are sums, one step added after another, so where a span ends is decided on what the sum has come to: from
    0 to 2.0 by 0.2 there are eleven.
    """

    @F.pandas_udf("array<double>")
    def times(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for lo, hi in zip(a, b, strict=True):
            n = int((hi - lo) / step) + 3 if lo < hi else 0
            line = np.add.accumulate(np.concatenate([[lo], np.full(max(0, n - 1), step)]))[:n]
            out.append(line[line < hi].tolist())
        return pd.Series(out, dtype=object)

    exact = spans.where(F.col(end) > F.col(start)).withColumn("vx_t", F.explode(times(F.col(start).cast("double"), F.col(end).cast("double"))))
    return exact.withColumn(name, pyround("vx_t", 3)).drop("vx_t")


def until_unreadable(df: DataFrame, keys: list[str], order: str, readable: Column) -> DataFrame:
    """Rows before the first that isn't readable."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("vx_bad", F.sum(F.when(readable, 0).otherwise(1)).over(w)).where("vx_bad = 0").drop("vx_bad")


def lag_difference(df: DataFrame, keys: list[str], order: list[str], value: str, difference: Callable[[Column, Column], Column] | None = None, name: str = "motion") -> DataFrame:
    """df with the difference to the row before; none if either is missing, so a missing row resets it."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    diff = difference(F.col(value), before) if difference else F.abs(F.col(value) - before)
    return df.withColumn(name, F.when(F.col(value).isNotNull() & before.isNotNull(), diff))


def stride_sample(df: DataFrame, keys: list[str], order: list[str], most: int = 8) -> DataFrame:
    """Every max(1, n div most)-th row of each group, the first `most` of them."""
    w = Window.partitionBy(*keys)
    rows = df.withColumn("vx_pos", F.row_number().over(w.orderBy(*order)) - 1).withColumn("vx_step", F.greatest(F.lit(1), F.floor(F.count("*").over(w) / most).cast("int")))
    return rows.where((F.col("vx_pos") % F.col("vx_step") == 0) & (F.floor(F.col("vx_pos") / F.col("vx_step")) < most)).drop("vx_pos", "vx_step")


def ends_and_middle(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """first, middle (number n div 2) and last value of each group, and n."""
    w = Window.partitionBy(*keys)
    rows = df.select(*keys, F.col(value).alias("v"), (F.row_number().over(w.orderBy(order)) - 1).alias("i"), F.count("*").over(w).alias("n"))
    at = lambda i, name: F.max(F.when(F.col("i") == i, F.col("v"))).alias(name)
    return rows.groupBy(*keys).agg(at(F.lit(0), "first"), at(F.floor(F.col("n") / 2), "middle"), at(F.col("n") - 1, "last"), F.max("n").alias("n"))


def by_first_seen(df: DataFrame, keys: list[str], group: str, seen: str, pos: str, prefix: str = "person_", name: str = "identity") -> DataFrame:
    """group and its name: prefix and rank by when it was first seen, ties by position."""
    firsts = df.groupBy(*keys, group).agg(F.min(F.struct(F.col(seen).alias("t"), F.col(pos).alias("p"))).alias("vx_first"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("vx_first") if keys else Window.orderBy("vx_first")) - 1
    return firsts.withColumn(name, F.concat(F.lit(prefix), rank.cast("string"))).withColumn("first_seen", F.col("vx_first.t")).drop("vx_first")


def merged_caption(last: dict | None, row: dict, similarity: Callable[[str, str], float], gap: float, least: float, start: str, end: str, mid: str, text: str, confidence: str) -> dict | None:
    """The caption that `row` makes of the one before, if it continues it; else None."""
    value = lambda x: 0.0 if x is None or pd.isna(x) else float(x)
    if last is None or row[start] - last[end] > gap or similarity(last[text], row[text]) < least:
        return None
    winner = row if value(row.get(confidence)) >= value(last.get(confidence)) else last
    return {**winner, start: last[start], end: row[end], mid: round((last[start] + row[end]) / 2, 2)}


def merge_near_duplicates(
    df: DataFrame, keys: list[str], similarity: Callable[[str, str], float] = text_ratio, gap: float = 0.5, least: float = 0.7, start: str = "start_sec", end: str = "end_sec", mid: str = "mid_sec", text: str = "text_pt", confidence: str = "confidence"
) -> DataFrame:
    """Left fold over captions in time: one that continues the merged one before it is merged into it.

    It does if it starts at most `gap` after its end and its text is alike.  The text and all other fields are
    those of the one of greater confidence (missing: 0; equal: the later); the span is from the first's start to the
    later's end, and the middle is worked out anew.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[dict] = []
        for row in pdf.sort_values([start, end], kind="stable").to_dict("records"):
            both = merged_caption(out[-1] if out else None, row, similarity, gap, least, start, end, mid, text, confidence)
            out[len(out) - (both is not None) :] = [both or row]
        return pd.DataFrame(out, columns=pdf.columns)

    return df.groupBy(*keys).applyInPandas(fold, fields)


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of every box in a with every box in b; rows are [x, y, w, h]."""
    a, b = np.asarray(a, float).reshape(-1, 1, 4), np.asarray(b, float).reshape(1, -1, 4)
    side = np.clip(np.minimum(a[..., :2] + a[..., 2:], b[..., :2] + b[..., 2:]) - np.maximum(a[..., :2], b[..., :2]), 0, None)
    shared = side.prod(axis=-1)
    union = a[..., 2:].prod(axis=-1) + b[..., 2:].prod(axis=-1) - shared
    return np.divide(shared, union, out=np.zeros_like(union), where=union > 0)


class Tracker:
    """Greedy links of boxes over time; feed it one time's boxes after another."""

    def __init__(self, least: float = 0.3, misses: int = 2):
        self.least, self.misses, self.open, self.done, self.next = least, misses, [], [], 0

    def choices(self, boxes: list[list]) -> list[int | None]:
        """For each open track, oldest first, the free box that overlaps it most (of equal ones the first); None if too little."""
        table, out = overlaps([t["box"] for t in self.open], boxes), []
        for row in table if len(boxes) else [()] * len(self.open):
            best = int(np.argmax(row)) if len(row) else 0
            enough = len(row) > 0 and row[best] > 0 and row[best] >= self.least
            out.append(best if enough else None)
            if enough:
                table[:, best] = -1
        return out

    def step(self, boxes: list[tuple[object, list]]) -> None:
        """boxes: (what to remember, [x, y, w, h])."""
        chosen = self.choices([b for _, b in boxes])
        for track, i in zip(self.open, chosen, strict=True):
            if i is None:
                track["missed"] += 1
            else:
                track["rows"].append(boxes[i][0])
                track["box"], track["missed"] = boxes[i][1], 0
        fresh = [b for i, b in enumerate(boxes) if i not in set(chosen)]
        self.done += [t for t in self.open if t["missed"] > self.misses]
        self.open = [t for t in self.open if t["missed"] <= self.misses]
        self.open += [{"id": self.next + k, "rows": [what], "box": box, "missed": 0} for k, (what, box) in enumerate(fresh)]
        self.next += len(fresh)

    def tracks(self) -> list[dict]:
        """Finished tracks in the order they ended, then open ones."""
        return self.done + self.open


def link_tracks(df: DataFrame, keys: list[str], t: str = "t", pos: str = "det_pos", box: str = "box", least: float = 0.3, misses: int = 2, detections: int = 3) -> DataFrame:
    """df with track_id, track_pos (finished tracks in the order they ended, then open ones) and nth (in its track).

    Detections of tracks of fewer than `detections` are left out; ids are given before that, so they have holes.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([t, pos], kind="stable").reset_index(drop=True)
        tracker = Tracker(least, misses)
        for _, now in pdf.groupby(t, sort=True):
            tracker.step([(i, list(b)) for i, b in zip(now.index, now[box], strict=True)])
        kept = [x for x in tracker.tracks() if len(x["rows"]) >= detections]
        rows = [(i, x["id"], p, k) for p, x in enumerate(kept) for k, i in enumerate(x["rows"])]
        out = pdf.iloc[[r[0] for r in rows]].copy()
        for j, name in ((1, "track_id"), (2, "track_pos"), (3, "nth")):
            out[name] = np.array([r[j] for r in rows], np.int32)
        return out

    return df.groupBy(*keys).applyInPandas(link, f"{fields}, track_id int, track_pos int, nth int")
