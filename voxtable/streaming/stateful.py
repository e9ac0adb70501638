"""Windows, sessions, interval joins and stateful folds over streams.  Event times are timestamps with a watermark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from voxtable.functions.python_udfs import text_ratio
from voxtable.operators.sequence import Tracker, merged_caption


def written(stream: DataFrame, folder: str) -> DataFrame:
    """Everything that the stream gives out until its input ends, written below folder and read back.

    folder must be new, and one that all executors share: it holds the files and the query's checkpoint.
    """
    run = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/rows")
    run.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def windowed(stream: DataFrame, t: str, late: str, width: str, keys: list[str], slide: str | None = None, **aggregates) -> DataFrame:
    """Aggregates of tumbling (or sliding) windows, each given out once, when the watermark has passed it."""
    rows = stream.withWatermark(t, late).groupBy(F.window(t, width, slide), *keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return rows.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *aggregates)


def sessions(stream: DataFrame, t: str, late: str, gap: str, keys: list[str], **aggregates) -> DataFrame:
    rows = stream.withWatermark(t, late).groupBy(F.session_window(t, gap), *keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return rows.select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *keys, *aggregates)


def interval_join(left: DataFrame, right: DataFrame, on: list[str], lt: str, rt: str, late: str, within: str) -> DataFrame:
    """Pairs of equal keys whose times are at most `within` apart; the watermarks on both sides bound the state."""
    a, b = left.withWatermark(lt, late).alias("vx_l"), right.withWatermark(rt, late).alias("vx_r")
    cond = (F.col(f"vx_r.{rt}") >= F.col(f"vx_l.{lt}") - F.expr(f"interval {within}")) & (F.col(f"vx_r.{rt}") <= F.col(f"vx_l.{lt}") + F.expr(f"interval {within}"))
    for k in on:
        cond = (F.col(f"vx_l.{k}") == F.col(f"vx_r.{k}")) & cond
    return a.join(b, cond).select("vx_l.*", *[F.col(f"vx_r.{c}") for c in right.columns if c not in on])


def anchored(stream: DataFrame, key: str, t: str, value: str, tolerance: float) -> DataFrame:
    """key, session, start, end, n of sessions whose values stay within tolerance of the session's first value.

    Rows of a micro-batch are taken in time order.  A session is given out when the next one starts; the last
    when no row has come for the timeout (processing time, one hour).
    """
    kind = dict(stream.dtypes)

    def fold(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = list(state.get) if state.exists else None  # session, anchor, start, end, n
        done: list[tuple] = []
        if state.hasTimedOut:
            done.append(tuple(now))
            state.remove()
        else:
            rows = pd.concat(list(batches)).sort_values(t, kind="stable")
            for at, v in zip(rows[t], rows[value], strict=True):
                if now is not None and abs(v - now[1]) <= tolerance:
                    now[3], now[4] = at, now[4] + 1
                else:
                    if now is not None:
                        done.append(tuple(now))
                    now = [0 if now is None else now[0] + 1, float(v), at, at, 1]
            state.update(tuple(now))
            state.setTimeoutDuration(3_600_000)
        yield pd.DataFrame([(keys[0], s, a, b, n) for s, _, a, b, n in done], columns=[key, "session", "start", "end", "n"])

    return stream.groupBy(key).applyInPandasWithState(
        fold, f"`{key}` {kind[key]}, session long, start timestamp, end timestamp, n long", "session long, anchor double, start timestamp, end timestamp, n long", "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def tracked(stream: DataFrame, key: str, t: str, box: str, least: float = 0.3, misses: int = 2) -> DataFrame:
    """key, t, track_id for each box, linked as operators.sequence.link_tracks does, time after time.

    Batches must hold whole times in order.  The state is the open tracks' last boxes.
    """
    kind = dict(stream.dtypes)

    def fold(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracker = Tracker(least, misses)
        if state.exists:
            tracker.next, ids, boxes, missed = state.get
            tracker.open = [{"id": i, "rows": [], "box": list(boxes[4 * k : 4 * k + 4]), "missed": m} for k, (i, m) in enumerate(zip(ids, missed, strict=True))]
        rows = pd.concat(list(batches)).sort_values(t, kind="stable").reset_index(drop=True)
        for _, now in rows.groupby(t, sort=True):
            tracker.step([(i, list(b)) for i, b in zip(now.index, now[box], strict=True)])
        out = sorted((i, x["id"]) for x in tracker.tracks() for i in x["rows"])
        still = tracker.open
        state.update((tracker.next, [x["id"] for x in still], [float(v) for x in still for v in x["box"]], [x["missed"] for x in still]))
        yield pd.DataFrame({key: keys[0], t: rows[t].iloc[[i for i, _ in out]].to_numpy(), "track_id": [j for _, j in out]})

    return stream.groupBy(key).applyInPandasWithState(
        fold, f"`{key}` {kind[key]}, `{t}` {kind[t]}, track_id long", "next long, ids array<long>, boxes array<double>, missed array<long>", "append", GroupStateTimeout.NoTimeout
    )


def merged_captions(stream: DataFrame, key: str, t: str, late: str = "1 minute", close: int = 60, similarity=text_ratio, gap: float = 0.5, least: float = 0.7) -> DataFrame:
    """key, start_sec, end_sec, mid_sec, text_pt, confidence: captions merged as operators.sequence.merge_near_duplicates does.

    stream has these columns and the event time t.  The state is the key's last caption.  It is given out when one
    that doesn't continue it comes, or when the watermark has passed its time by `close` seconds.
    """
    fields = ("start_sec", "end_sec", "mid_sec", "text_pt", "confidence")
    kind, kinds = dict(stream.dtypes)[key], "start_sec double, end_sec double, mid_sec double, text_pt string, confidence double"
    names = dict(start="start_sec", end="end_sec", mid="mid_sec", text="text_pt", confidence="confidence")

    def fold(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, done = dict(zip(fields, state.get, strict=True)) if state.exists else None, []
        if state.hasTimedOut:
            done, _ = [now], state.remove()
        else:
            rows = pd.concat(list(batches)).sort_values(["start_sec", "end_sec"], kind="stable")
            for row in rows[list(fields)].to_dict("records"):
                both = merged_caption(now, row, similarity, gap, least, **names)
                done += [now] if now and not both else []
                now = both or row
            state.update(tuple(None if pd.isna(now[f]) else now[f] for f in fields))
            state.setTimeoutTimestamp(max(int(rows[t].max().timestamp() * 1000) + close * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(keys[0], *(x[f] for f in fields)) for x in done], columns=[key, *fields])

    return stream.withWatermark(t, late).groupBy(key).applyInPandasWithState(fold, f"`{key}` {kind}, {kinds}", kinds, "append", GroupStateTimeout.EventTimeTimeout)
