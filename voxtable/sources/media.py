"""The boundary to media and models.

Decoders, detectors, encoders and recognisers stay outside.  What they have to give is a table, or a function
that an iterator over Arrow batches calls; each protocol has a stand-in, which is deterministic, for tests.
"""

from __future__ import annotations

import hashlib
import io
import math
import wave
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What outside decoders are to write.
FRAMES = "video_id string, frame_idx bigint, width int, height int, grey binary"
VIDEO = "video_id string, native_fps double, n_frames bigint, width int, height int"
SAMPLES = "video_id string, chunk_idx bigint, samples array<float>"


class Detector(Protocol):
    def __call__(self, picture: np.ndarray) -> list[tuple[list[int], dict[str, list[int]], float]]:
        """(box, keypoints, confidence) of each face in a grey picture."""


class Embedder(Protocol):
    def __call__(self, data: np.ndarray) -> np.ndarray:
        """A vector for a picture or for samples."""


class FrameScorer(Protocol):
    def __call__(self, frames: np.ndarray, samples: np.ndarray) -> np.ndarray:
        """A score for each frame of a chunk."""


def stub_embedder(size: int = 16) -> Embedder:
    """A unit vector that depends on nothing but the bytes."""

    def embed(data: np.ndarray) -> np.ndarray:
        seed = int.from_bytes(hashlib.sha256(np.ascontiguousarray(data).tobytes()).digest()[:8], "little")
        v = np.random.default_rng(seed).normal(size=size)
        return v / np.linalg.norm(v)

    return embed


def stub_detector(bright: int = 128) -> Detector:
    """A box about the bright points of each quarter of a picture, its mouth corners in the lower third."""

    def detect(picture: np.ndarray) -> list[tuple[list[int], dict[str, list[int]], float]]:
        found, (high, wide) = [], (picture.shape[0] // 2, picture.shape[1] // 2)
        for top in (0, high):
            for left in (0, wide):
                part = picture[top : top + high, left : left + wide] > bright
                if part.any():
                    ys, xs = np.nonzero(part)
                    x, y, w, h = int(xs.min()) + left, int(ys.min()) + top, int(np.ptp(xs)) + 1, int(np.ptp(ys)) + 1
                    mouth = {"mouth_left": [x + w // 4, y + 2 * h // 3], "mouth_right": [x + 3 * w // 4, y + 2 * h // 3]}
                    found.append(([x, y, w, h], mouth, float(part.mean())))
        return found

    return detect


def stub_scorer() -> FrameScorer:
    """How much brighter than the chunk's mean a frame is, times how loud the chunk is."""
    return lambda frames, samples: (frames.reshape(len(frames), -1).mean(axis=1) - frames.mean()) * (np.abs(samples).mean() if samples.size else 0.0)


def detected(frames: DataFrame, make) -> DataFrame:
    """video_id, frame_idx, det_pos, box, keypoints and confidence (4 places) of the faces in each picture.

    frames: FRAMES.  make() loads the detector, once for each task.  Frames without a picture give nothing.
    """

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = make()
        for pdf in it:
            out = []
            for video, at, w, h, grey in zip(pdf["video_id"], pdf["frame_idx"], pdf["width"], pdf["height"], pdf["grey"], strict=True):
                if grey is not None and len(grey):
                    found = detector(np.frombuffer(grey, np.uint8).reshape(int(h), int(w)))
                    out += [(video, at, i, [int(v) for v in box], {k: [int(v) for v in xy] for k, xy in points.items()}, round(sure, 4)) for i, (box, points, sure) in enumerate(found)]
            yield pd.DataFrame(out, columns=["video_id", "frame_idx", "det_pos", "box", "keypoints", "confidence"])

    return frames.select("video_id", "frame_idx", "width", "height", "grey").mapInPandas(batches, "video_id string, frame_idx bigint, det_pos int, box array<int>, keypoints map<string, array<int>>, confidence double")


def scored_frames(df: DataFrame, keys: list[str], frame: str, picture: str, samples: str, make, durations: tuple[int, ...], fps: int = 25) -> DataFrame:
    """keys, frame, score (3 places): the mean over all durations of what the scorer gives a frame in its chunk.

    df has a row for each frame of a track, with its picture and its samples as flat arrays of one length each.  A
    track is cut from its first frame on; one track is held at a time.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys, frame).schema)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, scorer = pdf.sort_values(frame).reset_index(drop=True), make()
        pictures, sound = (np.array(pdf[c].tolist(), np.float32) for c in (picture, samples))
        parts = [np.concatenate([np.asarray(scorer(pictures[i : i + d * fps], sound[i : i + d * fps])) for i in range(0, len(pdf), d * fps)]) for d in durations]
        return pdf[[*keys, frame]].assign(score=np.rint(np.mean(parts, axis=0) * 1000) / 1000)

    return df.select(*keys, frame, picture, samples).groupBy(*keys).applyInPandas(score, f"{kinds}, score double")


def cropped(picture: Column, width: Column, box: Column) -> Column:
    """The points of a grey picture within [x0, y0, x1, y1], row by row; null if there are none."""

    @F.pandas_udf("array<float>")
    def cut(grey: pd.Series, wide: pd.Series, at: pd.Series) -> pd.Series:
        out = []
        for g, w, b in zip(grey, wide, at, strict=True):
            part = np.zeros(0) if g is None or b is None else np.frombuffer(g, np.uint8).reshape(-1, int(w))[b[1] : b[3], b[0] : b[2]]
            out.append(part.ravel().astype(np.float32) if part.size else None)
        return pd.Series(out, dtype=object)

    return cut(picture, width, box)


def track_embeddings(detections: DataFrame, frames: DataFrame, video: DataFrame, make, most: int = 8, pad: float = 0.2) -> DataFrame:
    """video_id, shot_id, track_id and a unit vector for each track: the mean over at most `most` of its detections.

    Detections at an even stride meet their frames; the padded box is cut out and given to the embedder.  Frames
    that can't be read and empty crops are passed over; a track without any crop has no row.
    """
    from voxtable.functions.scalars import padded_box
    from voxtable.operators.aggregates import mean_vector
    from voxtable.operators.sequence import stride_sample

    track = ["video_id", "shot_id", "track_id"]
    picked = stride_sample(detections.select(*track, "det_pos", "t", "box"), track, ["det_pos"], most)
    seen = frames_at(picked, frames, video).where("grey is not null")
    crops = seen.select(*track, cropped(F.col("grey"), F.col("width"), padded_box("box", F.col("width"), F.col("height"), pad)).alias("crop"))
    return mean_vector(embedded(crops, "crop", make).where("embedding is not null"), track, "embedding")


def resampled(samples: np.ndarray, rate: int, to: int, side: int = 32) -> np.ndarray:
    """Samples at another rate, by a sinc under a Hann window of `side` zero crossings a side; zeros beyond the ends."""
    if rate == to or not len(samples):
        return np.asarray(samples, np.float64)
    g = math.gcd(rate, to)
    up, down = to // g, rate // g
    cut = min(1.0, up / down)  # of the old rate's band
    reach = int(math.ceil(side / cut))
    n = np.arange(-(-len(samples) * up // down))
    base, phase = np.divmod(n * down, up)
    k = np.arange(-reach + 1, reach + 1)
    x = (k[None, :] - (np.arange(up) / up)[:, None]) * cut
    table = cut * np.sinc(x) * np.cos(np.pi / 2 * np.clip(x / side, -1, 1)) ** 2
    line = np.concatenate([np.zeros(reach), samples, np.zeros(reach + 1)])
    out = np.empty(len(n))
    for i in range(0, len(n), 1 << 14):
        own = slice(i, i + (1 << 14))
        out[own] = np.einsum("nk,nk->n", line[base[own, None] + k + reach], table[phase[own]])
    return out


def wav_chunks(files: DataFrame, chunk: int = 16_000, rate: int | None = None) -> DataFrame:
    """video_id (the file's name), rate, chunk_idx and samples (-1 to 1) of WAV files, channels mixed to one.

    files: path, content.  Samples are whole numbers of 8 to 32 bits; with a rate they are resampled to it.
    """

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                values, own = _pcm(content)
                line = values.mean(axis=1) if values.size else np.zeros(0)
                line = resampled(line, own, rate) if rate else line
                name = path.rsplit("/", 1)[-1].removesuffix(".wav")
                for i in range(0, len(line), chunk):
                    yield pd.DataFrame({"video_id": [name], "rate": [rate or own], "chunk_idx": [i // chunk], "samples": [line[i : i + chunk].astype(np.float32)]})

    return files.select("path", "content").mapInPandas(batches, "video_id string, rate int, chunk_idx bigint, samples array<float>")


def _pcm(content: bytes) -> tuple[np.ndarray, int]:
    """(samples by channels, -1 to 1; rate) of a WAV file's bytes."""
    with wave.open(io.BytesIO(content)) as f:
        width, channels, rate, raw = f.getsampwidth(), f.getnchannels(), f.getframerate(), f.readframes(f.getnframes())
    if width == 1:
        values = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    else:
        bytes_ = np.frombuffer(raw, np.uint8).reshape(-1, width)
        wide = np.zeros((len(bytes_), 4), np.uint8)
        wide[:, 4 - width :] = bytes_
        values = wide.view("<i4")[:, 0] / 2.0**31
    return values.reshape(-1, channels), rate


def wav_whole_numbers(files: DataFrame) -> DataFrame:
    """video_id, rate and samples of 16-bit WAV files of one channel as the whole numbers that they hold."""

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                values, rate = _pcm(content)
                yield pd.DataFrame({"video_id": [path.rsplit("/", 1)[-1].removesuffix(".wav")], "rate": [rate], "samples": [np.rint(values[:, 0] * 32768).astype(np.int16)]})

    return files.select("path", "content").mapInPandas(batches, "video_id string, rate int, samples array<smallint>")


def trimmed_lengths(audio: Column, video: Column, audio_rate: int = 100, fps: int = 25) -> Column:
    """struct(n_audio, n_video): what is kept of both so that there are exactly four audio rows to a frame; zeros if nothing is."""
    from voxtable.functions.scalars import pyround

    whole = audio_rate // fps
    seconds = F.least((audio - audio % whole) / audio_rate, video / fps)
    kept = lambda rate: F.when(seconds > 0, pyround(seconds * rate)).otherwise(0).cast("long")
    return F.struct(kept(audio_rate).alias("n_audio"), kept(fps).alias("n_video"))


def embedded(df: DataFrame, data: str, make, out: str = "embedding") -> DataFrame:
    """df with a vector for each array in `data`; make() loads the model, once for each task.  Null and empty: null."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in it:
            vectors = [None if x is None or not len(x) else model(np.asarray(x, np.float32)).tolist() for x in pdf[data]]
            yield pdf.assign(**{out: pd.Series(vectors, dtype=object, index=pdf.index)})

    return df.mapInPandas(batches, f"{fields}, `{out}` array<double>")


def files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path, length, content of files, read as bytes."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder).select("path", "length", "content")


def frame_files(spark: SparkSession, folder: str, pattern: str = "*.jpg") -> DataFrame:
    """Pictures of one folder for each video, numbered from 0 by name within it."""
    df = files(spark, folder, pattern).withColumn("video_id", F.element_at(F.split("path", "/"), -2))
    return df.withColumn("frame_idx", F.row_number().over(Window.partitionBy("video_id").orderBy("path")).cast("long") - 1)


def frames_at(times: DataFrame, frames: DataFrame, video: DataFrame, t: str = "t") -> DataFrame:
    """times with the frame nearest to t; null fields where it can't be read."""
    from voxtable.functions.scalars import pyround

    wanted = times.join(video.select("video_id", "native_fps"), "video_id").withColumn("frame_idx", pyround(F.col(t) * F.col("native_fps")).cast("long")).drop("native_fps")
    return wanted.join(frames, ["video_id", "frame_idx"], "left")


def video_meta(video: DataFrame) -> DataFrame:
    """With the duration, null if the rate is zero."""
    return video.withColumn("duration_sec", F.when(F.col("native_fps") > 0, F.col("n_frames") / F.col("native_fps")))


def mono(channels: Column | str = "channels") -> Column:
    """Mean of the channels of each sample, from an array of samples, each an array of its channels."""
    mean = lambda s: F.aggregate(s, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(s)
    return F.transform(channels, mean)
