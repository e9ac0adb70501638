"""Sound files, stand-ins and what runs them."""

import wave

import numpy as np

from voxtable.operators.sequence import stride_sample
from voxtable.sources import media


def save(path, values, rate, width=2):
    with wave.open(str(path), "wb") as f:
        f.setnchannels(values.shape[1])
        f.setsampwidth(width)
        f.setframerate(rate)
        f.writeframes(values.astype({1: np.uint8, 2: "<i2", 4: "<i4"}[width]).tobytes())


def test_sound_files(spark, tmp_path):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-30_000, 30_000, (5_000, 2)), rng.integers(-32_768, 32_767, (700, 1))
    save(tmp_path / "a.wav", a, 8_000)
    save(tmp_path / "b.wav", b, 16_000)
    save(tmp_path / "c.wav", np.zeros((0, 1)), 16_000)
    files = media.files(spark, f"file://{tmp_path}", "*.wav")
    got = media.wav_chunks(files, 2_000).orderBy("video_id", "chunk_idx").collect()
    assert [(r.video_id, r.rate, r.chunk_idx, len(r.samples)) for r in got] == [("a", 8_000, 0, 2_000), ("a", 8_000, 1, 2_000), ("a", 8_000, 2, 1_000), ("b", 16_000, 0, 700)]
    line = np.concatenate([r.samples for r in got if r.video_id == "a"])
    assert np.allclose(line, a.mean(axis=1) / 32768, atol=1e-6)
    whole = {r.video_id: r.samples for r in media.wav_whole_numbers(files.where("path like '%/b.wav'")).collect()}
    assert whole == {"b": b[:, 0].tolist()}
    (tmp_path / "x").mkdir()
    save(tmp_path / "x" / "d.wav", np.array([[0], [128], [255]]), 100, 1)
    d = media.wav_chunks(media.files(spark, f"file://{tmp_path}/x", "*.wav")).first()
    assert d.samples == [-1.0, 0.0, 127 / 128]


def test_resampling_keeps_a_tone():
    for rate, to in ((44_100, 16_000), (8_000, 16_000), (48_000, 16_000)):
        t = np.arange(rate) / rate
        found = media.resampled(np.sin(2 * np.pi * 440 * t), rate, to)
        plain = np.sin(2 * np.pi * 440 * np.arange(to) / to)
        assert len(found) == to and np.abs(found[400:-400] - plain[400:-400]).max() < 2e-3
    high = media.resampled(np.sin(2 * np.pi * 15_000 * np.arange(44_100) / 44_100), 44_100, 16_000)
    assert np.abs(high[400:-400]).max() < 0.02


def test_detections_and_embeddings(spark):
    def picture(i):
        p = np.zeros((20, 30), np.uint8)
        p[2:8, 3:9] = 200
        if i % 2:
            p[12:18, 20:28] = 220
        return bytearray(p.tobytes())

    frames = spark.createDataFrame([("v", i, 30, 20, picture(i) if i != 6 else None) for i in range(24)], media.FRAMES)
    found = media.detected(frames, media.stub_detector).orderBy("frame_idx", "det_pos").collect()
    assert [r.frame_idx for r in found] == [i for i in range(24) for _ in range(2 if i % 2 else 1) if i != 6]
    assert found[0].box == [3, 2, 6, 6] and found[0].keypoints["mouth_left"] == [4, 6]
    video = spark.createDataFrame([("v", 25.0, 24, 30, 20)], media.VIDEO)
    rows = [("v", 0, 0, i, i / 25, [3, 2, 6, 6]) for i in range(20)] + [("v", 0, 1, i, 9.0 + i, [3, 2, 6, 6]) for i in range(3)] + [("v", 1, 0, 0, 0.0, [40, 30, 5, 5])]
    dets = spark.createDataFrame(rows, "video_id string, shot_id int, track_id int, det_pos int, t double, box array<int>")
    got = media.track_embeddings(dets, frames, video, media.stub_embedder).collect()
    assert [(r.shot_id, r.track_id) for r in got] == [(0, 0)]  # unreadable frames and empty crops leave no vector
    picked = [r.det_pos for r in stride_sample(dets.where("shot_id = 0 and track_id = 0"), ["track_id"], ["det_pos"], 8).collect()]
    embed, parts = media.stub_embedder(), []
    for i in sorted(picked):
        if i != 6:
            grey = np.frombuffer(bytes(picture(i)), np.uint8).reshape(20, 30)
            parts.append(embed(grey[1:9, 2:10].ravel().astype(np.float32)))
    mean = np.mean(parts, axis=0)
    assert np.allclose(got[0].embedding, mean / np.linalg.norm(mean))


def test_scored_frames_average_over_chunkings(spark):
    rng = np.random.default_rng(2)
    pictures, sound = rng.random((70, 6)).astype(np.float32), rng.random((70, 4)).astype(np.float32)
    df = spark.createDataFrame([("k", i, pictures[i].tolist(), sound[i].tolist()) for i in range(70)], "k string, frame long, p array<float>, s array<float>")
    found = media.scored_frames(df, ["k"], "frame", "p", "s", media.stub_scorer, (1, 1, 2), 25).orderBy("frame").collect()
    scorer, plain = media.stub_scorer(), []
    for d in (1, 1, 2):
        plain.append(np.concatenate([scorer(pictures[i : i + 25 * d], sound[i : i + 25 * d]) for i in range(0, 70, 25 * d)]))
    assert np.allclose([r.score for r in found], np.round(np.mean(plain, axis=0), 3), atol=1.01e-3)
