"""JSON documents there and back, media stand-ins, and streams against their batch forms."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtable.operators import sequence
from voxtable.sources import documents, media
from voxtable.streaming import stateful

#: Statuses and candidates (correlations) of a published example, to replay the decision on.
EXAMPLE = [
    ([0.2079], "assigned_single_candidate"), ([-0.2603], "assigned_single_candidate_low_conf"), ([0.8526, 0.4509], "assigned_multi_candidate"), ([0.2863], "assigned_single_candidate"),
    ([0.1944, -0.1623], "assigned_multi_candidate"), ([-0.5485], "uncertain_anticorrelated_mouth"), ([-0.2693], "assigned_single_candidate_low_conf"), ([0.2571], "assigned_single_candidate"),
    ([-0.392], "uncertain_anticorrelated_mouth"), ([0.0656], "assigned_single_candidate_low_conf"), ([-0.0072], "assigned_single_candidate_low_conf"), ([-0.1331], "assigned_single_candidate_low_conf"),
    ([0.0303], "assigned_single_candidate_low_conf"), ([0.495], "assigned_single_candidate"), ([0.1949], "assigned_single_candidate"), ([0.0825], "assigned_single_candidate_low_conf"),
    ([-0.2662], "assigned_single_candidate_low_conf"), ([-0.1203], "assigned_single_candidate_low_conf"), ([-0.1176], "assigned_single_candidate_low_conf"), ([-0.0913], "assigned_single_candidate_low_conf"),
    ([-0.1965], "assigned_single_candidate_low_conf"), ([-0.1708], "assigned_single_candidate_low_conf"),
]
#: start, end and middle of its segments.
TIMES = [
    (0.0, 1.47, 0.73), (1.47, 5.07, 3.27), (5.07, 6.94, 6.01), (26.56, 28.7, 27.63), (28.7, 33.1, 30.9), (33.1, 36.44, 34.77), (36.44, 38.97, 37.7), (47.65, 49.52, 48.59), (49.52, 51.65, 50.59), (51.65, 54.72, 53.19), (54.72, 57.12, 55.92),
    (57.12, 59.13, 58.12), (59.13, 60.86, 60.0), (60.86, 65.13, 62.99), (65.13, 66.6, 65.86), (66.6, 70.07, 68.33), (70.07, 75.28, 72.67), (75.28, 77.94, 76.61), (77.94, 82.08, 80.01), (82.08, 86.09, 84.09), (86.09, 88.76, 87.43), (88.76, 90.09, 89.43),
]


def test_published_example(spark):
    from voxtable.functions.scalars import midpoint, pyround
    from voxtable.plans.attribution import heuristic_attribution

    times = spark.createDataFrame(TIMES, "a double, b double, mid double")
    assert times.where(pyround(midpoint("a", "b"), 2) != F.col("mid")).count() == 0
    segments = spark.createDataFrame([("v", i, a, b) for i, (a, b, _) in enumerate(TIMES)], "video_id string, segment_id int, start_sec double, end_sec double")
    parts = [("v", i, f"shot0_track{k}", c, 9, f"shot0_track{k}", k, 0, k) for i, (cs, _) in enumerate(EXAMPLE) for k, c in enumerate(cs)]
    fragments = spark.createDataFrame(parts, "video_id string, segment_id int, track_key string, correlation double, n_samples long, identity string, pos int, shot_id int, track_id int")
    out = heuristic_attribution(segments, fragments).orderBy("segment_id").collect()
    assert [r.status for r in out] == [s for _, s in EXAMPLE]
    assert sum(r.assigned_speaker is not None for r in out) == 20


def put(folder, name, value):
    (folder / name).write_text(json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return f"file://{folder}/{name}"


def test_documents(spark, tmp_path):
    shots = put(tmp_path, "v1_shots.json", [{"shot_id": 0, "start_sec": 0.0, "end_sec": 1.5, "start_frame": 0, "end_frame": 45}])
    assert documents.shots(documents.read(spark, shots, "shots")).first().video_id == "v1"
    lines = [{"segment_id": 0, "start_sec": 0.0, "end_sec": 1.0, "mid_sec": 0.5, "text_pt": "olá – “ç”", "text_en_ref": None}, {"segment_id": 3, "start_sec": 1.0, "end_sec": 2.0, "mid_sec": 1.5, "text_pt": "b", "text_en_ref": "b", "confidence": 91.5}]
    path = put(tmp_path, "v1_transcript.json", {"video_id": "v1", "transcript": lines})
    table = documents.rows(documents.read(spark, path, "transcript"), "transcript")
    assert [(r.pos, r.text_pt, r.confidence) for r in table.orderBy("pos").collect()] == [(0, "olá – “ç”", None), (1, "b", 91.5)]
    columns = ["segment_id", "start_sec", "end_sec", "mid_sec", "text_pt", "text_en_ref", "confidence"]
    back = json.loads(documents.documents(table, "pos", "transcript", columns).first().json)
    assert back == {"video_id": "v1", "transcript": [{**dict.fromkeys(columns), **x} for x in lines]}
    documents.write_documents(documents.documents(table, "pos", "transcript", columns), f"file://{tmp_path}/out")
    assert documents.read_optional(spark, f"file://{tmp_path}/none.json", "face_identities").count() == 0


def test_nested_tracks_and_identities(spark, tmp_path):
    det = {"t": 0.2, "box": [1, 2, 3, 4], "keypoints": {"nose": [1, 2]}, "confidence": 0.99}
    path = put(tmp_path, "v_face_tracks.json", {"video_id": "v", "sample_fps": 5.0, "shots": [{"shot_id": 0, "start_sec": 0, "end_sec": 1, "tracks": []}, {"shot_id": 1, "start_sec": 1, "end_sec": 2, "tracks": [{"track_id": 4, "n_detections": 2, "detections": [det, det]}]}]})
    flat = documents.detections(documents.read(spark, path, "face_tracks"))
    assert [(r.shot_pos, r.shot_id, r.track_pos, r.track_id, r.det_pos, r.box, r.keypoints["nose"]) for r in flat.orderBy("det_pos").collect()] == [(1, 1, 0, 4, k, [1, 2, 3, 4], [1, 2]) for k in (0, 1)]
    path = put(tmp_path, "v_face_identities.json", {"identities": [{"identity": "person_0", "tracks": ["b", "a"], "n_tracks": 2}], "track_to_identity": {"a": "person_0"}, "nearest_other_cluster": {"a": {"track": "c", "identity": "person_1", "similarity": 0.5}}, "excluded_tracks": ["z"]})
    docs = documents.read(spark, path, "face_identities")
    assert [r.track_key for r in documents.identity_members(docs).orderBy("member_pos").collect()] == ["b", "a"]
    assert documents.nearest_others(docs).first().track == "c" and documents.excluded_tracks(docs).first().track_key == "z"
    path = put(tmp_path, "v_corrections.json", {"merge": [{"track": "a", "target_identity": "person_1"}], "exclude": ["b"]})
    assert sorted(r.action for r in documents.corrections(documents.read(spark, path, "corrections")).collect()) == ["exclude", "merge"]


def test_review_sources_by_shape(spark, tmp_path):
    row = {"segment_id": 0, "start_sec": 0.0, "end_sec": 1.0, "text_pt": "a"}
    a = put(tmp_path, "a.json", {"video_id": "v", "attribution": [{**row, "assigned_speaker": None, "status": "assigned"}]})
    b = put(tmp_path, "b.json", {"video_id": "v", "attribution": [{**row, "final_speaker": "x", "final_status": "not_confident"}]})
    c = put(tmp_path, "c.json", {"video_id": "v", "transcript": [row]})
    d = put(tmp_path, "d.json", {"video_id": "v", "other": 1})
    assert [documents.review_source(spark, p).first().kind for p in (a, b, c)] == ["assigned", "final", "transcript"]
    with pytest.raises(Exception, match="neither a transcript"):
        documents.review_source(spark, d).collect()


def test_media(spark, tmp_path):
    for n in ("b.jpg", "a.jpg", "c.png"):
        (tmp_path / n).write_bytes(n.encode())
    frames = media.frame_files(spark, f"file://{tmp_path}")
    assert [(r.frame_idx, bytes(r.content)) for r in frames.orderBy("frame_idx").collect()] == [(0, b"a.jpg"), (1, b"b.jpg")]
    video = spark.createDataFrame([("v", 25.0, 50, 4, 4), ("w", 0.0, 9, 4, 4)], "video_id string, native_fps double, n_frames bigint, width int, height int")
    assert [r.duration_sec for r in media.video_meta(video).orderBy("video_id").collect()] == [2.0, None]
    times = spark.createDataFrame([("v", 0.02), ("v", 0.06), ("v", 9.0)], "video_id string, t double")
    at = media.frames_at(times, spark.createDataFrame([("v", i, i * 10) for i in range(3)], "video_id string, frame_idx long, x int"), video)
    assert [r.x for r in at.orderBy("t").collect()] == [0, 20, None]
    df = spark.createDataFrame([(1, [0.5, 1.0]), (2, []), (3, None), (4, [0.5, 1.0])], "i int, samples array<float>")
    out = {r.i: r.embedding for r in media.embedded(df, "samples", media.stub_embedder).collect()}
    assert out[2] is None and out[3] is None and out[1] == out[4] and abs(np.linalg.norm(out[1]) - 1) < 1e-9
    stereo = spark.createDataFrame([([[0.0, 1.0], [2.0, 4.0]],)], "channels array<array<double>>")
    assert stereo.select(media.mono().alias("m")).first().m == [0.5, 3.0]


@pytest.fixture
def stream(spark, tmp_path):
    """Runs a query over the events as a stream, in time order, and gives its rows."""
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", "value", F.col("ts").cast("timestamp").alias("ts")).orderBy("ts", "event_id").coalesce(1)
    rows.write.parquet(f"file://{tmp_path}/in")

    def run(make, name):
        source = spark.readStream.schema("event_id long, user_id long, value double, ts timestamp").parquet(f"file://{tmp_path}/in")
        q = make(source).writeStream.format("memory").queryName(name).option("checkpointLocation", f"file://{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name)

    return run, rows


def test_streams(spark, stream):
    run, rows = stream
    days = run(lambda s: stateful.windowed(s, "ts", "1 hour", "1 day", [], n=F.count("*")), "days")
    batch = {r.d: r.n for r in rows.groupBy(F.window("ts", "1 day")["start"].alias("d")).agg(F.count("*").alias("n")).collect()}
    found = {r.window_start: r.n for r in days.collect()}
    assert len(found) >= len(batch) - 1 and all(batch[d] == n for d, n in found.items())
    sessions = run(lambda s: stateful.sessions(s, "ts", "1 hour", "30 minutes", ["user_id"], n=F.count("*")), "sessions")
    assert sessions.count() > 0.9 * rows.groupBy(F.session_window("ts", "30 minutes"), "user_id").count().count()
    pairs = run(lambda s: stateful.interval_join(s, s.select(F.col("user_id"), F.col("event_id").alias("other"), F.col("ts").alias("ts2")), ["user_id"], "ts", "ts2", "1 hour", "30 minutes"), "pairs")
    b = rows.select("user_id", F.col("ts").alias("ts2"))
    assert pairs.count() == rows.join(b, "user_id").where("ts2 between ts - interval 30 minutes and ts + interval 30 minutes").count()


def test_stateful_streams(spark, stream):
    run, rows = stream
    out = run(lambda s: stateful.anchored(s, "user_id", "ts", "value", 20.0), "anchored")
    batch = sequence.anchored_sessions(rows.withColumn("on", F.lit(True)), ["user_id"], ["ts", "event_id"], lambda a, b: abs(a - b) <= 20, "value", "on")
    plain = {(r.user_id, r.session): r.n for r in batch.groupBy("user_id", "session").agg(F.count("*").alias("n")).collect()}
    found = {(r.user_id, r.session): r.n for r in out.collect()}
    last = {u: max(s for v, s in plain if v == u) for u, _ in plain}
    assert found == {k: n for k, n in plain.items() if k[1] != last[k[0]]}
    boxes = lambda df: df.withColumn("box", F.array(F.col("value"), F.lit(0.0), F.lit(30.0), F.lit(30.0)))
    tracked = run(lambda s: stateful.tracked(boxes(s), "user_id", "ts", "box"), "tracked")
    plain = sequence.link_tracks(boxes(rows), ["user_id"], "ts", "event_id", detections=1)
    key = lambda df: sorted((r.user_id, r.ts, r.track_id) for r in df.select("user_id", "ts", "track_id").collect())
    assert key(tracked) == key(plain)


def test_streamed_captions_merge_as_in_batch(spark, stream):
    run, rows = stream
    captions = lambda df: df.select("user_id", "ts", F.unix_seconds("ts").cast("double").alias("start_sec"), (F.unix_seconds("ts") + 3600).cast("double").alias("end_sec"), F.lit(0.0).alias("mid_sec"), F.concat(F.lit("line "), (F.col("value") / 40).cast("int").cast("string")).alias("text_pt"), (F.col("event_id") % 3).cast("double").alias("confidence"))
    found = run(lambda s: stateful.merged_captions(captions(s), "user_id", "ts", "1 hour", 3600, gap=40_000.0, least=0.9), "captions")
    batch = sequence.merge_near_duplicates(captions(rows), ["user_id"], gap=40_000.0, least=0.9)
    columns = ["user_id", "start_sec", "end_sec", "mid_sec", "text_pt", "confidence"]
    plain, got = (sorted(map(tuple, df.select(*columns).collect())) for df in (batch, found))
    last = {u: max(x for x in plain if x[0] == u) for u in {x[0] for x in plain}}
    closed = {x for x in plain if x != last[x[0]]}
    assert closed <= set(got) <= set(plain) and len(got) == len(set(got)) and len(plain) < rows.count()
