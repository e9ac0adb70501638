"""The attribution stages, each one lazy plan keyed by video."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.config import DEFAULTS, Config
from voxtable.functions.scalars import pyround
from voxtable.operators import attribution as A
from voxtable.operators import cluster, filters, intervals, sequence, signals
from voxtable.operators.aggregates import durations

VIDEO = ["video_id"]
SEGMENT = ["video_id", "segment_id"]


def caption_segments(frames: DataFrame, fps: float, config: Config = DEFAULTS, alike=None) -> DataFrame:
    """Segments of frames (video_id, t, density, mask, present): anchored sessions, long enough, numbered densely."""
    from voxtable.operators.aggregates import segment_stats

    marked = sequence.anchored_sessions(frames, VIDEO, ["t"], alike or sequence.masks_alike(config.mask_iou), "mask", "present", "session")
    stats = segment_stats(marked.where("session is not null"), ["video_id", "session"], "t", "density")
    kept = filters.long_enough(stats, 1 / fps, config.min_segment)
    dense = sequence.numbered(kept, VIDEO, ["session"], "segment_id")
    return dense.select("video_id", "segment_id", pyround("start", 2).alias("start_sec"), pyround(F.col("end") + 1 / fps, 2).alias("end_sec"), "mean_density", "n_samples")


def motion_signals(motion: DataFrame, step: float, config: Config = DEFAULTS) -> DataFrame:
    """Motion of tracks (video_id, track_key, t, v) on the audio grid; tracks of too few samples have no signal."""
    track = ["video_id", "track_key"]
    enough = filters.having(motion.where("v is not null"), track, config.min_samples)
    return signals.interpolate_to_grid(enough, track, "t", "v", step)


def heuristic_fragments(segments: DataFrame, signal: DataFrame, energy: DataFrame, tracks: DataFrame, step: float, config: Config = DEFAULTS, width: float | None = 10.0) -> DataFrame:
    """A row for each segment and track that has enough of it: correlation (4 places) and n_samples.

    signal: video_id, track_key, hop_idx, v.  energy: video_id, hop_idx, rms.  tracks: video_id, track_key,
    identity, pos, shot_id, track_id.  The signal meets the audio once, on the grid; then grid points meet
    segments by buckets of `width` seconds, so that work grows with the points and not with points times
    segments.  All shuffles are by video and what hangs below it.
    """
    joint = signal.join(energy, ["video_id", "hop_idx"]).withColumn("t", F.col("hop_idx") * F.lit(step))
    within = intervals.points_in(joint, segments.select(*SEGMENT, "start_sec", "end_sec"), VIDEO, "t", ("start_sec", "end_sec"), width)
    r = within.groupBy(*SEGMENT, "track_key").agg(pyround(signals.pearson("v", "rms", config.min_samples), 4).alias("correlation"), signals.joint_count("v", "rms").alias("n_samples"))
    return r.where("correlation is not null").join(tracks, ["video_id", "track_key"])


def heuristic_attribution(segments: DataFrame, fragments: DataFrame, config: Config = DEFAULTS) -> DataFrame:
    """segments with assigned_speaker, status and candidates; segments without a candidate stay."""
    best = A.best_fragment(fragments, SEGMENT, "correlation", "pos")
    ranked = A.ranked_candidates(best, SEGMENT, "correlation", "pos", ["identity", "shot_id", "track_id", "correlation", "n_samples"])
    return _decided(segments, ranked, "correlation", lambda n, a, b: A.decide_heuristic(n, a, b, config.confident, config.reject, config.margin))


def _decided(segments: DataFrame, ranked: DataFrame, score: str, decide) -> DataFrame:
    """segments with status, assigned_speaker and candidates; the two best are read off the ranked list."""
    out = segments.join(ranked, SEGMENT, "left")
    nth = lambda k: F.get("candidates", F.lit(k))
    out = out.withColumn("status", decide(F.when(F.col("candidates").isNotNull(), F.size("candidates")), nth(0)[score], nth(1)[score]))
    return out.withColumn("assigned_speaker", A.speaker_of(F.col("status"), nth(0)["identity"]))


def model_attribution(segments: DataFrame, scores: DataFrame, tracks: DataFrame, config: Config = DEFAULTS, width: int | None = 250) -> DataFrame:
    """segments with assigned_speaker, status and candidates from a face model's frame scores.

    scores: video_id, track_key, frame, score at config.target_fps.
    """
    f = lambda c: pyround(F.col(c) * config.target_fps).cast("long")
    spans = segments.select(*SEGMENT, f("start_sec").alias("f0"), f("end_sec").alias("f1"))
    inside = intervals.points_in(scores, spans, VIDEO, "frame", ("f0", "f1"), width)
    parts = inside.groupBy(*SEGMENT, "track_key").agg(pyround(F.avg("score"), 3).alias("mean_score"), F.count("*").alias("n_frames")).join(tracks, ["video_id", "track_key"])
    own = A.weighted_identity(parts, SEGMENT, "mean_score", "n_frames", "pos")
    ranked = A.ranked_candidates(own, SEGMENT, "mean_score", "pos", ["identity", "shot_id", "track_id", "n_frames", "mean_score"])
    return _decided(segments, ranked, "mean_score", lambda n, a, b: A.decide_model(n, a, b, config.model_margin))


def enrollment(segments: DataFrame, heuristic: DataFrame | None, model: DataFrame | None, config: Config = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """(segments whose voice may be enrolled, with identity; the log for each identity).  Either source may be missing."""
    side = lambda df, p: df.select(*SEGMENT, F.col("assigned_speaker").alias(f"{p}_speaker"), F.col("status").alias(f"{p}_status"))
    out = segments
    for p, df in (("h", heuristic), ("m", model)):
        out = out.join(side(df, p), SEGMENT, "left") if df is not None else out.withColumns({f"{p}_speaker": F.lit(None).cast("string"), f"{p}_status": F.lit(None).cast("string")})
    pick = A.enrollment_pick(F.col("h_speaker"), F.col("h_status"), F.col("m_speaker"), F.col("m_status"), config.confident_heuristic, config.confident_model)
    chosen = out.withColumn("identity", pick).where("identity is not null").select(*segments.columns, "identity")
    log = durations(chosen, ["video_id", "identity"], "start_sec", "end_sec", "segment_id", config.enroll_seconds)
    return chosen.join(log.where("enrolled").select("video_id", "identity"), ["video_id", "identity"], "left_semi"), log


def voice_profiles(clips: DataFrame, vector: str = "embedding") -> DataFrame:
    """A unit vector for each identity from its clips' vectors."""
    from voxtable.operators.aggregates import mean_vector

    return mean_vector(clips, ["video_id", "identity"], vector)


def final_attribution(segments: DataFrame, model: DataFrame, voices: DataFrame, profiles: DataFrame, config: Config = DEFAULTS) -> DataFrame:
    """segments with the model's answer, voice_candidates (3 places) and the final one, decided on exact similarities.

    voices: video_id, segment_id, embedding of the segments that have audio.
    """
    ranked = cluster.profile_ranking(voices, profiles, VIDEO, "segment_id", "embedding")
    exact = F.transform(F.sort_array(F.collect_list(F.struct("nth", "identity", "similarity"))), lambda v: F.struct(v["identity"].alias("identity"), v["similarity"].alias("similarity")))
    lists = ranked.groupBy(*SEGMENT).agg(exact.alias("voices"))
    side = model.select(*SEGMENT, F.col("assigned_speaker").alias("talknet_speaker"), F.col("status").alias("m_status"))
    out = segments.join(side, SEGMENT, "left").join(lists, SEGMENT, "left").withColumn("d", A.decide_final(F.col("talknet_speaker"), F.col("m_status"), F.col("voices"), config.voice_confident, config.override_margin))
    shown = F.coalesce(F.transform("voices", lambda v: F.struct(v["identity"].alias("identity"), pyround(v["similarity"], 3).alias("similarity"))), F.expr("cast(array() as array<struct<identity:string, similarity:double>>)"))
    return out.select(*segments.columns, "talknet_speaker", F.coalesce(F.col("m_status") == "assigned", F.lit(False)).alias("talknet_confident"), shown.alias("voice_candidates"), "d.final_speaker", "d.final_status")


def identities(tracks: DataFrame, config: Config = DEFAULTS) -> DataFrame:
    """tracks (video_id, track_key, embedding, first_seen, pos) with cluster and identity."""
    labels = cluster.cluster_tracks(tracks, VIDEO, "track_key", "embedding", config.cluster_distance)
    return cluster.named_clusters(tracks.join(labels, ["video_id", "track_key"]), VIDEO, "track_key", "first_seen", "pos")
