"""Parameters of the attribution pipeline, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

#: The statuses of the three attributions.
HEURISTIC_STATUSES = (
    "assigned_single_candidate", "assigned_single_candidate_low_conf", "assigned_multi_candidate",
    "uncertain_no_confident_face", "uncertain_anticorrelated_mouth", "uncertain_ambiguous_multi_candidate",
)
MODEL_STATUSES = ("assigned", "assigned_low_confidence", "uncertain_no_confident_face", "uncertain_ambiguous_multi_candidate")
FINAL_STATUSES = ("confident_talknet", "confident_voice_override", "confident_talknet_no_voice_check", "confident_voice_only", "not_confident")


@dataclass(frozen=True)
class Config:
    """Fixed values are the defaults: with others, results are other ones."""

    # shots and caption segments
    shot_threshold: float = 27.0
    shot_min_frames: int = 8
    caption_fps: float = 8.0
    white: int = 190
    density: float = 0.012
    mask_iou: float = 0.55
    min_segment: float = 0.3
    glyph_heights: tuple[int, int] = (4, 22)
    glyph_area: int = 250
    min_glyphs: int = 10
    first_line: tuple[float, float, float, float] = (0.0, 282 / 360, 1.0, 307 / 360)
    second_line: tuple[float, float, float, float] = (0.0, 308 / 360, 1.0, 326 / 360)
    # captions
    ocr_confidence: float = 60.0
    merge_gap: float = 0.5
    merge_similarity: float = 0.7
    # faces and identities
    face_fps: float = 5.0
    track_iou: float = 0.3
    track_misses: int = 2
    track_detections: int = 3
    frames_a_track: int = 8
    face_pad: float = 0.2
    cluster_distance: float = 0.5
    borderline: float = 0.35
    # mouth motion against audio
    sample_rate: int = 16_000
    hop: int = 320
    frame: int = 640
    mouth_pad: float = 0.9
    confident: float = 0.15
    reject: float = -0.35
    margin: float = 0.1
    min_samples: int = 3
    # face model
    target_fps: int = 25
    filter_width: int = 13
    min_frames: int = 10
    model_margin: float = 0.2
    durations: tuple[int, ...] = (1, 1, 1, 2, 2, 2, 3, 3, 4, 5, 6)
    # voices
    enroll_seconds: float = 3.0
    voice_confident: float = 0.6
    override_margin: float = 0.08
    confident_heuristic: tuple[str, ...] = field(default=("assigned_single_candidate", "assigned_multi_candidate"))
    confident_model: tuple[str, ...] = field(default=("assigned",))


DEFAULTS = Config()
