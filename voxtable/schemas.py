"""Schemas of the JSON documents and of their tables; every table is led by video_id."""

from __future__ import annotations

SHOT = "shot_id int, start_sec double, end_sec double, start_frame bigint, end_frame bigint"
SEGMENT = "segment_id int, start_sec double, end_sec double, mean_density double, n_samples int"
PARAMS = "struct<white_thresh:int, density_on_thresh:double, sim_thresh:double, min_segment_sec:double>"
META = f"video_path string, width int, height int, native_fps double, sample_fps_requested double, sample_fps_actual double, duration_sec double, pt_line_frac array<double>, en_line_frac array<double>, params {PARAMS}"
LINE = "segment_id int, start_sec double, end_sec double, mid_sec double, text_pt string, text_en_ref string, confidence double"
DETECTION = "t double, box array<int>, keypoints map<string, array<int>>, confidence double"
TRACKED_SHOT = f"shot_id int, start_sec double, end_sec double, tracks array<struct<track_id:int, n_detections:int, detections:array<struct<{DETECTION.replace(' double', ':double').replace('box ', 'box:').replace('keypoints ', 'keypoints:')}>>>>"
CORRELATED = "struct<identity:string, shot_id:int, track_id:int, correlation:double, n_samples:int>"
SCORED = "struct<identity:string, shot_id:int, track_id:int, n_frames:int, mean_score:double>"
ATTRIBUTED = "segment_id int, start_sec double, end_sec double, text_pt string, assigned_speaker string, status string, candidates array<{}>"
FINAL = "segment_id int, start_sec double, end_sec double, text_pt string, talknet_speaker string, talknet_confident boolean, voice_candidates array<struct<identity:string, similarity:double>>, final_speaker string, final_status string"


def as_struct(fields: str) -> str:
    """The same fields as a struct type."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(fields + ","):
        depth += (c in "<(") - (c in ">)")
        if c == "," and depth == 0:
            name, kind = fields[start:i].strip().split(" ", 1)
            out.append(f"{name}:{kind.strip()}")
            start = i + 1
    return f"struct<{', '.join(out)}>"


#: Documents: shots are a bare array, the others objects.
DOCUMENTS = {
    "shots": SHOT,
    "caption_segments": f"meta {as_struct(META)}, segments array<{as_struct(SEGMENT)}>",
    "transcript": f"video_id string, transcript array<{as_struct(LINE)}>",
    "face_tracks": f"video_id string, sample_fps double, shots array<{as_struct(TRACKED_SHOT)}>",
    "face_identities": "identities array<struct<identity:string, tracks:array<string>, n_tracks:int>>, track_to_identity map<string, string>, nearest_other_cluster map<string, struct<track:string, identity:string, similarity:double>>, excluded_tracks array<string>, _manually_corrected boolean",
    "corrections": "merge array<struct<track:string, target_identity:string>>, exclude array<string>",
    "speaker_attribution": f"video_id string, attribution array<{as_struct(ATTRIBUTED.format(CORRELATED))}>",
    "speaker_attribution_model": f"video_id string, attribution array<{as_struct(ATTRIBUTED.format(SCORED))}>",
    "speaker_attribution_final": f"video_id string, attribution array<{as_struct(FINAL)}>",
}
