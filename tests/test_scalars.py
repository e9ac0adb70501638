"""Column functions on hand-written rows, against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtable.functions import scalars as S
from voxtable.functions.python_udfs import glyph_components, glyphs_udf, text_similarity


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_pyround(spark, n):
    rng = random.Random(n)
    xs = [0.735, 58.125, 37.705, 65.865, -0.5, -1.5, 2.5, 0.0, -0.125, 1e6 + 0.5, 3.0] + [rng.randint(-10**6, 10**6) / 2 / 10**n for _ in range(2000)] + [rng.uniform(-100, 100) for _ in range(500)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", S.pyround("x", n).alias("r")).collect()
    assert all(r.r == round(r.x, n) for r in rows)
    assert one(spark, r=S.pyround(F.lit(None).cast("double"), 2)).r is None


def test_rounding_kinds_differ(spark):
    assert one(spark, r=S.scaled_round(F.lit(0.0015), 3)).r == np.round(0.0015, 3)


def test_time(spark):
    r = one(spark, a=S.frame_at(F.lit(0.1), 25), b=S.sample_at(F.lit(0.9999), 16000), c=S.sample_step(F.lit(29.97), 8.0), d=S.midpoint(F.lit(1.0), F.lit(2.0)), e=S.frame_time(F.lit(50), F.lit(25)), f=S.extended_end(F.lit(1.0), F.lit(4.0)))
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == (2, 15998, 4, 1.5, 2.0, 1.25)


def box(*v):
    return F.array(*map(F.lit, v))


def test_boxes(spark):
    r = one(
        spark, same=S.box_iou(box(0, 0, 2, 2), box(0, 0, 2, 2)), half=S.box_iou(box(0, 0, 2, 2), box(1, 0, 2, 2)), none=S.box_iou(box(0, 0, 1, 1), box(5, 5, 1, 1)), empty=S.box_iou(box(0, 0, 0, 0), box(0, 0, 0, 0)),
        px=S.fraction_to_pixels(box(0.0, 282 / 360, 1.0, 307 / 360), 640, 360), pad=S.padded_box(box(1, 2, 10, 20), 100, 15), size=S.centre_and_size(S.corners(box(0, 0, 4, 10))), mouth=S.mouth_box(box(10, 10), box(20, 12), 100, 100), gone=S.mouth_box(box(-90, 0), box(-80, 0), 10, 10),
    )
    assert (r.same, r.none, r.empty) == (1.0, 0.0, 0.0) and abs(r.half - 1 / 3) < 1e-12
    assert r.px == [0, 282, 640, 307] and r.pad == [0, 0, 15, 15] and (r["size"].x, r["size"].y, r["size"].s) == (2.0, 5.0, 5.0)
    assert r.mouth == [5, 4, 24, 17] and r.gone is None
    r = one(spark, b=S.int_box(box(1.9, 2.1)), k=S.int_keypoints(F.create_map(F.lit("nose"), box(1.7, 2.2))))
    assert r.b == [1, 2] and r.k == {"nose": [1, 2]}


def test_masks_and_vectors(spark):
    a, b, z = box(1, 1, 0, 0), box(1, 0, 1, 0), box(0, 0, 0, 0)
    r = one(spark, w=S.white_mask(box(190, 191, 0)), d=S.density(a), i=S.mask_iou(a, b), e=S.mask_iou(z, z), p=S.packed_mask_iou(box(0b1100), box(0b1010)), m=S.mean_abs_difference(box(1, 5), box(3, 4)), c=S.cosine(box(1.0, 0.0), box(1.0, 1.0)), u=S.unit(box(3.0, 4.0)), t=S.distance(F.lit(1.5)))
    assert r.w == [0, 1, 0] and r.d == 0.5 and abs(r.i - 1 / 3) < 1e-12 and r.e == 1.0 and abs(r.p - 1 / 3) < 1e-12 and r.m == 1.5
    assert abs(r.c - 2**-0.5) < 1e-6 and r.u == [0.6, 0.8] and r.t == 0.0


def test_text(spark):
    words = F.array(F.lit(" a"), F.lit("  "), F.lit(""), F.lit("b "))
    r = one(
        spark, k=S.track_key(F.lit(3), F.lit(12)), p=S.parse_track_key(F.lit("shot3_track12")), bad=S.parse_track_key(F.lit("x")), line=S.line_text(words), conf=S.line_confidence(box("96.9", "-1", "95", "-0.4")), no=S.line_confidence(F.array().cast("array<string>")),
        low=S.is_low_confidence(F.lit("assigned_single_candidate_low_conf")), null=S.is_low_confidence(F.lit(None).cast("string")), short=S.shortened(F.lit("abcdef"), 3), d1=S.or_default(F.lit(""), "x"), d2=S.or_default(F.lit(None).cast("string"), "x"), d3=S.or_default(F.lit("y"), "x"),
        html=S.escape_html(F.lit("<a href='x'>&\"")), over=S.override(F.struct(F.lit(1).alias("a"), F.lit(2).alias("b")), b=F.lit(9)),
    )
    assert r.k == "shot3_track12" and tuple(r.p) == (3, 12) and tuple(r.bad) == (None, None)
    assert r.line == "a b" and r.conf == (96 + 95 + 0) / 3 and r.no == 0.0
    assert r.low and not r.null and r.short == "abc" and (r.d1, r.d2, r.d3) == ("x", "x", "y")
    assert r.html == "&lt;a href=&#39;x&#39;&gt;&amp;&quot;" and tuple(r.over) == (1, 9)


def test_axis(spark):
    r = one(
        spark, a=S.time_label(F.lit(61.9)), b=S.time_label(F.lit(3725)), c=S.time_label(F.lit(-1)), d=S.time_label(F.lit(float("nan"))), e=S.axis_step(F.lit(60.0)), f=S.axis_step(F.lit(60.1)), g=S.axis_step(F.lit(1e6)), t=S.axis_ticks(F.lit(23.0)),
        l=S.lane_left(F.lit(5.0), F.lit(50.0)), w=S.lane_width(F.lit(1.0), F.lit(1.0), F.lit(50.0)), p=S.playhead(F.lit(99.0), F.lit(50.0)), c1=S.colour(F.lit(17), [str(i) for i in range(16)]), c2=S.colour(F.lit(1), ["a"], F.lit(True)),
    )
    assert (r.a, r.b, r.c, r.d) == ("01:01", "1:02:05", "00:00", "00:00") and (r.e, r.f, r.g) == (5, 10, 1800) and r.t == [0, 5, 10, 15, 20]
    assert (r.l, r.w, r.p, r.c1, r.c2) == (10.0, 0.15, 1.0, "1", "#888888")


def test_glyphs(spark):
    picture = np.zeros((30, 20), int)
    picture[2:8, 2] = 1  # of glyph size
    picture[10, 5:8] = 1  # too low
    picture[12:16, 10], picture[16, 11] = 1, 1  # joined at a corner
    assert glyph_components(picture) == (2, 3)
    assert glyph_components(np.zeros((3, 3))) == (0, 0)
    rows = spark.createDataFrame([(picture.ravel().tolist(),)], "mask array<int>").select(glyphs_udf(20)(F.col("mask")).alias("g")).first()
    assert tuple(rows.g) == (2, 3)
    import difflib

    assert one(spark, s=text_similarity(F.lit("abcd"), F.lit("bcde"))).s == difflib.SequenceMatcher(None, "abcd", "bcde").ratio()
