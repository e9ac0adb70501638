"""Row-wise column functions; all of them stay in generated JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Cols = Column | str


def _c(x: Cols | float) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


# rounding and time


def pyround(x: Cols, n: int = 0) -> Column:
    """Round a double as Python does: the exact binary value, halves to even.

    The sign of x * 2S - (2k + 1), for S = 10^n and k = floor(x * S), is found without error by splitting x
    into two halves of 26 bits.
    """
    x = _c(x).cast("double")
    s = float(10**n)
    k = F.floor(x * s).cast("double")
    c = x * 134217729.0
    hi = c - (c - x)
    d = (hi * (2 * s) - (2 * k + 1)) + (x - hi) * (2 * s)
    up = (d > 0) | ((d == 0) & (F.pmod(k, F.lit(2.0)) == 1))
    return F.when(up, k + 1).otherwise(k) / s


def scaled_round(x: Cols, n: int) -> Column:
    """Scale, round halves to even, unscale; not the same as pyround()."""
    return F.rint(_c(x) * float(10**n)) / float(10**n)


def sample_step(fps: Cols, target: float) -> Column:
    return F.greatest(F.lit(1), pyround(_c(fps) / target).cast("int"))


def frame_time(frame: Cols, fps: Cols | float) -> Column:
    return _c(frame) / _c(fps)


def frame_at(t: Cols, fps: Cols | float) -> Column:
    return pyround(_c(t) * _c(fps)).cast("long")


def sample_at(t: Cols, rate: Cols | int) -> Column:
    return (_c(t) * _c(rate)).cast("long")


def midpoint(start: Cols, end: Cols) -> Column:
    return (_c(start) + _c(end)) / 2


def extended_end(end: Cols, fps: Cols | float) -> Column:
    return _c(end) + 1 / _c(fps)


# boxes: arrays [x, y, w, h] unless said otherwise


def fraction_to_pixels(box: Cols, width: Cols | int, height: Cols | int) -> Column:
    """[x0, y0, x1, y1] as fractions, cut down to whole pixels."""
    b, w, h = _c(box), _c(width), _c(height)
    return F.array(*[(F.get(b, F.lit(i)) * (w if i % 2 == 0 else h)).cast("int") for i in range(4)])


def box_iou(a: Cols, b: Cols) -> Column:
    a, b = _c(a), _c(b)
    at = lambda v, i: F.get(v, F.lit(i))
    wide = F.greatest(F.lit(0), F.least(at(a, 0) + at(a, 2), at(b, 0) + at(b, 2)) - F.greatest(at(a, 0), at(b, 0)))
    high = F.greatest(F.lit(0), F.least(at(a, 1) + at(a, 3), at(b, 1) + at(b, 3)) - F.greatest(at(a, 1), at(b, 1)))
    union = at(a, 2) * at(a, 3) + at(b, 2) * at(b, 3) - wide * high
    return F.when(union > 0, wide * high / union).otherwise(0.0)


def padded_box(box: Cols, width: Cols | int, height: Cols | int, pad: float = 0.2) -> Column:
    """[x0, y0, x1, y1] of a box widened by a share of its longer side, within the frame."""
    x, y, w, h = (F.get(_c(box), F.lit(i)) for i in range(4))
    p = (F.greatest(w, h) * pad).cast("int")
    zero = F.lit(0)
    return F.array(F.greatest(zero, x - p), F.greatest(zero, y - p), F.least(_c(width), x + w + p), F.least(_c(height), y + h + p))


def corners(box: Cols) -> Column:
    x, y, w, h = (F.get(_c(box), F.lit(i)) for i in range(4))
    return F.array(x, y, x + w, y + h)


def centre_and_size(box: Cols) -> Column:
    """(x, y, s) of corners [x0, y0, x1, y1]; s is half the longer side."""
    x0, y0, x1, y1 = (F.get(_c(box), F.lit(i)) for i in range(4))
    return F.struct(((x0 + x1) / 2).alias("x"), ((y0 + y1) / 2).alias("y"), (F.greatest(y1 - y0, x1 - x0) / 2).alias("s"))


def mouth_box(left: Cols, right: Cols, width: Cols | int, height: Cols | int, expand: float = 0.9) -> Column:
    """[x0, y0, x1, y1] about the two mouth corners [x, y], within the frame; null if nothing is left."""
    lx, ly, rx, ry = F.get(_c(left), F.lit(0)), F.get(_c(left), F.lit(1)), F.get(_c(right), F.lit(0)), F.get(_c(right), F.lit(1))
    half = F.greatest(F.lit(8.0), F.abs(rx - lx) * (1 + expand) / 2)
    cx, cy = (lx + rx) / 2, (ly + ry) / 2
    x0, x1 = F.greatest(F.lit(0), (cx - half).cast("int")), F.least(_c(width), (cx + half).cast("int"))
    y0, y1 = F.greatest(F.lit(0), (cy - 0.7 * half).cast("int")), F.least(_c(height), (cy + 0.7 * half).cast("int"))
    return F.when((x1 > x0) & (y1 > y0), F.array(x0, y0, x1, y1))


def int_box(box: Cols) -> Column:
    return F.transform(_c(box), lambda v: v.cast("int"))


def int_keypoints(points: Cols) -> Column:
    return F.transform_values(_c(points), lambda _, v: F.transform(v, lambda x: x.cast("int")))


# masks, pixels and vectors


def white_mask(grey: Cols, threshold: int = 190) -> Column:
    return F.transform(_c(grey), lambda g: (g > threshold).cast("int"))


def array_sum(v: Cols) -> Column:
    return F.aggregate(_c(v), F.lit(0.0), lambda a, x: a + x)


def density(mask: Cols) -> Column:
    return F.try_divide(array_sum(mask), F.size(_c(mask)))


def mask_iou(a: Cols, b: Cols) -> Column:
    """Of 0/1 arrays; two empty masks are the same."""
    both = array_sum(F.zip_with(_c(a), _c(b), lambda x, y: F.when((x > 0) & (y > 0), 1.0).otherwise(0.0)))
    any_ = array_sum(F.zip_with(_c(a), _c(b), lambda x, y: F.when((x > 0) | (y > 0), 1.0).otherwise(0.0)))
    return F.when(any_ == 0, 1.0).otherwise(both / any_)


def packed_mask_iou(a: Cols, b: Cols) -> Column:
    """Of masks packed into longs."""
    count = lambda op: F.aggregate(F.zip_with(_c(a), _c(b), op), F.lit(0), lambda n, x: n + F.bit_count(x))
    both, any_ = count(lambda x, y: x.bitwiseAND(y)), count(lambda x, y: x.bitwiseOR(y))
    return F.when(any_ == 0, 1.0).otherwise(both / any_)


def mean_abs_difference(a: Cols, b: Cols) -> Column:
    return F.try_divide(array_sum(F.zip_with(_c(a), _c(b), lambda x, y: F.abs(x - y).cast("double"))), F.size(_c(a)))


def doubles(v: Cols) -> Column:
    return F.transform(_c(v), lambda x: x.cast("double"))


def dot(a: Cols, b: Cols) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Cols) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Cols, b: Cols, epsilon: float = 1e-8) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + epsilon)


def unit(a: Cols) -> Column:
    return F.transform(_c(a), lambda x: F.try_divide(x.cast("double"), norm(a)))


def distance(similarity: Cols) -> Column:
    return F.greatest(F.lit(0.0), 1 - _c(similarity))


# text


def track_key(shot: Cols, track: Cols) -> Column:
    return F.concat(F.lit("shot"), _c(shot).cast("string"), F.lit("_track"), _c(track).cast("string"))


def parse_track_key(key: Cols) -> Column:
    part = lambda i: F.regexp_extract(_c(key), r"^shot(\d+)_track(\d+)$", i).try_cast("int")
    return F.struct(part(1).alias("shot_id"), part(2).alias("track_id"))


def line_text(words: Cols) -> Column:
    """Words that aren't blank, joined by spaces and trimmed."""
    return F.trim(F.array_join(F.filter(_c(words), lambda w: F.length(F.trim(w)) > 0), " "))


def line_confidence(confidences: Cols) -> Column:
    """Mean of the confidences cut to whole numbers, those below zero left out; 0.0 without any."""
    kept = F.filter(F.transform(_c(confidences), lambda c: c.try_cast("double").cast("int")), lambda c: c >= 0)
    return F.coalesce(F.try_divide(F.aggregate(kept, F.lit(0), lambda a, c: a + c), F.size(kept)), F.lit(0.0))


def is_low_confidence(status: Cols) -> Column:
    return F.coalesce(F.endswith(_c(status), F.lit("low_conf")), F.lit(False))


def shortened(text: Cols, n: int) -> Column:
    return F.substring(_c(text), 1, n)


def or_default(x: Cols, default: str) -> Column:
    """default in place of null and of empty text."""
    return F.coalesce(F.nullif(_c(x), F.lit("")), F.lit(default))


def time_label(seconds: Cols) -> Column:
    """mm:ss, or h:mm:ss from an hour on; what is no time is 00:00."""
    x = _c(seconds).cast("double")
    s = F.when(x.isNull() | F.isnan(x) | (x < 0) | (x == float("inf")), F.lit(0)).otherwise(F.floor(x)).cast("long")
    two = lambda v: F.lpad(v.cast("string"), 2, "0")
    h, m, sec = F.floor(s / 3600).cast("long"), F.floor(F.pmod(s, F.lit(3600)) / 60).cast("long"), F.pmod(s, F.lit(60))
    return F.when(h > 0, F.concat_ws(":", h.cast("string"), two(m), two(sec))).otherwise(F.concat_ws(":", two(m), two(sec)))


#: Seconds between ticks of a time axis.
AXIS_STEPS = (5, 10, 15, 30, 60, 120, 300, 600, 900)


def axis_step(total: Cols) -> Column:
    """The first step that gives at most twelve ticks, else half an hour."""
    t = _c(total)
    return reduce(lambda rest, step: F.when(t / step <= 12, step).otherwise(rest), reversed(AXIS_STEPS), F.lit(1800))


def axis_ticks(total: Cols) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor(_c(total) / axis_step(total)).cast("int")), lambda i: i * axis_step(total))


def lane_left(start: Cols, total: Cols) -> Column:
    return _c(start) / _c(total) * 100


def lane_width(start: Cols, end: Cols, total: Cols) -> Column:
    return F.greatest((_c(end) - _c(start)) / _c(total) * 100, F.lit(0.15))


def playhead(t: Cols, total: Cols) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), _c(t) / _c(total)))


def colour(index: Cols, palette: list[str], uncertain: Column | None = None, grey: str = "#888888") -> Column:
    own = F.element_at(F.array(*map(F.lit, palette)), F.pmod(_c(index), F.lit(len(palette))).cast("int") + 1)
    return own if uncertain is None else F.when(uncertain, grey).otherwise(own)


def escape_html(x: Cols) -> Column:
    out = F.coalesce(_c(x), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def override(winner: Cols, **fields: Column) -> Column:
    """A struct with some of its fields replaced."""
    return reduce(lambda c, kv: c.withField(*kv), fields.items(), _c(winner))
