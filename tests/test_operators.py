"""Operators on hand-written rows: ties, nulls, empty input, touching ends."""

import random
import tracemalloc
from collections import Counter
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from voxtable.config import Config
from voxtable.functions.python_udfs import byte_edits
from voxtable.operators import aggregates, attribution, cluster, corrections, filters, intervals, review, sequence, signals
from voxtable.plans import attribution as plans


def rows(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=repr)


def test_overlaps_touch_and_agree(spark):
    rng = random.Random(1)
    a = [(i % 3, i, s, s + rng.choice([0, 0.5, 9])) for i in range(60) if (s := rng.randint(0, 60) / 2) or True]
    b = [(i % 3, 100 + i, s, s + rng.choice([0, 1, 20])) for i in range(60) if (s := rng.randint(0, 60) / 2) or True]
    left, right = spark.createDataFrame(a, "k int, i int, start double, end double"), spark.createDataFrame(b, "k int, j int, lo double, hi double")
    plain = sorted((i, j) for k, i, s, e in a for q, j, lo, hi in b if k == q and lo <= e and hi >= s)
    assert rows(intervals.overlap_join(left, right, ["k"]), "i", "j") == sorted(plain, key=repr)
    assert rows(intervals.bucketed_overlap_join(left, right, ["k"], 3.0), "i", "j") == sorted(plain, key=repr)
    points = right.select("k", "j", F.col("lo").alias("frame"))
    within = sorted(((i, j) for k, i, s, e in a for q, j, lo, _ in b if k == q and s <= lo <= e), key=repr)
    assert rows(intervals.points_in(points, left, ["k"], "frame", ("start", "end")), "i", "j") == within
    assert rows(intervals.points_in(points, left, ["k"], "frame", ("start", "end"), 4), "i", "j") == within
    assert intervals.stab(left, 10.0).count() == sum(s <= 10 <= e for _, _, s, e in a)


def test_audio_slices_are_half_open(spark):
    samples = list(range(23))
    chunks = spark.createDataFrame([("v", i, [float(x) for x in samples[i * 5 : i * 5 + 5]]) for i in range(5)], "video_id string, chunk_idx long, samples array<float>")
    spans = spark.createDataFrame([("v", 1, 0.0, 1.0), ("v", 2, 0.49, 1.51), ("v", 3, 2.0, 9.0), ("v", 4, 1.0, 1.0)], "video_id string, segment_id int, start double, end double")
    found = {r.segment_id: [int(x) for x in r.samples] for r in intervals.samples_of(spans, chunks, ["video_id"], 10, 5).collect()}
    assert found == {i: samples[int(s * 10) : int(e * 10)] for i, s, e in ((1, 0.0, 1.0), (2, 0.49, 1.51), (3, 2.0, 9.0))}


def test_anchor_is_not_the_neighbour(spark):
    values = [(0, 0.0), (1, 4.0), (2, 8.0), (3, 11.0), (4, None), (5, 11.0), (6, 12.0)]
    df = spark.createDataFrame([("v", t, x, x is not None) for t, x in values], "video_id string, t int, x double, on boolean")
    out = sequence.anchored_sessions(df, ["video_id"], ["t"], lambda a, b: abs(a - b) <= 9, "x", "on")
    assert [r.session for r in out.orderBy("t").collect()] == [0, 0, 0, 1, None, 2, 2]
    alike = sequence.masks_alike()
    assert alike([0, 0], [0, 0]) and not alike([1, 1, 0, 0], [0, 1, 1, 1]) and alike([1, 1, 1], [1, 1, 0])


def test_caption_segments(spark):
    mask = {"a": [1, 1, 1, 0], "b": [0, 0, 1, 1], "-": [0, 0, 0, 0]}
    frames = [(i / 10, mask[c], c != "-") for i, c in enumerate("aaaa-bbbbbaaaaa-a")]
    df = spark.createDataFrame([("v", t, sum(m) / 4, m, p) for t, m, p in frames], "video_id string, t double, density double, mask array<int>, present boolean")
    out = plans.caption_segments(df, 10.0).orderBy("segment_id").collect()
    assert [(r.segment_id, r.start_sec, r.end_sec, r.n_samples) for r in out] == [(0, 0.0, 0.4, 4), (1, 0.5, 1.0, 5), (2, 1.0, 1.5, 5)]
    glyphs = filters.caption_present(df, lambda m: F.struct(F.size(m).alias("n_like"), F.size(m).alias("n_total")).alias("x"), least=0.6, glyphs=4)
    assert [r.n_text_like for r in glyphs.orderBy("t").collect()] == [4 if sum(m) / 4 >= 0.6 else 0 for _, m, _ in frames]


def test_shots_keep_their_least_length(spark):
    scores = [None, 30, 1, 1, 1, 1, 1, 1, 40, 1, 99, 27.0, 1, 1, 1, 1, 50]
    df = spark.createDataFrame([("v", i, None if s is None else float(s)) for i, s in enumerate(scores)], "v string, frame long, score double")
    out = sequence.shot_cuts(df, ["v"], "frame", "score").orderBy("frame").collect()
    assert [r.shot_id for r in out] == [0] * 8 + [1] * 8 + [2]


def test_merging_compares_with_what_was_merged(spark):
    text = ["aaaaaaaaaa", "aaaaaaabbb", "aaaabbbbbb", "zzzz"]
    df = spark.createDataFrame([("v", i, i * 1.0, i + 0.9, i + 0.45, t, c) for i, (t, c) in enumerate(zip(text, [50.0, None, 50.0, 1.0], strict=True))], "video_id string, segment_id int, start_sec double, end_sec double, mid_sec double, text_pt string, confidence double")
    out = sequence.merge_near_duplicates(df, ["video_id"]).orderBy("start_sec").collect()
    assert [(r.segment_id, r.start_sec, r.end_sec, r.mid_sec) for r in out] == [(0, 0.0, 1.9, 0.95), (2, 2.0, 2.9, 2.45), (3, 3.0, 3.9, 3.45)]
    equal = df.withColumn("confidence", F.lit(7.0)).where("segment_id < 2")
    assert sequence.merge_near_duplicates(equal, ["video_id"]).first().segment_id == 1
    assert sequence.merge_near_duplicates(df.limit(0), ["video_id"]).count() == 0


def test_tracker(spark):
    def frame(t, *boxes):
        return [("v", 0, float(t), i, list(b)) for i, b in enumerate(boxes)]

    a, b = (0, 0, 10, 10), (100, 0, 10, 10)
    data = frame(0, a, b) + frame(1, a) + frame(2, a) + frame(3, b, a) + frame(4, b) + frame(5, b) + frame(6, b) + frame(7, b)
    df = spark.createDataFrame(data, "video_id string, shot_id int, t double, det_pos int, box array<int>")
    out = sequence.link_tracks(df, ["video_id", "shot_id"])
    found = Counter((r.track_id, r.track_pos) for r in out.collect())
    assert found == {(0, 0): 4, (1, 1): 6}  # two misses survive; the finished track comes first
    gone = frame(0, a) + frame(1, a) + frame(2, a) + frame(3) + frame(4, b) + frame(5, b) + frame(6, b) + frame(7, a)
    out = sequence.link_tracks(spark.createDataFrame(gone, df.schema), ["video_id", "shot_id"])
    assert Counter((r.track_id, r.track_pos) for r in out.collect()) == {(0, 0): 3, (1, 1): 3}
    tracker = sequence.Tracker()
    tracker.step([("x", [0, 0, 10, 10]), ("y", [1, 0, 10, 10])])
    tracker.step([("z", [0, 0, 10, 10])])
    assert [t["rows"] for t in tracker.tracks()] == [["x", "z"], ["y"]]


def test_grids_and_strides(spark):
    spans = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 0.0), (3, 0.0, 0.41)], "i int, start double, end double")
    out = sequence.sampling_grid(spans, 0.2).groupBy("i").count()
    assert rows(out) == [(1, 5), (3, 3)]
    df = spark.createDataFrame([(1, i, None if i == 3 else i * i * 1.0) for i in range(20)], "k int, t int, v double")
    assert [r.t for r in sequence.stride_sample(df, ["k"], ["t"]).orderBy("t").collect()] == list(range(20))[::2][:8]
    moved = [r.motion for r in sequence.lag_difference(df, ["k"], ["t"], "v").orderBy("t").collect()]
    assert moved[0] is None and moved[3] is None and moved[4] is None and moved[5] == 9.0
    assert sequence.until_unreadable(df, ["k"], "t", F.col("v").isNotNull()).count() == 3
    r = sequence.ends_and_middle(df, ["k"], "t", "t").first()
    assert (r.first, r.middle, r.last, r.n) == (0, 10, 19, 20)


def test_interpolation(spark):
    df = spark.createDataFrame([(1, 0.1, 1.0), (1, 0.5, 5.0), (1, 0.6, None), (1, 1.0, 0.0), (2, 0.3, 1.0)], "k int, t double, v double")
    out = signals.interpolate_to_grid(df, ["k"], "t", "v", 0.25).orderBy("hop_idx").collect()
    grid = [i for i in range(5) if 0.1 <= i * 0.25 <= 1.0]
    assert [r.hop_idx for r in out] == grid
    assert np.allclose([r.v for r in out], np.interp([i * 0.25 for i in grid], [0.1, 0.5, 1.0], [1.0, 5.0, 0.0]))
    rng = random.Random(3)
    ts = sorted(rng.uniform(0, 3) for _ in range(12))
    vs = [rng.uniform(0, 9) for _ in ts]
    dense = signals.dense_frames(spark.createDataFrame([(1, t, v) for t, v in zip(ts, vs, strict=True)], "k int, t double, v double"), ["k"], "t", ["v"]).orderBy("frame").collect()
    frames = list(range(round(ts[0] * 25), round(ts[-1] * 25) + 1))
    assert [r.frame for r in dense] == frames and np.allclose([r.v for r in dense], np.interp(np.array(frames) / 25, ts, vs))


@pytest.mark.parametrize("n", [12, 13, 30])
def test_median_filter(spark, n):
    rng = random.Random(n)
    v = [rng.uniform(-5, 5) for _ in range(n)]
    out = signals.median_filter(spark.createDataFrame([(1, i, x) for i, x in enumerate(v)], "k int, i int, v double"), ["k"], ["i"], "v").orderBy("i").collect()
    padded = [0.0] * 6 + v + [0.0] * 6
    assert [r.smooth for r in out] == (v if n < 13 else [sorted(padded[i : i + 13])[6] for i in range(n)])


def test_rms(spark):
    rng = random.Random(8)
    x = [rng.uniform(-1, 1) for _ in range(50)]
    out = signals.rms_hops(spark.createDataFrame([(1, i, v) for i, v in enumerate(x)], "k int, i long, x double"), ["k"], "i", "x", 4, 8).orderBy("hop_idx").collect()
    padded = np.array([0.0] * 4 + x + [0.0] * 8)
    assert np.allclose([r.rms for r in out], [np.sqrt((padded[i : i + 8] ** 2).mean()) for i in range(0, 50, 4)])


def test_correlation(spark):
    data = [(1, 1.0, 2.0), (1, 2.0, None), (1, None, 9.0), (1, 3.0, 1.0), (1, 4.0, 5.0), (2, 1.0, 1.0), (2, 2.0, 2.0), (3, 1.0, 1.0), (3, 1.0, 2.0), (3, 1.0, 3.0)]
    out = {r.k: (r.r, r.n) for r in spark.createDataFrame(data, "k int, a double, b double").groupBy("k").agg(signals.pearson("a", "b").alias("r"), signals.joint_count("a", "b").alias("n")).collect()}
    assert abs(out[1][0] - np.corrcoef([1, 3, 4], [2, 1, 5])[0, 1]) < 1e-12 and out[1][1] == 3
    assert out[2] == (None, 2) and out[3] == (0.0, 3)


def test_chunk_ensemble(spark):
    v = [float(i * i % 17) for i in range(40)]
    out = signals.chunk_scores(spark.createDataFrame([(1, i, x) for i, x in enumerate(v)], "k int, f long, v double"), ["k"], "f", F.avg("v"), (1, 1, 2, 3), 5).orderBy("f").collect()
    mean = lambda i, d: np.mean(v[i // (d * 5) * d * 5 :][: d * 5])
    assert np.allclose([r.score for r in out], [np.mean([mean(i, d) for d in (1, 1, 2, 3)]) for i in range(40)])


def decide(spark, f, *cases):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, n long, a double, b double")
    return [r.s for r in df.select("i", f(F.col("n"), F.col("a"), F.col("b")).alias("s")).orderBy("i").collect()]


def test_decisions_at_their_thresholds(spark):
    assert decide(spark, attribution.decide_heuristic, (None, None, None), (0, None, None), (1, -0.35, None), (1, -0.3499, None), (1, 0.15, None), (1, 0.1499, None), (2, 0.3, 0.2), (2, -0.5, -0.7), (2, 0.2, 0.15)) == [
        "uncertain_no_confident_face", "uncertain_no_confident_face", "uncertain_anticorrelated_mouth", "assigned_single_candidate_low_conf", "assigned_single_candidate", "assigned_single_candidate_low_conf",
        "uncertain_ambiguous_multi_candidate", "assigned_multi_candidate", "uncertain_ambiguous_multi_candidate",
    ]
    assert 0.3 - 0.2 < 0.1
    assert decide(spark, attribution.decide_model, (None, None, None), (1, 0.0, None), (1, -0.001, None), (2, 0.5, 0.3001), (2, 0.5, 0.2), (2, -0.1, -0.9)) == [
        "uncertain_no_confident_face", "assigned", "assigned_low_confidence", "uncertain_ambiguous_multi_candidate", "assigned", "assigned_low_confidence",
    ]


def test_enrollment_pick(spark):
    single, low, ok, unsure = "assigned_single_candidate", "assigned_single_candidate_low_conf", "assigned", "assigned_low_confidence"
    cases = [("a", single, "a", ok, "a"), ("a", low, "a", unsure, None), ("a", low, "a", ok, "a"), ("a", single, "b", ok, "b"), ("a", single, "b", unsure, "a"), (None, None, None, None, None), (None, None, "b", ok, "b"), ("a", single, None, None, "a"), (None, "uncertain_no_confident_face", None, "uncertain_no_confident_face", None), ("a", low, "b", unsure, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, hs string, ht string, ms string, mt string, want string")
    c = Config()
    out = df.select("want", attribution.enrollment_pick(F.col("hs"), F.col("ht"), F.col("ms"), F.col("mt"), c.confident_heuristic, c.confident_model).alias("got")).collect()
    assert all(r.want == r.got for r in out)


def test_final_decision(spark):
    v = lambda **k: sorted(k.items(), key=lambda x: -x[1])
    cases = [
        ("a", "assigned", v(a=0.5, b=0.59), "b", "confident_voice_override"), ("a", "assigned", v(a=0.5, b=0.58), "a", "confident_talknet"), ("a", "assigned", v(b=0.9), "a", "confident_talknet_no_voice_check"),
        ("a", "assigned", None, "a", "confident_talknet_no_voice_check"), ("a", "assigned_low_confidence", v(b=0.6), "b", "confident_voice_only"), (None, "uncertain_no_confident_face", v(b=0.59), None, "not_confident"), (None, None, None, None, "not_confident"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, s string, t string, v array<struct<identity:string, similarity:double>>, who string, status string")
    for r in df.select("who", "status", attribution.decide_final(F.col("s"), F.col("t"), F.col("v")).alias("d")).collect():
        assert (r.d.final_speaker, r.d.final_status) == (r.who, r.status)


def test_weighted_identity_rounds_twice(spark):
    data = [(1, "p", 0, 1, 0, 10, 0.123), (1, "p", 0, 2, 1, 10, 0.124), (1, "p", 0, 3, 2, 1, 0.9), (1, "q", 1, 0, 3, 4, -1.0)]
    df = spark.createDataFrame(data, "s int, identity string, shot_id int, track_id int, pos int, n long, m double")
    out = {r.identity: r for r in attribution.weighted_identity(df, ["s"], "m", "n", "pos").collect()}
    assert out["p"].m == round((1.23 + 1.24 + 0.9) / 21, 3) and out["p"].track_id == 1 and out["p"].n == 21 and out["q"].m == -1.0
    best = attribution.best_fragment(df.withColumn("m", F.lit(0.5)), ["s"], "m", "pos").orderBy("identity").collect()
    assert [r.pos for r in best] == [0, 3]
    ranked = attribution.ranked_candidates(df, ["s"], "m", "pos", ["identity", "m"]).first().candidates
    assert [c.m for c in ranked] == [0.9, 0.124, 0.123, -1.0]


def test_compare(spark):
    a = filters.last_wins(spark.createDataFrame([(0.0, 1.0, "x", 0), (0.0, 1.0, "y", 1), (1.0, 2.0, None, 2), (2.0, 3.0, None, 3), (9.0, 9.5, "z", 4)], "start double, end double, who string, pos int"), ["start", "end"], "pos")
    b = spark.createDataFrame([(0.0, 1.0, "y"), (1.0, 2.0, None), (2.0, 3.0, "q"), (5.0, 6.0, "z")], "start double, end double, who string")
    found = attribution.compare(a, b, ["start", "end"], "who")
    assert sorted(r.outcome for r in found.collect()) == ["agree", "both_none", "one_abstained"]
    assert rows(attribution.only_on_one_side(a, b, ["start", "end"])) == [(5.0, 6.0, "b"), (9.0, 9.5, "a")]
    assert attribution.agreement(found.limit(0)).first().n_compared == 0
    assert aggregates.confident_percent(found.limit(0), "outcome", ("agree",)).first().percent is None


def test_pairs_by_blocks(spark):
    rng = np.random.default_rng(6)
    v = [[float(x) for x in rng.normal(size=3).astype(np.float32)] for _ in range(23)]
    v[3], v[7], v[9] = None, [1.0, None, 2.0], [1.0, 2.0]
    data = [("g", i, x) for i, x in enumerate(v)] + [("h", 1, v[0]), ("h", 1, v[1]), ("h", 2, v[2]), (None, 1, v[0]), (None, 2, v[0])]
    df = spark.createDataFrame(data, "k string, i long, v array<double>")
    product = lambda x, y: reduce(lambda s, pq: s + pq[0] * pq[1], zip(x, y, strict=True), 0.0) if x and y and len(x) == len(y) and None not in x + y else None
    plain = {(g, i, j): product(x, y) for g, i, x in data for h, j, y in data if g == h == "g" and i != j}
    for block in (1, 4, 100):
        found = cluster.pairwise(df.where("k = 'g'"), ["k"], "i", "v", True, block=block)
        assert {(r.k, r.a, r.b): r.similarity for r in found.collect()} == plain and found.count() == len(plain)
        half = cluster.pairwise(df, ["k"], "i", "v", block=block)
        assert {(r.k, r.a, r.b): r.similarity for r in half.where("k = 'g'").collect()} == {k: x for k, x in plain.items() if k[1] < k[2]}
        assert rows(half.where("k != 'g' or k is null"), "k", "a", "b") == [("h", 1, 2), ("h", 1, 2)]
    near = cluster.pairwise(df.where("i < 9"), ["k"], "i", "v", places=2).where("similarity is not null").first()
    assert near.similarity == round(plain[near.k, near.a, near.b], 2) and near.distance == round(max(0, 1 - plain[near.k, near.a, near.b]), 2)
    # no row is made for a pair before its product is known
    assert "Join" not in half._jdf.queryExecution().executedPlan().toString()


def plain_average_linkage(s, cut):
    groups = [[i] for i in range(len(s))]
    while len(groups) > 1:
        d, i, j = min((np.mean([max(0, 1 - s[x][y]) for x in groups[i] for y in groups[j]]), i, j) for i in range(len(groups)) for j in range(i))
        if d > cut:
            break
        groups[j] += groups.pop(i)
    return sorted(map(sorted, groups))


def test_average_linkage():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 12, 25):
        for cut in (0.3, 0.6, 0.9):
            v = rng.normal(size=(n, 4)) + rng.integers(0, 3, (n, 1))
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            label = cluster.average_linkage(v @ v.T, cut)
            assert sorted(sorted(np.flatnonzero(label == k).tolist()) for k in set(label)) == plain_average_linkage(v @ v.T, cut)
    chain = np.array([[1, 0.6, 0.1], [0.6, 1, 0.6], [0.1, 0.6, 1]])
    assert len(set(cluster.average_linkage(chain, 0.5))) == 2  # single linkage would make one


def test_folds_hold_whole_groups(spark):
    """Parts of a union that lie by the keys are dealt again, whatever partitions adaptive execution has joined."""
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst", "spark.sql.autoBroadcastJoinThreshold")}
    for k, x in zip(old, ("24", "20k", "false", "-1"), strict=True):
        spark.conf.set(k, x)
    try:
        one = spark.range(3000).select((F.col("id") % 300).alias("k"), F.lit(1).alias("x")).groupBy("k").agg(F.min("x").alias("x"))
        many = spark.range(30_000).select((F.col("id") % 300).alias("k"), (F.col("id") + 2).cast("int").alias("x"))
        many = many.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("x"))).where("n > 0").select("k", "x")

        def step(state, x):
            state[0] += 1
            return state[0]

        counted = sequence.folded(one.unionByName(many), ["k"], ["x"], ["x"], lambda: [0], step, "n")
        assert {r.n for r in counted.groupBy("k").agg(F.max("n").alias("n")).collect()} == {101}
        frames = [(v, i, 40.0 if i in (3, 9, 12, 20) else 0.0) for v in (*range(40), None) for i in range(24)]
        df = spark.createDataFrame(frames, "v int, frame int, score double")
        cut = sequence.shot_cuts(df, ["v"], "frame", "score").groupBy("v", "shot_id").agg(F.min("frame").alias("a")).collect()
        assert sorted((r.v is None, r.v or 0, r.shot_id, r.a) for r in cut) == [(v is None, v or 0, i, a) for v in (*range(40), None) for i, a in enumerate((0, 9, 20))]
    finally:
        for k, x in old.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)


def test_byte_edits():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(8)
    for n in range(300):
        a, b = ("".join(rng.choices("abç–" if n % 2 else "a😀", k=rng.randrange(1 + n // 4))).encode() for _ in range(2))
        assert byte_edits(a, b) == byte_edits(b, a) == plain(a, b)


def test_linkage_without_the_matrix():
    rng = np.random.default_rng(5)
    parts = lambda label: sorted(sorted(np.flatnonzero(label == k).tolist()) for k in set(label))
    for n in (1, 2, 3, 12, 25):
        for cut in (0.0, 0.3, 0.6, 0.9, 2.0):
            v = rng.normal(size=(n, 4)) + rng.integers(0, 3, (n, 1))
            v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32).astype(float)
            assert parts(cluster.linked_by_sums(v, cut, block=7)) == plain_average_linkage(v @ v.T, cut)
    v = rng.normal(size=(3000, 16)) + 2 * rng.normal(size=(30, 16))[rng.integers(0, 30, 3000)]
    v[100:300] = v[5]  # one vector two hundred times
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32).astype(float)
    for cut in (0.2, 0.5, 0.9):
        assert parts(cluster.linked_by_sums(v, cut)) == parts(cluster.average_linkage(v @ v.T, cut))
    tracemalloc.start()
    cluster.linked_by_sums(v, 0.9)
    assert tracemalloc.get_traced_memory()[1] < 3000 * 3000 * 8 / 2  # half a matrix of them
    tracemalloc.stop()


def test_identities_and_neighbours(spark):
    v = {"t0": [1.0, 0.0], "t1": [0.8, 0.6], "t2": [0.0, 1.0], "t3": [0.96, 0.28]}
    df = spark.createDataFrame([("v", k, x, 9 - i, i) for i, (k, x) in enumerate(v.items())], "video_id string, track_key string, embedding array<double>, first_seen int, pos int")
    named = plans.identities(df, Config(cluster_distance=0.1))
    who = {r.track_key: r.identity for r in named.collect()}
    assert who == {"t3": "person_0", "t0": "person_0", "t2": "person_1", "t1": "person_2"} or who["t0"] == who["t3"]
    near = cluster.nearest_other(named, ["video_id"], "track_key", "embedding", "identity")
    found = {r.track_key: (r.track, r.similarity) for r in near.collect()}
    assert found["t2"] == ("t1", 0.6) and found["t1"] == ("t3", 0.936)
    alone = cluster.borderline(near, named, ["video_id"], "track_key", "identity")
    assert {r.track_key for r in alone.collect()} == {"t1", "t2"}
    assert cluster.nearest_other(named.where("identity = 'person_0'"), ["video_id"], "track_key", "embedding", "identity").count() == 0
    maps = cluster.identity_maps(named, near, ["video_id"]).first()
    assert maps.track_to_identity["t0"] == who["t0"] and maps.nearest_other_cluster["t2"].track == "t1"


def test_corrections_in_order(spark):
    members = [("a", "p0"), ("b", "p0"), ("c", "p1"), ("d", "p2")]
    groups, gone, log = corrections.apply_in_order(members, [("x", "p0"), ("a", "p0"), ("c", "p0"), ("d", "p0")], ["d", "d", "nobody"], ["old"])
    assert groups == {"p0": ["a", "b", "c"]} and gone == ["old", "d"]
    assert [x.split()[0] for x in log] == ["SKIP", "SKIP", "MERGED", "MERGED", "EXCLUDED", "SKIP", "SKIP"]
    with pytest.raises(corrections.MissingIdentity):
        corrections.apply_in_order(members, [("c", "p0"), ("d", "p1")], [], [])
    df = spark.createDataFrame([("v", t, i, p) for p, (t, i) in enumerate(members)], "video_id string, track_key string, identity string, member_pos int")
    fixes = spark.createDataFrame([("v", "merge", 0, "c", "p0"), ("v", "exclude", 0, "d", None)], "video_id string, action string, seq int, track string, target string")
    out = corrections.corrected(df, fixes)
    assert rows(out.where("kind = 'member'"), "track_key", "identity", "pos") == [("a", "p0", 0), ("b", "p0", 1), ("c", "p0", 2)]
    assert rows(out.where("kind = 'excluded'"), "track_key") == [("d",)]
    near = spark.createDataFrame([("v", "a", "d", "p2", 0.4), ("v", "d", "a", "p0", 0.4)], "video_id string, track_key string, track string, identity string, similarity double")
    assert rows(corrections.pruned(near, df), "track_key") == [("d",)]


def test_guard_and_versions(spark, tmp_path):
    path = f"file://{tmp_path}/ids"
    corrections.guarded(spark, path)
    spark.createDataFrame([("v", ["t"])], "video_id string, excluded_tracks array<string>").write.parquet(path)
    with pytest.raises(FileExistsError):
        corrections.guarded(spark, path)
    corrections.guarded(spark, path, force=True)
    first, second = (corrections.write_version(spark.range(n), f"file://{tmp_path}/versions") for n in (1, 2))
    assert first.endswith("v000000") and second.endswith("v000001") and spark.read.parquet(first).count() == 1


def test_review(spark):
    lines = spark.createDataFrame([(0.0, 2.0, "hi"), (2.0, 3.0, None)], "start_sec double, end_sec double, text_pt string")
    named = spark.createDataFrame([(0.0, 2.0, "", "b", "assigned"), (2.0, 4.0, "yo", "", "uncertain_no_confident_face"), (4.0, 5.0, "z", "a", "assigned")], "start_sec double, end_sec double, text_pt string, assigned_speaker string, status string")
    both = review.review_rows(lines, "0", "transcript").withColumn("pos", F.col("start")).unionByName(review.review_rows(named, "1", "assigned").withColumn("pos", F.col("start")))
    assert [r.speaker for r in review.speakers(both).orderBy("rank").collect()] == ["b", "a", review.UNCERTAIN]
    r = review.overlay(both, 2.0).first()
    assert r.text == "hi" and [(c.source, c.speaker) for c in r.chips] == [("1", "b")]
    assert review.overlay(both, 99.0).first().text == ""
    assert {r.left for r in review.lanes(both).collect()} == {0.0, 40.0, 80.0}
    assert rows(both.select(review.lane(F.col("speaker"), F.col("kind")).alias("x")).distinct()) == [("Caption",), ("a",), ("b",), (review.UNCERTAIN,)]
    final = named.withColumnsRenamed({"assigned_speaker": "final_speaker", "status": "final_status"})
    assert review.review_rows(final, "2", "final").where("speaker = 'b'").first().status == "assigned"


def test_results_do_not_depend_on_partitions(spark):
    from voxtable.queries import QUERIES

    found = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append([rows(QUERIES[q](spark, "/root/testdata/sf0.001")) for q in ("heuristic_attribution", "shots", "weighted_identity", "correct_identities")])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1]


def test_heuristic_attribution_keeps_every_user(spark, tmp_path):
    from voxtable.queries import QUERIES

    rows = [(i, f"2024-01-01 {i % 24:02}:00:00", 10_005, "e", float(i % 7)) for i in range(24)]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["heuristic_attribution"](spark, str(tmp_path)).where("segment_id = 0").collect()
    assert [(r.video_id, r.n_candidates) for r in found] == [(5, 1)]


def test_merge_captions_compares_whole_texts(spark, tmp_path):
    from difflib import SequenceMatcher

    from voxtable.queries import QUERIES

    same, far, other = "the same long opening of forty letters ok " + "abc " * 40, "the same long opening of forty letters ok " + "xyz " * 60, "nothing alike 12345"
    turns = [(1, 0, "user", same), (1, 1, "user", far), (1, 2, "user", far + "."), (1, 3, "user", other), (2, 0, "user", other), (2, 1, "assistant", other), (2, 5, "user", other)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    plain = []
    for conv, turn, role, text in turns:
        t, c = f"{role} {text}", float(len(text))
        last = plain[-1] if plain and plain[-1][0] == conv else None
        if last and turn - last[2] <= 0.5 and SequenceMatcher(None, last[3], t).ratio() >= 0.7:
            plain[-1] = (conv, last[1], turn + 0.75, t if c >= last[4] else last[3], max(c, last[4]))
        else:
            plain.append((conv, float(turn), turn + 0.75, t, c))
    assert len(plain) == 5
    assert rows(QUERIES["merge_captions"](spark, str(tmp_path)), "conv_id", "start_sec", "end_sec", "text_pt", "confidence") == sorted(plain, key=repr)


def test_motion_needs_three_samples(spark):
    """A track of two samples has no signal, so no candidate, however well they would fit."""
    motion = spark.createDataFrame([("v", "two", 0.0, 1.0), ("v", "two", 2.0, 3.0), ("v", "three", 0.0, 1.0), ("v", "three", 1.0, 0.0), ("v", "three", 2.0, 3.0), ("v", "null", 0.0, 1.0), ("v", "null", 1.0, None), ("v", "null", 2.0, 1.0)], "video_id string, track_key string, t double, v double")
    signal = plans.motion_signals(motion, 0.2)
    assert {r.track_key for r in signal.collect()} == {"three"}
    energy = spark.createDataFrame([("v", i, i * 0.2) for i in range(12)], "video_id string, hop_idx long, rms double")
    tracks = spark.createDataFrame([("v", k, k, i, 0, i) for i, k in enumerate(("two", "three", "null"))], "video_id string, track_key string, identity string, pos int, shot_id int, track_id int")
    segments = spark.createDataFrame([("v", 0, 0.0, 2.0)], "video_id string, segment_id int, start_sec double, end_sec double")
    fragments = plans.heuristic_fragments(segments, signal, energy, tracks, 0.2)
    assert [(r.track_key, r.n_samples) for r in fragments.collect()] == [("three", 11)]


def test_grid_times_are_sums(spark):
    """Ten steps of 0.2 come to a little less than 2, so an eleventh time lies before the end; times are rounded, sums aren't."""
    spans = spark.createDataFrame([(1, 0.0, 2.0), (2, 0.0, 0.0), (3, 1.0, 0.5), (4, 7.1, 8.0), (5, 0.0, 60.0)], "k int, start double, end double")
    found = {k: [] for k in range(1, 6)}
    for r in sequence.sampling_grid(spans, 0.2).orderBy("k", "t").collect():
        found[r.k].append(r.t)
    for k, a, b in ((1, 0.0, 2.0), (2, 0.0, 0.0), (3, 1.0, 0.5), (4, 7.1, 8.0), (5, 0.0, 60.0)):
        t, plain = a, []
        while t < b:
            plain.append(round(t, 3))
            t += 0.2
        assert found[k] == plain
    assert len(found[1]) == 11


def test_folds_over_many_small_groups(spark):
    import random

    rng = random.Random(3)
    given = [(k, i, rng.random() * 50) for k in range(300) for i in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rng.sample(given, len(given)), "k long, i long, v double").repartition(5)
    found = sequence.folded(df, ["k"], ["i"], ["v"], lambda: [0.0], lambda state, v: state.__setitem__(0, state[0] + v) or state[0], "total", "double")
    total, plain = {}, []
    for k, i, v in given:
        total[k] = total.get(k, 0.0) + v
        plain.append((k, i, v, total[k]))
    assert sorted(map(tuple, found.collect())) == sorted(plain)


def test_nearest_other_across_blocks(spark):
    import random

    rng = random.Random(4)
    vectors = [(v, i, i % 3 if v else 0, [rng.uniform(-1, 1) for _ in range(4)]) for v in (0, 1) for i in range(23)]
    df = spark.createDataFrame(vectors, "video_id long, i long, label long, e array<double>")
    plain = []
    for v, i, l, e in vectors:
        best = max(((sum(map(float.__mul__, e, f)), -j) for w, j, m, f in vectors if w == v and m != l), default=None)
        if best and best[0] > -1:
            plain.append((i, -best[1], round(best[0], 3)))
    for block in (4096, 5):
        assert sorted((r.i, r.track, r.similarity) for r in cluster.nearest_other(df, ["video_id"], "i", "e", "label", block).collect()) == sorted(plain)


def test_excluded_tracks_that_are_still_members(spark):
    """The identity is looked at first: such a track leaves it and is noted once more; without one it is skipped."""
    groups, gone, log = corrections.apply_in_order([("a", "p"), ("b", "p")], [], ["a", "a", "x"], ["a"])
    assert groups == {"p": ["b"]} and gone == ["a", "a"]
    assert log == ["EXCLUDED a (was p)", "SKIP exclude a: already excluded", "SKIP exclude x: track not found in track_to_identity"]
    with pytest.raises(corrections.MissingIdentity):
        corrections.apply_in_order([("a", "p"), ("b", "q")], [("a", "q"), ("b", "p")], [], [])
    _, _, log = corrections.apply_in_order([("a", "p"), ("b", "q"), ("c", "p")], [("z", "q"), ("a", "p"), ("a", "q")], [], [])
    assert log == ["SKIP merge z -> q: track not found in track_to_identity", "SKIP merge a -> p: already in that identity", "MERGED a: p -> q"]


def test_identity_counts(spark):
    members = spark.createDataFrame([("v", "a", "p"), ("v", "b", "p"), ("v", "c", "q")], "video_id string, track_key string, identity string")
    excluded = spark.createDataFrame([("v", "x"), ("w", "y")], "video_id string, track_key string")
    assert rows(aggregates.identity_counts(members, excluded, ["video_id"]), "video_id", "n_identities", "n_excluded") == [("v", 2, 1), ("w", 0, 1)]


def test_tracks_against_a_plain_tracker(spark):
    """Random boxes: the linked tracks are those of the rule, written out track by track and face by face."""
    import random

    rng = random.Random(9)

    def iou(a, b):
        w = max(0, min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]))
        h = max(0, min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1]))
        union = a[2] * a[3] + b[2] * b[3] - w * h
        return w * h / union if union > 0 else 0.0

    given, pos = [], 0
    for video in range(4):
        for t in range(60):
            for _ in range(rng.randint(0, 4)):
                given.append((video, float(t), pos, [rng.randint(0, 30), rng.randint(0, 20), rng.randint(0, 20), 20]))
                pos += 1
    plain = []
    for video in range(4):
        live, over, n = [], [], 0
        for t in sorted({r[1] for r in given if r[0] == video}):
            faces = [r for r in given if r[0] == video and r[1] == t]
            used = set()
            for track in live:
                scores = [(iou(track["box"], f[3]), -i) for i, f in enumerate(faces) if i not in used]
                score, i = max(scores, default=(0.0, 0))
                if score > 0 and score >= 0.3:
                    used.add(-i)
                    track["pos"].append(faces[-i][2])
                    track["box"], track["missed"] = faces[-i][3], 0
                else:
                    track["missed"] += 1
            over += [x for x in live if x["missed"] > 2]
            live = [x for x in live if x["missed"] <= 2]
            for i, f in enumerate(faces):
                if i not in used:
                    live.append({"id": n, "pos": [f[2]], "box": f[3], "missed": 0})
                    n += 1
        for p, track in enumerate(x for x in over + live if len(x["pos"]) >= 3):
            plain += [(video, at, track["id"], p, k) for k, at in enumerate(track["pos"])]
    df = spark.createDataFrame(rng.sample(given, len(given)), "video_id long, t double, det_pos long, box array<long>")
    found = sequence.link_tracks(df, ["video_id"]).select("video_id", "det_pos", "track_id", "track_pos", "nth").collect()
    assert sorted(map(tuple, found)) == sorted(plain)
