"""From scored fragments to a decision for each segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxtable.functions.scalars import pyround


def best_fragment(df: DataFrame, keys: list[str], score: str, pos: str, identity: str = "identity") -> DataFrame:
    """For each key and identity the row of the highest score, of equal ones the first."""
    w = Window.partitionBy(*keys, identity).orderBy(F.desc(score), pos)
    return df.withColumn("vx_nth", F.row_number().over(w)).where("vx_nth = 1").drop("vx_nth")


def weighted_identity(df: DataFrame, keys: list[str], mean: str, n: str, pos: str, identity: str = "identity", labels: tuple[str, ...] = ("shot_id", "track_id")) -> DataFrame:
    """For each key and identity the mean of fragments, weighted with their sizes, to 3 places.

    The fragments' own means must have been rounded before.  The labels are those of the largest fragment, of
    equal ones the first; pos is the first fragment's.
    """
    g = df.groupBy(*keys, identity).agg(
        pyround(F.sum(F.col(mean) * F.col(n)) / F.sum(n), 3).alias(mean),
        F.sum(n).alias("vx_total"),
        F.min(pos).alias("vx_pos"),
        F.min(F.struct((-F.col(n)).alias("vx_m"), pos, *labels)).alias("vx_top"),
    )
    return g.select(*keys, identity, *[F.col(f"vx_top.{c}").alias(c) for c in labels], F.col("vx_total").alias(n), mean, F.col("vx_pos").alias(pos))


def ranked_candidates(df: DataFrame, keys: list[str], score: str, pos: str, fields: list[str], name: str = "candidates") -> DataFrame:
    """keys and an array of the candidates' fields, highest score first, of equal ones the first by position."""
    rows = F.sort_array(F.collect_list(F.struct((-F.col(score)).alias("vx_s"), F.col(pos).alias("vx_p"), F.struct(*fields).alias("vx_c"))))
    return df.groupBy(*keys).agg(F.transform(rows, lambda r: r["vx_c"]).alias(name))


def top_two(df: DataFrame, keys: list[str], score: str, pos: str, identity: str = "identity") -> DataFrame:
    """keys, n, first, second and best: the two highest scores and whose the highest is."""
    own = Window.partitionBy(*keys)
    nth = lambda k, c: F.max(F.when(F.col("vx_nth") == k, F.col(c)))
    two = df.withColumn("vx_nth", F.row_number().over(own.orderBy(F.desc(score), pos))).withColumn("vx_n", F.count("*").over(own)).where("vx_nth <= 2")
    return two.groupBy(*keys).agg(nth(1, score).alias("first"), nth(2, score).alias("second"), nth(1, identity).alias("best"), F.max("vx_n").alias("n"))


def other_best(candidates: Column, name: Column, identity: str = "identity") -> Column:
    """The first of ranked candidates that isn't name's."""
    return F.get(F.filter(candidates, lambda c: ~c[identity].eqNullSafe(name)), F.lit(0))


def decide_heuristic(n: Column, first: Column, second: Column, confident: float = 0.15, reject: float = -0.35, margin: float = 0.1) -> Column:
    """Status by correlation; missing n counts as no candidate."""
    return (
        F.when(F.coalesce(n, F.lit(0)) == 0, "uncertain_no_confident_face")
        .when((n == 1) & (first <= reject), "uncertain_anticorrelated_mouth")
        .when((n == 1) & (first >= confident), "assigned_single_candidate")
        .when(n == 1, "assigned_single_candidate_low_conf")
        .when(first - second >= margin, "assigned_multi_candidate")
        .otherwise("uncertain_ambiguous_multi_candidate")
    )


def decide_model(n: Column, first: Column, second: Column, margin: float = 0.2) -> Column:
    """Status by the face model's mean score."""
    return (
        F.when(F.coalesce(n, F.lit(0)) == 0, "uncertain_no_confident_face")
        .when((n > 1) & (first - second < margin), "uncertain_ambiguous_multi_candidate")
        .when(first >= 0, "assigned")
        .otherwise("assigned_low_confidence")
    )


def speaker_of(status: Column, best: Column) -> Column:
    return F.when(F.startswith(status, F.lit("assigned")), best)


def enrollment_pick(h_speaker: Column, h_status: Column, m_speaker: Column, m_status: Column, confident_h: tuple[str, ...], confident_m: tuple[str, ...]) -> Column:
    """Whose voice a segment may enroll, null if nobody's.

    Both methods agree, unless both are unsure; else the face model where it is confident, else the heuristic.
    """
    is_in = lambda s, names: F.coalesce(s.isin(*names), F.lit(False))
    unsure = F.coalesce(F.endswith(h_status, F.lit("low_conf")), F.lit(False)) & F.coalesce(m_status == "assigned_low_confidence", F.lit(False))
    agree = h_speaker.isNotNull() & h_speaker.eqNullSafe(m_speaker)
    return F.when(agree & ~unsure, h_speaker).when(is_in(m_status, confident_m), m_speaker).when(is_in(h_status, confident_h), h_speaker)


def decide_final(m_speaker: Column, m_status: Column, voices: Column, confident: float = 0.6, margin: float = 0.08) -> Column:
    """struct(final_speaker, final_status) from the face model and ranked voice candidates (identity, similarity)."""
    voices = F.coalesce(voices, F.expr("cast(array() as array<struct<identity:string, similarity:double>>)"))
    sure = F.coalesce(m_status == "assigned", F.lit(False))
    own = F.get(F.filter(voices, lambda v: v["identity"] == m_speaker), F.lit(0))["similarity"]
    other, top = other_best(voices, m_speaker), F.get(voices, F.lit(0))
    override = own.isNotNull() & F.coalesce(other["similarity"] - own >= margin, F.lit(False))
    as_ = lambda who, status: F.struct(who.cast("string").alias("final_speaker"), F.lit(status).alias("final_status"))
    return (
        F.when(sure & override, as_(other["identity"], "confident_voice_override"))
        .when(sure & own.isNotNull(), as_(m_speaker, "confident_talknet"))
        .when(sure, as_(m_speaker, "confident_talknet_no_voice_check"))
        .when(F.coalesce(top["similarity"] >= confident, F.lit(False)), as_(top["identity"], "confident_voice_only"))
        .otherwise(as_(F.lit(None), "not_confident"))
    )


def compare(a: DataFrame, b: DataFrame, keys: list[str], speaker: str) -> DataFrame:
    """keys, speaker_a, speaker_b and outcome for keys on both sides; two nulls agree on nobody.

    Keys must be unique on each side (see last_wins).
    """
    both = a.select(*keys, F.col(speaker).alias("speaker_a")).join(b.select(*keys, F.col(speaker).alias("speaker_b")), keys)
    x, y = F.col("speaker_a"), F.col("speaker_b")
    outcome = F.when(x.isNull() & y.isNull(), "both_none").when(x.isNull() | y.isNull(), "one_abstained").when(x == y, "agree").otherwise("disagree")
    return both.withColumn("outcome", outcome)


def only_on_one_side(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """keys and side ("a" or "b") of rows without a partner."""
    left = a.select(*keys).distinct().join(b.select(*keys), keys, "left_anti").withColumn("side", F.lit("a"))
    return left.unionByName(b.select(*keys).distinct().join(a.select(*keys), keys, "left_anti").withColumn("side", F.lit("b")))


def agreement(compared: DataFrame) -> DataFrame:
    """One row: n_compared, both_assigned, agree, disagree, one_abstained, both_none and whole percentages."""
    n = lambda *names: F.count(F.when(F.col("outcome").isin(*names), 1))
    total = F.greatest(F.lit(1), F.count("*"))
    counts = {"both_assigned": n("agree", "disagree"), "agree": n("agree"), "disagree": n("disagree"), "one_abstained": n("one_abstained"), "both_none": n("both_none")}
    return compared.agg(F.count("*").alias("n_compared"), *[c.alias(k) for k, c in counts.items()], *[F.floor(c * 100 / total).cast("long").alias(f"{k}_percent") for k, c in counts.items()])
