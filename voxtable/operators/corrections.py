"""Human corrections of identities."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtable.operators.filters import singletons

LOG = "video_id string, kind string, track_key string, identity string, pos long, message string"


class MissingIdentity(ValueError):
    """A correction names an identity that isn't there (any more)."""


def apply_in_order(members: list[tuple[str, str]], merges: list[tuple[str, str]], excludes: list[str], excluded: list[str]) -> tuple[dict[str, list[str]], list[str], list[str]]:
    """(identity -> tracks, excluded tracks, log) after all merges, then all exclusions, each in order.

    An identity that loses its last track is gone, also as a later target.  The wording of the log is fixed.
    """
    groups: dict[str, list[str]] = {}
    for track, identity in members:
        groups.setdefault(identity, []).append(track)
    at = {t: i for t, i in members}
    gone, log = list(excluded), []

    def leave(track: str) -> str:
        identity = at.pop(track)
        groups[identity].remove(track)
        if not groups[identity]:
            del groups[identity]
        return identity

    for track, target in merges:
        if track not in at:
            log.append(f"SKIP merge {track} -> {target}: track not found in track_to_identity")
        elif at[track] == target:
            log.append(f"SKIP merge {track} -> {target}: already in that identity")
        else:
            source = leave(track)
            if target not in groups:
                raise MissingIdentity(f"{target} isn't an identity")
            groups[target].append(track)
            at[track] = target
            log.append(f"MERGED {track}: {source} -> {target}")
    for track in excludes:
        if track in at:  # also one that is excluded already, but still a member
            log.append(f"EXCLUDED {track} (was {leave(track)})")
            gone.append(track)
        elif track in gone:
            log.append(f"SKIP exclude {track}: already excluded")
        else:
            log.append(f"SKIP exclude {track}: track not found in track_to_identity")
    return groups, gone, log


def corrected(members: DataFrame, corrections: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Rows of kind member, excluded or log for every video, after its corrections.

    members: video_id, track_key, identity, member_pos.  corrections: video_id, action (merge or exclude), seq,
    track, target.  excluded: video_id, track_key, pos.  Order matters, so one video's corrections are applied
    one after another, in one group; videos are independent.
    """
    spark = members.sparkSession
    excluded = excluded if excluded is not None else spark.range(0).select(F.lit("").alias("video_id"), F.lit("").alias("track_key"), F.lit(0).alias("pos"))
    row = lambda df, kind, track, identity, pos: df.select("video_id", F.lit(kind).alias("kind") if kind else F.col("action").alias("kind"), F.col(track).alias("track"), identity.cast("string").alias("identity"), F.col(pos).cast("long").alias("pos"))
    given = row(members, "member", "track_key", F.col("identity"), "member_pos").unionByName(row(corrections, None, "track", F.col("target"), "seq")).unionByName(row(excluded, "excluded", "track_key", F.lit(None), "pos"))

    def apply(pdf: pd.DataFrame) -> pd.DataFrame:
        video = pdf["video_id"].iloc[0]
        of = lambda kind: pdf[pdf["kind"] == kind].sort_values("pos", kind="stable")
        pairs = lambda x: list(zip(x["track"], x["identity"], strict=True))
        groups, gone, log = apply_in_order(pairs(of("member")), pairs(of("merge")), list(of("exclude")["track"]), list(of("excluded")["track"]))
        rows = [(video, "member", t, i, p, None) for i, ts in groups.items() for p, t in enumerate(ts)]
        rows += [(video, "excluded", t, None, p, None) for p, t in enumerate(gone)] + [(video, "log", None, None, p, m) for p, m in enumerate(log)]
        return pd.DataFrame(rows, columns=["video_id", "kind", "track_key", "identity", "pos", "message"])

    return given.groupBy("video_id").applyInPandas(apply, LOG)


def last_merge_wins(members: DataFrame, merges: DataFrame) -> DataFrame:
    """members with the target of each track's last merge: the same as corrected() while no target is emptied."""
    last = merges.groupBy("video_id", F.col("track").alias("track_key")).agg(F.max(F.struct("seq", "target")).alias("vx_last"))
    return members.join(last, ["video_id", "track_key"], "left").withColumn("identity", F.coalesce("vx_last.target", "identity")).drop("vx_last")


def pruned(nearest: DataFrame, members: DataFrame) -> DataFrame:
    """Nearest-other rows of tracks that are now alone in their identity."""
    alone = members.join(singletons(members, ["video_id", "identity"]), ["video_id", "identity"], "left_semi")
    return nearest.join(alone, ["video_id", "track_key"], "left_semi")


def guarded(spark: SparkSession, path: str, force: bool = False) -> None:
    """Refuse to write over identities that somebody has corrected."""
    if force:
        return
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return
    old = spark.read.parquet(path)
    touched = F.lit(False)
    if "excluded_tracks" in old.columns:
        touched = touched | (F.size("excluded_tracks") > 0)
    if "manually_corrected" in old.columns:
        touched = touched | F.coalesce("manually_corrected", F.lit(False))
    if old.where(touched).limit(1).count():
        raise FileExistsError(f"{path} has been corrected by hand; give force to write over it")


def write_version(df: DataFrame, folder: str) -> str:
    """Write df as the folder's next version and return its path; older versions stay, as backups."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    out = f"{folder}/v{max([int(n[1:]) for n in names if n[:1] == 'v' and n[1:].isdigit()], default=-1) + 1:06d}"
    df.write.parquet(out)
    return out
