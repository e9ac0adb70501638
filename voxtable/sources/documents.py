"""JSON documents, whole files, to and from tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtable.schemas import DOCUMENTS, FINAL, LINE, as_struct


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The documents of a kind, a row for each (for shots, each element), with file_id from the file's name.

    The schema is declared, so that fields that older files lack are null and nothing is inferred.
    """
    df = spark.read.schema(DOCUMENTS[kind]).option("multiLine", True).option("encoding", "UTF-8").json(path)
    return df.withColumn("file_id", F.regexp_extract(F.col("_metadata.file_name"), rf"^(.*?)(?:_{kind})?\.json$", 1))


def read_optional(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """As read(), or no rows if there is no such file."""
    if _exists(spark, path):
        return read(spark, path, kind)
    return spark.createDataFrame([], f"{DOCUMENTS[kind]}, file_id string")


def rows(docs: DataFrame, field: str, pos: str = "pos") -> DataFrame:
    """video_id, pos and the fields of the elements of an array; pos keeps their order in the document."""
    video = F.coalesce("video_id", "file_id") if "video_id" in docs.columns else F.col("file_id")
    return docs.select(video.alias("video_id"), F.posexplode(field).alias(pos, "vx")).select("video_id", pos, "vx.*")


def shots(docs: DataFrame) -> DataFrame:
    return docs.withColumnRenamed("file_id", "video_id").withColumn("pos", F.col("shot_id"))


def detections(docs: DataFrame) -> DataFrame:
    """Face tracks flat: shot_pos, track_pos and det_pos keep the order of the three nested lists."""
    a = docs.select("video_id", F.posexplode("shots").alias("shot_pos", "s"))
    b = a.select("video_id", "shot_pos", "s.shot_id", F.posexplode("s.tracks").alias("track_pos", "k"))
    return b.select("video_id", "shot_pos", "shot_id", "track_pos", "k.track_id", F.posexplode("k.detections").alias("det_pos", "d")).select("video_id", "shot_pos", "shot_id", "track_pos", "track_id", "det_pos", "d.*")


def identity_members(docs: DataFrame) -> DataFrame:
    a = docs.select(F.col("file_id").alias("video_id"), F.explode("identities").alias("i"))
    return a.select("video_id", "i.identity", F.posexplode("i.tracks").alias("member_pos", "track_key"))


def nearest_others(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("file_id").alias("video_id"), F.explode("nearest_other_cluster").alias("track_key", "v")).select("video_id", "track_key", "v.*")


def excluded_tracks(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("file_id").alias("video_id"), F.posexplode("excluded_tracks").alias("pos", "track_key"))


def corrections(docs: DataFrame) -> DataFrame:
    """video_id, action, seq, track, target."""
    merge = docs.select(F.col("file_id").alias("video_id"), F.posexplode("merge").alias("seq", "m")).select("video_id", F.lit("merge").alias("action"), "seq", "m.track", F.col("m.target_identity").alias("target"))
    out = docs.select(F.col("file_id").alias("video_id"), F.posexplode("exclude").alias("seq", "track")).select("video_id", F.lit("exclude").alias("action"), "seq", "track", F.lit(None).cast("string").alias("target"))
    return merge.unionByName(out)


def review_source(spark: SparkSession, path: str) -> DataFrame:
    """video_id, pos, kind and the segment fields of a file of any kind that can be reviewed.

    The kind shows in which array there is, and in the first row's fields; a file with neither is an error.
    """
    row = as_struct(FINAL + ", assigned_speaker string, status string")
    docs = spark.read.schema(f"video_id string, transcript array<{as_struct(LINE)}>, attribution array<{row}>").option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_name"))
    bad = F.raise_error(F.concat(F.lit("neither a transcript nor an attribution: "), F.col("file")))
    first = F.get("attribution", F.lit(0))
    kind = F.when(F.col("transcript").isNotNull(), "transcript").when(F.col("attribution").isNull(), bad).when(first["final_status"].isNotNull(), "final").otherwise("assigned")
    kinds = docs.select("video_id", "file", kind.alias("kind"), "transcript", "attribution")
    lines = kinds.select("video_id", "kind", F.posexplode_outer("transcript").alias("pos", "l"), F.lit(None).cast(row).alias("a")).where("kind = 'transcript' and l is not null")
    rest = kinds.where("kind != 'transcript'").select("video_id", "kind", F.posexplode("attribution").alias("pos", "a"))
    pick = lambda src: [F.col(f"{src}.start_sec"), F.col(f"{src}.end_sec"), F.col(f"{src}.text_pt")]
    none = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    a = lines.select("video_id", "pos", "kind", *pick("l"), *none("assigned_speaker", "status", "final_speaker", "final_status"))
    b = rest.select("video_id", "pos", "kind", *pick("a"), "a.assigned_speaker", "a.status", "a.final_speaker", "a.final_status")
    return a.unionByName(b)


def documents(df: DataFrame, pos: str, field: str, columns: list[str]) -> DataFrame:
    """A JSON text for each video: its rows as an array, in order.  Text stays as it is, not escaped to ASCII."""
    elements = F.transform(F.sort_array(F.collect_list(F.struct(pos, F.struct(*columns).alias("v")))), lambda x: x["v"])
    return df.groupBy("video_id").agg(elements.alias(field)).select("video_id", F.to_json(F.struct("video_id", field), {"pretty": "true", "ignoreNullFields": "false"}).alias("json"))


def write_documents(docs: DataFrame, folder: str) -> None:
    """One file for each video, below video_id=...; the table itself belongs in Parquet."""
    docs.write.partitionBy("video_id").option("lineSep", "\n").text(folder)
