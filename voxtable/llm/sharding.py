"""Byte-balanced contiguous shards from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import rows_with_ids, stage, table


def byte_shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut the table, in its stored order, into n_shards runs of rows of nearly equal bytes.

    Stored order is that in which Spark reads the rows: by partition, then by place in it.  Sessions that cut the
    files differently (other split sizes) give other partitions and other cuts; cut a table once and keep the result.

    One pass measures every row and writes (partition, position, size).  The totals of the partitions are
    added up in partition order; a row's place on the global byte line is its partition's start plus the
    sizes before it there, and its shard is the equal target that the middle of the row falls into.  So a
    shard differs from the target by at most one row at either end, and texts never move.

    The only step on one task adds up one row per input partition.  Result, a row for each input row:
    id_col, size (UTF-8 bytes of the text plus 1; null text: 1), text_crc32 (of the UTF-8 text, null: of
    nothing), shard, slot (0, 1, ... within the shard, in stored order), start (byte offset of the row).
    Repeated rows and null ids are rows like any other; an empty table gives no rows; a row of more bytes
    than a target may leave a shard empty.  Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stage(
        rows_with_ids(docs.select(F.col(id_col).alias("id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("crc")), "row")
    ).withColumn("part", F.shiftright("row", 33))
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(whole).alias("total"),
    )
    within = Window.partitionBy("part").orderBy("row")
    placed = stage(
        rows.withColumn("upto", F.sum("size").over(within))
        .withColumn("nth", F.row_number().over(within).cast("long") - 1)
        .join(starts, "part")
        .select(
            "id",
            "size",
            "crc",
            (F.col("bytes_before") + F.col("upto") - F.col("size")).alias("start"),
            (F.col("rows_before") + F.col("nth")).alias("pos"),
            F.expr(f"int(least({n_shards - 1}, ((2 * (bytes_before + upto) - size) * {n_shards}) div (2 * total)))").alias("shard"),
        )
    )
    firsts = placed.groupBy("shard").agg(F.min("pos").alias("first"))  # n_shards rows at most
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("pos") - F.col("first")).alias("slot"), "start"
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, text_col: str = "text") -> None:
    """Write the documents below path, one folder vx_shard=N for each shard, cut as byte_shards() does.

    Columns may have any names but vx_row and vx_shard.  An empty table writes an empty folder.
    """
    numbered = stage(rows_with_ids(docs, "vx_row"))
    cut = byte_shards(numbered, n_shards, "vx_row", text_col).select("vx_row", F.col("shard").alias("vx_shard"))
    numbered.join(cut, "vx_row").drop("vx_row").write.partitionBy("vx_shard").parquet(path)


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
