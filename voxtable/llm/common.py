"""Helpers that the training-data operators share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only on one machine (a local master, as in tests) and only where no shared folder is named.
LOCAL_STAGE = "file:///tmp/checkpoints/voxtable"

#: What may be broadcast: rows of a side, and bytes of its values, both measured before the hint is given.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_INNER: ContextVar[str] = ContextVar("voxtable_scratch", default="")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, else the context's checkpoint folder.

    Without either a local master uses a folder of this machine; any other master is refused, since each
    executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = LOCAL_STAGE
    return f"{base.rstrip('/')}/voxtable-{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession) -> str:
    """A new folder path below the shared folder."""
    return f"{base_dir(spark)}/{_INNER.get()}{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back.

    Cuts the lineage, fixes generated row ids, and gives later joins a plain scan, so that adaptive
    execution can split a hot key.  Lost executors lose nothing: the files are in the shared folder.
    """
    path = path or f"{shared_dir(df.sparkSession)}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables staged inside are deleted at the end, but for one: stage(df, the path that this gives)."""
    kept, name = f"{shared_dir(spark)}.parquet", f"{_INNER.get()}{uuid.uuid4().hex}/"
    before = _INNER.set(name)
    try:
        yield kept
    finally:
        _INNER.reset(before)
        delete(spark, f"{base_dir(spark)}/{name}")


def delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_stages(spark: SparkSession) -> None:
    """Delete everything that stage() wrote in this application, once all results have been written."""
    delete(spark, base_dir(spark))


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it has at most `limit` rows of together at most `size` bytes; else for a shuffled join.

    df should be cheap to read: a staged table or a scan.  Bytes are those of the rows as JSON, an upper bound for
    what such rows take.
    """
    rows, held = df.select(F.octet_length(F.to_json(F.struct("*"))).alias("n")).agg(F.count("*"), F.sum("n")).first()
    return F.broadcast(df) if rows <= limit and (held or 0) <= size else df.hint("merge")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def rows_with_ids(df: DataFrame, name: str = "vx_row") -> DataFrame:
    """df with a number for each row; stage() it before the number is used twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def session(app: str = "voxtable") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
