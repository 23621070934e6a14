"""Trip-update snapshots landed as JSON, one snapshot per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEED

_READ = f"{FEED}, _corrupt_record string"


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Backfill: every landed snapshot, in the arrival order given by file time and path."""
    return _with_arrival(spark.read.schema(_READ).json(folder))


def stream_snapshots(spark: SparkSession, folder: str, max_files: int) -> DataFrame:
    """Live: new snapshot files, at most `max_files` per micro-batch."""
    reader = spark.readStream.schema(_READ).option("maxFilesPerTrigger", max_files)
    return _with_arrival(reader.json(folder))


def _with_arrival(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        "header",
        "entity",
        F.unix_micros("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_corrupt_record").alias("corrupt"),
    )


def epoch() -> Column:
    """Time of a snapshot in seconds, null if its header has no readable one."""
    return F.col("header.timestamp").try_cast("bigint")


def unreadable() -> Column:
    """Whether a record is no JSON, or a snapshot without a time."""
    return F.col("corrupt").isNotNull() | epoch().isNull()
