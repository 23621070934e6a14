"""Punctuality aggregates per line and per stop, and their coarser roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..functions.clock import local_day_bucket, utc_bucket
from ..functions.measures import fact_measures, merged_measures

LINE_KEYS = ["service_date", "version_id", "line_id", "operator_id"]
STOP_KEYS = ["service_date", "version_id", "stop_id", "line_id"]


def line_15m(facts: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    bucket = utc_bucket(F.col("ts"), "15 minutes").alias("bucket")
    return facts.groupBy(bucket, *LINE_KEYS).agg(*fact_measures(cfg))


def stop_15m(facts: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    bucket = utc_bucket(F.col("ts"), "15 minutes").alias("bucket")
    return facts.groupBy(bucket, *STOP_KEYS).agg(*fact_measures(cfg))


def line_1h(quarters: DataFrame) -> DataFrame:
    """From the 15-minute aggregate."""
    bucket = utc_bucket(F.col("bucket"), "1 hour").alias("bucket")
    return quarters.groupBy(bucket, *LINE_KEYS).agg(*merged_measures())


def line_1d(hours: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """From the hourly aggregate; the bucket is the UTC instant of local midnight."""
    bucket = local_day_bucket(F.col("bucket"), cfg.zone).alias("bucket")
    return hours.groupBy(bucket, *LINE_KEYS).agg(*merged_measures())
