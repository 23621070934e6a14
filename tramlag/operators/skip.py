"""Skipping of snapshots that are not newer than the ones before them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import written

ROWS_PER_RANGE = 100_000


def in_ranges(heads: DataFrame, arrival: list[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """`heads` with the number of their range of the arrival order, `_range`.

    Ranges are Spark's range partitions of a total order, so their number follows the heads. They
    are written, since both the ranges and what lies in them are read from there.
    """
    ranges = math.ceil(heads.count() / rows_per_range)
    if ranges < 2:
        return heads.withColumn("_range", F.lit(0))
    return written(heads.repartitionByRange(ranges, *arrival).withColumn("_range", F.spark_partition_id()), "heads")


def mark_fresh(
    heads: DataFrame,
    arrival: list[str],
    ts: str,
    last: int | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """`heads` with a flag `fresh`: newer than everything that arrived before.

    A skipped head never exceeds the marker, so the marker is the running maximum of all
    earlier heads. It is the maximum over whole earlier ranges of the arrival order, plus
    the running maximum inside a head's own range: no window spans all heads. `arrival`
    gives a total order without nulls, all of which cuts the ranges: files landed at one
    moment spread over several. `last` is the epoch time of the last processed snapshot
    (`ts` holds epoch seconds then).
    """
    placed = in_ranges(heads, arrival, rows_per_range)
    earlier_ranges = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # a row a range
    before = (
        placed.groupBy("_range")
        .agg(F.max(ts).alias("_max"))
        .select("_range", F.max("_max").over(earlier_ranges).alias("_before"))
    )
    earlier_heads = W.partitionBy("_range").orderBy(*arrival).rowsBetween(W.unboundedPreceding, -1)
    inside = placed.withColumn("_inside", F.max(ts).over(earlier_heads))
    floor = F.lit(last).cast(heads.schema[ts].dataType)
    marker = F.greatest("_before", "_inside", floor)
    return (
        inside.join(before, "_range")
        .withColumn("fresh", marker.isNull() | (F.col(ts) > marker))
        .drop("_range", "_before", "_inside")
    )


def fresh_only(heads: DataFrame, arrival: list[str], ts: str, last: int | None = None, **options) -> DataFrame:
    return mark_fresh(heads, arrival, ts, last, **options).where("fresh").drop("fresh")


def numbered(heads: DataFrame, arrival: list[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """`heads` with their place in the order of arrival, `place`, from 0 on; range by range as above."""
    placed = in_ranges(heads, arrival, rows_per_range)
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(W.partitionBy("_range").orderBy(*arrival)) - 1
    joined = placed.withColumn("_inside", inside).join(offsets, "_range")
    return joined.withColumn("place", F.col("_offset") + F.col("_inside")).drop("_range", "_offset", "_inside")
