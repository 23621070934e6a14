"""Union and deduplication of package tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

PACKAGE_ORDER = ["pkg_ord", "line_no"]


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key, the first in `order`; null keys count as equal.

    Spark limits the row_number filter to one row per key and task before the shuffle,
    so a hot key reaches its reducer with one row per map task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def merge_tables(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Merge each package table on its key; `feed_info` keeps only its first package."""
    merged = {}
    for name, df in tables.items():
        if name == "feed_info":
            merged[name] = first_package(df)
        elif name in keys:
            merged[name] = keep_first(df, keys[name], PACKAGE_ORDER)
        else:
            merged[name] = df
    return merged


def first_package(df: DataFrame) -> DataFrame:
    """All rows of the package that comes first among those holding the table."""
    first = df.agg(F.min("pkg_ord").alias("pkg_ord"))  # one row, so broadcast
    return df.join(F.broadcast(first), "pkg_ord", "left_semi")
