"""Row rules of the table writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merge import keep_first


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace old rows of the same key; keys absent from the batch are kept."""
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def insertable(target: DataFrame, batch: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Rows of the batch to append: the first per key, without keys that are stored already."""
    return keep_first(batch, keys, order).join(target.select(*keys), keys, "left_anti")


def recompute_window(target: DataFrame, fresh: DataFrame, lo, hi) -> DataFrame:
    """Buckets in [lo, hi) from `fresh`, all others as they are stored in `target`."""
    inside = (F.col("bucket") >= lo) & (F.col("bucket") < hi)
    return target.where(~inside).unionByName(fresh.where(inside))
