"""The seven stored measures: from facts, and merged from finer aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CANCELLED, OBSERVED, SKIPPED_STOP, Settings

MEASURES = ["delay_sum", "obs", "on_time", "delay_min", "delay_max", "cancelled", "skipped"]


def fact_measures(cfg: Settings) -> list[Column]:
    """Sum, min and max are null without observations; counts are 0."""
    status = F.col("status")
    observed = status == OBSERVED
    delay = F.when(observed, F.col("delay_s"))
    return [
        F.sum(delay).alias("delay_sum"),
        F.count_if(observed).alias("obs"),
        F.count_if(delay.between(cfg.on_time_from_s, cfg.on_time_to_s)).alias("on_time"),
        F.min(delay).alias("delay_min"),
        F.max(delay).alias("delay_max"),
        F.count_if(status == CANCELLED).alias("cancelled"),
        F.count_if(status == SKIPPED_STOP).alias("skipped"),
    ]


def merged_measures() -> list[Column]:
    """Sums of sums and counts, extremes of extremes; averages are never stored."""
    merge = {"delay_min": F.min, "delay_max": F.max}
    return [merge.get(name, F.sum)(name).alias(name) for name in MEASURES]


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient at 6 decimals, null when nothing was observed."""
    return F.round(F.try_divide(numerator, denominator), 6)
