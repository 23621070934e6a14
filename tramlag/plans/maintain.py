"""Aggregate refresh, backfill and retention jobs; an external scheduler passes `now`."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.clock import BUCKET_WIDTHS, bucket_ceiling, bucket_start, ntz, to_utc
from ..operators import rollup
from ..operators.upsert import recompute_window
from ..warehouse import Warehouse

# level -> (source table, its time column and partition column)
SOURCES = {
    "agg_line_15m": ("fact_delay", "ts", "ts_date"),
    "agg_stop_15m": ("fact_delay", "ts", "ts_date"),
    "agg_line_1h": ("agg_line_15m", "bucket", "bucket_date"),
    "agg_line_1d": ("agg_line_1h", "bucket", "bucket_date"),
}
REFRESH_ORDER = ["agg_line_15m", "agg_stop_15m", "agg_line_1h", "agg_line_1d"]


def aggregate(wh: Warehouse, level: str, source: DataFrame) -> DataFrame:
    if level == "agg_line_15m":
        return rollup.line_15m(source, wh.cfg)
    if level == "agg_stop_15m":
        return rollup.stop_15m(source, wh.cfg)
    if level == "agg_line_1h":
        return rollup.line_1h(source)
    return rollup.line_1d(source, wh.cfg)


def refresh_window(cfg: Settings, level: str, now: datetime) -> tuple[datetime, datetime]:
    """Whole buckets inside [now - start, now - end) of the level's policy."""
    policy = cfg.refresh[level]
    width, zone = BUCKET_WIDTHS[level], cfg.zone
    now = to_utc(now)
    return bucket_ceiling(now - policy.start, width, zone), bucket_start(now - policy.end, width, zone)


def between(df: DataFrame, column: str, partition: str, lo: datetime, hi: datetime) -> DataFrame:
    """Rows with lo <= column < hi, pruned on the date partition as well."""
    return df.where(
        F.col(partition).between(F.lit(lo.date()), F.lit(hi.date()))
        & (F.col(column) >= ntz(lo))
        & (F.col(column) < ntz(hi))
    )


def recompute(wh: Warehouse, level: str, lo: datetime, hi: datetime) -> None:
    """Rebuild the buckets in [lo, hi) of one level and keep all others.

    Only the first and the last date partition can hold buckets on both sides of the
    window, so only these are read back; other partitions are replaced as a whole.
    """
    if lo >= hi:
        return
    with wh.claim(level) as check:
        _recompute(wh, level, lo, hi, check)


def _recompute(wh: Warehouse, level: str, lo: datetime, hi: datetime, check: Callable[[], None]) -> None:
    table, column, partition = SOURCES[level]
    days = [str(lo.date() + timedelta(days=i)) for i in range((hi.date() - lo.date()).days + 1)]
    fresh = aggregate(wh, level, between(wh.read(table, days), column, partition, lo, hi))
    fresh = fresh.withColumn("bucket_date", F.col("bucket").cast("date"))
    edges = wh.read(level, sorted({str(lo.date()), str(hi.date())}))
    rows = recompute_window(edges, fresh.select(*edges.columns), ntz(lo), ntz(hi))
    check()
    wh.replace_partitions(level, rows, days)


def require_window(wh: Warehouse, level: str) -> None:
    if SOURCES[level][0] == "fact_delay" and wh.cfg.refresh[level].start > wh.cfg.fact_retention:
        raise ValueError(f"{level}: refresh reaches behind the retention of the facts")


def refresh(wh: Warehouse, level: str, now: datetime) -> None:
    require_window(wh, level)
    recompute(wh, level, *refresh_window(wh.cfg, level, now))


def refresh_all(wh: Warehouse, now: datetime) -> None:
    """All levels, finer ones first."""
    for level in REFRESH_ORDER:
        refresh(wh, level, now)


def backfill(wh: Warehouse, level: str, first: datetime, last: datetime) -> None:
    """Fill the whole buckets inside [first, last), e.g. history before the first refresh."""
    width, zone = BUCKET_WIDTHS[level], wh.cfg.zone
    recompute(wh, level, bucket_ceiling(first, width, zone), bucket_start(last, width, zone))


def line_15m_realtime(wh: Warehouse, now: datetime) -> DataFrame:
    """Materialised buckets plus those computed from facts newer than the last refresh."""
    stored = wh.read("agg_line_15m").drop("bucket_date")
    newest = stored.agg(F.max("bucket")).first()[0]
    start = newest + timedelta(minutes=15) if newest else to_utc(now) - wh.cfg.fact_retention
    recent = between(wh.read("fact_delay"), "ts", "ts_date", start, to_utc(now))
    return stored.unionByName(rollup.line_15m(recent, wh.cfg))


def first_kept_day(now: datetime, keep: timedelta, weekly: bool = False) -> date:
    """First day that retention keeps: partitions go only when they lie wholly before it."""
    limit = (to_utc(now) - keep).date()
    return limit - timedelta(days=limit.weekday()) if weekly else limit


def compact_closed(wh: Warehouse, now: datetime) -> list[str]:
    """Rewrite the fact dates before yesterday that lie in several files; returns them.

    A live query appends a file a cycle and date; snapshots that old are no longer awaited.
    """
    closed = (to_utc(now).date() - timedelta(days=1)).isoformat()
    values = [v for v in wh.partitions("fact_delay") if v < closed and len(wh.files("fact_delay", v)) > 1]
    for value in values:
        wh.compact("fact_delay", value)
    return values


def apply_retention(wh: Warehouse, now: datetime) -> dict[str, list[str]]:
    """Drop the expired partitions of facts and audit rows; aggregates stay."""
    facts = first_kept_day(now, wh.cfg.fact_retention).isoformat()
    runs = first_kept_day(now, wh.cfg.run_retention, weekly=True).isoformat()
    return {
        "fact_delay": wh.drop_partitions("fact_delay", lambda value: value < facts),
        "fact_run": wh.drop_partitions("fact_run", lambda value: value < runs),
    }
