"""Refresh by invalidation: appends log what they touch, and a refresh rebuilds no more than that.

The log of a level lists ranges [lo, hi) of its buckets whose source has changed since they were
built: a small file per append, with a line per range. A refresh merges the ranges, rebuilds
those inside its window, logs the buckets that came out different for the next coarser level, and
leaves the rest of the ranges in the log for a later window or a backfill. Every step may be
repeated: a range that is logged once too often is built again to the same rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import BUCKET_WIDTHS, bucket_ceiling, bucket_start, buckets_of, level_bucket
from ..warehouse import Warehouse
from .maintain import REFRESH_ORDER, SOURCES, aggregate, refresh_window, require_window

Range = tuple[datetime, datetime]


@dataclass
class Refreshed:
    """What a refresh did to a level."""

    level: str
    rebuilt: list[datetime] = field(default_factory=list)  # buckets
    changed: list[datetime] = field(default_factory=list)  # of these the ones that came out different
    rewritten: list[str] = field(default_factory=list)  # date partitions
    left: list[Range] = field(default_factory=list)  # ranges outside the window


def _folder(wh: Warehouse, level: str) -> str:
    return wh.path(f"_invalid/{level}")


def fed_by(table: str) -> list[str]:
    """Levels that are built from a table."""
    return [level for level in REFRESH_ORDER if SOURCES[level][0] == table]


def merged(ranges: list[Range]) -> list[Range]:
    """Ranges that overlap or touch as one, in order."""
    found: list[Range] = []
    for lo, hi in sorted(ranges):
        if found and lo <= found[-1][1]:
            found[-1] = found[-1][0], max(hi, found[-1][1])
        else:
            found.append((lo, hi))
    return found


def log_touched(wh: Warehouse, table: str, rows: DataFrame, time: str) -> None:
    """Log the buckets that `rows`, stored in `table` before, touch in the levels built from it.

    The driver gets the distinct quarters of an hour of the rows: their number depends on the time
    that the rows span, not on how many they are. Rows that a repeated batch did not insert may be
    among them: whoever stored them may have died before logging.
    """
    quarter = level_bucket(F.col(time), "agg_line_15m", wh.cfg.zone).alias("quarter")
    times = [row[0] for row in rows.select(quarter).distinct().collect() if row[0]]
    log_times(wh, table, times)


def log_times(wh: Warehouse, table: str, times: list[datetime]) -> None:
    """Log the buckets of these times in the levels built from `table`."""
    for level in fed_by(table) if times else []:
        width, zone = BUCKET_WIDTHS[level], wh.cfg.zone
        starts = {bucket_start(t, width, zone) for t in times}
        _log(wh, level, [(b, bucket_start(b + (width or timedelta(hours=26)), width, zone)) for b in starts])


def append_facts(wh: Warehouse, facts: DataFrame) -> None:
    """Append facts (without `ts_date`) and log what they touch."""
    wh.append("fact_delay", facts.withColumn("ts_date", F.col("ts").cast("date")))
    log_touched(wh, "fact_delay", facts, "ts")


def invalidate(wh: Warehouse, level: str, lo: datetime, hi: datetime) -> None:
    """Log a range by hand; it is widened to whole buckets."""
    width, zone = BUCKET_WIDTHS[level], wh.cfg.zone
    _log(wh, level, [(bucket_start(lo, width, zone), bucket_ceiling(hi, width, zone))])


def _log(wh: Warehouse, level: str, ranges: list[Range]) -> None:
    lines = [json.dumps([edge.isoformat() for edge in r]) for r in merged(ranges)]
    wh.put(f"{_folder(wh, level)}/{uuid.uuid4().hex}", "\n".join(lines))


def pending(wh: Warehouse, level: str) -> tuple[list[str], list[Range]]:
    """Files of a level's log, and the ranges in them, merged and in order."""
    folder = _folder(wh, level)
    files = [f"{folder}/{name}" for name in wh.names(folder)]
    lines = [json.loads(line) for path in files for line in wh.text(path).splitlines()]
    return files, merged([tuple(map(datetime.fromisoformat, line)) for line in lines])


def divided(ranges: list[Range], lo: datetime, hi: datetime) -> tuple[list[Range], list[Range]]:
    """Parts of the ranges inside [lo, hi), and the parts outside."""
    inside, outside = [], []
    for a, b in ranges:
        cut = (a, min(b, lo)), (max(a, lo), min(b, hi)), (max(a, hi), b)
        for place, (begin, end) in zip((outside, inside, outside), cut):
            if begin < end:
                place.append((begin, end))
    return inside, outside


def refresh_touched(wh: Warehouse, level: str, lo: datetime, hi: datetime) -> Refreshed:
    """Rebuild the buckets of a level in [lo, hi), whole buckets, that the log names."""
    done = Refreshed(level)
    with wh.claim(level) as check:
        files, ranges = pending(wh, level)
        inside, done.left = divided(ranges, lo, hi)
        if not inside and len(files) < 2:
            return done
        if inside:
            done.rebuilt = [b for r in inside for b in buckets_of(*r, level, wh.cfg.zone)]
            _rebuild(wh, level, done, check)
        if done.left:
            _log(wh, level, done.left)
        for path in files:
            wh.delete(path)
    return done


def _rebuild(wh: Warehouse, level: str, done: Refreshed, check) -> None:
    """Build the buckets anew and replace the date partitions in which one of them differs.

    Only dates of these buckets are opened, of the source and of the level. Buckets are a bounded
    list, as many as the window has.
    """
    table, column, _ = SOURCES[level]
    zone = wh.cfg.zone
    buckets = F.broadcast(wh.spark.createDataFrame([(b,) for b in done.rebuilt], "_bucket timestamp_ntz"))
    spans = (0, 24) if BUCKET_WIDTHS[level] is None else (0,)  # a local day lies on two dates
    days = {(b + timedelta(hours=h)).date() for b in done.rebuilt for h in spans}
    source = wh.read(table, sorted(map(str, days)))
    placed = source.withColumn("_bucket", level_bucket(F.col(column), level, zone))
    fresh = aggregate(wh, level, placed.join(buckets, "_bucket", "left_semi").drop("_bucket"))
    stored = wh.read(level, sorted({str(b.date()) for b in done.rebuilt}))
    fresh = fresh.withColumn("bucket_date", F.col("bucket").cast("date")).select(*stored.columns).persist()
    inside = stored["bucket"] == buckets["_bucket"]
    old = stored.join(buckets, inside, "left_semi")
    both = fresh.withColumn("_n", F.lit(1)).unionByName(old.withColumn("_n", F.lit(-1)))
    differ = both.groupBy(*stored.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0").select("bucket").distinct()
    done.changed = sorted(row["bucket"] for row in differ.collect())
    done.rewritten = sorted({str(b.date()) for b in done.changed})
    if done.changed:
        rows = fresh.unionByName(stored.join(buckets, inside, "left_anti"))
        check()
        # logged before, in case this job dies once the rows are visible, and after, in case the
        # coarser level is refreshed before they are
        log_times(wh, level, done.changed)
        wh.replace_partitions(level, rows.where(F.col("bucket_date").cast("string").isin(done.rewritten)), done.rewritten)
        log_times(wh, level, done.changed)
    fresh.unpersist()


def refresh_invalid(wh: Warehouse, level: str, now: datetime) -> Refreshed:
    """What the log names inside the window of the level's policy."""
    require_window(wh, level)
    return refresh_touched(wh, level, *refresh_window(wh.cfg, level, now))


def refresh_all_invalid(wh: Warehouse, now: datetime) -> list[Refreshed]:
    """All levels, finer ones first, so that what changes is passed on in the same run."""
    return [refresh_invalid(wh, level, now) for level in REFRESH_ORDER]
