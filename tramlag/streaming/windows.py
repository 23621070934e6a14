"""Aggregates kept up to date by a stream: event-time windows over the facts as they are appended.

A window's measures are state until the watermark has passed its end, and every micro-batch
upserts the buckets that it has changed. Facts that come after that are left to the refresh by
invalidation, which their append has logged.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.clock import BUCKET_WIDTHS, from_instant, to_instant
from ..functions.measures import fact_measures
from ..operators.rollup import LINE_KEYS, STOP_KEYS
from ..plans.invalidate import log_touched
from ..schemas import TABLES
from ..warehouse import FIRST_GENERATION, ClaimedError, Warehouse

log = logging.getLogger(__name__)

WATERMARK = "3 hours"  # how far a fact may lag behind the newest one of the stream
CLAIM_TRIES, CLAIM_WAIT_S = 60, 2.0  # a refresh of the level may be under way


def appended_facts(wh: Warehouse, max_files: int | None = None) -> DataFrame:
    """Stream of the facts that are appended. Compacted partitions are generations of their own,
    so that no fact comes twice; what is appended to a date after its compaction is not seen."""
    reader = wh.spark.readStream.schema(f"{TABLES['fact_delay']}, gen string").option("basePath", wh.path("fact_delay"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{wh.path('fact_delay')}/ts_date=*/gen={FIRST_GENERATION}").drop("gen")


def windowed(facts: DataFrame, level: str, wh: Warehouse, watermark: str) -> DataFrame:
    """Rows of a level over a stream (or a table) of facts, by event-time windows."""
    width, zone = BUCKET_WIDTHS[level], wh.cfg.zone
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("ts"))
    at = to_instant(local if width is None else F.col("ts"))  # local days are days of the local clock
    span = "1 day" if width is None else f"{int(width.total_seconds())} seconds"
    keys = STOP_KEYS if level == "agg_stop_15m" else LINE_KEYS
    groups = facts.withColumn("at", at).withWatermark("at", watermark).groupBy(F.window("at", span).alias("span"), *keys)
    start = from_instant(F.col("span.start"))
    if width is None:
        start = F.convert_timezone(F.lit(zone), F.lit("UTC"), start)
    rows = groups.agg(*fact_measures(wh.cfg)).withColumn("bucket", start)
    return rows.withColumn("bucket_date", F.col("bucket").cast("date")).select(*_columns(level))


def _columns(level: str) -> list[str]:
    return [part.split()[0] for part in TABLES[level].replace("\n", " ").split(",")]


def upsert_buckets(wh: Warehouse, level: str, rows: DataFrame) -> list[str]:
    """Put aggregate rows in place of those of the same keys, null keys being equal; returns the dates.

    Dates without a change are left alone: rows of a repeated micro-batch replace nothing.
    """
    keys = ["bucket", *(STOP_KEYS if level == "agg_stop_15m" else LINE_KEYS)]
    rows = rows.persist()
    try:
        stored = wh.read(level, [str(r[0]) for r in rows.select("bucket_date").distinct().collect()])
        new = rows.exceptAll(stored).persist()
        dates = sorted(str(r[0]) for r in new.select("bucket_date").distinct().collect())
        if dates:
            same = [stored[k].eqNullSafe(new[k]) for k in keys]
            kept = stored.where(F.col("bucket_date").cast("string").isin(dates)).join(new, same, "left_anti")
            log_touched(wh, level, new, "bucket")
            wh.replace_partitions(level, kept.unionByName(new), dates)
            log_touched(wh, level, new, "bucket")
        new.unpersist()
        return dates
    finally:
        rows.unpersist()


def _claimed(wh: Warehouse, level: str, stack: ExitStack, wait: Callable[[float], None]) -> None:
    for left in reversed(range(CLAIM_TRIES)):
        try:
            stack.enter_context(wh.claim(level))
            return
        except ClaimedError:
            if not left:
                raise
            wait(CLAIM_WAIT_S)


def stream_level(
    wh: Warehouse,
    level: str,
    checkpoint: str,
    watermark: str = WATERMARK,
    once: bool = False,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start the query that keeps one level; `once` works off what has been appended and stops.

    A micro-batch that dies is repeated by Spark with the same rows, which changes nothing.
    """

    def put(rows: DataFrame, batch_id: int) -> None:
        with ExitStack() as stack:
            _claimed(wh, level, stack, time.sleep)
            dates = upsert_buckets(wh, level, rows)
        log.info("%s, batch %s: %s", level, batch_id, dates)

    writer = (
        windowed(appended_facts(wh, max_files), level, wh, watermark)
        .writeStream.outputMode("update")
        .foreachBatch(put)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if once else {"processingTime": f"{wh.cfg.poll_seconds} seconds"}
    return writer.trigger(**trigger).start()
