"""Backfill in chunks that can be taken up again where it stopped.

A ledger of the job holds its plan, ranges of about equal stored size, and a row for each chunk
that is done. A job that is started again with the same bounds finds its plan and goes on with the
first open chunk. The chunk that was under way is built again, which replaces its buckets.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from ..functions.clock import BUCKET_WIDTHS, bucket_ceiling, bucket_start
from ..warehouse import Warehouse
from .invalidate import fed_by, invalidate
from .maintain import SOURCES, recompute

CHUNK_BYTES = 4 << 30  # of the source, as stored
PLAN = "chunk int, lo timestamp_ntz, hi timestamp_ntz, bytes bigint"
DONE = "chunk int"


def chunks(wh: Warehouse, level: str, lo: datetime, hi: datetime, chunk_bytes: int) -> list[tuple]:
    """(chunk, lo, hi, bytes): consecutive ranges over whole dates of the source, up to `chunk_bytes`
    each or a single date. Dates without data belong to the chunk around them."""
    table, width, zone = SOURCES[level][0], BUCKET_WIDTHS[level], wh.cfg.zone
    found, begin, held = [], lo, 0
    day = lo.date()
    while day <= hi.date():
        size = wh.stored_bytes(table, str(day))
        edge = bucket_start(datetime(day.year, day.month, day.day), width, zone)
        if held and held + size > chunk_bytes and begin < edge < hi:
            found.append((len(found), begin, edge, held))
            begin, held = edge, 0
        held += size
        day += timedelta(days=1)
    return [*found, (len(found), begin, hi, held)]


def backfill_chunks(
    wh: Warehouse, level: str, first: datetime, last: datetime, chunk_bytes: int = CHUNK_BYTES
) -> list[int]:
    """Fill the whole buckets in [first, last); returns the chunks that this run has built.

    What is built is logged for the coarser levels. Once every chunk is done the ledger goes, so
    that the same bounds can be filled again.
    """
    width, zone = BUCKET_WIDTHS[level], wh.cfg.zone
    lo, hi = bucket_ceiling(first, width, zone), bucket_start(last, width, zone)
    if lo >= hi:
        return []
    job = f"{level}-{lo:%Y%m%dT%H%M}-{hi:%Y%m%dT%H%M}"
    ledger = wh.path(f"_backfill/{job}")
    with wh.claim(f"backfill-{job}") as check:
        if not wh.names(f"{ledger}/plan"):
            plan = wh.spark.createDataFrame(chunks(wh, level, lo, hi, chunk_bytes), PLAN)
            plan.coalesce(1).write.mode("append").parquet(f"{ledger}/plan")
        planned = wh.spark.read.schema(PLAN).parquet(f"{ledger}/plan").orderBy("chunk").collect()
        done = set()
        if wh.names(f"{ledger}/done"):
            done = {row["chunk"] for row in wh.spark.read.schema(DONE).parquet(f"{ledger}/done").collect()}
        built = []
        for row in planned:
            if row["chunk"] in done:
                continue
            check()
            for coarser in fed_by(level):
                invalidate(wh, coarser, row["lo"], row["hi"])
            recompute(wh, level, row["lo"], row["hi"])
            for coarser in fed_by(level):
                invalidate(wh, coarser, row["lo"], row["hi"])
            wh.spark.createDataFrame([(row["chunk"],)], DONE).coalesce(1).write.mode("append").parquet(f"{ledger}/done")
            built.append(row["chunk"])
        wh.delete(ledger)
    return built
