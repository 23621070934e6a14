"""Jobs for spark-submit or `python -m tramlag`; an external scheduler repeats them.

    static-load --root R --landing DIR --catalogue FILE [--today DATE] [--horizon N]
    live        --root R --landing DIR --checkpoint DIR [--once] [--max-files N]
    replay      --root R
    refresh     --root R [--level NAME] [--touched] [--now TIME]
    backfill    --root R --level NAME --first TIME --last TIME [--chunk-bytes N]
    windows     --root R --level NAME --checkpoint DIR [--once] [--watermark W]
    retention   --root R [--now TIME]
    compact     --root R [--now TIME]
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import SparkSession

from .functions.clock import BUCKET_WIDTHS
from .plans import maintain
from .plans.backfill import CHUNK_BYTES, backfill_chunks
from .plans.invalidate import refresh_invalid
from .plans.static_load import load_static
from .sources.packages import read_catalogue
from .streaming.live import replay_quarantine, run_live
from .streaming.windows import WATERMARK, stream_level
from .warehouse import Warehouse, clock_now


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tramlag", description="Transit delay warehouse jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.add_argument("--root", required=True, help="warehouse folder on shared storage")
        return sub

    load = job("static-load")
    load.add_argument("--landing", required=True, help="folder of the landed packages")
    load.add_argument("--catalogue", required=True, help="landed catalogue answer (JSON)")
    load.add_argument("--today", type=date.fromisoformat, default=None)
    load.add_argument("--horizon", type=int, default=None)
    load.add_argument("--keep-known-day-type", action="store_true")

    live = job("live")
    live.add_argument("--landing", required=True, help="folder of the landed snapshots")
    live.add_argument("--checkpoint", required=True)
    live.add_argument("--once", action="store_true", help="process what has landed, then stop")
    live.add_argument("--max-files", type=int, default=1)
    live.add_argument("--on-orphans", choices=["fail", "quarantine"], default="fail")

    job("replay")
    refresh = job("refresh")
    refresh.add_argument("--level", choices=list(BUCKET_WIDTHS), default=None)
    refresh.add_argument("--touched", action="store_true", help="only what appends have touched since")
    fill = job("backfill")
    fill.add_argument("--level", choices=list(BUCKET_WIDTHS), required=True)
    fill.add_argument("--first", type=datetime.fromisoformat, required=True)
    fill.add_argument("--last", type=datetime.fromisoformat, required=True)
    fill.add_argument("--chunk-bytes", type=int, default=CHUNK_BYTES)
    windows = job("windows")
    windows.add_argument("--level", choices=list(BUCKET_WIDTHS), required=True)
    windows.add_argument("--checkpoint", required=True)
    windows.add_argument("--once", action="store_true", help="process what has been appended, then stop")
    windows.add_argument("--watermark", default=WATERMARK)
    keep = job("retention")
    pack = job("compact")
    for sub in (refresh, keep, pack):
        sub.add_argument("--now", type=datetime.fromisoformat, default=None, help="UTC, default: the clock")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse(argv)
    spark = spark or SparkSession.builder.appName(f"tramlag {args.job}").getOrCreate()
    wh = Warehouse(spark, args.root)
    now = getattr(args, "now", None) or clock_now()
    if args.job == "static-load":
        today = args.today or datetime.now().date()
        catalogue = read_catalogue(spark, args.catalogue)
        load_static(wh, args.landing, catalogue, today, now, args.horizon, args.keep_known_day_type)
    elif args.job == "live":
        run_live(
            wh, args.landing, args.checkpoint, args.once, args.max_files, args.on_orphans
        ).awaitTermination()
    elif args.job == "replay":
        replay_quarantine(wh)
    elif args.job == "refresh":
        for level in [args.level] if args.level else maintain.REFRESH_ORDER:
            (refresh_invalid if args.touched else maintain.refresh)(wh, level, now)
    elif args.job == "backfill":
        backfill_chunks(wh, args.level, args.first, args.last, args.chunk_bytes)
    elif args.job == "windows":
        stream_level(wh, args.level, args.checkpoint, args.watermark, args.once).awaitTermination()
    elif args.job == "compact":
        maintain.compact_closed(wh, now)
    else:
        maintain.apply_retention(wh, now)


if __name__ == "__main__":
    main()
