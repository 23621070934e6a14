"""Report tables over the aggregates, the dimensions and the facts.

Measures are summed per key before the dimensions are joined, so the joins see one row
per line, stop or day.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CANCELLED, OBSERVED, RUN_ERROR
from ..functions.clock import ntz
from ..functions.measures import ratio
from ..warehouse import Warehouse


def _totals() -> list:
    return [F.sum(name).alias(name) for name in ["obs", "on_time", "delay_sum", "cancelled", "skipped"]]


def _rates() -> list:
    return [
        ratio(F.col("on_time"), F.col("obs")).alias("punctuality"),
        ratio(F.col("delay_sum"), F.col("obs")).alias("mean_delay_s"),
    ]


def punctuality(agg: DataFrame) -> DataFrame:
    """Share of observations on time, over everything."""
    totals = agg.agg(F.sum("on_time").alias("on_time"), F.sum("obs").alias("obs"))
    return totals.select("on_time", "obs", _rates()[0])


def delay_by_line(agg: DataFrame, dim_line: DataFrame) -> DataFrame:
    """Mean delay per line: sum of delays over number of observations, never a mean of means."""
    per_line = agg.groupBy("line_id").agg(*_totals())
    names = dim_line.select("line_id", "short_name", "mode", "line_type")
    return per_line.join(names, "line_id", "left").select(
        "line_id", "short_name", "mode", "line_type", "obs", "delay_sum", *_rates()
    )


def delay_by_operator(agg: DataFrame, dim_operator: DataFrame) -> DataFrame:
    per_operator = agg.groupBy("operator_id").agg(*_totals())
    names = dim_operator.select("operator_id", F.col("name").alias("operator_name"))
    return per_operator.join(names, "operator_id", "left").select(
        "operator_id", "operator_name", "obs", "delay_sum", *_rates()
    )


def most_cancelled_lines(agg: DataFrame, dim_line: DataFrame, k: int = 10) -> DataFrame:
    """Lines with the most cancelled stop rows (each snapshot of a cancellation counts)."""
    top = (
        agg.groupBy("line_id")
        .agg(F.sum("cancelled").alias("cancelled"))
        .orderBy(F.desc("cancelled"), "line_id")
        .limit(k)
    )
    return top.join(dim_line.select("line_id", "short_name"), "line_id", "left")


def most_cancelled_trips(facts: DataFrame, k: int = 10) -> DataFrame:
    """Trips cancelled on the most operating days, with their cancelled stop rows."""
    per_day = (
        facts.where(F.col("status") == CANCELLED)
        .groupBy("line_id", "trip_id", "service_date")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    per_trip = per_day.groupBy("line_id", "trip_id").agg(
        F.count(F.lit(1)).alias("days"), F.sum("rows").alias("rows")
    )
    return per_trip.orderBy(F.desc("days"), F.desc("rows"), "trip_id", "line_id").limit(k)


def cancelled_trips_by_line(facts: DataFrame) -> DataFrame:
    """Cancelled trips per line, each trip counted once per operating day."""
    runs = facts.where(F.col("status") == CANCELLED).select("line_id", "trip_id", "service_date").distinct()
    return runs.groupBy("line_id").agg(F.count(F.lit(1)).alias("cancelled_trips"))


def delay_map(facts: DataFrame, dim_stop: DataFrame) -> DataFrame:
    """Map points: delay per stop with its position."""
    per_stop = (
        facts.where(F.col("status") == OBSERVED)
        .groupBy("stop_id")
        .agg(F.count(F.lit(1)).alias("obs"), F.sum("delay_s").alias("delay_sum"))
    )
    points = dim_stop.select("stop_id", "name", "lat", "lon")
    return per_stop.join(points, "stop_id", "left").select(
        "stop_id", "name", "lat", "lon", "obs", ratio(F.col("delay_sum"), F.col("obs")).alias("mean_delay_s")
    )


def by_calendar(agg: DataFrame, dim_date: DataFrame, *parts: str) -> DataFrame:
    """Punctuality per day type, weekday, month or any other part of the date dimension."""
    per_day = agg.groupBy("service_date").agg(*_totals())
    joined = per_day.join(dim_date, per_day["service_date"] == dim_date["date"], "left")
    return joined.groupBy(*parts).agg(*_totals()).select(*parts, "obs", "cancelled", "skipped", *_rates())


def by_version(agg: DataFrame, dim_version: DataFrame) -> DataFrame:
    """History per schedule version; old facts keep the version they were matched with."""
    per_version = agg.groupBy("version_id").agg(*_totals())
    names = dim_version.select("version_id", "package_names", "valid_from", "valid_to")
    return per_version.join(names, "version_id", "left").select(
        "version_id", "package_names", "valid_from", "valid_to", "obs", "cancelled", *_rates()
    )


def pipeline_health(runs: DataFrame) -> DataFrame:
    """Cycles, stored rows and time per status and day."""
    return runs.groupBy("status", F.col("started_at").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("cycles"),
        F.sum("observed").alias("observed"),
        F.sum("inserted").alias("inserted"),
        F.max("seconds").alias("max_seconds"),
    )


def latest_failures(runs: DataFrame, k: int = 20) -> DataFrame:
    failed = runs.where(F.col("status") == RUN_ERROR)
    latest = failed.orderBy(F.desc("started_at"), F.desc("snapshot_ts")).limit(k)
    return latest.select("started_at", "snapshot_ts", "error")


def recent_facts(facts: DataFrame, key: str, value: str, since: datetime, k: int = 100) -> DataFrame:
    """Latest facts of one line or operator; `since` prunes date partitions of a stored table."""
    rows = facts.where((F.col(key) == value) & (F.col("ts") >= ntz(since)))
    if "ts_date" in facts.columns:
        rows = rows.where(F.col("ts_date") >= F.lit(since.date()))
    ties = ["trip_id", "stop_id", "stop_sequence"]
    return rows.orderBy(F.desc("ts"), *ties).limit(k).select(
        "ts", key, "trip_id", "stop_id", "stop_sequence", "delay_s", "status"
    )


def newest_rows(wh: Warehouse, table: str, keep: Column, order: list[Column | str], k: int) -> DataFrame:
    """First `k` rows in `order`, which begins with the time that the table is partitioned by, newest first.

    Date partitions are opened from the newest on, one, two, four and so on more at a time, until
    they hold `k` rows that `keep` lets pass: all older rows come behind these.
    """
    waiting, opened, found, step = wh.partitions(table)[::-1], [], 0, 1
    while waiting and found < k:
        more, waiting = waiting[:step], waiting[step:]
        found += wh.read(table, more).where(keep).limit(k - found).count()
        opened += more
        step *= 2
    return wh.read(table, opened).where(keep).orderBy(*order).limit(k)


def recent_stored_facts(wh: Warehouse, key: str, value: str, k: int = 100) -> DataFrame:
    """As `recent_facts` on the stored facts, however long ago the latest ones are."""
    order = [F.desc("ts"), "trip_id", "stop_id", "stop_sequence"]
    return newest_rows(wh, "fact_delay", F.col(key) == value, order, k).select(
        "ts", key, "trip_id", "stop_id", "stop_sequence", "delay_s", "status"
    )


def latest_stored_failures(wh: Warehouse, k: int = 20) -> DataFrame:
    """As `latest_failures` on the stored audit rows."""
    order = [F.desc("started_at"), F.desc("snapshot_ts")]
    return newest_rows(wh, "fact_run", F.col("status") == RUN_ERROR, order, k).select("started_at", "snapshot_ts", "error")
