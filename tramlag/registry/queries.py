"""Registered queries: each operator over whole sample tables, by inventory id."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import samples as s
from ..config import DEFAULTS, OBSERVED
from ..functions.clock import ntz
from ..functions.measures import MEASURES
from ..operators import dims as d
from ..operators import integrity, match, merge, rollup, skip, upsert
from ..operators import schedule as sched
from ..operators.skew import hot_keys
from ..plans import backfill, invalidate, maintain, reports
from ..schemas import PRIMARY_KEYS, SCHEDULE_REFERENCES
from ..session import shared_folder
from ..sources import packages as p
from ..streaming.live import process_batch, run_live
from ..streaming.windows import stream_level
from ..warehouse import Warehouse, week_start

REFRESH_NOW = datetime(2024, 1, 20, 10, 7)
RETENTION_NOW = datetime(2024, 2, 10, 12, 0)
RUN_RETENTION_NOW = datetime(2000, 6, 15, 12, 0)
AFTER_ALL = datetime(2024, 2, 10)  # past every sample fact
#: Refresh windows and retention that take in all sample facts at `AFTER_ALL`.
WIDE = replace(
    DEFAULTS,
    fact_retention=timedelta(days=90),
    refresh={level: replace(policy, start=timedelta(days=60)) for level, policy in DEFAULTS.refresh.items()},
)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


# ------------------------------------------------------------------ sources


@query
def s1_catalogue(spark, sf):
    return p.parse_catalogue(s.catalogue(spark, sf), DEFAULTS)


@query
def s2_periods(spark, sf):
    rows = p.parse_period(s.catalogue(spark, sf))
    return rows.select("name", "period_start", "period_end")


def _packages(spark, sf, horizon_days):
    raw = s.catalogue(spark, sf)
    periods = p.parse_period(raw).select("name", "period_start", "period_end")
    candidates = p.parse_catalogue(raw, DEFAULTS).join(periods, "name")
    return p.select_packages(candidates, s.TODAY, horizon_days, DEFAULTS)


@query
def s3_packages(spark, sf):
    return _packages(spark, sf, 14).select("pkg_ord", "name", "period_start", "period_end")


@query
def s3_packages_short(spark, sf):
    return _packages(spark, sf, 5).select("pkg_ord", "name", "period_start", "period_end")


@query
def s3_packages_long(spark, sf):
    return _packages(spark, sf, 20).select("pkg_ord", "name", "period_start", "period_end")


@query
def s6_current_version(spark, sf):
    versions = s.dim_version(spark, sf)
    return versions.orderBy(F.desc("loaded_at"), F.desc("version_id")).limit(1)


@query
def s7_schedule_scan(spark, sf):
    """The schedule of the version in force, of whose trips alone stop times are merged."""
    current = F.broadcast(s6_current_version(spark, sf).select("version_id"))  # one row
    trips = s.trips(spark, sf).withColumn("version_id", s.version_of(F.col("direction_id")))
    return s.schedule(spark, sf, trips.join(current, "version_id", "left_semi").select("trip_id")).drop("headsign")


# ------------------------------------------------------------------ merge


@query
def m1_concat(spark, sf):
    """Two packages with other columns in another order, as records of their own headers."""
    first = s.stops(spark, sf).select(
        F.lit(1).alias("pkg_ord"),
        F.create_map(F.lit("stop_id"), "stop_id", F.lit("stop_name"), "stop_name").alias("record"),
    )
    stop_id = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    second = s.table(spark, sf, "customer").select(
        F.lit(2).alias("pkg_ord"),
        F.create_map(F.lit("zone"), "c_mktsegment", F.lit("stop_name"), "c_name", F.lit("stop_id"), stop_id).alias("record"),
    )
    records = first.unionByName(second).select("*", F.lit("stops").alias("member"), F.lit(0).alias("line_no"))
    return p.member_table(records, "stops", ["stop_id", "stop_name", "zone"]).drop("pkg_ord", "line_no")


@query
def m2_dedup_first(spark, sf):
    return s.merged_stop_times(spark, sf)


@query
def m3_calendar(spark, sf):
    return s.merged_calendar(spark, sf)


@query
def m4_first_package(spark, sf):
    return merge.first_package(s.calendar(spark, sf)).select("service_id", "start_date", "pkg_ord", "line_no")


# ------------------------------------------------------------------ dimensions


@query
def d1_line(spark, sf):
    return d.dim_line(s.routes(spark, sf), s.routes_ext(spark, sf))


@query
def d2_stop(spark, sf):
    return d.dim_stop(
        s.stops(spark, sf), s.stops_ext(spark, sf), s.communities(spark, sf), s.stop_attributes(spark, sf)
    )


@query
def d3_operator(spark, sf):
    return d.dim_operator(s.operators_ext(spark, sf))


def _dim_date(spark, sf, first, last):
    return d.dim_date(s.merged_calendar(spark, sf), s.merged_service_ext(spark, sf), first, last, DEFAULTS)


@query
def d4_date(spark, sf):
    return _dim_date(spark, sf, s.DATES_FROM, s.DATES_TO)


@query
def d5_active_services(spark, sf):
    active = d.active_services(s.merged_calendar(spark, sf), s.DATES_FROM, s.DATES_TO)
    return active.groupBy("date", "service_id").agg(F.count(F.lit(1)).alias("periods"))


@query
def d6_primary_service(spark, sf):
    active = d.active_services(s.merged_calendar(spark, sf), s.DATES_FROM, s.DATES_TO)
    return d.primary_services(active, DEFAULTS)


@query
def d7_service_names(spark, sf):
    return d.service_names(s.merged_service_ext(spark, sf))


@query
def d9_version(spark, sf):
    return d.dim_version(
        _packages(spark, sf, 14), 7, s.TODAY, date(1998, 3, 14), datetime(1998, 3, 1, 4, 30)
    )


# ------------------------------------------------------------------ schedule


@query
def l1_trips(spark, sf):
    return sched.trips_with_operator(s.trips(spark, sf), s.trips_ext(spark, sf))


@query
def l_schedule(spark, sf):
    return s.schedule(spark, sf)


# ------------------------------------------------------------------ snapshots


def _entities(spark, sf):
    return match.trip_entities(s.snapshots(spark, sf), DEFAULTS.zone)


@query
def r2_entities(spark, sf):
    return _entities(spark, sf).select(
        "ts", "local_date", "trip_id", "cancelled", F.size("updates").alias("updates")
    )


def _feed_rows(spark, sf):
    return match.feed_rows(_entities(spark, sf))


@query
def r3_cancelled(spark, sf):
    cancelled = _feed_rows(spark, sf).where("cancelled")
    planned = match.match_side(s.schedule(spark, sf)).where("cancelled")
    rows = match.match_rows(cancelled, planned, hot_keys(cancelled, match.MATCH_KEYS))
    return rows.drop("entity_pos", "update_pos", "delay_s")


@query
def r4_stop_updates(spark, sf):
    updates = _feed_rows(spark, sf).where("not cancelled").withColumnRenamed("stop_key", "stop_sequence")
    return updates.drop("entity_pos", "cancelled")


@query
def r5_match(spark, sf):
    updates = _feed_rows(spark, sf).where("not cancelled")
    planned = match.match_side(s.schedule(spark, sf)).where("not cancelled")
    return match.match_rows(updates, planned, hot_keys(updates, match.MATCH_KEYS)).drop("entity_pos")


def _matched_facts(spark, sf):
    return match.match_snapshots(s.snapshots(spark, sf), s.schedule(spark, sf), 1, DEFAULTS)


@query
def r_facts(spark, sf):
    return _matched_facts(spark, sf).drop("entity_pos", "update_pos")


@query
def r9_stale_skip(spark, sf):
    return skip.fresh_only(s.snapshot_heads(spark, sf), ["arrival"], "ts", rows_per_range=10_000)


@query
def r13_cycle_counts(spark, sf):
    return _matched_facts(spark, sf).groupBy("ts", "status").agg(F.count(F.lit(1)).alias("observed"))


def _publish(wh, spark, sf, version_id, schedule):
    dims = {
        "dim_line": d1_line(spark, sf),
        "dim_stop": d2_stop(spark, sf),
        "dim_operator": d3_operator(spark, sf),
        "dim_date": d4_date(spark, sf),
    }
    version = spark.range(1).select(
        F.lit(version_id).alias("version_id"),
        F.lit("sample").alias("package_names"),
        F.lit(s.DATES_FROM).alias("valid_from"),
        F.lit(s.DATES_TO).alias("valid_to"),
        ntz(datetime(2023, 12, version_id)).alias("loaded_at"),
    )
    wh.publish(version, version_id, dims, schedule)


def _sample_warehouse(spark, sf):
    wh = Warehouse(spark, shared_folder(spark, "live"))
    _publish(wh, spark, sf, 1, s.schedule(spark, sf))
    return wh


@query
def s8_published_views(spark, sf):
    """Two loads one after the other; a report by SQL over the views of the version in force."""
    wh = Warehouse(spark, shared_folder(spark, "published"))
    plan = s.schedule(spark, sf)
    _publish(wh, spark, sf, 1, plan.where("direction = 'F'"))
    _publish(wh, spark, sf, 2, plan)
    wh.register_views()
    return spark.sql(
        f"""select p.version_id, l.mode, p.day_offset, count(*) as planned, count(distinct p.trip_id) as trips
            from schedule p left join dim_line l on l.line_id = p.line_id
            where p.version_id = {wh.current_version()} group by p.version_id, l.mode, p.day_offset"""
    )


@query
def w5_run_audit(spark, sf):
    """Audit rows of all snapshots, handled as one batch of the live path."""
    wh = _sample_warehouse(spark, sf)
    arrived = s.snapshots(spark, sf).select(
        "*", F.lit(0).cast("bigint").alias("arrived"), F.lit("sample").alias("file_path"), F.lit(None).cast("string").alias("corrupt")
    )
    process_batch(wh, arrived, 0, clock=lambda: AFTER_ALL)
    return wh.read("fact_run").select("snapshot_ts", "observed", "inserted", "status", "error")


@query
def r14_live_stream(spark, sf):
    """The whole live path: land snapshots as files, stream them, match, check, store.

    Snapshots of one time land in one file, so that the order of files does not decide which
    of several updates of one key is kept.
    """
    wh = _sample_warehouse(spark, sf)
    landing = shared_folder(spark, "landing")
    s.snapshots(spark, sf).repartition("header.timestamp").write.json(landing)
    stream = run_live(
        wh, landing, shared_folder(spark, "stream"), once=True, max_files=64, skip_stale=False
    )
    stream.awaitTermination()
    return wh.read("fact_delay").drop("ts_date")


# ------------------------------------------------------------------ writers and checks


@query
def w2_upsert(spark, sf):
    lines = d1_line(spark, sf)
    sizes = s.table(spark, sf, "part").select(
        F.concat(F.lit("L"), F.col("p_partkey").cast("string")).alias("line_id"), "p_size"
    )
    known = lines.join(sizes, "line_id")
    target = known.where("p_size <= 30").drop("p_size").withColumn("long_name", F.lit("before"))
    batch = known.where("p_size > 20").drop("p_size")
    return upsert.upsert(target, batch, ["line_id"])


@query
def w3_insert_ignore(spark, sf):
    """Stored: facts before 16 January. Batch: all facts twice, the copy with a later delay."""
    facts = s.fact_delay(spark, sf)
    stored = facts.where(F.col("ts") < ntz(datetime(2024, 1, 16)))
    batch = facts.withColumn("n", F.lit(1)).unionByName(
        facts.withColumn("delay_s", F.col("delay_s") + 5).withColumn("n", F.lit(2))
    )
    new = upsert.insertable(stored, batch, PRIMARY_KEYS["fact_delay"], ["n", F.asc("delay_s")])
    return new.select("ts", "trip_id", "stop_id", "stop_sequence", "delay_s", "status")


@query
def j1_unique(spark, sf):
    return integrity.duplicate_keys(s.stop_times(spark, sf), ["trip_id", "stop_id", "stop_sequence"])


def _reference_dims(spark, sf):
    return {
        "dim_stop": s.stops(spark, sf),
        "dim_line": s.routes(spark, sf).withColumnRenamed("route_id", "line_id"),
        "dim_operator": s.operators_ext(spark, sf),
        "dim_date": d.days_between(spark, date(2024, 1, 5), date(2024, 2, 15)),
        "dim_version": s.dim_version(spark, sf),
    }


@query
def j2_orphans(spark, sf):
    return integrity.orphans(s.fact_delay(spark, sf), _reference_dims(spark, sf))


@query
def j2_schedule_versions(spark, sf):
    """Planned stops of versions that nobody has loaded: those of low priority name version 9."""
    low = F.col("headsign") == "5-LOW"
    planned = s.schedule(spark, sf).withColumn("version_id", F.when(low, 9).otherwise(s.version_of(F.col("direction"))))
    return integrity.orphans(planned, {"dim_version": s.dim_version(spark, sf)}, SCHEDULE_REFERENCES)


@query
def j2_clean_facts(spark, sf):
    clean, _ = integrity.drop_orphans(s.fact_delay(spark, sf), j2_orphans(spark, sf))
    return clean.select("ts", "trip_id", "stop_id", "stop_sequence", "service_date")


@query
def j3_nulls(spark, sf):
    return integrity.null_counts(
        s.schedule(spark, sf), ["trip_id", "stop_id", "stop_sequence", "day_offset", "operator_id"]
    )


@query
def t1_retention(spark, sf):
    first = maintain.first_kept_day(RETENTION_NOW, DEFAULTS.fact_retention)
    facts = s.fact_delay(spark, sf).where(F.col("ts") >= F.lit(first).cast("timestamp_ntz"))
    return facts.select("ts", "trip_id", "stop_id", "stop_sequence", "status")


@query
def t1_retention_stored(spark, sf):
    """The retention job on stored partitions."""
    wh = Warehouse(spark, shared_folder(spark, "retention"))
    wh.append("fact_delay", s.fact_delay(spark, sf).withColumn("ts_date", F.col("ts").cast("date")))
    maintain.apply_retention(wh, RETENTION_NOW)
    return wh.read("fact_delay").select("ts", "trip_id", "stop_id", "stop_sequence", "status")


@query
def t2_run_retention(spark, sf):
    first = maintain.first_kept_day(RUN_RETENTION_NOW, DEFAULTS.run_retention, weekly=True)
    runs = s.fact_run(spark, sf).where(F.col("started_at") >= F.lit(first).cast("timestamp_ntz"))
    return runs.select("started_at", "status")


@query
def t2_run_retention_stored(spark, sf):
    """The retention job on stored audit rows."""
    wh = Warehouse(spark, shared_folder(spark, "runs"))
    runs = s.fact_run(spark, sf).withColumn("week_start", week_start(F.col("started_at")))
    wh.append("fact_run", runs.withColumn("seconds", F.col("seconds").cast("decimal(12,3)")))
    maintain.apply_retention(wh, RUN_RETENTION_NOW)
    return wh.read("fact_run").select("started_at", "status")


# ------------------------------------------------------------------ aggregates


@query
def a1_line_15m(spark, sf):
    return rollup.line_15m(s.fact_delay(spark, sf))


@query
def a2_line_1h(spark, sf):
    return rollup.line_1h(a1_line_15m(spark, sf))


@query
def a3_line_1d(spark, sf):
    return rollup.line_1d(a2_line_1h(spark, sf))


@query
def a4_stop_15m(spark, sf):
    return rollup.stop_15m(s.fact_delay(spark, sf))


@query
def a11_refresh_window(spark, sf):
    """Stored buckets know observations only; the refresh window is computed from all facts."""
    facts = s.fact_delay(spark, sf)
    lo, hi = maintain.refresh_window(DEFAULTS, "agg_line_15m", REFRESH_NOW)
    in_window = facts.where((F.col("ts") >= ntz(lo)) & (F.col("ts") < ntz(hi)))
    stored = rollup.line_15m(facts.where(F.col("status") == OBSERVED))
    return upsert.recompute_window(stored, rollup.line_15m(in_window), ntz(lo), ntz(hi))


@query
def a11_refresh_stored(spark, sf):
    """As a11_refresh_window, by the refresh job on stored tables."""
    wh = Warehouse(spark, shared_folder(spark, "refresh"))
    facts = s.fact_delay(spark, sf)
    wh.append("fact_delay", facts.withColumn("ts_date", F.col("ts").cast("date")))
    observed = rollup.line_15m(facts.where(F.col("status") == OBSERVED))
    wh.append("agg_line_15m", observed.withColumn("bucket_date", F.col("bucket").cast("date")))
    maintain.refresh(wh, "agg_line_15m", REFRESH_NOW)
    return wh.read("agg_line_15m").drop("bucket_date")


def _all_levels(wh):
    """The rows of the four levels in one table."""
    rows = None
    for level in maintain.REFRESH_ORDER:
        keys = ["line_id", "operator_id"] if level != "agg_stop_15m" else ["line_id", "stop_id"]
        measures = [F.col(c).cast("bigint").alias(c) for c in MEASURES]
        part = wh.read(level).select(F.lit(level).alias("level"), "bucket", "service_date", "version_id", *keys, *measures)
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rows


@query
def a11_refresh_all(spark, sf):
    """One scheduled refresh of all four levels, each inside the window of its policy."""
    wh = Warehouse(spark, shared_folder(spark, "levels"))
    wh.append("fact_delay", s.fact_delay(spark, sf).withColumn("ts_date", F.col("ts").cast("date")))
    maintain.refresh_all(wh, REFRESH_NOW)
    return _all_levels(wh)


@query
def a11_invalidated(spark, sf):
    """Facts in two appends that overlap in time; after each only what it touched is refreshed."""
    wh = Warehouse(spark, shared_folder(spark, "invalidated"), WIDE)
    facts = s.fact_delay(spark, sf)
    part = F.pmod(F.coalesce("stop_sequence", F.lit(0)), F.lit(50))
    for share in (part < 40, part >= 40):
        invalidate.append_facts(wh, facts.where(share))
        invalidate.refresh_all_invalid(wh, AFTER_ALL)
    return _all_levels(wh)


@query
def a12_backfill_chunks(spark, sf):
    """History filled chunk by chunk, the coarser levels by what the chunks have logged."""
    wh = Warehouse(spark, shared_folder(spark, "backfill"), WIDE)
    wh.append("fact_delay", s.fact_delay(spark, sf).withColumn("ts_date", F.col("ts").cast("date")))
    size = sum(wh.stored_bytes("fact_delay", day) for day in wh.partitions("fact_delay"))
    for level in ("agg_line_15m", "agg_stop_15m"):
        backfill.backfill_chunks(wh, level, datetime(2023, 12, 1), AFTER_ALL, size // 3)
    for level in ("agg_line_1h", "agg_line_1d"):
        invalidate.refresh_invalid(wh, level, AFTER_ALL)
    return _all_levels(wh)


def _streamed(spark, sf, level):
    """A level by event-time windows over a stream of the facts, which are appended twice."""
    wh = Warehouse(spark, shared_folder(spark, "windows"))
    facts, checkpoint = s.fact_delay(spark, sf), shared_folder(spark, "stream")
    late = F.col("status") != OBSERVED
    for share in (~late, late):
        invalidate.append_facts(wh, facts.where(share))
        stream_level(wh, level, checkpoint, watermark="60 days", once=True).awaitTermination()
    return wh.read(level).drop("bucket_date")


@query
def a1_streamed_windows(spark, sf):
    return _streamed(spark, sf, "agg_line_15m")


@query
def a3_streamed_windows(spark, sf):
    return _streamed(spark, sf, "agg_line_1d")


# ------------------------------------------------------------------ reports


def _lines(spark, sf):
    return d1_line(spark, sf)


@query
def k1_punctuality(spark, sf):
    return reports.punctuality(a3_line_1d(spark, sf))


@query
def k2_delay_by_line(spark, sf):
    return reports.delay_by_line(a1_line_15m(spark, sf), _lines(spark, sf))


@query
def k2_delay_by_operator(spark, sf):
    return reports.delay_by_operator(a2_line_1h(spark, sf), d3_operator(spark, sf))


@query
def k3_cancelled_lines(spark, sf):
    return reports.most_cancelled_lines(a3_line_1d(spark, sf), _lines(spark, sf))


@query
def k3_cancelled_trips(spark, sf):
    return reports.most_cancelled_trips(s.fact_delay(spark, sf))


@query
def k3_cancelled_trips_by_line(spark, sf):
    return reports.cancelled_trips_by_line(s.fact_delay(spark, sf))


@query
def k4_delay_map(spark, sf):
    return reports.delay_map(s.fact_delay(spark, sf), d2_stop(spark, sf))


@query
def k5_by_day_type(spark, sf):
    return reports.by_calendar(a3_line_1d(spark, sf), d4_date(spark, sf), "day_type")


@query
def k5_by_weekday(spark, sf):
    return reports.by_calendar(a3_line_1d(spark, sf), d4_date(spark, sf), "month", "iso_dow", "day_name")


@query
def k6_by_version(spark, sf):
    return reports.by_version(a3_line_1d(spark, sf), s.dim_version(spark, sf))


@query
def k7_health(spark, sf):
    return reports.pipeline_health(s.fact_run(spark, sf))


@query
def k7_failures(spark, sf):
    return reports.latest_failures(s.fact_run(spark, sf))


@query
def k8_recent_by_line(spark, sf):
    return reports.recent_facts(s.fact_delay(spark, sf), "line_id", "L3", datetime(2024, 1, 25))


@query
def k8_recent_by_operator(spark, sf):
    return reports.recent_facts(s.fact_delay(spark, sf), "operator_id", "O2", datetime(2024, 1, 25))


@query
def k8_recent_stored(spark, sf):
    """The latest facts of a line from stored date partitions, without a bound in time."""
    wh = Warehouse(spark, shared_folder(spark, "recent"))
    wh.append("fact_delay", s.fact_delay(spark, sf).withColumn("ts_date", F.col("ts").cast("date")))
    return reports.recent_stored_facts(wh, "line_id", "L3")


@query
def k7_failures_stored(spark, sf):
    wh = Warehouse(spark, shared_folder(spark, "failures"))
    runs = s.fact_run(spark, sf).withColumn("week_start", week_start(F.col("started_at")))
    wh.append("fact_run", runs.withColumn("seconds", F.col("seconds").cast("decimal(12,3)")))
    return reports.latest_stored_failures(wh)
