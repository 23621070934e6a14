"""Transit tables derived from the driver's generic tables.

Every function reads whole tables and maps their columns; `registry.oracle` states the
same mapping in SQL.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import CANCELLED, DEFAULTS, MERGE_KEYS, OBSERVED, SKIPPED_STOP, WEEKDAY_FLAGS
from .functions.clock import local_date
from .operators.merge import PACKAGE_ORDER, keep_first
from .operators.schedule import build_schedule, near_trip
from .operators.skew import hot_keys

TODAY = date(1998, 3, 1)  # package selection
DATES_FROM, DATES_TO = date(2023, 12, 1), date(2024, 2, 15)  # date dimension


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _prefixed(letter: str, value: Column) -> Column:
    return F.concat(F.lit(letter), value.cast("string"))


def _keyed(letter: str, value: Column, known: Column) -> Column:
    """The key, or one that nothing refers to: a gap in a join without leaving out a row."""
    return F.concat(F.when(known, letter).otherwise("X"), value.cast("string"))


def _yyyymmdd(day: Column) -> Column:
    return F.replace(day.cast("string"), F.lit("-"), F.lit(""))


# ------------------------------------------------------------------ facts from events


def fact_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    cancelled, skipped = F.col("event_type") == "error", F.col("event_type") == "signup"
    day = local_date(F.col("ts"), DEFAULTS.zone)
    return ev.select(
        "ts",
        F.when(F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"), 1).otherwise(2).alias("version_id"),
        _prefixed("T", F.col("user_id")).alias("trip_id"),
        _prefixed("S", k % 50).alias("stop_id"),
        k.alias("stop_sequence"),
        _prefixed("L", F.col("user_id") % 20).alias("line_id"),
        _prefixed("O", F.col("user_id") % 5).alias("operator_id"),
        (F.col("user_id") % 2).cast("string").alias("direction"),
        F.date_sub(day, F.when(k % 3 == 0, 1).otherwise(0)).alias("service_date"),
        F.when(~cancelled & ~skipped, F.floor("value").cast("int") - 60).alias("delay_s"),
        F.when(cancelled, CANCELLED).when(skipped, SKIPPED_STOP).otherwise(OBSERVED).alias("status"),
    )


def fact_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows: one cycle per order."""
    o = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    return o.select(
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey").cast("decimal(18,6)")))
        .alias("started_at"),
        F.col("o_orderdate").alias("snapshot_ts"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("observed"),
        F.floor(F.col("o_totalprice") / 2000).cast("int").alias("inserted"),
        (F.floor("o_totalprice") % 1000).cast("int").alias("seconds"),
        F.when(status == "F", "OK").when(status == "O", "SKIPPED").otherwise("ERROR").alias("status"),
        F.when(status == "P", F.col("o_orderpriority")).alias("error"),
    )


# ------------------------------------------------------------------ package tables


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not unique on its merge key; the four trailing columns give the merge order."""
    li = table(spark, sf_dir, "lineitem")
    hour = F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0")
    return li.select(
        _prefixed("T", F.col("l_orderkey")).alias("trip_id"),
        _prefixed("S", F.col("l_suppkey")).alias("stop_id"),
        F.col("l_linenumber").cast("string").alias("stop_sequence"),
        F.concat(hour, F.lit(":30:00")).alias("arrival_time"),
        *STOP_TIMES_ORDER,
    )


STOP_TIMES_ORDER = ["l_shipdate", "l_partkey", "l_quantity", "l_extendedprice"]


def merged_stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(stop_times(spark, sf_dir), MERGE_KEYS["stop_times"], STOP_TIMES_ORDER)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _prefixed("T", F.col("o_orderkey")).alias("trip_id"),
        _prefixed("L", F.col("o_custkey")).alias("route_id"),
        F.col("o_orderstatus").alias("direction_id"),
        F.col("o_orderpriority").alias("trip_headsign"),
    )


def trips_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ext rows of cheap orders name no trip, which leaves gaps in the left join."""
    return table(spark, sf_dir, "orders").select(
        _keyed("T", F.col("o_orderkey"), F.col("o_totalprice") >= 50000).alias("trip_id"),
        _prefixed("O", F.col("o_custkey") % 5).alias("operator_id"),
    )


def schedule(spark: SparkSession, sf_dir: str, of_trips: DataFrame | None = None) -> DataFrame:
    """The schedule, or that of some trips, whose stop times are then the only ones to be merged."""
    times = stop_times(spark, sf_dir)
    wanted = trips(spark, sf_dir)
    if of_trips is not None:
        wanted = wanted.join(of_trips, "trip_id", "left_semi")
        times = times.join(of_trips, "trip_id", "left_semi")
    hot = hot_keys(times, ["trip_id"])
    merged = keep_first(near_trip(times, hot), MERGE_KEYS["stop_times"], STOP_TIMES_ORDER)
    return build_schedule(merged, wanted, trips_ext(spark, sf_dir), hot)


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.array(*map(F.lit, ["0", "3", "11", "700"]))
    return table(spark, sf_dir, "part").select(
        _prefixed("L", F.col("p_partkey")).alias("route_id"),
        F.col("p_brand").alias("route_short_name"),
        F.col("p_name").alias("route_long_name"),
        F.element_at(codes, (F.col("p_size") % 4 + 1)).alias("route_type"),
    )


def routes_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ext rows of small parts name no route; one type is empty."""
    return table(spark, sf_dir, "part").select(
        _keyed("L", F.col("p_partkey"), F.col("p_size") > 10).alias("route_id"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("route_type_1"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("s_nationkey")
    return table(spark, sf_dir, "supplier").select(
        _prefixed("S", F.col("s_suppkey")).alias("stop_id"),
        F.col("s_name").alias("stop_name"),
        F.when(F.col("s_acctbal") < 0, "abc").otherwise((50 + nation / F.lit(100.0)).cast("string")).alias("stop_lat"),
        (19 + F.col("s_suppkey") / F.lit(10000.0)).cast("string").alias("stop_lon"),
    )


def stops_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ext rows of poor suppliers name no stop; some have no attributes."""
    nation = F.col("s_nationkey")
    return table(spark, sf_dir, "supplier").select(
        _keyed("S", F.col("s_suppkey"), F.col("s_acctbal") >= 1000).alias("stop_id"),
        F.concat_ws("_", nation.cast("string"), F.lit("99")).alias("community_ids"),
        F.concat(F.lit("City "), nation.cast("string")).alias("city"),
        F.when(F.col("s_acctbal") >= 3000, F.concat_ws("_", (nation % 7).cast("string"), F.lit("1"))).alias(
            "stop_attribute_ids"
        ),
    )


def communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations from 20 on go by another key, so that some stops name an unknown commune."""
    return table(spark, sf_dir, "nation").select(
        _keyed("", F.col("n_nationkey"), F.col("n_nationkey") < 20).alias("community_id"), F.col("n_name").alias("community_name")
    )


def stop_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("stop_type_id"), F.col("r_name").alias("stop_attr_name")
    )


def operators_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _prefixed("O", F.col("c_custkey")).alias("operator_id"), F.col("c_name").alias("operator_name")
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods from orders, moved into the range of the date dimension; many repeat.

    Services 1-12 take turns, a period lasts up to six days and runs on the weekdays that
    its order's price and priority pick.
    """
    o = table(spark, sf_dir, "orders")
    place = F.datediff("o_orderdate", F.lit(date(1995, 1, 1))) % 75
    start = F.date_add(F.lit(date(2023, 11, 20)), place)
    rush = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    week = F.when(F.col("o_totalprice") >= 100000, "1").otherwise("0")
    return o.select(
        (place % 12 + 1).cast("string").alias("service_id"),
        _yyyymmdd(start).alias("start_date"),
        _yyyymmdd(F.date_add(start, (F.col("o_custkey") % 6).cast("int"))).alias("end_date"),
        *[week.alias(flag) for flag in WEEKDAY_FLAGS[:5]],
        *[F.when(rush, "1").otherwise("0").alias(flag) for flag in WEEKDAY_FLAGS[5:]],
        (F.month("o_orderdate")).alias("pkg_ord"),
        F.col("o_orderkey").alias("line_no"),
    )


def merged_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(calendar(spark, sf_dir), MERGE_KEYS["calendar"], PACKAGE_ORDER)


def service_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names per service and package: several names per id, the same name in many packages.

    The entries of service 12 go by another id, and service 11 has one with an empty name.
    """
    service = F.col("c_custkey") % 12 + 1
    name = F.when(service != 11, F.concat("c_mktsegment", F.lit(" "), service.cast("string")))
    return table(spark, sf_dir, "customer").select(
        _keyed("", service, service != 12).alias("service_id"),
        name.alias("name"),
        F.col("c_nationkey").alias("pkg_ord"),
        F.col("c_custkey").alias("line_no"),
    )


def merged_service_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(service_ext(spark, sf_dir), MERGE_KEYS["service_ext"], PACKAGE_ORDER)


def version_of(status: Column) -> Column:
    return F.when(status == "F", 1).when(status == "O", 2).otherwise(3)


def dim_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version per order status, loaded on the last day that has such an order."""
    version_id = version_of(F.col("o_orderstatus")).alias("version_id")
    return table(spark, sf_dir, "orders").groupBy(version_id).agg(
        F.concat(F.lit("orders "), F.count(F.lit(1)).cast("string")).alias("package_names"),
        F.min("o_orderdate").cast("date").alias("valid_from"),
        F.max("o_orderdate").cast("date").alias("valid_to"),
        F.max("o_orderdate").alias("loaded_at"),
    )


# ------------------------------------------------------------------ catalogue


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One resource per order; a third is not a package, some names go on after `.zip`.

    The name's date says nothing about the period, which starts around `TODAY` and lasts
    up to ten days.
    """
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.replace(F.col("o_orderdate").cast("date").cast("string"), F.lit("-"), F.lit("."))
    core = F.concat(
        F.when(status == "P", "old_").otherwise(""),
        F.lit("schedule_ZTM_"), day, F.lit("_"),
        F.col("o_custkey").cast("string"), F.lit("_"), F.col("o_orderkey").cast("string"), F.lit(".zip"),
        F.when(priority == "5-LOW", ".bak").otherwise(""),
    )
    start = F.date_add(F.lit(date(1998, 2, 15)), (F.col("o_custkey") % 40).cast("int"))
    return table(spark, sf_dir, "orders").select(
        F.when(priority != "4-NOT SPECIFIED", core).alias("name"),
        F.concat(F.lit("https://example.org/"), F.col("o_orderkey").cast("string")).alias("url"),
        _yyyymmdd(start).alias("feed_start_date"),
        _yyyymmdd(F.date_add(start, (F.col("o_orderkey") % 10).cast("int"))).alias("feed_end_date"),
    )


# ------------------------------------------------------------------ snapshots


def _entity(entity_id: Column, trip_id: Column, relationship: Column, updates: Column, present: Column) -> Column:
    trip = F.struct(trip_id.alias("tripId"), relationship.alias("scheduleRelationship"))
    update = F.struct(trip.alias("trip"), updates.alias("stopTimeUpdate"))
    return F.array(
        F.struct(entity_id.cast("string").alias("id"), F.when(present, update).alias("tripUpdate"))
    )


def _update(sequence: Column, relationship: Column, delay: Column) -> Column:
    arrival = F.when(delay.isNotNull(), F.struct(delay.alias("delay")))
    return F.struct(
        sequence.cast("int").alias("stopSequence"),
        relationship.alias("scheduleRelationship"),
        arrival.alias("arrival"),
    )


def _header(day: str) -> Column:
    """Snapshot time: one snapshot per distinct day of the table, 1009 s apart from 2024 on."""
    place = F.datediff(F.col(day).cast("date"), F.lit(date(1995, 1, 1))).cast("bigint")
    return F.struct((F.lit(1704067200) + place * 1009).cast("string").alias("timestamp"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested feed records with one entity each.

    A lineitem gives an entity with two stop updates: its own line number (missing for
    some, skipped for returned goods, partly without an arrival) and the following one.
    Some entities lack the trip update or the trip id. An urgent, partly shipped order
    gives a cancelled trip, whose own stop update is to be ignored; other orders give
    entities without a trip update.
    """
    returned = F.when(F.col("l_returnflag") == "R", "SKIPPED")
    delay = F.when(
        (F.col("l_returnflag") != "N") | (F.col("l_linestatus") != "O"),
        F.floor("l_extendedprice").cast("int") % 600 - 120,
    )
    sequence = F.when(F.col("l_tax") < 0.08, F.col("l_linenumber"))
    nothing = F.lit(None).cast("string")
    running = table(spark, sf_dir, "lineitem").select(
        _header("l_shipdate").alias("header"),
        _entity(
            F.col("l_orderkey"),
            F.when(F.col("l_quantity") == 49, "").otherwise(_prefixed("T", F.col("l_orderkey"))),
            nothing,
            F.array(
                _update(sequence, returned, delay),
                _update(F.col("l_linenumber") + 1, nothing, F.col("l_quantity").cast("int")),
            ),
            F.col("l_quantity") < 50,
        ).alias("entity"),
    )
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    cancelled = table(spark, sf_dir, "orders").select(
        _header("o_orderdate").alias("header"),
        _entity(
            F.col("o_orderkey"),
            _prefixed("T", F.col("o_orderkey")),
            F.lit("CANCELED"),
            F.array(_update(F.lit(1), nothing, F.lit(0))),
            urgent,
        ).alias("entity"),
    )
    return running.unionByName(cancelled)


def snapshot_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival order is the order key, the snapshot time the order date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("arrival"), F.col("o_orderdate").alias("ts")
    )


