"""Dimension tables from merged package tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (
    DAY_NAMES,
    DEFAULT_LINE_TYPE,
    DEFAULT_STOP_TYPE,
    NO_SCHEDULE_LABEL,
    OTHER_MODE,
    TRANSPORT_MODES,
    WEEKDAY_FLAGS,
    Settings,
)
from ..functions.clock import ntz
from ..functions.lenient import lenient_double
from .skew import lookup_join


def _label(code: Column, labels: dict[str, str]) -> Column:
    """Constant lookup: the label of a code, null for an unknown one."""
    picked = F
    for key, value in labels.items():
        picked = picked.when(code == key, value)
    return picked


def dim_line(routes: DataFrame, routes_ext: DataFrame) -> DataFrame:
    """Lines with mode and type; the type default also covers lines without an ext row."""
    lines = routes.select(
        F.col("route_id").alias("line_id"),
        F.col("route_short_name").alias("short_name"),
        F.col("route_long_name").alias("long_name"),
        F.coalesce(_label(F.col("route_type"), TRANSPORT_MODES), F.lit(OTHER_MODE)).alias("mode"),
    )
    ext = routes_ext.select(F.col("route_id").alias("line_id"), F.col("route_type_1").alias("line_type"))
    return lines.join(ext, "line_id", "left").withColumn(
        "line_type", F.coalesce("line_type", F.lit(DEFAULT_LINE_TYPE))
    )


def _first_id(ids: str) -> Column:
    return F.split(F.coalesce(F.col(ids), F.lit("")), "_")[0]


def dim_stop(
    stops: DataFrame, stops_ext: DataFrame, communities: DataFrame, attributes: DataFrame
) -> DataFrame:
    """Stops with commune, city and type.

    The type default is set on the ext rows, so a stop without an ext row has no type.
    """
    base = stops.select(
        "stop_id",
        F.col("stop_name").alias("name"),
        lenient_double(F.col("stop_lat")).alias("lat"),
        lenient_double(F.col("stop_lon")).alias("lon"),
    )
    communes = communities.select(
        F.col("community_id").alias("_commune_id"), F.col("community_name").alias("commune")
    )
    types = attributes.select(
        F.col("stop_type_id").alias("_type_id"), F.col("stop_attr_name").alias("stop_type")
    )
    ext = stops_ext.select(
        "stop_id",
        "city",
        _first_id("community_ids").alias("_commune_id"),
        _first_id("stop_attribute_ids").alias("_type_id"),
    )
    # most stops share a few communes and types, hence not a plain shuffle join
    named = lookup_join(lookup_join(ext, communes, ["_commune_id"], "left"), types, ["_type_id"], "left")
    stop_type = F.coalesce("stop_type", F.lit(DEFAULT_STOP_TYPE)).alias("stop_type")
    return base.join(named.select("stop_id", "commune", "city", stop_type), "stop_id", "left")


def dim_operator(operators: DataFrame) -> DataFrame:
    return operators.select("operator_id", F.col("operator_name").alias("name"))


def days_between(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per calendar day of a fixed range."""
    span = (last - first).days + 1
    return spark.range(span).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))


def active_services(calendar: DataFrame, first: date, last: date) -> DataFrame:
    """(date, service_id) for each day of [first, last] on which a service runs.

    The range join is an explode of each period, clipped to the range, so every calendar
    row yields at most one row per day of the range.
    """
    flag = F.element_at(F.array(*WEEKDAY_FLAGS), F.weekday("date") + 1)
    return (
        calendar.withColumn("_from", F.to_date("start_date", "yyyyMMdd"))
        .withColumn("_to", F.to_date("end_date", "yyyyMMdd"))
        .where((F.col("_from") <= F.col("_to")) & (F.col("_from") <= F.lit(last)) & (F.col("_to") >= F.lit(first)))
        .withColumn(
            "date",
            F.explode(F.sequence(F.greatest("_from", F.lit(first)), F.least("_to", F.lit(last)))),
        )
        .where(flag == "1")
        .select("date", "service_id")
    )


def primary_services(active: DataFrame, cfg: Settings) -> DataFrame:
    """The service that names the day: holiday ids beat weekday ids, then the smallest id."""
    number = F.col("service_id").cast("int")
    rank = F.struct(F.when(number >= cfg.holiday_service_from, 0).otherwise(1), number)
    return active.groupBy("date").agg(F.min_by("service_id", rank).alias("service_id"))


def service_names(service_ext: DataFrame) -> DataFrame:
    """Name of each service: the last one that the merge on (service_id, name) kept."""
    place = F.struct("pkg_ord", "line_no")
    return service_ext.groupBy("service_id").agg(F.max_by("name", place).alias("service_name"))


def dim_date(
    calendar: DataFrame, service_ext: DataFrame, first: date, last: date, cfg: Settings
) -> DataFrame:
    """One row per day of [first, last] with calendar parts and the day type.

    A day without an active service, or whose service has no entry, gets the default
    label; an entry with an empty name stays null. Calendar exceptions are not applied.
    """
    named = primary_services(active_services(calendar, first, last), cfg).join(
        service_names(service_ext).withColumn("_known", F.lit(True)), "service_id", "left"
    )
    day = F.col("date")
    weekday = F.weekday(day)
    return (
        days_between(calendar.sparkSession, first, last)
        .join(named, "date", "left")
        .select(
            day,
            F.year(day).cast("smallint").alias("year"),
            F.month(day).cast("smallint").alias("month"),
            F.weekofyear(day).cast("smallint").alias("iso_week"),
            (weekday + 1).cast("smallint").alias("iso_dow"),
            F.element_at(F.array(*map(F.lit, DAY_NAMES)), weekday + 1).alias("day_name"),
            F.when(F.col("_known"), F.col("service_name")).otherwise(NO_SCHEDULE_LABEL).alias("day_type"),
        )
    )


def dim_version(
    selected: DataFrame, version_id: int, valid_from: date, valid_to: date, loaded_at: datetime
) -> DataFrame:
    """The row of one load; package names are joined in package order.

    `selected` holds at most one package per day of the horizon.
    """
    ordered = F.array_sort(F.collect_list(F.struct("pkg_ord", "name")))
    names = F.array_join(F.transform(ordered, lambda p: p["name"]), " | ")
    return selected.agg(names.alias("package_names")).select(
        F.lit(version_id).alias("version_id"),
        "package_names",
        F.lit(valid_from).alias("valid_from"),
        F.lit(valid_to).alias("valid_to"),
        ntz(loaded_at).alias("loaded_at"),
    )
