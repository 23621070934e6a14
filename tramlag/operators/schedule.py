"""Denormalised schedule: one row per planned stop of a trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lenient import lenient_int, truncated_int
from .skew import salted_join


def day_offset(arrival: Column) -> Column:
    """Whole days in the hour part of HH:MM:SS: 25:30 is 1; a bad or missing hour is 0."""
    hour = F.coalesce(truncated_int(F.substring_index(arrival, ":", 1)), F.lit(0))
    return F.floor(hour / 24).cast("smallint")


def trips_with_operator(trips: DataFrame, trips_ext: DataFrame) -> DataFrame:
    ext = trips_ext.select("trip_id", "operator_id")
    return trips.select("trip_id", "route_id", "direction_id", "trip_headsign").join(ext, "trip_id", "left")


def near_trip(stop_times: DataFrame, hot_trips: list[tuple]) -> DataFrame:
    """Stop times placed by trip, so that their merge and the trip join share one shuffle.

    The merge key contains the trip, and rows placed by trip satisfy both. Hot trips would
    overload a task that way; with any of them the two steps keep their own shuffles.
    """
    return stop_times if hot_trips else stop_times.repartition("trip_id")


def build_schedule(
    stop_times: DataFrame, trips: DataFrame, trips_ext: DataFrame, hot_trips: list[tuple] = ()
) -> DataFrame:
    """Planned stops with line, direction and operator; stop times of unknown trips drop out.

    `hot_trips` comes from `skew.hot_keys(stop_times, ["trip_id"])`.
    """
    times = stop_times.select("trip_id", "stop_id", "stop_sequence", "arrival_time")
    joined = salted_join(times, trips_with_operator(trips, trips_ext), ["trip_id"], list(hot_trips))
    return joined.select(
        "trip_id",
        "stop_id",
        lenient_int(F.col("stop_sequence").cast("string")).alias("stop_sequence"),
        F.col("arrival_time").alias("sched_arrival"),
        F.col("route_id").alias("line_id"),
        F.col("direction_id").alias("direction"),
        F.col("trip_headsign").alias("headsign"),
        "operator_id",
        day_offset(F.col("arrival_time")).alias("day_offset"),
    )
