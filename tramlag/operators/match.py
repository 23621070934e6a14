"""Trip-update snapshots matched with the schedule: cancelled, skipped and observed stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CANCELLED, OBSERVED, SKIPPED_STOP, Settings
from ..functions.clock import from_epoch, local_date, service_date
from .merge import keep_first
from .skew import hot_keys, salted_join

FACT_COLUMNS = [
    "ts", "version_id", "trip_id", "stop_id", "stop_sequence", "line_id", "operator_id",
    "direction", "service_date", "delay_s", "status",
]
# Arrival of a snapshot, and the position of a row inside it, kept until duplicates are removed.
ARRIVAL = ["arrived", "file_path"]
POSITION = ["entity_pos", "update_pos"]

# Relationship names of the public feed format, and their enum numbers.
TRIP_CANCELED = ["CANCELED", "3"]
STOP_SKIPPED = ["SKIPPED", "1"]


def snapshot_time() -> Column:
    return from_epoch(F.col("header.timestamp"))


def _is(relationship: Column, names: list[str]) -> Column:
    return F.coalesce(relationship.isin(names), F.lit(False))


def trip_entities(snapshots: DataFrame, zone: str) -> DataFrame:
    """One row per entity that has a trip update with a trip id; columns of ARRIVAL go along if there."""
    arrival = [c for c in ARRIVAL if c in snapshots.columns]
    timed = snapshots.select(*arrival, snapshot_time().alias("ts"), "entity").withColumn(
        "local_date", local_date(F.col("ts"), zone)
    )
    entities = timed.select(*arrival, "ts", "local_date", F.posexplode("entity").alias("entity_pos", "entity"))
    update = F.col("entity.tripUpdate")
    return entities.where(update.isNotNull() & (update["trip"]["tripId"] != "")).select(
        *arrival,
        "ts",
        "local_date",
        "entity_pos",
        update["trip"]["tripId"].alias("trip_id"),
        _is(update["trip"]["scheduleRelationship"], TRIP_CANCELED).alias("cancelled"),
        update["stopTimeUpdate"].alias("updates"),
    )


def feed_rows(entities: DataFrame) -> DataFrame:
    """One row per cancelled trip, whose updates are ignored, and per usable stop update.

    A stop update is usable with a sequence (0 counts) when the stop is skipped or an
    arrival delay is given. Both kinds come from one pass over the feed; `stop_key` is the
    sequence, or `WHOLE_TRIP`.
    """
    arrival = [c for c in ARRIVAL if c in entities.columns]
    updates = F.when(F.col("cancelled"), F.array(F.lit(None))).otherwise(F.col("updates"))
    flat = entities.select(
        *arrival, "ts", "local_date", "entity_pos", "trip_id", "cancelled", F.posexplode(updates).alias("update_pos", "u")
    )
    skipped = _is(F.col("u.scheduleRelationship"), STOP_SKIPPED)
    usable = F.col("u.stopSequence").isNotNull() & (skipped | F.col("u.arrival.delay").isNotNull())
    return flat.where(F.col("cancelled") | usable).select(
        *arrival,
        "ts",
        "local_date",
        "entity_pos",
        "update_pos",
        "trip_id",
        "cancelled",
        F.coalesce("u.stopSequence", F.lit(WHOLE_TRIP)).alias("stop_key"),
        skipped.alias("skipped"),
        F.col("u.arrival.delay").alias("delay"),
    )


_PLANNED = ["trip_id", "stop_sequence", "stop_id", "line_id", "operator_id", "direction", "day_offset"]
MATCH_KEYS = ["trip_id", "cancelled", "stop_key"]
WHOLE_TRIP = -1  # stop key of a cancelled trip; sequences are not negative


def stop_lookup(schedule: DataFrame) -> DataFrame:
    """One planned stop per (trip, sequence): the greatest stop id where several share it."""
    return keep_first(schedule.select(*_PLANNED), ["trip_id", "stop_sequence"], [F.desc("stop_id")])


def match_side(schedule: DataFrame) -> DataFrame:
    """Planned stops under the keys of `feed_rows`: all of a trip, and one per sequence."""
    whole = schedule.select(*_PLANNED).select(
        F.lit(True).alias("cancelled"), F.lit(WHOLE_TRIP).alias("stop_key"), *_PLANNED
    )
    single = stop_lookup(schedule).select(
        F.lit(False).alias("cancelled"), F.col("stop_sequence").alias("stop_key"), *_PLANNED
    )
    return whole.unionByName(single)


def match_rows(rows: DataFrame, planned: DataFrame, hot: list[tuple] = ()) -> DataFrame:
    """Feed rows with their planned stops: every stop of a cancelled trip, one per update.

    Trips and sequences that the schedule does not know drop out.
    """
    day = service_date(F.col("local_date"), F.col("day_offset")).alias("service_date")
    observed = ~F.col("cancelled") & ~F.col("skipped")
    arrival = [c for c in ARRIVAL if c in rows.columns]
    return salted_join(rows, planned, MATCH_KEYS, list(hot)).select(
        *arrival,
        "ts",
        "trip_id",
        "stop_id",
        "stop_sequence",
        "line_id",
        "operator_id",
        "direction",
        day,
        F.when(observed, F.col("delay")).cast("int").alias("delay_s"),
        F.when(F.col("cancelled"), CANCELLED).when(F.col("skipped"), SKIPPED_STOP).otherwise(OBSERVED).alias("status"),
        "entity_pos",
        F.when(F.col("cancelled"), F.col("stop_sequence")).otherwise(F.col("update_pos")).alias("update_pos"),
    )


def match_snapshots(snapshots: DataFrame, schedule: DataFrame, version_id: int, cfg: Settings) -> DataFrame:
    """Fact rows of the snapshots (with arrival and position), for live batches and backfill alike.

    One join by shuffle with the feed's hot trips and stops salted, whatever the sizes; Spark
    broadcasts the schedule where its own statistics allow.
    """
    rows = feed_rows(trip_entities(snapshots, cfg.zone))
    facts = match_rows(rows, match_side(schedule), hot_keys(rows, MATCH_KEYS))
    arrival = [c for c in ARRIVAL if c in facts.columns]
    return facts.withColumn("version_id", F.lit(version_id)).select(*FACT_COLUMNS, *arrival, *POSITION)


def mentioned_trips(snapshots: DataFrame, cfg: Settings) -> DataFrame:
    """The trip ids that a batch of snapshots mentions."""
    return trip_entities(snapshots, cfg.zone).select("trip_id").distinct()
