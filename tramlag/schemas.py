"""Schemas of the input feed and of the stored tables.

Timestamps are `timestamp_ntz` holding UTC wall time, so no result depends on the
session time zone.
"""

from __future__ import annotations

FEED = """
    header struct<timestamp: string>,
    entity array<struct<
        id: string,
        tripUpdate: struct<
            trip: struct<tripId: string, scheduleRelationship: string>,
            stopTimeUpdate: array<struct<
                stopSequence: int,
                scheduleRelationship: string,
                arrival: struct<delay: int>>>>>>
"""

_MEASURES = """
    delay_sum bigint, obs bigint, on_time bigint, delay_min int, delay_max int,
    cancelled bigint, skipped bigint
"""
_LINE_AGG = f"""
    bucket timestamp_ntz, service_date date, version_id int, line_id string, operator_id string,
    {_MEASURES}, bucket_date date
"""

TABLES = {
    "dim_line": "line_id string, short_name string, long_name string, mode string, line_type string, load_id int",
    "dim_stop": """stop_id string, name string, lat double, lon double, commune string, city string,
                   stop_type string, load_id int""",
    "dim_operator": "operator_id string, name string, load_id int",
    "dim_date": """date date, year smallint, month smallint, iso_week smallint, iso_dow smallint,
                   day_name string, day_type string, load_id int""",
    "dim_version": """version_id int, package_names string, valid_from date, valid_to date,
                      loaded_at timestamp_ntz""",
    "schedule": """trip_id string, stop_id string, stop_sequence int, sched_arrival string, line_id string,
                   direction string, headsign string, operator_id string, day_offset smallint, version_id int""",
    "fact_delay": """ts timestamp_ntz, version_id int, trip_id string, stop_id string, stop_sequence int,
                     line_id string, operator_id string, direction string, service_date date, delay_s int,
                     status string, ts_date date""",
    "fact_run": """started_at timestamp_ntz, snapshot_ts timestamp_ntz, observed int, inserted int,
                   seconds decimal(12,3), status string, error string, week_start date""",
    "agg_line_15m": _LINE_AGG,
    "agg_line_1h": _LINE_AGG,
    "agg_line_1d": _LINE_AGG,
    "agg_stop_15m": f"""
        bucket timestamp_ntz, service_date date, version_id int, stop_id string, line_id string,
        {_MEASURES}, bucket_date date""",
}

# The last column of each partitioned table is its partition column.
PARTITION_COLUMN = {
    "dim_line": "load_id",
    "dim_stop": "load_id",
    "dim_operator": "load_id",
    "dim_date": "load_id",
    "schedule": "version_id",
    "fact_delay": "ts_date",
    "fact_run": "week_start",
    "agg_line_15m": "bucket_date",
    "agg_line_1h": "bucket_date",
    "agg_line_1d": "bucket_date",
    "agg_stop_15m": "bucket_date",
}

PRIMARY_KEYS = {
    "dim_line": ["line_id"],
    "dim_stop": ["stop_id"],
    "dim_operator": ["operator_id"],
    "dim_date": ["date"],
    "dim_version": ["version_id"],
    "schedule": ["version_id", "trip_id", "stop_id", "stop_sequence"],
    "fact_delay": ["trip_id", "stop_id", "stop_sequence", "ts"],
    "fact_run": ["started_at"],
}

NOT_NULL = {
    "dim_line": ["line_id"],
    "dim_stop": ["stop_id"],
    "dim_operator": ["operator_id"],
    "dim_date": ["date"],
    "dim_version": ["version_id", "loaded_at"],
    "schedule": ["version_id", "trip_id", "stop_id", "stop_sequence", "day_offset"],
    "fact_delay": ["ts", "trip_id", "stop_id", "stop_sequence", "status"],
    "fact_run": ["started_at", "status"],
}

# fact column -> (dimension, its key); a null fact column is allowed.
FACT_REFERENCES = {
    "stop_id": ("dim_stop", "stop_id"),
    "line_id": ("dim_line", "line_id"),
    "operator_id": ("dim_operator", "operator_id"),
    "service_date": ("dim_date", "date"),
    "version_id": ("dim_version", "version_id"),
}

# the same of a planned stop
SCHEDULE_REFERENCES = {"version_id": ("dim_version", "version_id")}
