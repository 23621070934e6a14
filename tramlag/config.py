"""Settings of the warehouse: labels, keys, time zone, thresholds and policies."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

# Labels stored in the dimensions, as the data publisher names them.
TRANSPORT_MODES = {"0": "tramwaj", "3": "autobus", "11": "trolejbus"}
OTHER_MODE = "inne"
DEFAULT_LINE_TYPE = "Normalna"
DEFAULT_STOP_TYPE = "Standardowy"
NO_SCHEDULE_LABEL = "brak rozkładu"
DAY_NAMES = ["poniedziałek", "wtorek", "środa", "czwartek", "piątek", "sobota", "niedziela"]

# Status labels of facts and of audit rows.
OBSERVED, CANCELLED, SKIPPED_STOP = "OBSERWACJA", "ANULOWANY", "POMINIETY"
RUN_OK, RUN_SKIPPED, RUN_ERROR = "OK", "SKIPPED", "ERROR"

# Columns of the schedule package format.
WEEKDAY_FLAGS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]

# The key on which each package table is merged. `calendar` and `service_ext`
# need (nearly) the whole record, because one service_id means different things in
# different packages.
MERGE_KEYS = {
    "agency": ["agency_id"],
    "routes": ["route_id"],
    "routes_ext": ["route_id"],
    "stops": ["stop_id"],
    "stops_ext": ["stop_id"],
    "stops_attributes_ext": ["stop_type_id"],
    "communities_ext": ["community_id"],
    "trips": ["trip_id"],
    "trips_ext": ["trip_id"],
    "stop_times": ["trip_id", "stop_id", "stop_sequence"],
    "calendar": ["service_id", "start_date", "end_date", *WEEKDAY_FLAGS],
    "calendar_dates": ["service_id", "date", "exception_type"],
    "service_ext": ["service_id", "name"],
    "operators_ext": ["operator_id"],
}
PACKAGE_MEMBERS = [*MERGE_KEYS, "feed_info"]


@dataclass(frozen=True)
class RefreshPolicy:
    """Window [now - start, now - end) that a scheduled refresh recomputes."""

    start: timedelta
    end: timedelta
    every: timedelta


@dataclass(frozen=True)
class Settings:
    zone: str = "Europe/Warsaw"
    package_pattern: str = r"^schedule_ZTM_(\d{4})\.(\d{2})\.(\d{2})_(\d+)_(\d+)\.zip"
    horizon_days: int = 14
    window_days: int = 14  # days that packages are weighed on, or the horizon if that is longer
    date_lookback_days: int = 35
    holiday_service_from: int = 9  # service ids from here on beat the weekday services
    on_time_from_s: int = -30
    on_time_to_s: int = 60
    poll_seconds: int = 20
    fact_retention: timedelta = timedelta(days=30)
    run_retention: timedelta = timedelta(days=90)
    claim_lease: timedelta = timedelta(hours=6)  # after which the holder of a claim counts as dead
    schedule_parts: int = 64  # by hash of the trip, of each stored schedule version
    refresh: dict[str, RefreshPolicy] = field(
        default_factory=lambda: {
            "agg_line_15m": RefreshPolicy(timedelta(days=7), timedelta(minutes=10), timedelta(minutes=5)),
            "agg_line_1h": RefreshPolicy(timedelta(days=14), timedelta(minutes=30), timedelta(minutes=15)),
            "agg_line_1d": RefreshPolicy(timedelta(days=60), timedelta(hours=2), timedelta(hours=1)),
            "agg_stop_15m": RefreshPolicy(timedelta(days=7), timedelta(minutes=10), timedelta(minutes=5)),
        }
    )


DEFAULTS = Settings()
