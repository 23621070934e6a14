"""Static load: choose packages, merge them, build and publish dimensions and schedule."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MERGE_KEYS
from ..operators import dims as d
from ..operators.merge import merge_tables
from ..operators.schedule import build_schedule, near_trip
from ..operators.skew import hot_keys
from ..session import shared_folder
from ..sources import packages as p
from ..warehouse import Warehouse


class NoPackageError(LookupError):
    """No landed package is valid on any wanted day."""


class MissingPackageError(LookupError):
    """The catalogue names a package that the load needs and that has not landed."""


def choose_packages(wh: Warehouse, landing: str, catalogue: DataFrame, today: date, horizon_days: int) -> DataFrame:
    """Selected packages with their period and `pkg_ord`. Archives outside the catalogue are not opened."""
    listed = p.parse_catalogue(catalogue, wh.cfg).persist()
    files = p.zip_files(wh.spark, landing).join(listed.select("name").distinct(), "name", "left_semi")
    periods = p.read_periods(files)
    selected = p.select_packages(listed.join(periods, "name"), today, horizon_days, wh.cfg).persist()
    require_landed(listed, periods, selected, today, horizon_days)
    listed.unpersist()
    return selected


def require_landed(
    listed: DataFrame, periods: DataFrame, selected: DataFrame, today: date, horizon_days: int
) -> None:
    """Fail if a package is missing that could have covered a day: any, while days are left
    uncovered, else one newer than the oldest selected. `selected` is one row a day at most."""
    rank = F.struct(*p.RANK)
    missing = listed.join(periods, "name", "left_anti").agg(F.max(rank)).first()[0]
    if missing is None:
        return
    chosen = selected.select(rank.alias("rank"), "period_start", "period_end").collect()
    days = {today + timedelta(days=i) for i in range(horizon_days)}
    for row in chosen:
        days -= {day for day in days if row["period_start"] <= day <= row["period_end"]}
    if days or tuple(missing) > min(tuple(row["rank"]) for row in chosen):
        raise MissingPackageError(f"{missing['name']} is in the catalogue but has not landed")


def build_dimensions(wh: Warehouse, tables: dict[str, DataFrame], first: date, last: date) -> dict[str, DataFrame]:
    return {
        "dim_line": d.dim_line(tables["routes"], tables["routes_ext"]),
        "dim_stop": d.dim_stop(
            tables["stops"], tables["stops_ext"], tables["communities_ext"], tables["stops_attributes_ext"]
        ),
        "dim_operator": d.dim_operator(tables["operators_ext"]),
        "dim_date": d.dim_date(tables["calendar"], tables["service_ext"], first, last, wh.cfg),
    }


def load_static(
    wh: Warehouse,
    landing: str,
    catalogue: DataFrame,
    today: date,
    now: datetime,
    horizon_days: int | None = None,
    keep_known_day_type: bool = False,
) -> int:
    """Run the whole load and return the new version id.

    The unpacked records are written once, partitioned by member, so the archives are read
    a single time and a lost executor does not repeat the decompression. A second load at the
    same time fails with ClaimedError.
    """
    horizon_days = horizon_days or wh.cfg.horizon_days
    last = today + timedelta(days=horizon_days - 1)
    selected = choose_packages(wh, landing, catalogue, today, horizon_days)
    if selected.isEmpty():
        raise NoPackageError(f"no package is valid from {today} on")

    staging = shared_folder(wh.spark, "packages")
    try:
        with wh.claim("static-load") as check:
            return _load(wh, landing, selected, staging, today, now, last, keep_known_day_type, check)
    finally:
        selected.unpersist()
        wh.delete(staging)


def _load(
    wh: Warehouse, landing: str, selected: DataFrame, staging: str, today: date, now: datetime, last: date,
    keep_known_day_type: bool, check: Callable[[], None],
) -> int:
    p.unpack_packages(wh.spark, landing, selected).write.partitionBy("member").parquet(staging)
    records = wh.spark.read.schema(
        "pkg_ord int, line_no long, record map<string,string>, member string"
    ).parquet(staging)
    p.require_complete(records)
    raw = {name: p.member_table(records, name, columns) for name, columns in p.MEMBER_COLUMNS.items()}
    hot_trips = hot_keys(raw["stop_times"], ["trip_id"])
    raw["stop_times"] = near_trip(raw["stop_times"], hot_trips)
    tables = merge_tables(raw, MERGE_KEYS)

    first = today - timedelta(days=wh.cfg.date_lookback_days)
    version_id = wh.next_version_id()
    schedule = build_schedule(tables["stop_times"], tables["trips"], tables["trips_ext"], hot_trips)
    wh.publish(
        d.dim_version(selected, version_id, today, last, now),
        version_id,
        build_dimensions(wh, tables, first, last),
        schedule,
        keep_known_day_type,
        check,
    )
    return version_id
