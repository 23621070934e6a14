"""Schedule packages: catalogue, validity periods, selection and reading of ZIP files."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..config import PACKAGE_MEMBERS, Settings
from ..functions.lenient import empty_to_null

# Newest package = greatest tuple; url and name break ties.
RANK = ["year", "month", "day", "seq", "url", "name"]
_CHUNK_ROWS = 20_000
HEADER = -1


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(name, url) of the resources in a landed answer of the publisher's catalogue."""
    schema = "result struct<resources: array<struct<name: string, url: string>>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.inline("result.resources"))


def parse_catalogue(catalogue: DataFrame, cfg: Settings) -> DataFrame:
    """Resources whose name starts like a schedule package, with the parts that rank them."""
    name = F.coalesce(F.col("name"), F.lit(""))

    def part(i: int):
        return F.regexp_extract(name, cfg.package_pattern, i)

    return catalogue.where(name.rlike(cfg.package_pattern)).select(
        "name",
        "url",
        part(1).cast("int").alias("year"),
        part(2).cast("int").alias("month"),
        part(3).cast("int").alias("day"),
        part(4).cast("bigint").alias("seq"),
    )


def parse_period(rows: DataFrame) -> DataFrame:
    """Validity period from the raw `yyyyMMdd` texts; an unreadable date is an error."""
    return rows.withColumn("period_start", F.to_date("feed_start_date", "yyyyMMdd")).withColumn(
        "period_end", F.to_date("feed_end_date", "yyyyMMdd")
    )


def select_packages(candidates: DataFrame, today: date, horizon_days: int, cfg: Settings) -> DataFrame:
    """Packages a newest-first greedy cover of [today, today + horizon) would take.

    A package that adds no day also leaves the cover unchanged, so a package is taken
    exactly when it is the newest one for some day, up to the package that completes the
    cover. Only the newest package per day is shuffled on; at most one row a day of the window follows.
    Columns: the candidate's rank, period_start, period_end and `pkg_ord` (by period start).
    """
    last = today + timedelta(days=max(horizon_days, cfg.window_days) - 1)
    rank = F.struct(*RANK)
    per_day = (
        candidates.where(
            (F.col("period_start") <= F.col("period_end"))
            & (F.col("period_start") <= F.lit(last))
            & (F.col("period_end") >= F.lit(today))
        )
        .withColumn(
            "date",
            F.explode(
                F.sequence(
                    F.greatest("period_start", F.lit(today)), F.least("period_end", F.lit(last))
                )
            ),
        )
        .groupBy("date")
        .agg(
            F.max(rank).alias("rank"),
            F.max_by(F.struct("period_start", "period_end"), rank).alias("period"),
        )
    )
    # From here on one row per day of the window.
    wanted = F.col("date") < F.lit(today + timedelta(days=horizon_days))
    every_day = W.partitionBy()
    stop = F.when(
        F.count_if(wanted).over(every_day) >= horizon_days,
        F.min(F.when(wanted, F.col("rank"))).over(every_day),
    )
    chosen = (
        per_day.withColumn("stop", stop)
        .where(F.col("stop").isNull() | (F.col("rank") >= F.col("stop")))
        .select("rank.*", "period.*")
        .distinct()
    )
    order = W.orderBy("period_start", *[F.desc(c) for c in RANK])
    return chosen.withColumn("pkg_ord", F.row_number().over(order))


# ---------------------------------------------------------------- ZIP files


def _records(content: bytes, members: list[str]) -> Iterator[tuple[str, int, dict[str, str]]]:
    """(member, line number, record) for the wanted CSV members of one ZIP.

    Member streams are decoded as they are read; a byte order mark is dropped, header
    names are trimmed, and a record longer than its header is an error. The header itself
    comes first, as record number `HEADER` with empty values.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        present = set(archive.namelist())
        for member in members:
            if f"{member}.txt" not in present:
                continue
            with archive.open(f"{member}.txt") as raw:
                lines = csv.reader(io.TextIOWrapper(raw, "utf-8-sig", newline=""))
                header = [name.strip() for name in next(lines, [])]
                yield member, HEADER, dict.fromkeys(header, "")
                for number, fields in enumerate(row for row in lines if row):
                    if len(fields) > len(header):
                        raise ValueError(f"{member}.txt record {number}: {len(fields)} fields")
                    yield member, number, dict(zip(header, fields))


def _unpacker(members: list[str], first_only: bool):
    """mapInPandas body: ZIP rows in, record rows out in bounded chunks."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = _records(content, members)
                if first_only:
                    rows = (row for row in rows if row[1] == 0)
                chunk = []
                for row in rows:
                    chunk.append((path, *row))
                    if len(chunk) == _CHUNK_ROWS:
                        yield _frame(chunk)
                        chunk = []
                if chunk:
                    yield _frame(chunk)

    return unpack


def _frame(chunk: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(chunk, columns=["path", "member", "line_no", "record"])


_RECORD_ROWS = "path string, member string, line_no long, record map<string,string>"


def _file_name(path: str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def zip_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per landed package: its path, file name and content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip*").load(paths)
    return files.select("path", _file_name("path").alias("name"), "content")


def read_periods(files: DataFrame) -> DataFrame:
    """(name, period_start, period_end) from the first record of each feed_info member."""
    unpack = _unpacker(["feed_info"], first_only=True)
    rows = files.select("path", "content").mapInPandas(unpack, _RECORD_ROWS)
    return parse_period(
        rows.select(
            _file_name("path").alias("name"),
            F.col("record")["feed_start_date"].alias("feed_start_date"),
            F.col("record")["feed_end_date"].alias("feed_end_date"),
        )
    ).select("name", "period_start", "period_end")


def unpack_packages(
    spark: SparkSession, folder: str, selected: DataFrame, members: list[str] = PACKAGE_MEMBERS
) -> DataFrame:
    """(pkg_ord, member, line_no, record) of the selected packages, about one task each.

    `selected` holds at most one package per day of the horizon, so its names may pass
    through the driver: only those files are read. An archive is decompressed as a stream.
    """
    order = {row["name"]: row["pkg_ord"] for row in selected.select("name", "pkg_ord").collect()}
    files = zip_files(spark, [f"{folder}/{name}" for name in order]).select("path", "content")
    rows = files.repartition(len(order), "path").mapInPandas(
        _unpacker(members, first_only=False), _RECORD_ROWS
    )
    places = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    return rows.select(places[_file_name("path")].alias("pkg_ord"), "member", "line_no", "record")


def member_table(records: DataFrame, member: str, columns: list[str]) -> DataFrame:
    """One package table: the given columns of all packages by name, empty text as null."""
    fields = [empty_to_null(F.col("record")[c]).alias(c) for c in columns]
    return records.where((F.col("member") == member) & (F.col("line_no") != HEADER)).select("pkg_ord", "line_no", *fields)


# Columns that the warehouse uses of each package table (fixed by the package format).
MEMBER_COLUMNS = {
    "feed_info": ["feed_start_date", "feed_end_date"],
    "agency": ["agency_id"],
    "routes": ["route_id", "route_short_name", "route_long_name", "route_type"],
    "routes_ext": ["route_id", "route_type_1"],
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon"],
    "stops_ext": ["stop_id", "community_ids", "city", "stop_attribute_ids"],
    "communities_ext": ["community_id", "community_name"],
    "stops_attributes_ext": ["stop_type_id", "stop_attr_name"],
    "operators_ext": ["operator_id", "operator_name"],
    "trips": ["trip_id", "route_id", "direction_id", "trip_headsign"],
    "trips_ext": ["trip_id", "operator_id"],
    "stop_times": ["trip_id", "stop_id", "stop_sequence", "arrival_time"],
    "calendar": [
        "service_id", "start_date", "end_date",
        "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
    ],
    "calendar_dates": ["service_id", "date", "exception_type"],
    "service_ext": ["service_id", "name"],
}

# Members that are read but not used; all others must come with all columns above.
UNUSED_MEMBERS = {"feed_info", "agency", "calendar_dates"}


class IncompletePackageError(ValueError):
    """The selected packages lack a member or a column that the warehouse needs."""


def require_complete(records: DataFrame) -> None:
    """Fail unless every used member, with every used column, is in at least one package.

    The headers are a few hundred names, whatever the size of the packages.
    """
    headers = records.where(F.col("line_no") == HEADER).select("member", F.explode(F.map_keys("record")).alias("name"))
    found = {(r["member"], r["name"]) for r in headers.distinct().collect()}
    wanted = {(m, c) for m, columns in MEMBER_COLUMNS.items() if m not in UNUSED_MEMBERS for c in columns}
    if missing := sorted(wanted - found):
        raise IncompletePackageError(f"not in any selected package: {missing}")
