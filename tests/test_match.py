import json
from datetime import date, datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tramlag.config import DEFAULTS
from tramlag.functions.clock import bucket_ceiling, bucket_start
from tramlag.operators import match
from tramlag.operators.skip import fresh_only, in_ranges, numbered
from tramlag.schemas import FEED

NOON = int(datetime(2024, 7, 1, 12, tzinfo=timezone.utc).timestamp())


def update(seq=None, delay=None, rel=None, arrival=True):
    u = {}
    if seq is not None:
        u["stopSequence"] = seq
    if rel is not None:
        u["scheduleRelationship"] = rel
    if arrival:
        u["arrival"] = {} if delay is None else {"delay": delay}
    return u


def entity(trip_id, *updates, rel=None):
    trip = {"tripId": trip_id} if trip_id is not None else {}
    if rel:
        trip["scheduleRelationship"] = rel
    return {"id": "e", "tripUpdate": {"trip": trip, "stopTimeUpdate": list(updates)}}


def feed(spark, tmp_path, *snapshots):
    """(epoch, entities) pairs, landed and read as JSON."""
    folder = tmp_path / "feed"
    folder.mkdir()
    for i, (epoch, entities) in enumerate(snapshots):
        record = {"header": {"timestamp": epoch}, "entity": entities}
        (folder / f"{i:03}.json").write_text(json.dumps(record))
    return spark.read.schema(FEED).json(str(folder))


@pytest.fixture(scope="module")
def schedule(spark):
    rows = [
        ("T1", "S1", 0, "23:50:00", "L1", "0", "Centre", "O1", 0),
        ("T1", "S2", 1, "24:05:00", "L1", "0", "Centre", "O1", 1),
        ("T2", "S3", 5, "10:00:00", "L2", "1", "Depot", None, 0),
        ("T2", "S4", 5, "10:01:00", "L2", "1", "Depot", None, 1),
    ]
    return spark.createDataFrame(
        rows,
        """trip_id string, stop_id string, stop_sequence int, sched_arrival string, line_id string,
           direction string, headsign string, operator_id string, day_offset short""",
    )


def facts(spark, tmp_path, schedule, *entities, epoch=NOON):
    return match.match_snapshots(feed(spark, tmp_path, (epoch, list(entities))), schedule, 3, DEFAULTS)


SHOWN = ["trip_id", "stop_id", "stop_sequence", "delay_s", "status", "service_date"]
DAY, DAY_BEFORE = date(2024, 7, 1), date(2024, 6, 30)


def test_three_kinds_of_rows(spark, rows, tmp_path, schedule):
    got = facts(
        spark, tmp_path, schedule,
        entity("T1", update(0, 0), update(1, -45), update(7, 1)),
        entity("T2", update(5, 30, rel="SKIPPED")),
        entity("T1", update(0, 9), rel="CANCELED"),
        entity("T9", rel="CANCELED"),
    )
    assert rows(got, *SHOWN) == [
        ("T1", "S1", 0, 0, "OBSERWACJA", DAY),
        ("T1", "S1", 0, None, "ANULOWANY", DAY),
        ("T1", "S2", 1, -45, "OBSERWACJA", DAY_BEFORE),
        ("T1", "S2", 1, None, "ANULOWANY", DAY_BEFORE),
        ("T2", "S4", 5, None, "POMINIETY", DAY_BEFORE),
    ]
    assert rows(got.select("version_id", "ts").distinct()) == [(3, datetime(2024, 7, 1, 12))]


def test_salted_matching_equals_plain(spark, tmp_path, schedule):
    entities = [entity("T1", update(0, i)) for i in range(30)] + [entity("T2", rel="CANCELED"), entity("T2", update(5, 1))]
    rows = match.feed_rows(match.trip_entities(feed(spark, tmp_path, (NOON, entities)), DEFAULTS.zone))
    planned = match.match_side(schedule)
    plain = match.match_rows(rows, planned)
    salted = match.match_rows(rows, planned, [("T1", False, 0, 4), ("T2", True, match.WHOLE_TRIP, 2)])
    assert plain.count() == salted.count() == 33
    assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()


def test_cancelled_trip_yields_all_stops_of_a_shared_sequence(spark, rows, tmp_path, schedule):
    got = facts(spark, tmp_path, schedule, entity("T2", rel="CANCELED"))
    assert rows(got, "stop_id", "service_date") == [("S3", DAY), ("S4", DAY_BEFORE)]


def test_rows_that_drop_out(spark, tmp_path, schedule):
    got = facts(
        spark, tmp_path, schedule,
        {"id": "no trip update"},
        entity("", update(0, 1)),
        entity(None, update(0, 1)),
        entity("T1", update(None, 1), update(0), update(0, arrival=False), update(0, rel="NO_DATA", arrival=False)),
        entity("T9", update(0, 1)),
        entity("T1"),
    )
    assert got.count() == 0


def test_other_relationships_are_normal_and_enum_numbers_work(spark, rows, tmp_path, schedule):
    got = facts(
        spark, tmp_path, schedule,
        entity("T1", update(0, 5, rel="SCHEDULED"), rel="ADDED"),
        entity("T1", update(1, 5, rel=1)),
        entity("T2", rel=3),
    )
    assert [r[-1] for r in rows(got, "stop_id", "status")] == ["OBSERWACJA", "POMINIETY", "ANULOWANY", "ANULOWANY"]


@pytest.mark.parametrize(
    "when, day",
    [
        (datetime(2024, 7, 1, 21, 30), date(2024, 7, 1)),
        (datetime(2024, 7, 1, 22, 30), date(2024, 7, 2)),
        (datetime(2024, 1, 1, 22, 30), date(2024, 1, 1)),
        (datetime(2024, 1, 1, 23, 30), date(2024, 1, 2)),
    ],
)
def test_service_date_follows_local_midnight(spark, rows, tmp_path, schedule, when, day):
    epoch = int(when.replace(tzinfo=timezone.utc).timestamp())
    got = facts(spark, tmp_path, schedule, entity("T1", update(0, 1), update(1, 1)), epoch=str(epoch))
    before = date.fromordinal(day.toordinal() - 1)
    assert rows(got, "stop_sequence", "service_date", "ts") == [(0, day, when), (1, before, when)]


def loop(values, last=None):
    kept = []
    for v in values:
        if last is None or v > last:
            kept.append(v)
            last = v
    return kept


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 30), min_size=1, max_size=40), st.sampled_from([None, 3, 12]), st.sampled_from([1, 4, 1000]))
def test_stale_snapshots_are_skipped(spark, values, last, rows_per_range):
    heads = spark.createDataFrame(list(enumerate(values)), "arrival long, ts long")
    got = fresh_only(heads, ["arrival"], "ts", last, rows_per_range=rows_per_range)
    assert [r[0] for r in got.orderBy("arrival").select("ts").collect()] == loop(values, last)


def test_stale_example(spark, rows):
    heads = spark.createDataFrame(list(enumerate([5, 5, 3, 7])), "arrival long, ts long")
    assert rows(fresh_only(heads, ["arrival"], "ts"), "ts") == [(5,), (7,)]


def test_tied_arrivals_spread_over_ranges(spark):
    """All files of a bulk copy share one arrival time; path and epoch still part them."""
    values = [(7 * i) % 101 for i in range(400)]
    heads = spark.createDataFrame([(1, f"f{i:04}", v) for i, v in enumerate(values)], "arrived long, file_path string, epoch long")
    order = ["arrived", "file_path", "epoch"]
    sizes = [r["count"] for r in in_ranges(heads, order, 8).groupBy("_range").count().collect()]
    assert len(sizes) >= 40 and max(sizes) < 40
    got = fresh_only(heads, order, "epoch", rows_per_range=8).orderBy("file_path")
    assert [r["epoch"] for r in got.collect()] == loop(values)
    places = numbered(heads, order, rows_per_range=8).orderBy("file_path").select("place").collect()
    assert [r["place"] for r in places] == list(range(400))
    assert numbered(heads.limit(0), order).count() == 0


def test_scalar_buckets():
    zone = DEFAULTS.zone
    spring = datetime(2024, 3, 31, 12)
    assert bucket_start(spring, None, zone) == datetime(2024, 3, 30, 23)
    assert bucket_ceiling(spring, None, zone) == datetime(2024, 3, 31, 22)
    autumn = datetime(2024, 10, 27, 0, 30)
    assert bucket_start(autumn, None, zone) == datetime(2024, 10, 26, 22)
    assert bucket_ceiling(autumn, None, zone) == datetime(2024, 10, 27, 23)
