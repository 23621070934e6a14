import json
import os
import time
from datetime import date, datetime, timedelta, timezone

import pytest

from test_match import entity, update
from tramlag.operators.match import match_snapshots
from tramlag.schemas import TABLES
from tramlag.sources.feed import read_snapshots
from tramlag.streaming import live
from tramlag.warehouse import Warehouse

pytestmark = pytest.mark.usefixtures("interpreted")

START = datetime(2024, 7, 1, 12, tzinfo=timezone.utc)


def version_row(spark, version_id):
    day = date(2024, 7, 1)
    return spark.createDataFrame(
        [(version_id, "p", day, day, datetime(2024, 7, 1) + timedelta(minutes=version_id))], TABLES["dim_version"]
    )


def publish(spark, wh, version_id, trips=("T1", "T2"), stops=("S1", "S2")):
    def dim(table, *rows):
        schema = ", ".join(TABLES[table].replace("\n", " ").split(",")[:-1])
        return spark.createDataFrame(list(rows), schema)

    dims = {
        "dim_line": dim("dim_line", ("L1", "1", "x", "tramwaj", "Normalna")),
        "dim_stop": dim("dim_stop", *[(s, s, 1.0, 2.0, None, None, None) for s in stops]),
        "dim_operator": dim("dim_operator", ("O1", "x")),
        "dim_date": dim("dim_date", *[(date(2024, 6, 29) + timedelta(days=i), 2024, 7, 27, 1, "x", "x") for i in range(4)]),
    }
    rows = [
        (t, s, i, "10:00:00", "L1", "0", "x", "O1" if t == "T1" else None, i)
        for t in trips
        for i, s in enumerate(["S1", "S2"])
    ]
    schedule = spark.createDataFrame(
        rows,
        """trip_id string, stop_id string, stop_sequence int, sched_arrival string, line_id string,
           direction string, headsign string, operator_id string, day_offset short""",
    )
    wh.publish(version_row(spark, version_id), version_id, dims, schedule)


@pytest.fixture
def wh(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    publish(spark, wh, 1)
    return wh


class Feed:
    """Lands snapshot files with increasing file times."""

    def __init__(self, folder):
        self.folder, self.n = folder, 0
        folder.mkdir()

    def land(self, seconds, *entities):
        self.n += 1
        path = self.folder / f"s{self.n:03}.json"
        stamp = str(int(START.timestamp()) + seconds)
        path.write_text(json.dumps({"header": {"timestamp": stamp}, "entity": list(entities)}) + "\n")
        os.utime(path, (1_700_000_000 + self.n, 1_700_000_000 + self.n))


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path / "feed")


def run(wh, feed, tmp_path, **options):
    query = live.run_live(
        wh, str(feed.folder), str(tmp_path / "checkpoint"), once=True, clock=lambda: START, **options
    )
    query.awaitTermination()
    assert query.exception() is None


def audit(wh, rows):
    return [r[1:] for r in rows(wh.read("fact_run"), "started_at", "snapshot_ts", "status", "observed", "inserted")]


def at(seconds):
    return (START + timedelta(seconds=seconds)).replace(tzinfo=None)


@pytest.mark.parametrize("max_files", [1, 10])
def test_cycles(spark, wh, feed, tmp_path, rows, max_files):
    feed.land(5, entity("T1", update(0, 1), update(1, 2)))
    feed.land(5, entity("T1", update(0, 3)))
    feed.land(3, entity("T2", update(0, 3)))
    feed.land(7, entity("T1", update(0, 4), update(0, 5)), entity("T2", rel="CANCELED"))
    run(wh, feed, tmp_path, max_files=max_files)
    want = [(at(5), "OK", 2, 2), (at(5), "SKIPPED", 0, 0), (at(3), "SKIPPED", 0, 0), (at(7), "OK", 4, 3)]
    got = audit(wh, rows)
    assert sorted(got) == sorted(want) if max_files == 1 else got == want
    assert rows(wh.read("fact_delay"), "ts", "trip_id", "stop_id", "delay_s", "ts_date") == [
        (at(5), "T1", "S1", 1, date(2024, 7, 1)),
        (at(5), "T1", "S2", 2, date(2024, 7, 1)),
        (at(7), "T1", "S1", 4, date(2024, 7, 1)),  # the first of two updates of one stop
        (at(7), "T2", "S1", None, date(2024, 7, 1)),
        (at(7), "T2", "S2", None, date(2024, 7, 1)),
    ]
    # the marker survives a restart
    assert live.Marker(wh).epoch == START.timestamp() + 7
    if max_files > 1:
        feed.land(6, entity("T1", update(0, 9)))
        feed.land(8, entity("T1", update(0, 9)))
        run(wh, feed, tmp_path, max_files=max_files)
        assert wh.read("fact_delay").count() == 6
        assert wh.read("fact_run").where("status = 'SKIPPED'").count() == 3


def test_stream_equals_batch(spark, wh, feed, tmp_path, rows):
    for i in range(6):
        feed.land(i, entity("T1", update(0, i)), entity("T2", update(1, -i, rel="SKIPPED")))
    run(wh, feed, tmp_path, max_files=4)
    snapshots = read_snapshots(spark, str(feed.folder))
    batch = match_snapshots(snapshots, wh.schedule(1), 1, wh.cfg).drop("arrived", "file_path", "entity_pos", "update_pos")
    assert rows(wh.read("fact_delay").drop("ts_date")) == rows(batch)


def test_replay_inserts_nothing(spark, wh, feed, tmp_path, rows):
    feed.land(1, entity("T1", update(0, 1), update(1, 2)))
    snapshots = read_snapshots(spark, str(feed.folder))
    assert [r.inserted for r in live.store_batch(wh, snapshots).collect()] == [2]
    again = live.store_batch(wh, snapshots).collect()
    assert [(r.observed, r.inserted) for r in again] == [(2, 0)]
    assert wh.read("fact_delay").count() == 2


def test_new_version_is_picked_up(spark, wh, feed, tmp_path, rows):
    feed.land(1, entity("T1", update(0, 1)), entity("T3", update(0, 1)))
    run(wh, feed, tmp_path)
    publish(spark, wh, 2, trips=("T1", "T3"))
    feed.land(2, entity("T1", update(0, 1)), entity("T3", update(0, 1)))
    run(wh, feed, tmp_path)
    assert rows(wh.read("fact_delay"), "version_id", "trip_id") == [(1, "T1"), (2, "T1"), (2, "T3")]


def test_failed_batch_is_audited_and_can_be_replayed(spark, tmp_path, feed, rows):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    publish(spark, wh, 1, stops=("S1",))
    feed.land(1, entity("T1", update(0, 1)))
    feed.land(2, entity("T1", update(0, 1), update(1, 1)))  # S2 is unknown
    run(wh, feed, tmp_path)
    assert sorted(audit(wh, rows)) == [(at(1), "OK", 1, 1), (at(2), "ERROR", 0, 0)]
    error = wh.read("fact_run").where("status = 'ERROR'").first()["error"]
    assert "unknown references [('stop_id', 'S2')]" in error and len(error) <= 500
    assert wh.read("fact_delay").count() == 1
    publish(spark, wh, 2, stops=("S1", "S2"))
    assert live.replay_quarantine(wh) == 1
    assert wh.read("fact_delay").count() == 3
    assert live.replay_quarantine(wh) == 0


def test_orphans_can_be_set_aside(spark, tmp_path, feed, rows):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    publish(spark, wh, 1, stops=("S1",))
    feed.land(2, entity("T1", update(0, 1), update(1, 1)))
    run(wh, feed, tmp_path, on_orphans="quarantine")
    assert audit(wh, rows) == [(at(2), "OK", 2, 1)]
    assert rows(spark.read.parquet(wh.path("_rejected_facts")), "stop_id") == [("S2",)]


def test_audit_limits_and_failure(spark, wh, rows, monkeypatch):
    schema = "arrived bigint, file_path string, epoch bigint, snapshot_ts timestamp_ntz, observed int, inserted int, status string"
    cycles = spark.createDataFrame([(1, "f", None, None, 0, 0, "ERROR")], schema)
    live.audit(wh, cycles, START, 12345.6789, "x" * 900)
    row = wh.read("fact_run").first()
    assert str(row["seconds"]) == "12345.679" and len(row["error"]) == 500
    monkeypatch.setattr(Warehouse, "append", lambda *a: 1 / 0)
    live.audit(wh, cycles, START, 1.0)  # logged only


def test_unreadable_records_are_errors_and_hold_up_nothing(spark, wh, feed, tmp_path, rows):
    feed.land(1, entity("T1", update(0, 1)))
    whole = (feed.folder / "s001.json").read_text()
    (feed.folder / "s002.json").write_text(whole[: len(whole) // 2])
    (feed.folder / "s003.json").write_text(json.dumps({"header": {"timestamp": "noon"}, "entity": []}))
    feed.n = 3
    feed.land(4, entity("T1", update(0, 4)))
    run(wh, feed, tmp_path, max_files=10)
    assert sorted(map(repr, audit(wh, rows))) == sorted(
        map(repr, [(None, "ERROR", 0, 0)] * 2 + [(at(1), "OK", 1, 1), (at(4), "OK", 1, 1)])
    )
    errors = [r.error for r in wh.read("fact_run").where("status = 'ERROR'").collect()]
    assert sorted(e[-9:] for e in errors) == ["s002.json", "s003.json"]
    assert spark.read.json(wh.path("_unreadable")).count() == 2


def test_runs_do_not_touch_each_others_quarantine(spark, tmp_path, feed, rows):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    publish(spark, wh, 1, stops=("S1",))
    for i in (1, 2):
        feed.land(i, entity("T1", update(1, i)))  # S2 is unknown
        live.run_live(wh, str(feed.folder), str(tmp_path / f"c{i}"), once=True, clock=lambda: START, max_files=9).awaitTermination()
    waiting = spark.read.parquet(wh.path("_quarantine"))
    assert waiting.select("run").distinct().count() == 2 and waiting.count() == 3
    assert live.replay_quarantine(wh) == 0  # they fail again, are audited and stay
    assert spark.read.parquet(wh.path("_quarantine")).count() == 3
    publish(spark, wh, 2, stops=("S1", "S2"))
    assert live.replay_quarantine(wh) == 2
    assert wh.read("fact_delay").count() == 2


def test_first_arrival_is_kept(spark, wh, feed, tmp_path, rows):
    feed.land(5, entity("T2", update(1, 7)), entity("T1", update(0, 111)))
    feed.land(5, entity("T1", update(0, 222)))
    run(wh, feed, tmp_path, max_files=10, skip_stale=False)
    assert rows(wh.read("fact_delay"), "trip_id", "delay_s") == [("T1", 111), ("T2", 7)]


def test_start_needs_a_version(spark, tmp_path, feed):
    with pytest.raises(LookupError):
        live.run_live(Warehouse(spark, str(tmp_path / "none")), str(feed.folder), str(tmp_path / "c"))


def test_interval_trigger(spark, wh, feed, tmp_path):
    feed.land(1, entity("T1", update(0, 1)))
    query = live.run_live(wh, str(feed.folder), str(tmp_path / "checkpoint"))
    try:
        query.processAllAvailable()
        assert wh.read("fact_delay").count() == 1
    finally:
        query.stop()


# ------------------------------------------------------------------ bounded state, retries, halving


def watched(monkeypatch):
    """Partitions of the facts that are opened from now on."""
    opened, read = [], Warehouse.read

    def reading(self, table, only=None):
        if table == "fact_delay":
            opened.append(only)
        return read(self, table, only)

    monkeypatch.setattr(Warehouse, "read", reading)
    return opened


def test_a_feed_in_order_reads_no_stored_date(spark, wh, feed, tmp_path, rows, monkeypatch):
    for i in range(4):
        feed.land(i, entity("T1", update(0, i)), entity("T2", rel="CANCELED"))
    opened = watched(monkeypatch)
    run(wh, feed, tmp_path, max_files=2)
    assert len(opened) == 1  # when the query starts
    monkeypatch.undo()
    assert wh.read("fact_delay").count() == 12
    # the same snapshots land again, with one that is new: nothing is stored twice
    for i in range(4):
        feed.land(i, entity("T1", update(0, 100 + i), update(1, 5)), entity("T2", rel="CANCELED"))
    feed.land(9, entity("T1", update(0, 9)))
    opened = watched(monkeypatch)
    run(wh, feed, tmp_path, max_files=10, skip_stale=False)
    assert len(opened) == 2  # when the query starts, and the dates of the batch that goes back
    monkeypatch.undo()
    assert wh.read("fact_delay").count() == 12 + 4 + 1
    assert rows(wh.read("fact_delay").where("trip_id = 'T1' and stop_id = 'S1'"), "delay_s") == [(0,), (1,), (2,), (3,), (9,)]


def test_tried_is_one_number(wh):
    tried = live.Tried(wh)
    assert tried.epoch is None and tried.begin(5, 9) and tried.epoch == 9
    assert not tried.begin(9, 12) and tried.epoch == 12
    assert not tried.begin(3, 4) and tried.epoch == 12
    assert tried.begin(13, 13) and tried.epoch == 13


def test_one_bad_snapshot_costs_one_snapshot(spark, tmp_path, feed, rows):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    publish(spark, wh, 1, stops=("S1",))
    for i in range(8):
        feed.land(i, entity("T1", update(1 if i == 5 else 0, i)))  # S2 is unknown
    feed.land(3, entity("T1", update(0, 99)))  # stale
    run(wh, feed, tmp_path, max_files=99)
    want = [(at(i), "ERROR" if i == 5 else "OK", int(i != 5), int(i != 5)) for i in range(8)]
    assert sorted(audit(wh, rows)) == sorted([*want, (at(3), "SKIPPED", 0, 0)])
    assert rows(wh.read("fact_delay"), "delay_s") == [(i,) for i in range(8) if i != 5]
    waiting = spark.read.parquet(wh.path("_quarantine"))
    assert [r.file_path[-9:] for r in waiting.collect()] == ["s006.json"]
    assert wh.read("fact_run").select("started_at").distinct().count() == 9
    assert live.Marker(wh).epoch == START.timestamp() + 7
    assert live.attempts(wh).count() == 1


def test_a_fault_in_all_snapshots_is_not_halved_for_ever(spark, wh, feed, tmp_path, monkeypatch):
    for i in range(6):
        feed.land(i, entity("T1", update(0, i)))
    tries = []
    monkeypatch.setattr(live, "match_snapshots", lambda *a: tries.append(1) or 1 / 0)
    monkeypatch.setattr(live, "MOST_FAILURES", 4)
    run(wh, feed, tmp_path, max_files=99)
    monkeypatch.undo()
    assert len(tries) <= 6 and spark.read.parquet(wh.path("_quarantine")).count() == 6
    assert live.replay_quarantine(wh) == 1 and wh.read("fact_delay").count() == 6


def test_later_cycles_try_again(spark, tmp_path, feed, rows):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    publish(spark, wh, 1, stops=("S1",))
    now = [START]

    def cycle(seconds, *entities):
        now[0] = START + timedelta(seconds=seconds)
        feed.land(seconds, *entities)
        live.run_live(wh, str(feed.folder), str(tmp_path / "c"), once=True, clock=lambda: now[0]).awaitTermination()

    cycle(0, entity("T1", update(1, 7)))
    cycle(20, entity("T1", update(0, 1)))  # not due yet
    assert live.attempts(wh).count() == 1
    cycle(60, entity("T1", update(0, 2)))  # due, and fails again
    assert live.attempts(wh).count() == 2 and len(live.waiting_batches(wh)) == 1
    publish(spark, wh, 2)
    cycle(100, entity("T1", update(0, 3)))  # the pause has doubled
    assert len(live.waiting_batches(wh)) == 1
    cycle(200, entity("T1", update(0, 4)))
    assert live.waiting_batches(wh) == [] and live.attempts(wh).count() == 2
    assert rows(wh.read("fact_delay"), "delay_s", "version_id") == [(1, 1), (2, 1), (3, 2), (4, 2), (7, 2)]
    assert wh.read("fact_run").where("status = 'ERROR'").count() == 2


def tables_below(monkeypatch, folder):
    """The live path's intermediate tables go there; returns a function that lists what they are for."""
    folder.mkdir()
    monkeypatch.setattr(live, "shared_folder", lambda spark, purpose: f"{folder}/{purpose}-{time.monotonic_ns()}")
    return lambda: {name.split("-")[0] for name in os.listdir(folder)}


def test_no_rows_of_a_batch_are_cached_and_no_table_of_it_stays(spark, wh, feed, tmp_path, monkeypatch):
    """Executors' memory does not grow with a batch: only its heads and unknown references are cached."""
    log_touched, held, cached, tables = live.log_touched, tables_below(monkeypatch, tmp_path / "shared"), [], []

    def seen(*args):
        cached.append(sum(r.memSize() + r.diskSize() for r in spark.sparkContext._jsc.sc().getRDDStorageInfo()))
        tables.append(held())
        log_touched(*args)

    monkeypatch.setattr(live, "log_touched", seen)
    for i, updates in enumerate([1, 4000]):
        feed.land(i, *[entity("T1", update(0, n), update(1, n)) for n in range(updates)])
        run(wh, feed, tmp_path, max_files=1)
    few, many = cached
    assert many < 1.2 * few + 1000  # 8,000 facts instead of two
    assert all({"batch", "planned", "matched", "new"} <= found for found in tables)
    assert held() == set()


def test_tables_of_a_failed_batch_are_deleted(spark, tmp_path, feed, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    publish(spark, wh, 1, stops=("S1",))
    held = tables_below(monkeypatch, tmp_path / "shared")
    feed.land(1, entity("T1", update(1, 1)))  # S2 is unknown
    run(wh, feed, tmp_path)
    assert live.waiting_batches(wh)
    assert held() == set()
