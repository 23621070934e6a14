"""Partitions replaced as generations: nothing half done is seen, and two jobs do not meet."""

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from test_live import publish, version_row

from tramlag.plans import static_load
from tramlag.schemas import TABLES
from tramlag.warehouse import ClaimedError, ReplacedError, Warehouse, trip_part

pytestmark = pytest.mark.usefixtures("interpreted")

D1, D2, D3 = "2026-03-01", "2026-03-02", "2026-03-03"


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def facts(spark, *rows):
    """Fact rows from (date, delay)."""
    made = [
        (datetime.fromisoformat(day) + timedelta(hours=9), 1, "T", "S", 1, "L1", "O1", "0", date(2026, 3, 1), delay, "OBSERWACJA", date.fromisoformat(day))
        for day, delay in rows
    ]
    return spark.createDataFrame(made, TABLES["fact_delay"])


def shown(wh, rows):
    return [(str(d), v) for d, v in rows(wh.read("fact_delay"), "ts_date", "delay_s")]


def test_replacement_and_appends(spark, wh, rows):
    wh.append("fact_delay", facts(spark, (D1, 1), (D1, 2), (D2, 3)))
    before = wh.read("fact_delay")
    wh.replace_partitions("fact_delay", facts(spark, (D1, 9)), [D1, D2])
    assert shown(wh, rows) == [(D1, 9)] and wh.partitions("fact_delay") == [D1]
    assert before.count() == 3  # whoever had begun to read reads on
    wh.append("fact_delay", facts(spark, (D1, 10), (D2, 11), (D3, 12)))
    assert shown(wh, rows) == [(D1, 9), (D1, 10), (D2, 11), (D3, 12)]
    assert shown(Warehouse(spark, wh.root), rows) == shown(wh, rows)
    wh.replace_partitions("fact_delay", facts(spark, (D1, 5)), [D1])
    assert len(wh._stored("fact_delay")[D1]) == 2  # what is in force, and the one before
    assert wh.drop_partitions("fact_delay", lambda v: v < D3) == [D1, D2]
    assert shown(wh, rows) == [(D3, 12)]
    wh.append("fact_delay", facts(spark, (D1, 7)))
    assert shown(wh, rows) == [(D1, 7), (D3, 12)]


@pytest.mark.parametrize("step", ["write", "pointer"])
def test_a_writer_that_dies_leaves_nothing_visible(spark, wh, rows, monkeypatch, step):
    wh.append("fact_delay", facts(spark, (D1, 1), (D2, 2)))
    wh.replace_partitions("fact_delay", facts(spark, (D1, 3)), [D1])
    stored = shown(wh, rows)
    new = facts(spark, (D1, 8), (D2, 8))
    if step == "write":
        poisoned = new.withColumn("delay_s", F.when(F.col("ts_date") == D2, F.raise_error(F.lit("died")).cast("int")).otherwise(8))
        with pytest.raises(Exception, match="died"):
            wh.replace_partitions("fact_delay", poisoned, [D1, D2])
    else:
        monkeypatch.setattr(Warehouse, "put", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            wh.replace_partitions("fact_delay", new, [D1, D2])
        with pytest.raises(ZeroDivisionError):
            wh.drop_partitions("fact_delay", lambda v: True)
        monkeypatch.undo()
    assert shown(wh, rows) == stored
    wh.replace_partitions("fact_delay", new, [D1, D2])
    assert shown(wh, rows) == [(D1, 8), (D2, 8)]
    # what never became visible went with the replacement
    assert all(len(gens) <= 2 for gens in wh._stored("fact_delay").values())


def test_pointers_are_kept_in_few_files(spark, wh, rows, monkeypatch):
    monkeypatch.setattr("tramlag.warehouse.MOST_POINTER_FILES", 3)
    wh.append("fact_delay", facts(spark, (D1, 0), (D2, 0), (D3, 0)))
    for i in range(1, 8):
        wh.replace_partitions("fact_delay", facts(spark, (D1, i)), [D1] if i > 1 else [D1, D2])
    assert len(wh.names(wh._pointer_folder("fact_delay"))) <= 4
    assert shown(wh, rows) == shown(Warehouse(spark, wh.root), rows) == [(D1, 7), (D3, 0)]


def test_compaction_gives_way_to_an_append(spark, wh, rows, monkeypatch):
    for i in (1, 2):
        wh.append("fact_delay", facts(spark, (D1, i)))
    read = Warehouse.read

    def meanwhile(self, table, only=None):
        found = read(self, table, only)
        monkeypatch.undo()
        wh.append("fact_delay", facts(spark, (D1, 3)))
        return found

    monkeypatch.setattr(Warehouse, "read", meanwhile)
    with pytest.raises(ReplacedError):
        wh.compact("fact_delay", D1)
    assert shown(wh, rows) == [(D1, 1), (D1, 2), (D1, 3)]
    wh.compact("fact_delay", D1)
    assert shown(wh, rows) == [(D1, 1), (D1, 2), (D1, 3)] and len(wh.files("fact_delay", D1)) == 1


def test_claims(wh):
    later = datetime.now(timezone.utc) + timedelta(hours=7)
    with wh.claim("job") as check:
        check()
        with pytest.raises(ClaimedError, match="being done"), wh.claim("job"):
            pass
        with wh.claim("other"):
            pass
        with wh.claim("job", lambda: later) as taken:  # beyond the lease
            taken()
            with pytest.raises(ClaimedError, match="taken over"):
                check()
    with wh.claim("job"):
        pass
    with pytest.raises(KeyError), wh.claim("job"):
        raise KeyError
    with wh.claim("job"):  # given back after a failure as well
        assert wh.names(wh.root + "/_claims/job") == ["5"]


def test_two_loads_do_not_meet(spark, wh, monkeypatch):
    """The second load starts while the first one is under way."""
    tried = []

    def load(*args):
        if not tried:
            tried.append("second")
            with pytest.raises(ClaimedError):
                static_load.load_static(wh, "", None, date(2026, 3, 1), datetime(2026, 3, 1))
        publish(spark, wh, wh.next_version_id())
        return 1

    monkeypatch.setattr(static_load, "choose_packages", lambda *a: spark.range(1).persist())
    monkeypatch.setattr(static_load, "_load", load)
    static_load.load_static(wh, "", None, date(2026, 3, 1), datetime(2026, 3, 1))
    assert tried and wh.current_version() == 1


def test_a_load_that_was_overtaken_is_not_published(spark, wh, monkeypatch):
    publish(spark, wh, 1)
    append = Warehouse.append

    def overtaken(self, table, df):
        append(self, table, df)
        if table == "dim_stop":
            monkeypatch.undo()
            publish(spark, wh, 7)

    monkeypatch.setattr(Warehouse, "append", overtaken)
    with pytest.raises(ReplacedError, match="after version 1"):
        publish(spark, wh, 2, trips=("T1", "T9"))
    assert wh.current_version() == 7 and wh.read("dim_version").count() == 2


def test_a_schedule_needs_its_version(spark, wh, monkeypatch):
    monkeypatch.setattr("test_live.version_row", lambda spark, i: version_row(spark, i + 1))
    with pytest.raises(Exception, match="unknown references"):
        publish(spark, wh, 1)
    assert wh.read("dim_version").count() == 0


def scanned(df):
    """Rows that the scan of the schedule has read."""
    df.write.format("noop").mode("overwrite").save()
    return len(df.inputFiles())


def test_a_small_batch_opens_a_small_share_of_a_version(spark, wh, rows):
    trips = [f"T{i}" for i in range(400)]
    publish(spark, wh, 1, trips=trips)
    version = f"{wh.path('schedule')}/version_id=1"
    assert len(wh.names(version)) == wh.cfg.schedule_parts
    few = spark.createDataFrame([("T7",), ("T7",), ("T300",), (None,), ("unknown",)], "trip_id string")
    got = wh.schedule(1, few)
    assert scanned(got) <= 3 < scanned(wh.schedule(1))
    assert rows(got, "trip_id", "stop_sequence") == [("T300", 0), ("T300", 1), ("T7", 0), ("T7", 1)]
    assert sorted(got.columns) == sorted(wh.schedule(1).columns)
    assert wh.schedule(1, few.limit(0)).count() == 0 and wh.schedule(9, few).count() == 0
    every = spark.createDataFrame([(t,) for t in trips], "trip_id string")
    assert wh.schedule(1, every).count() == wh.schedule(1).count() == 800
    # a version keeps the number of parts that it was written with
    other = Warehouse(spark, wh.root, wh.cfg.__class__(schedule_parts=3))
    publish(spark, other, 2, trips=trips)
    assert other.schedule(1, few).count() == other.schedule(2, few).count() == wh.schedule(2, few).count() == 4
    # a trip's stops lie together and in order
    part = every.where("trip_id = 'T7'").select(trip_part(wh.cfg.schedule_parts)).first()[0]
    stored = spark.read.parquet(f"{version}/trip_part={part}").select("trip_id", "stop_sequence").collect()
    assert [tuple(r) for r in stored] == sorted(tuple(r) for r in stored)
