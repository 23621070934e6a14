from datetime import date, datetime, timedelta

import packages as zips
import pytest
from pyspark.sql import functions as F

from tramlag.operators.integrity import IntegrityError
from tramlag.plans import maintain
from tramlag.plans.static_load import MissingPackageError, NoPackageError, load_static
from tramlag.sources.packages import IncompletePackageError
from tramlag.schemas import TABLES
from tramlag.warehouse import NoVersionError, Warehouse, keep_known_labels, week_start

pytestmark = pytest.mark.usefixtures("interpreted")

TODAY = date(2026, 3, 2)


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def land(spark, tmp_path, *specs):
    """Packages (name day, seq, start, end, members) in a landing folder, and their catalogue."""
    folder = tmp_path / "landing"
    names = []
    for day, seq, start, end, members in specs:
        names.append(zips.name_of(day, seq))
        zips.write_package(folder, names[-1], start, end, **members)
    return str(folder), zips.catalogue_of(spark, *names, "notes.pdf", None)


@pytest.fixture
def two_packages(spark, tmp_path):
    other = "trip_id,stop_id,stop_sequence,arrival_time\nT1,S1,0,11:11:11\nT2,S1,2,10:30:00\n"
    return land(
        spark, tmp_path,
        ("2026.02.20", 1, "20260301", "20260308", {}),
        ("2026.02.27", 2, "20260309", "20260320", {"stop_times": other}),
        ("2026.01.01", 9, "20260301", "20260305", {"routes": "route_id\nLX\n"}),
    )


def test_static_load(spark, wh, rows, two_packages):
    landing, catalogue = two_packages
    version = load_static(wh, landing, catalogue, TODAY, datetime(2026, 3, 2, 4))
    assert version == 1 and wh.current_version() == 1
    names = " | ".join([zips.name_of("2026.02.20", 1), zips.name_of("2026.02.27", 2)])
    assert rows(wh.read("dim_version")) == [(1, names, TODAY, date(2026, 3, 15), datetime(2026, 3, 2, 4))]
    assert rows(wh.dimension("dim_line"), "line_id", "mode", "line_type") == [
        ("L1", "tramwaj", "Nocna"),
        ("L2", "inne", "Normalna"),
    ]
    assert rows(wh.dimension("dim_stop"), "stop_id", "lat", "commune", "stop_type") == [
        ("S1", 50.1, "Seven", "Terminus"),
        ("S2", None, None, None),
        ("S3", 50.3, None, "Standardowy"),
    ]
    assert rows(wh.schedule(1), "trip_id", "stop_id", "stop_sequence", "sched_arrival", "operator_id", "day_offset") == [
        ("T1", "S1", 0, "23:50:00", "O1", 0),
        ("T1", "S2", 1, "24:05:00", "O1", 1),
        ("T2", "S1", 2, "10:30:00", None, 0),
        ("T2", "S3", 1, "10:00:00", None, 0),
    ]
    days = wh.dimension("dim_date")
    assert days.count() == 35 + 14
    assert rows(days.where(F.col("date").between("2026-02-28", "2026-03-01")), "day_type") == [("Robocze",), ("brak rozkładu",)]


def test_known_day_types_can_be_kept(spark, rows):
    days = [date(2026, 3, i) for i in (1, 2, 3)]
    target = spark.createDataFrame(list(zip(days, ["A", "brak rozkładu", "A"])), "date date, day_type string")
    batch = spark.createDataFrame(list(zip(days, ["brak rozkładu"] * 2 + ["B"])), "date date, day_type string")
    assert rows(keep_known_labels(target, batch)) == list(zip(days, ["A", "brak rozkładu", "B"]))


def test_second_load_ten_days_later(spark, wh, rows, tmp_path):
    first, catalogue = land(spark, tmp_path, ("2026.02.20", 1, "20260301", "20260315", {}))
    load_static(wh, first, catalogue, TODAY, datetime(2026, 3, 2, 4))
    changed = {
        "routes": "route_id,route_short_name,route_long_name,route_type\nL1,1b,Line one,3\n",
        "stops": "stop_id,stop_name,stop_lat,stop_lon\nS9,Ninth,1,2\n",
    }
    (tmp_path / "later").mkdir()
    second, catalogue = land(spark, tmp_path / "later", ("2026.03.10", 1, "20260312", "20260325", changed))
    later = TODAY + timedelta(days=10)
    assert load_static(wh, second, catalogue, later, datetime(2026, 3, 12, 4)) == 2
    assert rows(wh.dimension("dim_line"), "line_id", "short_name") == [("L1", "1b"), ("L2", "2")]
    assert rows(wh.dimension("dim_stop"), "stop_id") == [("S1",), ("S2",), ("S3",), ("S9",)]
    days = wh.dimension("dim_date")
    assert days.agg(F.min("date"), F.max("date")).first()[:] == (date(2026, 1, 26), date(2026, 3, 25))
    assert rows(days.where("date = '2026-03-03'"), "day_type") == [("brak rozkładu",)]
    # readers of the old version still find its dimensions and schedule
    assert rows(wh.dimension("dim_line", 1), "line_id", "short_name") == [("L1", "1"), ("L2", "2")]
    assert wh.schedule(1).count() == 3


def test_unpublished_load_stays_invisible(spark, wh, two_packages, monkeypatch):
    landing, catalogue = two_packages
    load_static(wh, landing, catalogue, TODAY, datetime(2026, 3, 2, 4))
    append = Warehouse.append

    def fail_on_version(self, table, df):
        if table == "dim_version":
            raise RuntimeError("lost")
        append(self, table, df)

    monkeypatch.setattr(Warehouse, "append", fail_on_version)
    with pytest.raises(RuntimeError, match="lost"):
        load_static(wh, landing, catalogue, TODAY, datetime(2026, 3, 3, 4))
    monkeypatch.undo()
    assert wh.current_version() == 1 and wh.dimension("dim_line").count() == 2
    assert load_static(wh, landing, catalogue, TODAY, datetime(2026, 3, 3, 4)) == 3


def test_failing_loads(spark, wh, tmp_path):
    landing, catalogue = land(spark, tmp_path, ("2026.02.20", 1, "20250301", "20250308", {}))
    with pytest.raises(NoPackageError):
        load_static(wh, landing, catalogue, TODAY, datetime(2026, 3, 2, 4))
    with pytest.raises(NoVersionError):
        wh.current_version()
    bad = {"stop_times": "trip_id,stop_id,stop_sequence,arrival_time\nT1,S1,x,10:00:00\n"}
    (tmp_path / "bad").mkdir()
    landing, catalogue = land(spark, tmp_path / "bad", ("2026.02.20", 1, "20260301", "20260308", bad))
    with pytest.raises(IntegrityError, match="stop_sequence"):
        load_static(wh, landing, catalogue, TODAY, datetime(2026, 3, 2, 4))
    with pytest.raises(NoVersionError):
        wh.current_version()


@pytest.mark.parametrize(
    "members",
    [
        {"stop_times": None},
        {"routes": None},
        {"stop_times": "trip_id,stop_id,stop_sequence\nT1,S1,1\n"},
    ],
)
def test_incomplete_packages_are_refused(spark, wh, tmp_path, members):
    landing, catalogue = land(spark, tmp_path, ("2026.02.20", 1, "20260301", "20260308", members))
    with pytest.raises(IncompletePackageError, match=next(iter(members))):
        load_static(wh, landing, catalogue, TODAY, datetime(2026, 3, 2, 4))
    with pytest.raises(NoVersionError):
        wh.current_version()


def test_a_listed_package_must_have_landed_and_an_unlisted_one_is_not_opened(spark, wh, tmp_path):
    landing, catalogue = land(spark, tmp_path, ("2026.02.20", 1, "20260301", "20260331", {}))
    (tmp_path / "landing" / "schedule_ZTM_2026.02.28_9_1.zip").write_bytes(b"no archive at all")
    old, new = zips.name_of("2026.01.01", 1), zips.name_of("2026.02.25", 7)
    rows = spark.createDataFrame([(n, "u") for n in (old, new)], "name string, url string")
    with pytest.raises(MissingPackageError, match="2026.02.25"):
        load_static(wh, landing, catalogue.unionByName(rows), TODAY, datetime(2026, 3, 2, 4))
    # an old one that could add no day is not needed
    only_old = rows.where(rows["name"] == old)
    assert load_static(wh, landing, catalogue.unionByName(only_old), TODAY, datetime(2026, 3, 2, 4)) == 1


def test_empty_tables_have_their_schema(spark, wh):
    for table, schema in TABLES.items():
        assert wh.read(table).schema == spark.createDataFrame([], schema).schema
    assert maintain.line_15m_realtime(wh, datetime(2026, 3, 2)).count() == 0


# ------------------------------------------------------------------ aggregates and retention

NOW = datetime(2026, 3, 20, 10, 7)


def add_facts(spark, wh, *rows):
    day = date(2026, 3, 1)
    df = spark.createDataFrame(
        [(ts, 1, f"T{i}", "S1", i, "L1", "O1", "0", day, delay, "OBSERWACJA", ts.date()) for i, (ts, delay) in enumerate(rows)],
        TABLES["fact_delay"],
    )
    wh.append("fact_delay", df)


def test_refresh_windows(wh):
    assert maintain.refresh_window(wh.cfg, "agg_line_15m", NOW) == (datetime(2026, 3, 13, 10, 15), datetime(2026, 3, 20, 9, 45))
    assert maintain.refresh_window(wh.cfg, "agg_line_1h", NOW) == (datetime(2026, 3, 6, 11), datetime(2026, 3, 20, 9))
    assert maintain.refresh_window(wh.cfg, "agg_line_1d", NOW) == (datetime(2026, 1, 19, 23), datetime(2026, 3, 19, 23))
    exact = datetime(2026, 3, 20, 10, 10)
    assert maintain.refresh_window(wh.cfg, "agg_stop_15m", exact) == (datetime(2026, 3, 13, 10, 15), datetime(2026, 3, 20, 10))


def test_refresh_replaces_whole_buckets_inside_the_window(spark, wh, rows):
    edge, inside, newest = datetime(2026, 3, 13, 10), datetime(2026, 3, 15, 9), datetime(2026, 3, 20, 9, 45)
    add_facts(spark, wh, (edge, 1), (inside, 10), (newest, 100))
    maintain.refresh(wh, "agg_line_15m", NOW)
    assert rows(wh.read("agg_line_15m"), "bucket", "delay_sum") == [(inside, 10)]
    maintain.backfill(wh, "agg_line_15m", datetime(2026, 3, 1), datetime(2026, 3, 14))
    add_facts(spark, wh, (edge, 5), (datetime(2026, 3, 12, 8), 7), (inside, 20))  # the first two come too late
    maintain.refresh(wh, "agg_line_15m", NOW)
    stored = [(edge, 1), (inside, 30)]
    assert rows(wh.read("agg_line_15m"), "bucket", "delay_sum") == stored
    maintain.refresh(wh, "agg_line_15m", NOW)
    assert rows(wh.read("agg_line_15m"), "bucket", "delay_sum") == stored
    realtime = maintain.line_15m_realtime(wh, NOW)
    assert rows(realtime, "bucket", "delay_sum") == [*stored, (newest, 100)]


def test_refresh_drops_partitions_that_become_empty(spark, wh, rows):
    add_facts(spark, wh, (datetime(2026, 3, 15, 9), 1), (datetime(2026, 3, 16, 9), 2))
    maintain.refresh_all(wh, NOW)
    assert wh.partitions("agg_stop_15m") == ["2026-03-15", "2026-03-16"]
    wh.drop_partitions("fact_delay", lambda value: value == "2026-03-15")
    maintain.refresh_all(wh, NOW)
    assert wh.partitions("agg_stop_15m") == ["2026-03-16"]
    assert rows(wh.read("agg_line_1d"), "bucket", "delay_sum") == [(datetime(2026, 3, 15, 23), 2)]


def test_refresh_without_facts(spark, wh):
    maintain.refresh_all(wh, NOW)
    assert all(wh.read(level).count() == 0 for level in maintain.REFRESH_ORDER)
    add_facts(spark, wh, (NOW - timedelta(days=20), 1))  # outside the window of the 15-minute levels
    maintain.refresh_all(wh, NOW)
    assert wh.read("agg_line_15m").count() == 0


def test_any_refresh_schedule_equals_one_shot(spark, wh, rows):
    times = [datetime(2026, 3, 14) + timedelta(minutes=37 * i) for i in range(200)]
    for step in range(0, 200, 50):
        add_facts(spark, wh, *[(t, i) for i, t in enumerate(times[step : step + 50])])
        maintain.refresh_all(wh, times[step + 49] + timedelta(hours=30))
    got = rows(wh.read("agg_line_1d").drop("bucket_date"))
    once = maintain.aggregate(wh, "agg_line_15m", wh.read("fact_delay"))
    once = maintain.aggregate(wh, "agg_line_1d", maintain.aggregate(wh, "agg_line_1h", once))
    assert got == rows(once.select(wh.read("agg_line_1d").drop("bucket_date").columns))


def test_retention(spark, wh, rows):
    limit = NOW - timedelta(days=30)
    add_facts(spark, wh, (limit - timedelta(days=1), 1), (limit, 2), (limit.replace(hour=0, minute=0), 3), (NOW, 4))
    maintain.backfill(wh, "agg_line_15m", limit - timedelta(days=5), NOW)
    runs = spark.createDataFrame(
        [(NOW - timedelta(days=d), None, 0, 0, None, "OK", None, None) for d in (80, 90, 95, 100)], TABLES["fact_run"]
    )
    wh.append("fact_run", runs.withColumn("week_start", week_start(F.col("started_at"))))
    # 2025-12-20 is the limit; its week starts on the 15th
    dropped = maintain.apply_retention(wh, NOW)
    assert dropped == {"fact_delay": ["2026-02-17"], "fact_run": ["2025-12-08"]}
    assert rows(wh.read("fact_delay"), "delay_s") == [(2,), (3,), (4,)]
    assert wh.read("fact_run").count() == 3
    assert wh.read("agg_line_15m").count() == 3
    # a partition exactly at the limit stays, the one before it goes
    assert maintain.first_kept_day(datetime(2026, 3, 20), timedelta(days=30)) == date(2026, 2, 18)


def test_closed_dates_are_compacted(spark, wh, rows):
    empty = wh.read("fact_delay").schema
    for n in (17, 17, 19, 19):
        df = spark.createDataFrame([(datetime(2026, 3, n, 10), f"T{n}")], "ts timestamp_ntz, trip_id string")
        df = df.withColumn("ts_date", F.col("ts").cast("date"))
        wh.append("fact_delay", df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in empty]))
    assert maintain.compact_closed(wh, NOW) == ["2026-03-17"]
    assert len(wh.files("fact_delay", "2026-03-17")) == 1 and len(wh.files("fact_delay", "2026-03-19")) == 2


def test_views(spark, wh, two_packages):
    load_static(wh, *two_packages, TODAY, datetime(2026, 3, 2, 4))
    add_facts(spark, wh, (datetime(2026, 3, 15, 9), 90))
    maintain.refresh_all(wh, NOW)
    wh.register_views()
    got = spark.sql(
        """select l.short_name, sum(a.delay_sum) / sum(a.obs) from agg_line_1h a
           join dim_line l on l.line_id = a.line_id group by 1"""
    )
    assert [tuple(r) for r in got.collect()] == [("1", 90.0)]


def test_scans_are_pruned(spark, wh):
    add_facts(spark, wh, (datetime(2026, 3, 15, 9), 1), (datetime(2026, 3, 16, 9), 2))
    lo, hi = datetime(2026, 3, 16), datetime(2026, 3, 17)
    df = maintain.between(wh.read("fact_delay"), "ts", "ts_date", lo, hi).select("delay_s")
    plan = df._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ts_date" in plan and "ReadSchema: struct<ts:timestamp_ntz,delay_s:int>" in plan
    assert len(df.inputFiles()) == 2 and df.count() == 1
