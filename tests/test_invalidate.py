"""Refresh by invalidation, backfill in chunks, newest rows first."""

import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tramlag.config import DEFAULTS
from tramlag.plans import backfill, invalidate, maintain, reports
from tramlag.schemas import TABLES
from tramlag.warehouse import Warehouse, week_start

pytestmark = pytest.mark.usefixtures("interpreted")

NOW = datetime(2026, 3, 20, 10, 7)


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def facts(spark, *rows):
    """Facts from (time, delay); the line follows the hour."""
    made = [
        (ts, 1, f"T{i}", "S1", i, f"L{ts.hour % 3}", None if ts.hour % 2 else "O1", "0", date(2026, 3, 1), delay, "OBSERWACJA")
        for i, (ts, delay) in enumerate(rows)
    ]
    return spark.createDataFrame(made, TABLES["fact_delay"].rsplit(",", 1)[0])


def once(wh, level):
    """A level from all facts at once."""
    rows = wh.read("fact_delay")
    for part in {"agg_line_1h": ["agg_line_15m"], "agg_line_1d": ["agg_line_15m", "agg_line_1h"]}.get(level, []):
        rows = maintain.aggregate(wh, part, rows)
    return maintain.aggregate(wh, level, rows)


def equal(wh, level):
    stored = wh.read(level).drop("bucket_date")
    whole = once(wh, level).select(*stored.columns)
    return stored.exceptAll(whole).isEmpty() and whole.exceptAll(stored).isEmpty()


def test_only_touched_buckets_are_rebuilt(spark, wh, rows):
    days = [datetime(2026, 3, 14, 9), datetime(2026, 3, 15, 9), datetime(2026, 3, 16, 9), datetime(2026, 3, 17, 23, 50)]
    invalidate.append_facts(wh, facts(spark, *[(d, 1) for d in days]))
    first = {r.level: r for r in invalidate.refresh_all_invalid(wh, NOW)}
    assert first["agg_line_15m"].rewritten == ["2026-03-14", "2026-03-15", "2026-03-16", "2026-03-17"]
    assert [len(r.rebuilt) for r in first.values()] == [4, 4, 4, 4]
    assert all(equal(wh, level) for level in maintain.REFRESH_ORDER)
    # nothing new: nothing is opened or written
    before = {level: wh.generations(level) for level in maintain.REFRESH_ORDER}
    assert all(not r.rebuilt and not r.rewritten for r in invalidate.refresh_all_invalid(wh, NOW))
    assert before == {level: wh.generations(level) for level in maintain.REFRESH_ORDER}
    # one late fact: one bucket, one partition a level
    invalidate.append_facts(wh, facts(spark, (datetime(2026, 3, 15, 9, 3), 7)))
    again = invalidate.refresh_all_invalid(wh, NOW)
    assert [r.rewritten for r in again] == [["2026-03-15"]] * 3 + [["2026-03-14"]]
    assert [r.rebuilt for r in again][2:] == [[datetime(2026, 3, 15, 9)], [datetime(2026, 3, 14, 23)]]
    assert all(equal(wh, level) for level in maintain.REFRESH_ORDER)
    # a range that is logged again changes nothing and passes nothing on
    invalidate.invalidate(wh, "agg_line_15m", datetime(2026, 3, 15, 9, 1), datetime(2026, 3, 15, 9, 2))
    same = invalidate.refresh_all_invalid(wh, NOW)
    assert same[0].rebuilt == [datetime(2026, 3, 15, 9)] and not any(r.rewritten for r in same)
    assert not same[2].rebuilt and not same[3].rebuilt


def test_what_lies_outside_the_window_waits(spark, wh, rows):
    old, new, recent = datetime(2026, 3, 1, 9), datetime(2026, 3, 16, 9), datetime(2026, 3, 20, 10, 5)
    invalidate.append_facts(wh, facts(spark, (old, 1), (new, 2), (recent, 3)))
    done = invalidate.refresh_invalid(wh, "agg_line_15m", NOW)
    assert done.rebuilt == [new] and [r[0] for r in done.left] == [old, datetime(2026, 3, 20, 10)]
    assert len(invalidate.pending(wh, "agg_line_15m")[0]) == 1
    later = invalidate.refresh_invalid(wh, "agg_line_15m", NOW + timedelta(hours=1))
    assert later.rebuilt == [datetime(2026, 3, 20, 10)]
    assert invalidate.refresh_touched(wh, "agg_line_15m", datetime(2026, 2, 1), NOW.replace(minute=0)).rebuilt == [old]
    assert equal(wh, "agg_line_15m") and invalidate.pending(wh, "agg_line_15m") == ([], [])


def test_a_refresh_that_dies_is_repeated(spark, wh, monkeypatch):
    invalidate.append_facts(wh, facts(spark, (datetime(2026, 3, 16, 9), 2)))
    point = Warehouse._point
    for dies_after in (False, True):
        def die(self, *args):
            if dies_after:
                point(self, *args)
            raise RuntimeError("died")

        monkeypatch.setattr(Warehouse, "_point", die)
        with pytest.raises(RuntimeError, match="died"):
            invalidate.refresh_invalid(wh, "agg_line_15m", NOW)
        monkeypatch.undo()
    invalidate.refresh_all_invalid(wh, NOW)
    assert all(equal(wh, level) for level in maintain.REFRESH_ORDER)


def test_any_order_of_appends_and_refreshes_equals_one_shot(spark, wh):
    rng = random.Random(5)
    times = [datetime(2026, 3, 14) + timedelta(minutes=37 * i) for i in range(200)]
    rng.shuffle(times)
    for step in range(0, 200, 50):
        part = times[step : step + 50]
        invalidate.append_facts(wh, facts(spark, *[(t, i) for i, t in enumerate(part)]))
        for level in rng.sample(maintain.REFRESH_ORDER, 2):
            invalidate.refresh_invalid(wh, level, NOW - timedelta(hours=rng.randint(0, 60)))
    invalidate.refresh_all_invalid(wh, NOW)
    invalidate.refresh_all_invalid(wh, NOW)
    assert all(equal(wh, level) for level in maintain.REFRESH_ORDER)


ranges_of = st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(ranges_of, st.integers(0, 50), st.integers(0, 50))
def test_ranges_are_divided_without_loss(spans, lo, hi):
    at = lambda m: datetime(2026, 3, 1) + timedelta(minutes=m)
    lo, hi = min(lo, hi), max(lo, hi)
    ranges = [(at(a), at(a + n)) for a, n in spans]
    inside, outside = invalidate.divided(ranges, at(lo), at(hi))
    minutes = lambda found: sorted(m for a, b in found for m in range(60) if a <= at(m) < b)
    assert minutes(inside) == [m for m in minutes(ranges) if lo <= m < hi]
    assert minutes(outside) == [m for m in minutes(ranges) if not lo <= m < hi]


def test_ranges_are_merged():
    at = lambda m: datetime(2026, 3, 1) + timedelta(minutes=m)
    spans = [(9, 12), (0, 5), (3, 4), (5, 7), (9, 10), (20, 21)]
    want = [(at(a), at(b)) for a, b in ((0, 7), (9, 12), (20, 21))]
    assert invalidate.merged([(at(a), at(b)) for a, b in spans]) == want


# ------------------------------------------------------------------ backfill


@pytest.mark.parametrize("level", ["agg_line_15m", "agg_line_1d"])
def test_backfill_goes_on_where_it_stopped(spark, wh, monkeypatch, level):
    start = datetime(2026, 3, 1, 12)
    invalidate.append_facts(wh, facts(spark, *[(start + timedelta(hours=7 * i), i) for i in range(30)]))
    if level == "agg_line_1d":
        for finer in ("agg_line_15m", "agg_line_1h"):
            maintain.backfill(wh, finer, datetime(2026, 2, 1), NOW)
    first, last = datetime(2026, 2, 27), datetime(2026, 3, 12)
    size = wh.stored_bytes(maintain.SOURCES[level][0], "2026-03-04")
    planned = backfill.chunks(wh, level, *(maintain.bucket_start(t, maintain.BUCKET_WIDTHS[level], wh.cfg.zone) for t in (first, last)), 2 * size)
    assert len(planned) >= 4 and all(a[2] == b[1] for a, b in zip(planned, planned[1:]))
    recompute, calls = maintain.recompute, []

    def dying(*args):
        if len(calls) == 2:
            raise RuntimeError("killed")
        calls.append(args[2:])
        recompute(*args)

    monkeypatch.setattr(backfill, "recompute", dying)
    with pytest.raises(RuntimeError, match="killed"):
        backfill.backfill_chunks(wh, level, first, last, 2 * size)
    monkeypatch.undo()
    assert wh.read(level).count() > 0 and not equal(wh, level)
    built = backfill.backfill_chunks(wh, level, first, last, 2 * size)
    assert built == list(range(2, len(planned)))
    assert equal(wh, level) and not wh.names(wh.path("_backfill"))
    assert len(backfill.backfill_chunks(wh, level, first, last)) == 1  # large chunks, everything again
    assert equal(wh, level)


# ------------------------------------------------------------------ newest first


def test_newest_rows_open_few_partitions(spark, wh, rows):
    start = datetime(2026, 3, 1, 12)
    wh.append("fact_delay", facts(spark, *[(start + timedelta(hours=6 * i), i) for i in range(60)]).withColumn("ts_date", F.col("ts").cast("date")))
    for line, k in (("L0", 3), ("L0", 12), ("L2", 500), ("unknown", 5)):
        got = reports.recent_stored_facts(wh, "line_id", line, k)
        whole = reports.recent_facts(wh.read("fact_delay"), "line_id", line, datetime(2020, 1, 1), k)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in whole.collect()]
    assert len(wh.partitions("fact_delay")) == 16
    few = reports.recent_stored_facts(wh, "line_id", "L0", 3)
    assert {p.split("ts_date=")[1][:10] for p in few.inputFiles()} == {"2026-03-14", "2026-03-15", "2026-03-16"}
    assert reports.latest_stored_failures(wh).count() == 0
    runs = [(NOW - timedelta(days=d), None, 0, 0, None, "ERROR" if d % 3 else "OK", f"e{d}", None) for d in range(0, 80, 2)]
    df = spark.createDataFrame(runs, TABLES["fact_run"])
    wh.append("fact_run", df.withColumn("week_start", week_start(F.col("started_at"))))
    got = reports.latest_stored_failures(wh, 4)
    assert [r.error for r in got.collect()] == ["e2", "e4", "e8", "e10"]
    assert len({p.split("week_start=")[1][:10] for p in got.inputFiles()}) <= 3 < len(wh.partitions("fact_run"))


def test_wide_windows_must_not_reach_behind_the_facts(wh):
    wide = {k: replace(p, start=timedelta(days=99)) for k, p in DEFAULTS.refresh.items()}
    with pytest.raises(ValueError, match="retention"):
        invalidate.refresh_invalid(Warehouse(wh.spark, wh.root, replace(DEFAULTS, refresh=wide)), "agg_line_15m", NOW)
