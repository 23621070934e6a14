"""Aggregates by streamed windows equal the batch, late facts included, within the watermark."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_invalidate import equal, facts

from tramlag.plans import invalidate, maintain
from tramlag.schemas import TABLES
from tramlag.streaming import windows
from tramlag.warehouse import ClaimedError, Warehouse

pytestmark = pytest.mark.usefixtures("interpreted")


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def stream(wh, tmp_path, level, **options):
    query = windows.stream_level(wh, level, str(tmp_path / f"c-{level}"), once=True, **options)
    query.awaitTermination()
    assert query.exception() is None
    return query


@pytest.mark.parametrize("level", maintain.REFRESH_ORDER)
def test_stream_equals_batch(spark, wh, tmp_path, level, rows):
    """Two runs of the stream; the second has rows that are late, but not too late."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start = datetime(2024, 10, 26, 20)  # the night in which the clock goes back
        invalidate.append_facts(wh, facts(spark, *[(start + timedelta(minutes=50 * i), i) for i in range(20)]))
        stream(wh, tmp_path, level, watermark="30 hours")
        assert equal(wh, level)
        late = [(start + timedelta(minutes=55 * i + 1), 100 + i) for i in range(10)]
        invalidate.append_facts(wh, facts(spark, *late, (start + timedelta(days=2), 1)))
        stream(wh, tmp_path, level, watermark="30 hours")
        assert equal(wh, level)
        assert [r.bucket_date for r in wh.read(level).collect()] == [r.bucket.date() for r in wh.read(level).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_what_is_too_late_is_left_to_the_refresh(spark, wh, tmp_path):
    start = datetime(2026, 3, 14, 9)
    invalidate.append_facts(wh, facts(spark, (start, 1), (start + timedelta(hours=9), 2)))
    stream(wh, tmp_path, "agg_line_15m", watermark="2 hours")
    invalidate.append_facts(wh, facts(spark, (start + timedelta(minutes=3), 50), (start + timedelta(hours=8), 3)))
    query = stream(wh, tmp_path, "agg_line_15m", watermark="2 hours")
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress) == 1
    assert not equal(wh, "agg_line_15m") and wh.read("agg_line_15m").count() == 3
    done = invalidate.refresh_all_invalid(wh, start + timedelta(days=2))
    assert equal(wh, "agg_line_15m")
    # the stream had done the rest, and the coarser levels have heard of all of it
    assert done[0].changed == [start] and equal(wh, "agg_line_1h") and equal(wh, "agg_line_1d")


def test_state_stays_bounded(spark, wh, tmp_path):
    start = datetime(2026, 3, 1)
    for day in range(4):
        invalidate.append_facts(wh, facts(spark, *[(start + timedelta(days=day, minutes=20 * i), i) for i in range(30)]))
        query = stream(wh, tmp_path, "agg_line_15m", watermark="1 hour")
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(state) <= 31 + 5  # a day's windows, and what the last hour of the day before holds
    assert equal(wh, "agg_line_15m")


def test_upserts_are_repeatable_and_keep_other_rows(spark, wh, rows):
    at = datetime(2026, 3, 1, 9)

    def agg(*cells):
        made = [(b, date(2026, 3, 1), 1, line, op, n, 1, 0, n, n, 0, 0, b.date()) for b, line, op, n in cells]
        return spark.createDataFrame(made, TABLES["agg_line_15m"])

    other = at + timedelta(days=1)
    first = agg((at, "L1", None, 1), (at, "L1", "O1", 2), (other, "L1", None, 3))
    assert windows.upsert_buckets(wh, "agg_line_15m", first) == ["2026-03-01", "2026-03-02"]
    again = wh.generations("agg_line_15m")
    assert windows.upsert_buckets(wh, "agg_line_15m", first) == [] and wh.generations("agg_line_15m") == again
    assert windows.upsert_buckets(wh, "agg_line_15m", agg((at, "L1", None, 7))) == ["2026-03-01"]
    got = wh.read("agg_line_15m").select("bucket", "operator_id", "delay_sum")
    assert rows(got) == [(at, "O1", 2), (at, None, 7), (other, None, 3)]
    assert windows.upsert_buckets(wh, "agg_line_15m", first.limit(0)) == []


def test_the_stream_waits_for_a_refresh(wh, monkeypatch):
    from contextlib import ExitStack

    waited = []
    with ExitStack() as outer, ExitStack() as stack:
        outer.enter_context(wh.claim("agg_line_15m"))

        def wait(seconds):
            waited.append(seconds)
            if len(waited) == 2:
                outer.pop_all().close()

        windows._claimed(wh, "agg_line_15m", stack, wait)
        with pytest.raises(ClaimedError):
            monkeypatch.setattr(windows, "CLAIM_TRIES", 2)
            windows._claimed(wh, "agg_line_15m", stack, lambda s: None)
    assert len(waited) == 2
