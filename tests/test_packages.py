from datetime import date, timedelta

import packages as zips
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException

from tramlag.config import DEFAULTS, MERGE_KEYS
from tramlag.operators import merge
from tramlag.sources import packages as p

TODAY = date(2026, 3, 1)


def test_catalogue_names(spark, rows):
    names = [
        "schedule_ZTM_2026.03.01_9_100.zip",
        "schedule_ZTM_2026.03.01_10_100.zip.bak",
        "old schedule_ZTM_2026.03.01_1_1.zip",
        "schedule_ZTM_2026.3.01_1_1.zip",
        None,
    ]
    df = spark.createDataFrame([(n, "u") for n in names], "name string, url string")
    got = rows(p.parse_catalogue(df, DEFAULTS), "name", "year", "month", "day", "seq")
    assert got == [(names[1], 2026, 3, 1, 10), (names[0], 2026, 3, 1, 9)]


def greedy(candidates, today, horizon, clip):
    """Newest-first cover, one package after the other."""
    target = {today + timedelta(days=i) for i in range(horizon)}
    window = {today + timedelta(days=i) for i in range(clip)}
    covered, taken = set(), []
    for c in sorted(candidates, key=lambda c: (c[:4], c[5], c[4]), reverse=True):
        if covered >= target:
            break
        days = {c[6] + timedelta(days=i) for i in range((c[7] - c[6]).days + 1)} & window
        if days - covered:
            taken.append(c)
            covered |= days
    return [c[4] for c in sorted(taken, key=lambda c: c[6])]


package = st.tuples(st.integers(-6, 20), st.integers(-1, 9), st.integers(1, 12), st.integers(0, 99))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(package, max_size=9), min_size=1, max_size=6), st.sampled_from([5, 14, 20]))
def test_selection_equals_greedy_cover(spark, cases, horizon):
    for case in cases:
        candidates = [
            (2026, 2, seq, serial, f"n{i}", f"u{i}", TODAY + timedelta(days=start), TODAY + timedelta(days=start + length))
            for i, (start, length, seq, serial) in enumerate(case)
        ]
        df = spark.createDataFrame(
            candidates,
            "year int, month int, day int, seq long, name string, url string, period_start date, period_end date",
        )
        got = p.select_packages(df, TODAY, horizon, DEFAULTS).orderBy("pkg_ord").select("name").collect()
        assert [r[0] for r in got] == greedy(candidates, TODAY, horizon, max(horizon, DEFAULTS.window_days))


def test_zip_reading(spark, rows, tmp_path):
    zips.write_package(
        tmp_path, "a.zip", "20260301", "20260303",
        routes='﻿ route_id ,route_type,route_long_name,route_short_name\r\nL1,3,"Rynek, Dworzec",""\r\n\r\n'.encode(),
        operators_ext=None,
        service_ext="service_id,name\n1,A\n1,B\n",
    )
    zips.write_package(
        tmp_path, "b.zip", "20260304", "20260305",
        routes="route_short_name,route_id\n7,L1\n8,L2\n",
        service_ext="service_id,name\n1,A\n",
    )
    periods = p.read_periods(p.zip_files(spark, str(tmp_path)))
    assert rows(periods) == [
        ("a.zip", date(2026, 3, 1), date(2026, 3, 3)),
        ("b.zip", date(2026, 3, 4), date(2026, 3, 5)),
    ]
    selected = spark.createDataFrame([("a.zip", 1), ("b.zip", 2)], "name string, pkg_ord int")
    records = p.unpack_packages(spark, str(tmp_path), selected).persist()
    raw = {m: p.member_table(records, m, c) for m, c in p.MEMBER_COLUMNS.items()}
    assert rows(raw["operators_ext"], "pkg_ord", "operator_id") == [(2, "O1")]
    merged = merge.merge_tables(raw, MERGE_KEYS)
    assert rows(merged["routes"].drop("pkg_ord", "line_no")) == [
        ("L1", None, "Rynek, Dworzec", "3"),
        ("L2", "8", None, None),
    ]
    assert rows(merged["feed_info"], "feed_start_date") == [("20260301",)]
    assert rows(merged["service_ext"], "service_id", "name", "pkg_ord") == [("1", "A", 1), ("1", "B", 1)]


def test_overlong_record_fails(spark, tmp_path):
    zips.write_package(tmp_path, "a.zip", "20260301", "20260303", trips="trip_id,route_id\nT1,L1,x\n")
    selected = spark.createDataFrame([("a.zip", 1)], "name string, pkg_ord int")
    with pytest.raises(PythonException, match="trips.txt record 0: 3 fields"):
        p.unpack_packages(spark, str(tmp_path), selected).count()


def test_bad_period_fails(spark, tmp_path):
    zips.write_package(tmp_path, "a.zip", "2026-03-01", "20260303")
    with pytest.raises(Exception, match="2026-03-01"):
        p.read_periods(p.zip_files(spark, str(tmp_path))).collect()


def test_keep_first_takes_null_keys_as_equal(spark, rows):
    df = spark.createDataFrame(
        [(1, 2, None, "x"), (1, 1, None, "y"), (2, 0, "a", "z"), (1, 9, "a", "w")],
        "pkg_ord int, line_no int, key string, value string",
    )
    assert rows(merge.keep_first(df, ["key"], merge.PACKAGE_ORDER), "key", "value") == [("a", "w"), (None, "y")]


def test_keep_first_limits_rows_before_the_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = merge.keep_first(df, ["l_orderkey"], ["l_shipdate", "l_partkey"])._jdf.queryExecution().toString()
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")
