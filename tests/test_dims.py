from datetime import date, datetime

import pytest

from tramlag.config import DEFAULTS, WEEKDAY_FLAGS
from tramlag.operators import dims as d
from tramlag.operators import merge


def test_line(spark, rows):
    routes = spark.createDataFrame(
        [("A", "1", "x", "0"), ("B", "2", "x", "3"), ("C", "3", "x", "11"), ("D", "4", "x", "700"), ("E", "5", "x", None)],
        "route_id string, route_short_name string, route_long_name string, route_type string",
    )
    ext = spark.createDataFrame([("A", "Nocna"), ("B", None)], "route_id string, route_type_1 string")
    assert rows(d.dim_line(routes, ext), "line_id", "mode", "line_type") == [
        ("A", "tramwaj", "Nocna"),
        ("B", "autobus", "Normalna"),
        ("C", "trolejbus", "Normalna"),
        ("D", "inne", "Normalna"),
        ("E", "inne", "Normalna"),
    ]


def test_stop_defaults_are_set_before_the_join(spark, rows):
    stops = spark.createDataFrame(
        [("S1", "a", "50.5", "19"), ("S2", "b", "abc", "25d"), ("S3", "c", None, " 1e1 "), ("S4", "d", "", "-1.5")],
        "stop_id string, stop_name string, stop_lat string, stop_lon string",
    )
    ext = spark.createDataFrame(
        [("S1", "7_8", "Town", "5_6"), ("S2", "9", None, None), ("S3", None, "City", "6")],
        "stop_id string, community_ids string, city string, stop_attribute_ids string",
    )
    communities = spark.createDataFrame([("7", "Seven"), ("8", "Eight")], "community_id string, community_name string")
    attributes = spark.createDataFrame([("5", "Five"), ("6", None)], "stop_type_id string, stop_attr_name string")
    got = rows(d.dim_stop(stops, ext, communities, attributes))
    assert got == [
        ("S1", "a", 50.5, 19.0, "Seven", "Town", "Five"),
        ("S2", "b", None, None, None, None, "Standardowy"),
        ("S3", "c", None, 10.0, None, "City", "Standardowy"),
        ("S4", "d", None, -1.5, None, None, None),
    ]


def calendar(spark, *periods):
    columns = ["service_id", "start_date", "end_date", *WEEKDAY_FLAGS]
    return spark.createDataFrame(
        [(s, a, b, *flags) for s, a, b, flags in periods], ", ".join(f"{c} string" for c in columns)
    )


def test_day_types(spark, rows):
    cal = calendar(
        spark,
        ("2", "20261228", "20270103", "1111111"),
        ("9", "20270101", "20270101", "1111111"),
        ("10", "20270101", "20270102", "1111111"),
        ("1", "20261228", "20261230", "1110111"),
        ("4", "20270103", "20270103", "1111111"),
        ("3", "20270103", "20270103", "1111110"),
        ("12", "20270104", "20270104", "1111111"),
        ("11", "20270105", "20270105", "1111111"),
        ("5", "20270110", "20270101", "1111111"),
    )
    names = spark.createDataFrame(
        [("1", "one", 1, 0), ("2", "two", 1, 1), ("9", "nine", 1, 2), ("10", "ten", 1, 3), ("11", None, 1, 4)],
        "service_id string, name string, pkg_ord int, line_no int",
    )
    got = rows(d.dim_date(cal, names, date(2026, 12, 29), date(2027, 1, 6), DEFAULTS))
    assert got == [
        (date(2026, 12, 29), 2026, 12, 53, 2, "wtorek", "one"),
        (date(2026, 12, 30), 2026, 12, 53, 3, "środa", "one"),
        (date(2026, 12, 31), 2026, 12, 53, 4, "czwartek", "two"),
        (date(2027, 1, 1), 2027, 1, 53, 5, "piątek", "nine"),
        (date(2027, 1, 2), 2027, 1, 53, 6, "sobota", "ten"),
        (date(2027, 1, 3), 2027, 1, 53, 7, "niedziela", "two"),
        (date(2027, 1, 4), 2027, 1, 1, 1, "poniedziałek", "brak rozkładu"),
        (date(2027, 1, 5), 2027, 1, 1, 2, "wtorek", None),
        (date(2027, 1, 6), 2027, 1, 1, 3, "środa", "brak rozkładu"),
    ]


def test_non_integer_service_fails(spark):
    cal = calendar(spark, ("x1", "20270101", "20270101", "1111111"))
    with pytest.raises(Exception, match="x1"):
        d.primary_services(d.active_services(cal, date(2027, 1, 1), date(2027, 1, 1)), DEFAULTS).collect()


def test_last_surviving_name_wins(spark, rows):
    raw = spark.createDataFrame(
        [("1", "A", 1, 0), ("1", "B", 2, 0), ("1", "A", 3, 0)],
        "service_id string, name string, pkg_ord int, line_no int",
    )
    merged = merge.keep_first(raw, ["service_id", "name"], merge.PACKAGE_ORDER)
    assert rows(d.service_names(merged)) == [("1", "B")]


def test_version_row(spark, rows):
    selected = spark.createDataFrame([("b.zip", 2), ("a.zip", 1), ("c.zip", 10)], "name string, pkg_ord int")
    got = d.dim_version(selected, 4, date(2026, 3, 1), date(2026, 3, 14), datetime(2026, 3, 1, 5))
    assert rows(got) == [(4, "a.zip | b.zip | c.zip", date(2026, 3, 1), date(2026, 3, 14), datetime(2026, 3, 1, 5))]
