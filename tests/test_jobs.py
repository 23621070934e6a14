"""The jobs one after the other, as a scheduler runs them."""

import json
from datetime import datetime, timezone

import packages as zips
import pytest
from test_match import entity, update

from tramlag.__main__ import main
from tramlag.warehouse import Warehouse

pytestmark = pytest.mark.usefixtures("interpreted")


def test_jobs_end_to_end(spark, tmp_path, rows):
    root, landing, feed = str(tmp_path / "wh"), tmp_path / "landing", tmp_path / "feed"
    name = zips.name_of("2026.02.20", 1)
    zips.write_package(landing, name, "20260301", "20260315")
    catalogue = tmp_path / "catalogue.json"
    answer = {"success": True, "result": {"resources": [{"name": name, "url": "u"}, {"url": "v"}]}}
    catalogue.write_text(json.dumps(answer, indent=2))
    main(
        ["static-load", "--root", root, "--landing", str(landing), "--catalogue", str(catalogue), "--today", "2026-03-02"],
        spark,
    )
    feed.mkdir()
    stamp = int(datetime(2026, 3, 5, 10, tzinfo=timezone.utc).timestamp())
    record = {"header": {"timestamp": str(stamp)}, "entity": [entity("T1", update(0, 30), update(1, 90)), entity("T2", rel="CANCELED")]}
    (feed / "a.json").write_text(json.dumps(record))
    main(["live", "--root", root, "--landing", str(feed), "--checkpoint", str(tmp_path / "cp"), "--once"], spark)
    main(["refresh", "--root", root, "--now", "2026-03-06T12:00:00"], spark)
    wh = Warehouse(spark, root)
    day = wh.read("agg_line_1d").select("bucket", "service_date", "line_id", "delay_sum", "obs", "on_time", "cancelled")
    midnight = datetime(2026, 3, 4, 23)
    assert [r[0] for r in rows(day)] == [midnight] * 3
    assert [r[2:] for r in rows(day)] == [("L1", 90, 1, 0, 0), ("L1", 30, 1, 1, 0), ("L2", None, 0, 0, 1)]
    main(["backfill", "--root", root, "--level", "agg_stop_15m", "--first", "2026-03-01", "--last", "2026-03-06"], spark)
    wh.compact("fact_delay", "2026-03-05")
    assert wh.read("fact_delay").count() == 3
    main(["retention", "--root", root, "--now", "2026-05-01T00:00:00"], spark)
    assert wh.read("fact_delay").count() == 0
    assert wh.read("agg_stop_15m").count() == 3
    main(["replay", "--root", root], spark)
