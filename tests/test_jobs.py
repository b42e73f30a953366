"""The command line, job by job, on replay files."""

import pytest

from parcelake.jobs import main
from parcelake.layout import Layout
from parcelake.sources.serving import ParquetServing
from parcelake.sources.tables import Table
from parcelake.streaming.state import live_table
from tests.replay import Replay, event_payload, order_payload


def test_all_jobs(spark, tmp_path):
    replay, root = Replay(tmp_path / "log"), str(tmp_path / "lake")
    replay.add_master()
    replay.add("orders", [order_payload()])
    replay.add("shipment_events", [event_payload(n) for n in range(1, 8)])
    log = ["--root", root, "--replay", str(tmp_path / "log")]
    main(["ingest-master", *log], spark)
    main(["ingest-events", *log, "--once"], spark)
    for job in ("bronze", "silver", "gold", "bi"):
        main([job, "--root", root, "--as-of", "2026-07-02"], spark)
    assert ParquetServing(spark, root + "/serving").read("bi_lead_time").first()[
        "avg_lead_time_hrs"] == 6.75
    main(["live", *log, "--once"], spark)
    layout = Layout(root)
    assert live_table(spark, layout).read().first()["shipment_status"] == "DELIVERED"
    main(["panels", "--root", root], spark)
    shown = ParquetServing(spark, root + "/serving")
    assert len(list((tmp_path / "lake" / "serving").glob("panel_*"))) == 22
    assert shown.read("panel_bi_delivery_lead_time").first()["Avg (hrs) Band"] == "green"
    assert shown.read("panel_realtime_active_shipments").first()["value"] == 0
    with pytest.raises(ValueError, match="as_of 2026-06-30 is earlier"):
        main(["gold", "--root", root, "--as-of", "2026-06-30"], spark)
    spark.createDataFrame([], "fulfillment_center_id string, delivery_station_id string"
                          ).write.parquet(str(tmp_path / "network"))
    main(["checks", "--root", root, "--network", str(tmp_path / "network")], spark)
    assert Table(spark, layout.quality("lifecycle")).read().first()["conforms"]


def test_log_jobs_need_a_log(spark, tmp_path):
    with pytest.raises(SystemExit, match="--kafka or --replay"):
        main(["ingest-master", "--root", str(tmp_path)], spark)
    with pytest.raises(SystemExit):
        main(["unknown", "--root", str(tmp_path)], spark)


def test_options(monkeypatch):
    from parcelake.jobs import _options

    monkeypatch.setenv("DB_PASSWORD", "s=1")
    assert _options(["user=bi", "password=env:DB_PASSWORD"]) == {"user": "bi", "password": "s=1"}
    for bad in ("user", "=x", "password=env:NOT_SET_ANYWHERE"):
        with pytest.raises(SystemExit):
            _options([bad])
