"""Each panel text gives the rows of the panel built from columns."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parcelake.operators import panels
from parcelake.plans import panel_sql
from verification.sample import Sample

CLOCK = "2027-06-30 00:00:00"


@pytest.fixture(scope="module")
def dashboards(spark, tmp_path_factory):
    """Both dashboards over the sample, from written tables."""
    sample, root = Sample(spark, "/root/testdata/sf0.001"), tmp_path_factory.mktemp("panels")

    def written(name, df):
        df.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    live = written("live", sample.live)
    tables = {name: written(name, df) for name, df in sample.bi.items()}
    panel_sql.register(spark, live, tables)
    return {"realtime": panels.realtime(live, F.lit(CLOCK).cast("timestamp")), "bi": panels.bi(tables)}


def test_every_panel_has_a_text(dashboards):
    assert set(panel_sql.TEXTS) == {(d, title) for d, shown in dashboards.items() for title in shown}
    assert len(panel_sql.TEXTS) == 22


@pytest.mark.parametrize("dashboard, title", sorted(panel_sql.TEXTS))
def test_text_equals_panel(spark, dashboards, dashboard, title):
    want = panels.banded(title, dashboards[dashboard][title])
    got = panel_sql.panel(spark, dashboard, title, datetime.fromisoformat(CLOCK))
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() > 0


def test_a_panel_with_a_clock_asks_for_it(spark, dashboards):
    with pytest.raises(ValueError, match="as_of"):
        panel_sql.panel(spark, "realtime", "Stale at Delivery Station")
