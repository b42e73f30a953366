from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from parcelake.session import build_session

    session = build_session("tests", **{
        "spark.master": "local[8]", "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """make("a string, b int", (..), (..)) -> DataFrame; text is cast to date/time columns."""
    from pyspark.sql import functions as F, types as T

    from parcelake.schemas import flat

    timed = (T.TimestampType, T.DateType)

    def build(columns: str, *rows: tuple):
        wanted = flat(columns)
        written = T.StructType([
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, timed) else f.dataType)
            for f in wanted.fields])
        return spark.createDataFrame(list(rows), written).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])

    return build


@pytest.fixture(scope="session")
def rows():
    """Rows as dicts keyed by one column (or a list of dicts)."""
    def collect(df, key: str | None = None):
        dicts = [r.asDict(recursive=True) for r in df.collect()]
        return dicts if key is None else {d[key]: d for d in dicts}

    return collect
