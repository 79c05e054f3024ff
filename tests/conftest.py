from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaugeloom.session import session


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": 4,
            "spark.sql.session.timeZone": "UTC",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def series(spark):
    """Builder of `(sn, feature, date, seq, value)` rows, one second apart."""

    def build(values, sn="d", feature="f", dates=None):
        rows = [
            (
                sn,
                feature,
                dates[i]
                if dates
                else f"2020-01-01 {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}",
                i,
                None if v is None else float(v),
            )
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(
            rows, "sn string, feature string, date string, seq bigint, value double"
        )

    return build
