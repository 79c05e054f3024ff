"""Feature rows of pages that keep arriving.

Parsing and exploding keep no state, so the batch operators run unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeloom.operators.readings import parse_feature_rows
from gaugeloom.schema import READING_SCHEMA, Mode


def stream_feature_rows(spark, directory: str, mode: Mode) -> DataFrame:
    """Streaming feature rows of Parquet reading files dropped in `directory`.

    Unreadable payloads are skipped rather than stopping the stream.
    """
    readings = spark.readStream.schema(READING_SCHEMA).parquet(directory)
    return parse_feature_rows(readings, mode, strict=False)
