"""Read-only JDBC source for the raw readings table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from gaugeloom.schema import BATCH_ROWS, require_count

# Defaults of the published source.
DEFAULT_SCHEMA = "public"
DEFAULT_TABLE = "dashboard_dtudata"
CONNECT_TIMEOUT_SECONDS = 15
STATEMENT_TIMEOUT_SECONDS = 300

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _quoted(name: str) -> str:
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"unsafe identifier: {name!r}")
    return f'"{name}"'


def jdbc_options(
    url: str,
    user: str,
    password: str,
    *,
    schema: str = DEFAULT_SCHEMA,
    table: str = DEFAULT_TABLE,
    key: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    fetch_rows: int = BATCH_ROWS,
    connect_timeout_seconds: int = CONNECT_TIMEOUT_SECONDS,
    statement_timeout_seconds: int = STATEMENT_TIMEOUT_SECONDS,
) -> dict[str, str]:
    """Reader options: every session is read-only and has a statement timeout.

    With `key` and its bounds the table is read in `partitions` ranges at once.
    """
    require_count(partitions, "partitions", 1)
    require_count(fetch_rows, "fetch_rows", 1)
    require_count(connect_timeout_seconds, "connect_timeout_seconds", 1)
    require_count(statement_timeout_seconds, "statement_timeout_seconds", 1)
    options = {
        "url": url,
        "user": user,
        "password": password,
        "driver": "org.postgresql.Driver",
        "dbtable": f"{_quoted(schema)}.{_quoted(table)}",
        "sessionInitStatement": (
            "SET SESSION CHARACTERISTICS AS TRANSACTION READ ONLY; "
            f"SET statement_timeout = {statement_timeout_seconds * 1000}"
        ),
        "queryTimeout": str(statement_timeout_seconds),
        "connectTimeout": str(connect_timeout_seconds),
        "fetchsize": str(fetch_rows),
    }
    if key is None and partitions > 1:
        raise ValueError("several partitions need a key")
    if key is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs both key bounds")
        options |= {
            "partitionColumn": _quoted(key),
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The source table; filters, columns and limits are pushed to the database."""
    return spark.read.format("jdbc").options(**options).load()
