"""Views of relational test tables as device readings and series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
DATE_TEXT = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def _event_readings(events: DataFrame, data) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("sn"),
        F.date_format("ts", DATE_TEXT).alias("date"),
        data.alias("data"),
        (F.col("user_id") % 4).cast("int").alias("slave_id"),
        (
            F.array_position(F.array(*map(F.lit, EVENT_TYPES)), F.col("event_type")) - 1
        )
        .cast("int")
        .alias("type_id"),
        F.col("event_id").alias("seq"),
    )


def events_readings(events: DataFrame) -> DataFrame:
    """JSON payload `{"k": 69, "value": 6.55, "label": "zone: error"}`."""
    data = F.concat(
        F.expr("substring(props, 1, length(props) - 1)"),
        F.lit(', "value": '),
        F.col("value").cast("string"),
        F.lit(', "label": "zone: '),
        F.col("event_type"),
        F.lit('"}'),
    )
    return _event_readings(events, data)


def flagged_events_readings(events: DataFrame) -> DataFrame:
    """Payload `{"flag": true, "state": 6.55}` with booleans.

    `flag` is always a boolean; `paid` too, but only purchases have it; `state`
    is `true` for errors and the value otherwise.
    """
    high = F.when(F.col("value") > 25, F.lit("true")).otherwise(F.lit("false"))
    is_error = F.col("event_type") == "error"
    data = F.concat(
        F.lit('{"flag": '),
        high,
        F.lit(', "state": '),
        F.when(is_error, F.lit("true")).otherwise(F.col("value").cast("string")),
        F.when(
            F.col("event_type") == "purchase", F.concat(F.lit(', "paid": '), high)
        ).otherwise(F.lit("")),
        F.lit("}"),
    )
    return _event_readings(events, data)


def legacy_events_readings(events: DataFrame) -> DataFrame:
    """Old payload text `{u'k':u'69',u'value':u'6.55',u'label':u'error'}`.

    Only purchases carry a `paid` entry, so that integer column has gaps.
    """
    data = F.concat(
        F.lit("{u'k':u'"),
        F.regexp_extract("props", r": (-?[0-9]+)\}", 1),
        F.lit("',u'value':u'"),
        F.col("value").cast("string"),
        F.lit("',u'label':u'"),
        F.col("event_type"),
        F.when(
            F.col("event_type") == "purchase",
            F.concat(
                F.lit("',u'paid':u'"), F.floor("value").cast("string"), F.lit("'}")
            ),
        ).otherwise(F.lit("'}")),
    )
    return _event_readings(events, data)


def orders_series(orders: DataFrame) -> DataFrame:
    """Order totals per customer: day-grained times, values above the hard limit."""
    return orders.select(
        F.col("o_custkey").cast("string").alias("sn"),
        F.lit("totalprice").alias("feature"),
        F.date_format("o_orderdate", DATE_TEXT).alias("date"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").alias("value"),
    )


def lineitem_series(lineitem: DataFrame) -> DataFrame:
    """Quantity and price per supplier: many rows per time.

    No key is unique, so the whole row is the position.
    """
    features = {"quantity": "l_quantity", "price": "l_extendedprice"}
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("sn"),
        F.date_format("l_shipdate", DATE_TEXT).alias("date"),
        F.struct(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
            "l_returnflag",
            "l_linestatus",
        ).alias("seq"),
        F.explode(
            F.create_map(
                *(
                    part
                    for name, column in features.items()
                    for part in (F.lit(name), F.col(column))
                )
            )
        ).alias("feature", "value"),
    ).select("sn", "feature", "date", "seq", "value")
