"""Readings to long feature rows: device views, payload explode, merge, pivot."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.functions.payload import parse_payload
from gaugeloom.scale import number_rows
from gaugeloom.schema import RAW_COLUMNS, RESERVED_COLUMNS, Mode


def select_raw(source: DataFrame) -> DataFrame:
    """The raw columns in their fixed order; pruning reaches the scan."""
    return source.select(*RAW_COLUMNS)


def group_by_device(pages: Iterable[DataFrame]) -> DataFrame:
    """All pages as one table of readings with a device, keyed by device text.

    The device column is the partitioning key of everything downstream, not a
    physical split, so a device of any size stays distributed.
    """
    together = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), pages
    )
    return together.where(F.col("sn").isNotNull()).withColumn(
        "sn", F.col("sn").cast("string")
    )


def device_counts(readings: DataFrame) -> DataFrame:
    return readings.groupBy("sn").agg(
        F.count("*").alias("rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def distinct_devices(readings: DataFrame) -> DataFrame:
    return readings.where(F.col("sn").isNotNull()).select("sn").distinct().orderBy("sn")


def parse_feature_rows(
    readings: DataFrame, mode: Mode, *, strict: bool = True
) -> DataFrame:
    """One row per reading and payload entry; readings without entries vanish.

    Entries with a reserved column's name are dropped. Every reading that yields rows yields exactly one with `pos` 0.
    """
    entries = F.filter(
        parse_payload(F.col("data"), mode, strict=strict),
        lambda entry: ~entry["feature"].isin(*RESERVED_COLUMNS),
    )
    return readings.select(
        "sn",
        "date",
        "seq",
        "slave_id",
        "type_id",
        F.posexplode(entries).alias("pos", "entry"),
    ).select(
        "sn",
        "date",
        "seq",
        "pos",
        F.col("entry.feature").alias("feature"),
        F.col("entry.value").alias("value"),
        "slave_id",
        "type_id",
    )


def bad_payloads(readings: DataFrame) -> DataFrame:
    """Readings the strict corrected parser would stop at."""
    return readings.where(
        parse_payload(F.col("data"), Mode.CORRECTED, strict=False).isNull()
    )


def feature_order(features: DataFrame) -> DataFrame:
    """Features of each device in the order of their first appearance.

    The windows hold one row per distinct feature name of a device.
    """
    seen = (
        features.where(~F.col("feature").isin(*RESERVED_COLUMNS))
        .groupBy("sn", "feature")
        .agg(F.min("seq").alias("seq"), F.min_by("pos", "seq").alias("pos"))
    )
    ordered = Window.partitionBy("sn").orderBy("seq", "pos")
    return seen.select(
        "sn", "feature", F.row_number().over(ordered).alias("feature_position")
    )


def pivot_features(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """Wide view of the named features, NULL where a reading lacks one."""
    return (
        features.groupBy("sn", "date", "seq", "slave_id", "type_id")
        .pivot("feature", list(names))
        .agg(F.first("value"))
        .select("sn", "date", "seq", *names, "slave_id", "type_id")
    )


def merge_and_sort(
    chunks: Iterable[DataFrame], *, slices: int | None = None
) -> DataFrame:
    """Union chunks and number each device's rows by date text, then position.

    Rows without a date come last; entries of one reading keep their order. Date text sorts like time only when it is zero-padded, as in the source.
    """
    together = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), chunks
    )
    undated = together.withColumn("_undated", F.col("date").isNull())
    order = ["_undated", "date", "seq", *(["pos"] if "pos" in together.columns else [])]
    return number_rows(
        undated, order, within=("sn",), name="position", slices=slices
    ).drop("_undated")


def merge_features(features: DataFrame, *, slices: int | None = None) -> DataFrame:
    """Like `merge_and_sort` with a chunk for every feature, in the order of their names.

    The long rows are numbered in one pass, whatever features there are.
    """
    undated = features.withColumn("_undated", F.col("date").isNull())
    return number_rows(
        undated,
        ["_undated", "date", "feature", "seq", "pos"],
        within=("sn",),
        name="position",
        slices=slices,
    ).drop("_undated")
