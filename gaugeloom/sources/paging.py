"""Reproducible pages over a table: offset, keyset and whole-table numbering."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.scale import number_rows
from gaugeloom.schema import BATCH_ROWS, Mode, require_count


def _key_width(keys: Sequence[str], last_key: Sequence[Any] = ()) -> None:
    if not keys:
        raise ValueError("paging needs at least one key column")
    if last_key and len(last_key) != len(keys):
        raise ValueError("last key width does not match the key columns")


def page_numbering(
    table: DataFrame,
    keys: Sequence[str],
    batch: int = BATCH_ROWS,
    *,
    slices: int | None = None,
) -> DataFrame:
    """Every row with its 1-based `row_number` and dense `page_no`, by key order."""
    require_count(batch, "batch", 1)
    _key_width(keys)
    return number_rows(table, keys, slices=slices).withColumn(
        "page_no", F.floor((F.col("row_number") - 1) / batch) + 1
    )


def keyset_pages(
    table: DataFrame,
    keys: Sequence[str],
    batch: int = BATCH_ROWS,
    *,
    slices: int | None = None,
) -> DataFrame:
    """All pages a keyset reader would fetch one after the other."""
    return page_numbering(table, keys, batch, slices=slices)


def offset_pages(
    table: DataFrame,
    keys: Sequence[str],
    batch: int = BATCH_ROWS,
    *,
    slices: int | None = None,
) -> DataFrame:
    """Legacy pages: the first `batch` rows are skipped, then numbered from 1.

    The old reader gave no order; `keys` fixes one so that pages can be repeated.
    """
    return (
        page_numbering(table, keys, batch, slices=slices)
        .where(F.col("row_number") > batch)
        .withColumn("page_no", F.col("page_no") - 1)
    )


def _after(keys: Sequence[str], last_key: Sequence[Any]) -> Column:
    """Row-value comparison, spelled so that the first key reaches the scan."""
    later = F.struct(*keys) > F.struct(
        *(F.lit(value).alias(name) for name, value in zip(keys, last_key))
    )
    return (F.col(keys[0]) >= F.lit(last_key[0])) & later


def keyset_page(
    table: DataFrame,
    keys: Sequence[str],
    last_key: Sequence[Any] = (),
    batch: int = BATCH_ROWS,
) -> DataFrame:
    """The page after `last_key`, or the first page."""
    require_count(batch, "batch", 1)
    _key_width(keys, last_key)
    rest = table.where(_after(keys, last_key)) if last_key else table
    return rest.orderBy(*keys).limit(batch)


def last_key(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key of the last row of each page."""
    _key_width(keys)
    return (
        pages.groupBy("page_no")
        .agg(F.max(F.struct(*keys)).alias("last"))
        .select("page_no", *(F.col("last")[name].alias(name) for name in keys))
    )


def page_summary(
    table: DataFrame, mode: Mode, batch: int = BATCH_ROWS
) -> DataFrame:
    """Pages and rows an export would write.

    A reader stops at the first short page, so a full last page is followed by
    an empty one, and legacy mode loses its first batch.
    """
    require_count(batch, "batch", 1)
    skipped = batch if mode is Mode.LEGACY else 0
    rows = F.greatest(F.count("*") - skipped, F.lit(0))
    return table.agg(rows.alias("row_count")).select(
        (F.floor(F.col("row_count") / batch) + 1).alias("page_count"), "row_count"
    )
