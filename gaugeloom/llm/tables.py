"""What the operators share: document keys, text slices, staged tables.

A document is known by `doc_id` and a hash of its text, so rows that repeat an
id with another text stay apart and rows that repeat both share every verdict.
A null id counts as the largest id, a null text as empty. Only `doc_id` and
`text` are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST_ID = (1 << 63) - 1

# Six characters part words and are stripped from lines.
SPACES = b" \t\n\v\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

SLICE_BYTES = 1 << 19


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, _doc, _tid, _text): the id, its sort key, text hash and text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_doc"),
        F.xxhash64(text_of()).alias("_tid"),
        text_of().alias("_text"),
    )


def with_keys(docs: DataFrame) -> DataFrame:
    """Whole rows packed into `_row` beside their key, safe from name clashes."""
    return docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_doc"),
        F.xxhash64(text_of()).alias("_tid"),
    )


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows, without a copy."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows in turn as (first, last + 1, bytes, offsets), about `limit` bytes each.

    It bounds the arrays of a task: only a single longer text exceeds the limit.
    """
    data, offsets = text_bytes(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(rows, max(first + 1, last))
        part = offsets[first : last + 1]
        yield first, last, data[part[0] : part[-1]], part - part[0]
        first = last


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and how many words precede each row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = _IS_SPACE[data]
    opens = ~space
    opens[1:] &= space[:-1]
    closes = ~space
    closes[:-1] &= space[1:]
    # A text ends where the next one starts, with or without a space between.
    inner = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[inner] = ~space[inner]
    inner = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    closes[inner] = ~space[inner]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)
