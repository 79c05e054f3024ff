"""Fill-in-middle texts: lines cut at two places and put in another order.

The ends of a text's lines form a boundary set in the manner of a roaring bitmap:
offsets are grouped by their upper 16 bits, and each group is kept as a sorted
array, a bitmap or a list of runs, whichever is smallest, beside the number of
offsets in the groups before it. The k-th boundary is found by a search over these
counts and a select inside one container; two of them cut a text.

Which lines are cut and which form a text takes depend on a hash of seed and
doc_id alone, so reruns agree and equal rows give equal rows. A null text counts
as empty; an empty text, or one that holds a marker, stays plain. The decimal
text of a null doc_id is empty. Texts of any length are cut whole; only `doc_id`
and `text` are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.tables import keyed, slices

# Markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_PREFIX, _SUFFIX, _MIDDLE = (marker.encode() for marker in (PREFIX, SUFFIX, MIDDLE))

CONTAINER_BITS = 16
_LOW = (1 << CONTAINER_BITS) - 1
_BITMAP_BYTES = 1 << (CONTAINER_BITS - 3)


class ArrayContainer:
    """Few offsets: the sorted values themselves."""

    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.values[rank])


class BitmapContainer:
    """Many offsets: one bit per value, and the bits set before each word."""

    def __init__(self, values: np.ndarray):
        bits = np.zeros(1 << CONTAINER_BITS, bool)
        bits[values] = True
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.before, rank, side="right")) - 1
        left = int(self.words[word])
        for _ in range(rank - int(self.before[word])):
            left &= left - 1
        return (word << 6) + (left & -left).bit_length() - 1


class RunContainer:
    """Neighbouring offsets: first value of each run and the values before it."""

    def __init__(self, values: np.ndarray):
        first = np.flatnonzero(np.diff(values, prepend=-2) != 1)
        self.starts = values[first].astype(np.uint16)
        self.before = first

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, side="right")) - 1
        return int(self.starts[run]) + rank - int(self.before[run])


def container(values: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for sorted values below 2^16."""
    runs = int(np.count_nonzero(np.diff(values) != 1)) + 1
    if 4 * runs < min(2 * len(values), _BITMAP_BYTES):
        return RunContainer(values)
    return ArrayContainer(values) if 2 * len(values) <= _BITMAP_BYTES else BitmapContainer(values)


class BoundarySet:
    """A set of offsets that answers which is the k-th smallest."""

    def __init__(self, offsets: np.ndarray):
        """`offsets` are distinct and ascending."""
        groups = offsets >> CONTAINER_BITS
        first = np.flatnonzero(np.diff(groups, prepend=-1))
        self.keys = groups[first]
        self.before = np.append(first, len(offsets))
        low = offsets & _LOW
        self.containers = [container(low[a:b]) for a, b in zip(self.before[:-1], self.before[1:], strict=True)]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, rank: int) -> int:
        """The offset with `rank` smaller ones."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        place = int(np.searchsorted(self.before, rank, side="right")) - 1
        return (int(self.keys[place]) << CONTAINER_BITS) + self.containers[place].select(rank - int(self.before[place]))


def draws(doc_id: int | None, seed: int) -> tuple[int, ...]:
    """Four numbers from the hash of seed and id."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def transform_documents(docs: DataFrame, *, seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    `rate` of 100 texts are cut, `spm_rate` of 100 of these begin with the suffix.
    `n` counts lines, the characters are code points and null in plain texts.
    """
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, last, data, offsets in slices(batch.column("_text")):
                breaks = np.flatnonzero(data == 0x0A) + 1
                inner = np.searchsorted(breaks, offsets, side="right")
                rows = []
                for row in range(last - first):
                    start, end = int(offsets[row]), int(offsets[row + 1])
                    ends = breaks[inner[row] : inner[row + 1]] - start
                    if end > start and (not len(ends) or ends[-1] < end - start):
                        ends = np.append(ends, end - start)
                    text = data[start:end].tobytes()
                    number = ids[first + row]
                    rows.append((number, len(ends), *cut_text(text, ends, draws(number, seed), rate, spm_rate)))
                columns = zip(*rows, strict=True)
                arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return (
        keyed(docs)
        .select("doc_id", "_text")
        .mapInArrow(
            transform,
            "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string",
        )
    )


def cut_text(text: bytes, ends: np.ndarray, drawn: tuple[int, ...], rate: int, spm_rate: int) -> tuple:
    """(form, prefix characters, middle characters, output) of one text."""
    if not text or any(marker in text for marker in (_PREFIX, _SUFFIX, _MIDDLE)) or drawn[2] % 100 >= rate:
        return "plain", None, None, text.decode()
    boundaries = BoundarySet(np.concatenate(([0], ends)))
    low, high = (boundaries.select(rank) for rank in sorted(draw % len(boundaries) for draw in drawn[:2]))
    prefix, middle, suffix = (part.decode() for part in (text[:low], text[low:high], text[high:]))
    if drawn[3] % 100 < spm_rate:
        return "spm", len(prefix), len(middle), SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return "psm", len(prefix), len(middle), PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def restored(output: Column, form: Column) -> Column:
    """The text that gave `output`; only markers begin with `<P>`, `<S>` or `<M>` there."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, third = (F.get(parts, F.lit(place)) for place in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(first, third, second))
        .when(form == "spm", F.concat(second, third, first))
        .otherwise(output)
    )


def restore_documents(transformed: DataFrame) -> DataFrame:
    """(doc_id, text) from (doc_id, form, output)."""
    return transformed.select("doc_id", restored(F.col("output"), F.col("form")).alias("text"))


def transform_digests(docs: DataFrame, **options: int) -> DataFrame:
    """The columns of `transform_documents` with digests of output and rebuilt text."""
    done = transform_documents(docs, **options)
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
