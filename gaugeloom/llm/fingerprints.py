"""Winnowing fingerprints of texts and of their edited copies.

Every gram of `GRAM` code points has a rolling hash. Of each `WINDOW`
neighbouring grams the one with the smallest hash is chosen, the rightmost on
ties, and its place is kept. Two texts that share a passage of at least
GRAM + WINDOW - 1 code points share a chosen gram of it, and the places say
where. A shorter text has one window over what it has, a text shorter than a
gram is one gram; an empty or null text has an empty fingerprint.

The fingerprint is text: base64 of the 32-bit hashes of the chosen grams and
of the gaps between their places, both in little-endian order. Likeness is the
Dice coefficient of the two multisets of hashes: 1 for equal fingerprints, empty
ones included, 0 without a common gram.

Documents follow one another by id, then by text hash; a null id comes last, and the
last is followed by the first. A single document follows itself. Rows that repeat an
id and its text share a task.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.llm.hashing import gram_hashes, mix, prefix_sums, rightmost_minima
from gaugeloom.llm.tables import LAST_ID, keyed

GRAM = 10
WINDOW = 32


def chosen_grams(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the chosen grams in order of place."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    sums = prefix_sums(mix(points + np.uint64(1)))
    hashes = gram_hashes(sums, min(gram, len(points)))
    places = np.unique(rightmost_minima(hashes, min(window, len(hashes))))
    return (hashes[places] >> np.uint64(32)).astype(np.uint32), places.astype(np.uint32)


def written(hashes: np.ndarray, places: np.ndarray) -> str:
    gaps = np.diff(places, prepend=np.uint32(0)).astype(np.uint32)
    return base64.b64encode(hashes.astype("<u4").tobytes() + gaps.astype("<u4").tobytes()).decode()


def read(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places from a written fingerprint."""
    numbers = np.frombuffer(base64.b64decode(fingerprint), "<u4")
    half = len(numbers) // 2
    return numbers[:half], np.cumsum(numbers[half:], dtype=np.uint32)


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Twice the common hashes over all, repeats counted; both sorted."""
    if not len(left) and not len(right):
        return 1.0
    if not len(left) or not len(right):
        return 0.0
    # The k-th copy of a hash on one side matches the k-th on the other.
    both = np.concatenate([_numbered(left), _numbered(right)])
    both.sort()
    return 2.0 * int((both[1:] == both[:-1]).sum()) / len(both)


def _numbered(values: np.ndarray) -> np.ndarray:
    copy = np.arange(len(values)) - np.searchsorted(values, values)
    return (values.astype(np.uint64) << np.uint64(32)) | copy.astype(np.uint64)


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, _text, _next): each document with the text of its follower.

    Ids are cut into ranges at their approximate quantiles. An id that is the
    quantile several times over, as the null id may be, is a hot one: its rows are
    cut by text hash as often. So a window sees one slice of one range only. The
    first document of each slice is repeated at the end of the slice before; there
    are as many of these as slices.
    """
    texts = keyed(docs)
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    found = texts.select(F.col("_doc").cast("double")).approxQuantile("_doc", shares, 0.25 / ranges)
    splits = [float("-inf"), *sorted(set(found)), float("inf")]
    if len(splits) == 2:
        splits.insert(1, 0.0)
    # At most half as many hot ids as ranges.
    hot = {min(int(value), LAST_ID): times + 1 for value, times in Counter(found).items() if times > 1}
    ids = F.array(*map(F.lit, sorted(hot))).cast("array<long>")
    pieces = F.coalesce(_lookup(hot, F.col("_doc")), F.lit(1))
    place = (F.col("_tid").cast("double") / float(1 << 64) + 0.5) * pieces
    placed = (
        Bucketizer(splits=splits, inputCol="_at", outputCol="_range")
        .transform(texts.withColumn("_at", F.col("_doc").cast("double")))
        .withColumn(
            "_slice",
            # In order: the range, the hot ids below, whether it is one itself, its piece.
            F.struct(
                F.col("_range").cast("int").alias("range"),
                F.size(F.filter(ids, lambda one: one < F.col("_doc"))).alias("below"),
                F.array_contains(ids, F.col("_doc")).alias("own"),
                F.when(pieces > 1, F.least(F.floor(place), pieces - 1)).otherwise(F.lit(0)).cast("int").alias("piece"),
            ),
        )
        .drop("_at", "_range")
    )
    # One row per slice.
    heads = (
        placed.groupBy("_slice")
        .agg(F.min(F.struct("_doc", "_tid")).alias("_low"))
        .orderBy("_slice")
        .collect()
    )
    moves = [(row["_low"]["_doc"], row["_low"]["_tid"], heads[i - 1]["_slice"]) for i, row in enumerate(heads)]
    goes = F.broadcast(
        spark.createDataFrame(moves, f"_doc long, _tid long, _to {placed.schema['_slice'].dataType.simpleString()}")
    )
    firsts = (
        placed.join(goes, ["_doc", "_tid"])
        .groupBy("_to")
        .agg(F.min("_text").alias("_text"))
        .select(
            F.lit(None).cast("long").alias("doc_id"),
            F.lit(None).cast("long").alias("_doc"),
            F.lit(None).cast("long").alias("_tid"),
            "_text",
            F.col("_to").alias("_slice"),
            F.lit(1).alias("_extra"),
        )
    )
    order = Window.partitionBy("_slice").orderBy("_extra", "_doc", "_tid", "_text")
    return (
        placed.withColumn("_extra", F.lit(0))
        .unionByName(firsts)
        .withColumn("_next", F.lead("_text").over(order))
        .filter(F.col("_extra") == 0)
        .select("doc_id", "_text", "_next")
    )


def _lookup(values: dict[int, int], key: Column) -> Column:
    """The value of a key in a small table, else NULL."""
    if not values:
        return F.lit(None).cast("int")
    pairs = [F.lit(x) for pair in values.items() for x in (F.lit(pair[0]).cast("long"), pair[1])]
    return F.try_element_at(F.create_map(*pairs), key)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    # Rows come in order, so a follower is mostly the next row's own text.
    last: tuple[str, tuple] | None = None
    for batch in batches:
        rows = []
        for text, after in zip(batch.column("_text").to_pylist(), batch.column("_next").to_pylist(), strict=True):
            own = last[1] if last is not None and last[0] == text else chosen_grams(text)
            following = chosen_grams(after)
            last = after, following
            share = len(text) // 4
            edited = text[: len(text) - share] + after[:share]
            other = chosen_grams(edited)
            mine = np.sort(own[0])
            rows.append(
                (
                    len(text),
                    sha256(edited.encode()).hexdigest(),
                    written(*own),
                    written(*other),
                    likeness(mine, np.sort(other[0])),
                    likeness(mine, np.sort(following[0])),
                )
            )
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            ["doc_id", *names],
        )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last quarter, floor(n_chars / 4) code points, replaced
    by as many first code points of the following document, or all it has.
    """
    return with_next(docs).mapInArrow(
        _compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
