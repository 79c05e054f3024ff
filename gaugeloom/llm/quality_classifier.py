"""Quality scores from compressed sizes.

Two zstandard dictionaries are built from labelled text, one from good and one
from bad documents. A text is cut into blocks and each block is compressed with
both; the total sizes give (bad - good) / (bad + good), above 0 when the good
dictionary helps more. A logistic curve turns that into a probability.

Fitting uses a bounded sample of labelled rows: at most `sample_rows` documents of
each class, chosen by a hash of the id: three of four go into the dictionaries, the
others calibrate. Texts are taken whole: a dictionary holds as many of them as fit, one
longer than `sample_bytes` is left out of it, and the calibrating documents are
measured in full on the executors. Rows that repeat a labelled id are one document,
the least text. The bounds are parameters; every document is scored in full. Scores
depend on the text alone.

Null and empty texts have difference 0 and get the score of that difference;
repeated rows get equal scores. `fit` raises MissingClass, a ValueError, for a class
without sampled text; `fit_or_constant` gives every document 0.5 then.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.tables import text_bytes, text_of
from gaugeloom.scale import stage

SAMPLE_ROWS = 1500
# A longer text is not sampled for a dictionary; with SAMPLE_ROWS it bounds the driver.
SAMPLE_BYTES = 64 << 10
DICTIONARY_BYTES = 4 << 20
BLOCK_BYTES = 256
LEVEL = 6


class MissingClass(ValueError):
    """One class, or both, have no text to learn from."""


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def probability(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * difference, -40, 40)))


@lru_cache(maxsize=4)
def _compressors(good: bytes, bad: bytes) -> tuple:
    out = []
    for body in (good, bad):
        dictionary = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        out.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
            )
        )
    return tuple(out)


def size_difference(text: memoryview | bytes, good: bytes, bad: bytes) -> float:
    """(bad - good) / (bad + good) of the compressed sizes of all blocks."""
    with_good, with_bad = _compressors(good, bad)
    view = memoryview(text)
    sizes = [0, 0]
    for start in range(0, len(view), BLOCK_BYTES):
        block = view[start : start + BLOCK_BYTES]
        sizes[0] += len(with_good.compress(block))
        sizes[1] += len(with_bad.compress(block))
    return (sizes[1] - sizes[0]) / sum(sizes) if sum(sizes) else 0.0


def _differences(docs: DataFrame, good: bytes, bad: bytes, keep: list[Column]) -> DataFrame:
    """`keep` and the difference of every row."""
    model = docs.sparkSession.sparkContext.broadcast((good, bad))
    rows = docs.select(*keep, text_of().alias("_text"))
    names = rows.columns[:-1]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("_text"))
            values = [
                size_difference(data[a:b].tobytes(), *model.value)
                for a, b in zip(offsets[:-1], offsets[1:], strict=True)
            ]
            columns = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.float64())], [*names, "_difference"])

    return rows.mapInArrow(score, f"{schema}, _difference double")


def fit(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES
) -> QualityModel:
    """Fit on (doc_id, quality) rows of `labels`; pass only those to learn from.

    Labels other than 0 and 1 are ignored; of repeated ids the lower label counts.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.min("quality").alias("_label"))
    )
    drawn = None
    for label in (0, 1):
        part = (
            known.filter(F.col("_label") == label)
            .orderBy(F.xxhash64("_id", F.lit("quality")), "_id")
            .limit(sample_rows)
        )
        drawn = part if drawn is None else drawn.unionByName(part)
    # At most 2 * sample_rows ids: bounded by the parameter. An id is one document,
    # however many rows have it.
    sampled = stage(
        docs.select(F.col("doc_id").cast("long").alias("_id"), text_of().alias("text"))
        .join(F.broadcast(drawn), "_id")
        .groupBy("_id", "_label")
        .agg(F.min("text").alias("text")),
        "quality_sample",
    )
    builds = F.pmod(F.xxhash64("_id", F.lit("part")), F.lit(4)) > 0
    fits = F.octet_length("text").between(1, sample_bytes)
    rows = sampled.filter(builds & fits).select("_id", "_label", "text").collect()
    rows.sort(key=lambda row: row["_id"])
    bodies: dict[int, list[bytes]] = {0: [], 1: []}
    for row in rows:
        bodies[row["_label"]].append(row["text"].encode())
    if not all(bodies.values()):
        raise MissingClass("both classes need labelled documents")
    # Equal sizes: a larger dictionary would win whatever it holds.
    size = min(DICTIONARY_BYTES, *(sum(map(len, part)) for part in bodies.values()))
    good, bad = (_dictionary(bodies[label], size) for label in (1, 0))
    # One number for each calibrating document, from its whole text.
    measured = _differences(sampled.filter(~builds), good, bad, [F.col("_id"), F.col("_label")]).collect()
    measured.sort(key=lambda row: row["_id"])
    differences = np.array([row["_difference"] for row in measured] or [0.0])
    truth = np.array([row["_label"] for row in measured] or [1], float)
    slope, offset = logistic(differences, truth)
    return QualityModel(good, bad, slope, offset)


def fit_or_constant(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Like `fit`, with a constant score of 0.5 where a class has no sampled text."""
    try:
        return fit(docs, labels, sample_rows)
    except MissingClass:
        return QualityModel(b"", b"", 0.0, 0.0)


def _dictionary(bodies: list[bytes], size: int) -> bytes:
    """Whole texts in turn that fit into `size` bytes, the shortest one if none does."""
    parts, left = [], size
    for body in bodies:
        if len(body) <= left:
            parts.append(body)
            left -= len(body)
    return b"".join(parts) or min(bodies, key=len)


def logistic(x: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve by Newton steps.

    Both classes weigh the same, so that 0.5 parts them whatever their shares; a
    small penalty keeps the slope finite when they part without error.
    """
    scale = float(np.std(x)) or 1.0
    z = x / scale
    weight = np.where(truth == 1, 0.5 / max(truth.sum(), 1), 0.5 / max((1 - truth).sum(), 1)) * len(z)
    a = b = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(b + a * z, -30, 30)))
        gap, curve = weight * (truth - p), weight * p * (1 - p) + 1e-9
        gradient = np.array([(gap * z).sum() - 0.01 * a, gap.sum()])
        hessian = np.array([[(curve * z * z).sum() + 0.01, (curve * z).sum()], [(curve * z).sum(), curve.sum()]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a + float(step[0]), b + float(step[1])
        if np.abs(step).max() < 1e-9:
            break
    if not math.isfinite(a) or not math.isfinite(b):
        return 0.0, 0.0
    return a / scale, b


def score_documents(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of every whole text."""
    if not model.good and not model.bad:
        constant = F.lit(float(model.probability(np.zeros(1))[0]))
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), constant.alias("score"))
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(model.offset) + F.lit(model.slope) * F.col("_difference"))))
    return _differences(docs, model.good, model.bad, [F.col("doc_id").cast("long").alias("doc_id")]).select(
        "doc_id", probability.alias("score")
    )
