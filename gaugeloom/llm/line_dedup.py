"""Line dedup by range-partitioned hashes.

Each document sends one row per distinct line key (128-bit hash, document, the
places of its lines). Rows are range-partitioned by hash and document and sorted
by hash, then document from the largest down, so a pass over a partition meets
the keeper first. A key inside one partition is decided in the pass. A common key
may span partitions: the first and last key of a partition are left open, and
their few facts, at most two keys per partition, decide them afterwards. So a
line found in a third of all documents is spread over many tasks, and no pass
holds more than the documents up to the third.

The result is a compressed bitmap of kept lines per document; texts move only
when they are cut.

A null or empty text is one empty line and keeps it. Rows that share an id are
one document: a key counts once for them, and both keep or lose it. A null id
counts as the largest. Long texts are split whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.tables import SPACES, keyed, text_bytes, with_keys
from gaugeloom.scale import stage

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3

_KEYS = "h1 long, h2 long, _doc long, _tid long, places array<int>"
_DECIDED = "h1 long, h2 long, _doc long, _tid long, places array<int>, open boolean"


def line_key(line: bytes) -> bytes:
    """The line stripped of white space, with A-Z lower-cased (bytes: ASCII only)."""
    return line.strip(SPACES).lower()


def _key_rows(batches: Iterator[pa.RecordBatch], least_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("_text"))
        digests, owners, places = [], [], []
        for row in range(len(offsets) - 1):
            found: dict[bytes, list[int]] = {}
            for place, line in enumerate(data[offsets[row] : offsets[row + 1]].tobytes().split(b"\n")):
                key = line_key(line)
                if len(key) >= least_chars and (key.isascii() or len(key.decode()) >= least_chars):
                    found.setdefault(key, []).append(place)
            digests.extend(blake2b(key, digest_size=16).digest() for key in found)
            places.extend(found.values())
            owners.extend([row] * len(found))
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        owner = pa.array(owners, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.ascontiguousarray(halves[:, 0])),
                pa.array(np.ascontiguousarray(halves[:, 1])),
                batch.column("_doc").take(owner),
                batch.column("_tid").take(owner),
                pa.array(places, pa.list_(pa.int32())),
            ],
            ["h1", "h2", "_doc", "_tid", "places"],
        )


def _decide(batches: Iterator[pa.RecordBatch], least_documents: int) -> Iterator[pa.RecordBatch]:
    """Rows to drop, and undecided rows of the partition's first and last key.

    Of a key inside the partition the largest document is kept; the next ones wait
    until enough documents are seen, then all go. Rows come sorted by key.
    """
    first = None
    key, documents, last_doc = None, 0, None
    waiting: list[tuple] = []
    kept: list[tuple] = []
    out: list[tuple] = []

    def rows(final: bool) -> Iterator[pa.RecordBatch]:
        if out and (final or len(out) >= 20_000):
            columns = zip(*out, strict=True)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int32()), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["h1", "h2", "_doc", "_tid", "places", "open"],
            )
            out.clear()

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("h1", "h2", "_doc", "_tid", "places")]
        for row in zip(*columns, strict=True):
            if row[:2] != key:
                if first is None:
                    first = row[:2]
                # What still waits belongs to a key of too few documents.
                waiting.clear()
                kept.clear()
                key, documents, last_doc = row[:2], 0, None
            if key == first:
                out.append((*row, True))
                yield from rows(False)
                continue
            if row[2] != last_doc:
                documents += 1
                last_doc = row[2]
            if documents == 1:
                kept.append(row)
            elif documents < least_documents:
                waiting.append(row)
            else:
                out.extend((*held, False) for held in waiting)
                waiting.clear()
                out.append((*row, False))
                yield from rows(False)
    # The last key may go on in the next partition. What it dropped is final, since
    # its keeper is here; the keeper and those that wait stay open.
    if key is not None and key != first:
        out.extend((*held, True) for held in (*kept, *waiting))
    yield from rows(True)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for dropped in batch.column("dropped").to_pylist():
            # Whole bytes, so that the padding keeps lines too.
            bits = np.ones((max(max(places) for places in dropped) // 8 + 1) * 8, np.uint8)
            for places in dropped:
                bits[places] = 0
            maps.append(zlib.compress(np.packbits(bits).tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_doc"), batch.column("_tid"), pa.array(maps, pa.binary())], ["_doc", "_tid", "keep"]
        )


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(_doc, _tid, keep) for `keyed` documents that lose lines.

    `keep` is a zlib-compressed bit per line, highest bit first; lines beyond the
    bitmap are kept.
    """
    if least_documents < 2:
        raise ValueError("least_documents: at least 2")
    keys = docs.select("_doc", "_tid", "_text").mapInArrow(lambda batches: _key_rows(batches, least_chars), _KEYS)
    order = ["h1", "h2", F.col("_doc").desc()]
    decided = stage(
        keys.repartitionByRange(*order)
        .sortWithinPartitions(*order, "_tid")
        .mapInArrow(lambda batches: _decide(batches, least_documents), _DECIDED),
        "lines",
    )
    # The rows of keys that have open rows, at most two keys per partition.
    left = decided.filter("open")
    facts = (
        decided.join(F.broadcast(left.select("h1", "h2").distinct()), ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2", "_doc")
        .agg(F.lit(1).alias("_one"))
        .groupBy("h1", "h2")
        .agg(F.max("_doc").alias("_keeper"), F.count("*").alias("_documents"))
    )
    late = (
        left.join(F.broadcast(facts), ["h1", "h2"])
        .filter((F.col("_documents") >= least_documents) & (F.col("_doc") < F.col("_keeper")))
        .select("_doc", "_tid", "places")
    )
    return (
        decided.filter("not open")
        .select("_doc", "_tid", "places")
        .unionByName(late)
        .groupBy("_doc", "_tid")
        .agg(F.collect_list("places").alias("dropped"))
        .mapInArrow(_bitmaps, "_doc long, _tid long, keep binary")
    )


def kept_lines(text: bytes, keep: bytes | None) -> tuple[int, int, bytes]:
    """Lines, dropped lines and the remaining text of one document."""
    lines = text.split(b"\n")
    if keep is None:
        return len(lines), 0, text
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))
    left = [line for i, line in enumerate(lines) if i >= len(bits) or bits[i]]
    return len(lines), len(lines) - len(left), b"\n".join(left)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("_text"))
        rows = []
        for i, keep in enumerate(batch.column("keep").to_pylist()):
            total, dropped, text = kept_lines(data[offsets[i] : offsets[i + 1]].tobytes(), keep)
            rows.append((total, dropped, sha256(text).hexdigest()))
        columns = zip(*rows, strict=True) if rows else [[]] * 3
        kinds = [pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )


def line_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) per document."""
    texts = keyed(docs)
    return texts.join(keep_bitmaps(texts), ["_doc", "_tid"], "left").mapInArrow(
        _digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )


def drop_lines(docs: DataFrame) -> DataFrame:
    """The same rows and columns with `text` cut; other columns are untouched.

    A null text stays null and a changed text may become empty.
    """
    texts = keyed(docs)
    cut = F.pandas_udf(_cut_texts, "string")
    columns = [
        F.when(F.col("keep").isNull(), F.col("_row.text")).otherwise(cut("_row.text", "keep")).alias(name)
        if name == "text"
        else F.col(f"_row.`{name}`")
        for name in docs.columns
    ]
    return with_keys(docs).join(keep_bitmaps(texts), ["_doc", "_tid"], "left").select(*columns)


def _cut_texts(text, keep):
    return pd.Series(
        [
            value if bits is None else kept_lines((value or "").encode(), bits)[2].decode()
            for value, bits in zip(text, keep, strict=True)
        ],
        dtype=object,
    )
