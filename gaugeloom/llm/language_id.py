"""The language of a text by compression.

Each language has a raw-content zstandard dictionary made of whole texts known to
be in it. A text is lower-cased, everything but letters and marks becomes one
blank, and its blocks are compressed with every dictionary; the smallest total
names the language. The margin, 1 - smallest / second smallest, is the score; a
text whose margin is narrow is rejected (`accepted` is false), whatever its size.

Dictionaries come from a bounded sample of labelled rows: of each language the
`sample_rows` rows with the smallest hash among those of at most `row_bytes` bytes;
their whole texts are taken in that order while they fit into `dictionary_bytes`.
At most `languages` languages, those with the most rows, are learned. Every text
is classified whole, and a prediction depends on the text alone.

Null texts and texts without a letter are `und` with score 0. On equal sizes the
language with more labelled rows wins, then the smaller name; such a text has
score 0 and is not accepted. Where nothing can be learned every row is `und`.
Repeated rows get equal results; further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.llm.tables import text_bytes, text_of
from gaugeloom.scale import stage

SAMPLE_ROWS = 400
ROW_BYTES = 64 << 10
DICTIONARY_BYTES = 128 << 10
LANGUAGES = 200
BLOCK_BYTES = 512
LEVEL = 3
MARGIN = 0.02

UNKNOWN = "und"

Model = tuple[tuple[str, bytes], ...]


def letters(text: Column) -> Column:
    """Lower-case words with a blank at both ends and between two; a lone blank without letters."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")), F.lit(" "))


def fit(
    docs: DataFrame,
    *,
    sample_rows: int = SAMPLE_ROWS,
    row_bytes: int = ROW_BYTES,
    dictionary_bytes: int = DICTIONARY_BYTES,
    languages: int = LANGUAGES,
) -> Model:
    """(language, dictionary) pairs from (doc_id, text, lang); pass only rows to learn from.

    Rows without language, id or letter are passed over.
    """
    known = docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.col("lang").cast("string").alias("_lang"),
        text_of().alias("_text"),
    ).filter(F.col("_id").isNotNull() & F.col("_lang").isNotNull() & F.col("_text").rlike(r"\p{L}"))
    short = F.octet_length("_text") <= row_bytes
    counts = known.groupBy("_lang").agg(F.count("*").alias("rows"), F.count_if(short).alias("short"))
    counts = counts.orderBy(F.desc("rows"), "_lang").limit(languages).collect()
    order = [row["_lang"] for row in counts]
    if not order:
        return ()
    # Four times the wanted rows, by a bound on their hash: what is ranked per
    # language does not grow with the input or the number of tasks.
    bounds = [
        (row["_lang"], min(-(1 << 63) + int((1 << 64) * min(1.0, 4 * sample_rows / max(row["short"], 1))), (1 << 63) - 1))
        for row in counts
    ]
    bounds = F.broadcast(docs.sparkSession.createDataFrame(bounds, "_lang string, _bound long"))
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy("_hash", "_id", "_tid"))
    chosen = (
        known.filter(short)
        .select("_lang", "_id", F.xxhash64("_text").alias("_tid"), F.xxhash64("_id", F.lit("language")).alias("_hash"))
        .join(bounds, "_lang")
        .filter(F.col("_hash") <= F.col("_bound"))
        .withColumn("_rank", rank)
        .filter(F.col("_rank") <= sample_rows)
        .select("_lang", "_id", "_tid", "_rank")
    )
    texts = stage(
        known.withColumn("_tid", F.xxhash64("_text"))
        .join(F.broadcast(chosen), ["_lang", "_id", "_tid"])
        .groupBy("_lang", "_rank")
        .agg(F.min(letters(F.col("_text"))).alias("_text")),
        "language_sample",
    )
    # The walk over the sizes is bounded by sample_rows, the texts by dictionary_bytes.
    sizes: dict[str, list[tuple[int, int]]] = {}
    for row in texts.select("_lang", "_rank", F.octet_length("_text").alias("size")).collect():
        sizes.setdefault(row["_lang"], []).append((row["_rank"], row["size"]))
    fitting = []
    for language, rows in sizes.items():
        left = dictionary_bytes
        for number, size in sorted(rows):
            if size <= left:
                left -= size
                fitting.append((language, number))
    if not fitting:
        return ()
    wanted = docs.sparkSession.createDataFrame(fitting, "_lang string, _rank int")
    bodies: dict[str, list[tuple[int, bytes]]] = {}
    for row in texts.join(F.broadcast(wanted), ["_lang", "_rank"]).collect():
        bodies.setdefault(row["_lang"], []).append((row["_rank"], row["_text"].encode()))
    return tuple((name, b"".join(text for _, text in sorted(bodies[name]))) for name in order if name in bodies)


@lru_cache(maxsize=2)
def _compressors(bodies: tuple[bytes, ...]) -> list:
    out = []
    for body in bodies:
        dictionary = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        out.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
            )
        )
    return out


def compressed_sizes(text: bytes, bodies: tuple[bytes, ...]) -> list[int]:
    """Total compressed size of the blocks of a text with each dictionary."""
    compressors = _compressors(bodies)
    sizes = [0] * len(bodies)
    for start in range(0, len(text), BLOCK_BYTES):
        block = text[start : start + BLOCK_BYTES]
        for place, compressor in enumerate(compressors):
            sizes[place] += len(compressor.compress(block))
    return sizes


def predict(docs: DataFrame, model: Model, *, margin: float = MARGIN) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (tuple(name for name, _ in model), tuple(body for _, body in model))
    )
    names = ["doc_id", "lang_pred", "score"]

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, bodies = shared.value
        for batch in batches:
            data, offsets = text_bytes(batch.column("_letters"))
            found, scores = [], []
            for start, end in zip(offsets[:-1], offsets[1:], strict=True):
                if end - start <= 2 or not bodies:
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                sizes = compressed_sizes(data[start:end].tobytes(), bodies)
                best = int(np.argmin(sizes))
                found.append(languages[best])
                others = sizes[:best] + sizes[best + 1 :]
                scores.append(1 - sizes[best] / min(others) if others else 1.0)
            arrays = [batch.column("doc_id"), pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    # Marks alone are no letters.
    words = F.when(text_of().rlike(r"\p{L}"), letters(text_of())).otherwise("")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), words.alias("_letters"))
        .mapInArrow(classify, "doc_id long, lang_pred string, score double")
        .withColumn("accepted", (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= margin))
    )
