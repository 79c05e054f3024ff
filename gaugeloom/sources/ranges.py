"""Digests of byte ranges, so that a file of any size is hashed by many tasks.

A file of one range is hashed inside Spark's own file scan. A larger one becomes one
row per range, dealt to all tasks; each task reads its ranges in small pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.schema import require_count
from gaugeloom.sources.records import listed_files, relative_path

RANGE_BYTES = 64 << 20
_PIECE = 1 << 20


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    scheme, mark, rest = uri.partition(":/")
    if mark and scheme != "file":
        return fs.FileSystem.from_uri(quote(uri, safe=":/@"))
    return fs.LocalFileSystem(), "/" + rest.lstrip("/") if mark else uri


def _digest(uri: str, start: int, size: int) -> str:
    system, path = _file_system(uri)
    digest = hashlib.sha256()
    with system.open_input_file(path) as file:
        file.seek(start)
        while size > 0:
            piece = file.read(min(size, _PIECE))
            if not piece:
                raise OSError(f"{uri} became shorter while it was read")
            digest.update(piece)
            size -= len(piece)
    return digest.hexdigest()


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        ranges = zip(frame["uri"], frame["start"], frame["size"])
        yield frame[["path", "start"]].assign(
            digest=[_digest(uri, int(start), int(size)) for uri, start, size in ranges]
        )


def range_digests(
    spark: SparkSession, root: str, *, skip: str = "", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """(path, start, digest): SHA-256 of every range of the files below `root`.

    Paths are relative to `root`; those that match the pattern `skip` are left out.
    A row with start -1 and an empty digest stands for the file itself, which may be empty.
    """
    require_count(range_bytes, "range_bytes", 1)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .withColumnRenamed("path", "uri")
        .withColumn("path", relative_path(root))
    )
    names = listed_files(spark, root)
    if skip:
        files, names = (table.where(~F.col("path").rlike(skip)) for table in (files, names))
    # The scan skips the files that its filter on the length leaves out.
    small = files.where(F.col("length") <= range_bytes).select(
        "path", F.lit(0).cast("bigint").alias("start"), F.sha2("content", 256).alias("digest")
    )
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))
    ranges = (
        files.where(F.col("length") > range_bytes)
        .select("uri", "path", "length", F.explode(starts).alias("start"))
        .withColumn("size", F.least(F.lit(range_bytes).cast("bigint"), F.col("length") - F.col("start")))
        .repartition("uri", "start")
    )
    large = ranges.mapInPandas(_digests, "path string, start bigint, digest string")
    marks = names.withColumns({"start": F.lit(-1).cast("bigint"), "digest": F.lit("")})
    return small.unionByName(large).unionByName(marks)
