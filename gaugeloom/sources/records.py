"""Records of CSV files, also those that hold line breaks, read in parallel.

Whether a line starts inside quotes depends on all lines before it. A line maps
each of the two states it may start in to the state it ends in. These maps are
composed within a split, then over the splits of a file (one row each), so every
split cuts its records on its own and a large file is read by many tasks.

As CSV readers do, a quote opens a cell only at its start, two quotes inside are
one, and text after the closing quote belongs to the cell. Records end with a line
feed, with or without a carriage return before it. A quote that is never closed
makes the rest of its file one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeloom.scale import stage

# Possessive loops never go back, so a line costs one pass and no stack.
_INSIDE = r'(?:[^"]++|"")*+'
_CELLS = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|),)*+'
_OPENED = rf'{_CELLS}"{_INSIDE}\z'
_OPENS = rf"\A{_OPENED}"
_STAYS = rf'\A{_INSIDE}(?:\z|"[^,]*+,{_OPENED})'


def relative_path(root: str) -> Column:
    """Path of a row's file below `root`, whatever scheme the listing puts in front.

    File paths of rows are percent-encoded, with a plus sign standing for itself.
    """
    return path_below(root, F.col("_metadata.file_path"))


def path_below(root: str, uri: Column) -> Column:
    path = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    tail = "/" + root.split("://")[-1].strip("/") + "/"
    return F.substr(path, F.locate(tail, path) + F.lit(len(tail)))


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """(path) of every file below `root`.

    A scan skips empty files, so the list comes from Spark's own file index, which the
    driver holds for any scan of the folder.
    """
    index = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    listed = spark.createDataFrame([(uri,) for uri in index.inputFiles()], "uri string")
    return listed.select(path_below(root, F.col("uri")).alias("path"))


def _lines(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """Lines with their place and what they do to either state."""
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("lineSep", "\n")
        .text(root)
        .select(
            relative_path(root).alias("path"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("place"),
            F.col("value").alias("line"),
        )
    )
    return stage(
        lines.withColumns({"from_out": F.col("line").rlike(_OPENS), "from_in": F.col("line").rlike(_STAYS)}),
        "lines",
    )


def _before(within: list[str], order: str) -> tuple[Column, Column]:
    """What is known of the state before a row: a fixed state or NULL, and whether it flips.

    Rows carry `from_out` and `from_in`, the states that follow either state.
    """
    earlier = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.when(F.col("from_out") == F.col("from_in"), F.col("from_out"))
    flips = F.when(F.col("from_out") & ~F.col("from_in"), 1).otherwise(0)
    upto = F.sum(flips).over(Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    since = F.coalesce(F.sum(flips).over(earlier), F.lit(0)) - F.coalesce(
        F.last(F.when(fixed.isNotNull(), F.col("_upto")), ignorenulls=True).over(earlier), F.lit(0)
    )
    return F.last(fixed, ignorenulls=True).over(earlier), since, upto


def _with_state(rows: DataFrame, within: list[str], order: str) -> DataFrame:
    fixed, since, upto = _before(within, order)
    return rows.withColumn("_upto", upto).withColumns({"_fixed": fixed, "_flip": since % 2 == 1}).drop("_upto")


def _inside(start: Column) -> Column:
    """True if a row begins inside quotes when its split or file begins in state `start`."""
    return F.coalesce(F.col("_fixed"), start) != F.col("_flip")


def csv_records(spark: SparkSession, root: str, glob: str = "*.[cC][sS][vV]") -> DataFrame:
    """(path, record_no, record): records of all files below `root`, numbered from 1 in each."""
    split = ["path", "split"]
    lines = _with_state(_lines(spark, root, glob), split, "place")
    running = Window.partitionBy(*split).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    states = {"out": _inside(F.lit(False)), "in": _inside(F.lit(True))}
    for name, inside in states.items():
        lines = lines.withColumns(
            {
                f"_starts_{name}": F.sum(F.when(inside, 0).otherwise(1)).over(running),
                f"_after_{name}": F.when(inside, F.col("from_in")).otherwise(F.col("from_out")),
            }
        )
    splits = lines.groupBy(*split).agg(
        F.max_by("_after_out", "place").alias("from_out"),
        F.max_by("_after_in", "place").alias("from_in"),
        F.max("_starts_out").alias("_all_out"),
        F.max("_starts_in").alias("_all_in"),
    )
    # From here on one row per split.
    splits = _with_state(splits, ["path"], "split").withColumn("_begins_in", _inside(F.lit(False)))
    earlier = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.when(F.col("_begins_in"), F.col("_all_in")).otherwise(F.col("_all_out"))
    splits = splits.select(
        *split, "_begins_in", F.coalesce(F.sum(starts).over(earlier), F.lit(0)).alias("_records")
    )
    begins = F.col("_begins_in")
    placed = lines.join(splits, split).select(
        *split,
        "place",
        "line",
        (F.col("_records") + F.when(begins, F.col("_starts_in")).otherwise(F.col("_starts_out"))).alias("record_no"),
        (~_inside(begins) & ~F.when(begins, F.col("_after_in")).otherwise(F.col("_after_out"))).alias("_whole"),
    )
    whole = placed.where("_whole").select("path", "record_no", F.col("line").alias("record"))
    broken = (
        placed.where("not _whole")
        .groupBy("path", "record_no")
        .agg(F.array_sort(F.collect_list(F.struct("split", "place", "line"))).alias("parts"))
        .select("path", "record_no", F.array_join(F.transform("parts", lambda part: part["line"]), "\n").alias("record"))
    )
    return whole.unionByName(broken)


def split_cells(record: Column) -> Column:
    """Cells of one record with their quotes undone."""
    bare = F.regexp_replace(record, r"\A\x{FEFF}|\r\z", "")
    cells = F.regexp_extract_all(
        F.concat(F.lit(","), bare), F.lit(rf',("{_INSIDE}(?:"[^,]*+)?|[^",][^,]*+|)'), F.lit(1)
    )
    quoted = rf'\A"({_INSIDE})"?([^,]*+)\z'

    def plain(cell: Column) -> Column:
        inner = F.replace(F.regexp_extract(cell, quoted, 1), F.lit('""'), F.lit('"'))
        return F.when(F.startswith(cell, F.lit('"')), F.concat(inner, F.regexp_extract(cell, quoted, 2))).otherwise(cell)

    return F.transform(cells, plain)
