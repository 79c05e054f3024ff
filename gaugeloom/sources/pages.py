"""CSV pages of raw readings: numbered page files, or one folder of page rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeloom.scale import new_shared_path, spread_join, stage
from gaugeloom.schema import RAW_COLUMNS
from gaugeloom.sources.records import csv_records, split_cells

# Fixed value: name of a page file.
PAGE_FILE = r"SqlData([1-9][0-9]*)\.csv"

# Quotes inside a payload are doubled, as CSV writers do.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "encoding": "UTF-8",
}

# Rows of one page are numbered below this bit of `seq`.
_PAGE_BIT = 32


def check_pages(spark: SparkSession, directory: str) -> None:
    """Fail on stray names, no pages at all, or a gap in the numbering.

    Only the listing is read; one small aggregate comes back.
    """
    names = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(directory)
        .select(
            F.regexp_extract("path", rf"/{PAGE_FILE}\z", 1)
            .try_cast("long")
            .alias("page_no")
        )
    )
    found = names.agg(
        F.count("*").alias("files"),
        F.count("page_no").alias("pages"),
        F.max("page_no").alias("last"),
        F.count_distinct("page_no").alias("distinct"),
    ).first()
    if found["files"] == 0:
        raise ValueError("no exported page found")
    if found["pages"] != found["files"]:
        raise ValueError("unexpected entry among the pages")
    if found["distinct"] != found["files"] or found["last"] != found["files"]:
        raise ValueError("page numbering is not contiguous")


def _readings(pages: DataFrame, page_no: Column, position: Column) -> DataFrame:
    """Reading columns plus the page and the position inside it as `seq`."""
    page = page_no.cast("long")
    return pages.select(
        F.col("sn").cast("string").alias("sn"),
        "date",
        "data",
        F.col("slave_id").cast("int").alias("slave_id"),
        F.col("type_id").cast("int").alias("type_id"),
        page.alias("page_no"),
        (F.shiftleft(page, _PAGE_BIT) + position.cast("long")).alias("seq"),
    )


def page_headers(records: DataFrame) -> DataFrame:
    """(path, header, rows): the column names of every page and its number of records."""
    first = F.when(F.col("record_no") == 1, split_cells(F.col("record")))
    return records.groupBy("path").agg(
        F.max(first).alias("header"), F.count("*").alias("rows")
    )


def read_pages(spark: SparkSession, directory: str) -> DataFrame:
    """Readings of all `SqlData{n}.csv` pages, in page and record order by `seq`.

    Columns are found by their name in each page's own header, so pages may differ
    in column order and have further columns, such as a row index; a page that
    lacks a reading column fails the job. Empty cells are NULL. A page of any size
    is read by many tasks.
    """
    check_pages(spark, directory)
    records = stage(csv_records(spark, directory), "pages")
    rows = spread_join(records.where(F.col("record_no") > 1), page_headers(records), ["path"], size="rows")
    # A line without any text is no record.
    cells = rows.where(~F.col("record").rlike(r"\A\r?\z")).withColumn("cells", split_cells(F.col("record")))

    def named(name: str) -> Column:
        place = F.array_position("header", F.lit(name))
        lacking = F.concat(F.lit(f"no column {name} in page "), F.col("path"))
        cell = F.get("cells", (place - 1).cast("int"))
        return F.when(place == 0, F.raise_error(lacking).cast("string")).otherwise(F.nullif(cell, F.lit(""))).alias(name)

    pages = cells.select("path", "record_no", *(named(name) for name in RAW_COLUMNS))
    page_no = F.regexp_extract(F.concat(F.lit("/"), F.col("path")), rf"/{PAGE_FILE}\z", 1)
    return _readings(pages, page_no, F.col("record_no") - 2)


def write_page_files(pages: DataFrame, directory: str) -> None:
    """Pages as files `SqlData{n}.csv` with a header and a row index, write-once.

    Each page is a sorted partition of its own, as a page has at most a batch of
    rows; the part files are then renamed to page names, one rename per page.
    """
    spark = pages.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(directory).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(path(directory)):
        raise FileExistsError(f"output exists: {directory}")
    parts = new_shared_path(spark, "page-parts")
    (
        pages.select("page_no", (F.col("row_number") - 1).alias("index"), *RAW_COLUMNS)
        .repartition("page_no")
        .sortWithinPartitions("page_no", "index")
        .write.partitionBy("page_no")
        .option("maxRecordsPerFile", 0)
        .options(header="true", quote='"', escape='"')
        .csv(parts)
    )
    system.mkdirs(path(directory))
    for folder in system.listStatus(path(parts)):
        name = folder.getPath().getName()
        if not name.startswith("page_no="):
            continue
        (part,) = (item for item in system.listStatus(folder.getPath()) if item.getPath().getName().endswith(".csv"))
        system.rename(part.getPath(), path(f"{directory}/SqlData{name.removeprefix('page_no=')}.csv"))


def write_pages(pages: DataFrame, directory: str) -> None:
    """Numbered pages as one write-once CSV folder, pages kept together.

    `page_no` and `row_number` are columns instead of one file per page, so a
    large export stays a moderate number of large files.
    """
    (
        pages.select("page_no", "row_number", *RAW_COLUMNS)
        .repartitionByRange("page_no", "row_number")
        .sortWithinPartitions("page_no", "row_number")
        .write.mode("errorifexists")
        .options(**CSV_OPTIONS)
        .csv(directory)
    )


def read_page_rows(spark: SparkSession, directory: str) -> DataFrame:
    """Readings of a folder written by `write_pages`."""
    schema = T.StructType(
        [
            T.StructField("page_no", T.LongType()),
            T.StructField("row_number", T.LongType()),
            *(T.StructField(name, T.StringType()) for name in RAW_COLUMNS),
        ]
    )
    pages = spark.read.options(**CSV_OPTIONS).schema(schema).csv(directory)
    return _readings(pages, F.col("page_no"), F.col("row_number"))
