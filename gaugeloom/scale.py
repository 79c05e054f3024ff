"""Building blocks that keep one oversized series from landing in one task.

A third of all rows may belong to a single device and feature, so nothing here
or above gathers a whole series in a window or a join task:

* `stage` cuts lineage by writing a Parquet table in the shared folder the
  cluster names in `spark.checkpoint.dir`;
* `number_rows` numbers rows through range-partitioned slices and slice offsets;
* `spread_join` joins rows with one fact row per series and cuts hot series only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# monotonically_increasing_id() keeps the partition above this bit.
_PARTITION_BIT = 33

# Rows of one key that a join task takes; the rows of larger keys are spread.
TASK_ROWS = 1 << 22

# Facts up to this size are sent to every executor.
BROADCAST_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """Folder for staged tables that all executors share.

    The cluster names it in `spark.checkpoint.dir`; where that is unset, the
    session's warehouse holds them.
    """
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A new place in the application's own folder, which goes when it ends."""
    context = spark.sparkContext
    own = f"{shared_folder(spark).rstrip('/')}/gaugeloom/{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(own)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{own}/{label}-{uuid.uuid4().hex}"


# Shuffle files of an execution go when it ends, not when the driver collects its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    What was shuffled for it leaves the disks as soon as it is written.
    """
    return _written(df, new_shared_path(df.sparkSession, label))


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like `stage`, for rows that are read within the block only: deleted after it.

    Nothing that is built from them may be left to run later, but `stage` and what
    stages its rows runs at once.
    """
    context = df.sparkSession.sparkContext
    path = new_shared_path(df.sparkSession, label)
    try:
        yield _written(df, path)
    finally:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def tasks(df: DataFrame) -> int:
    """Tasks that rows should be dealt to where each of them becomes many."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def by_range(df: DataFrame, order: Sequence[str], slices: int | None) -> DataFrame:
    """Range-partition on `order`; without a count AQE picks the slice size."""
    return (
        df.repartitionByRange(*order)
        if slices is None
        else df.repartitionByRange(slices, *order)
    )


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    *,
    within: Sequence[str] = (),
    name: str = "row_number",
    slices: int | None = None,
    keep: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in `order`, per `within` group.

    The rows are sorted by range, written once so slice membership is data and
    no longer depends on a recomputed sample, and numbered by adding the sizes
    of the earlier slices. Per group only one row per slice is ever windowed.
    The `within` columns must not be NULL. With `keep` only these columns are written
    beside the group's: what serves the order alone is left out.
    """
    keys = [*within, *order]
    columns = ["*"] if keep is None else [*within, *keep]
    placed = stage(
        by_range(df, keys, slices)
        .sortWithinPartitions(*keys)
        .select(*columns, F.monotonically_increasing_id().alias("_place")),
        "numbered",
    ).withColumn("_slice", F.shiftright("_place", _PARTITION_BIT))

    sizes = placed.groupBy("_slice", *within).agg(
        F.min("_place").alias("_start"), F.count("*").alias("_size")
    )
    earlier = (
        Window.partitionBy(*within)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select(
        "_slice",
        *within,
        "_start",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
    )
    if not within:
        # One row per slice, so never more rows than shuffle partitions.
        starts = F.broadcast(starts)
    return (
        placed.join(starts, ["_slice", *within])
        .withColumn(name, F.col("_before") + F.col("_place") - F.col("_start") + 1)
        .drop("_slice", "_place", "_start", "_before")
    )


def spread_join(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    *,
    size: str,
    how: str = "inner",
    task_rows: int = TASK_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join many rows per key with at most one fact row per key.

    `size` names the fact column with the key's number of rows, which is left out
    of the result. The facts are staged and measured: up to `broadcast_bytes` they
    are broadcast and no row is shuffled. Beyond that only keys of more than
    `task_rows` rows are cut, in proportion to their size: their rows by content,
    their fact row once per cut; other fact rows are not copied. The list of these
    keys has at most one row per `task_rows` rows. The rows need a column that
    tells them apart: mass copies share a cut.
    """
    facts = stage(facts, "facts")
    # Keys, and eight bytes for each of the numbers beside them.
    row_bytes = F.lit(8 * len(facts.columns))
    for key in keys:
        row_bytes += F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0))
    measured = facts.agg(F.sum(row_bytes)).first()[0] or 0
    if measured <= broadcast_bytes:
        return rows.join(F.broadcast(facts.drop(size)), list(keys), how)
    cuts = F.greatest(F.ceil(F.col(size) / task_rows), F.lit(1))
    hot = facts.where(F.col(size) > task_rows).select(*keys, cuts.alias("_cuts"))
    own = [name for name in rows.columns if name not in keys]
    cut = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_cut", F.coalesce(F.pmod(F.xxhash64(*own), F.col("_cuts")), F.lit(0))
    )
    copies = facts.withColumn(
        "_cut", F.explode(F.sequence(F.lit(0).cast("long"), cuts - 1))
    )
    # Measured as too large for a broadcast, whatever their shuffle files say.
    return cut.drop("_cuts").join(copies.drop(size).hint("merge"), [*keys, "_cut"], how).drop("_cut")
