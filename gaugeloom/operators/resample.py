"""Local-time text to epoch seconds, first row per time, fixed-grid resampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.scale import number_rows, staged, tasks
from gaugeloom.schema import GRID_POINTS, KEY, Mode, require_count

# Times are whole seconds, so a block of this width holds at most this many
# rows once duplicates are gone, however large the series is.
BLOCK_SECONDS = 1 << 22

# Accepts padded and unpadded text, like the C library parser did.
DATE_PATTERN = "yyyy-M-d H:m:s"


def epoch_seconds(series: DataFrame) -> DataFrame:
    """`(time, data)` rows; date text is local time of the session time zone."""
    return series.select(
        *KEY,
        F.unix_timestamp("date", DATE_PATTERN).cast("double").alias("time"),
        F.col("value").alias("data"),
    )


def _timed(series: DataFrame) -> DataFrame:
    """Rows with a date and a number, their time as bigint."""
    return series.where(
        F.col("date").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value")
    ).withColumn("time", F.unix_timestamp("date", DATE_PATTERN))


def _block(block_seconds: int) -> Column:
    # Not nullable, so that a join on it adds no filter of its own to one
    # side and both sides share this shuffle.
    return F.coalesce(F.floor(F.col("time") / block_seconds), F.lit(0))


def _first_per_time(series: DataFrame, block_seconds: int) -> DataFrame:
    """First row of each time by (date text, position), with its block, time as bigint.

    Rows are reduced with a map-side combine. Two texts can name the same second;
    the one that sorts first is kept. Rows without a position count last.
    """
    position = F.when(F.col("seq").isNotNull(), F.struct("date", "seq"))
    return (
        _timed(series)
        .groupBy(*KEY, "time")
        .agg(F.min_by("value", position).alias("data"))
        .withColumn("block", _block(block_seconds))
    )


def zip_in_input_order(
    series: DataFrame,
    order: Sequence[str] = ("date", "seq"),
    *,
    slices: int | None = None,
) -> DataFrame:
    """The n-th distinct time with the n-th first occurrence of a time in `order`.

    The old data behaviour: times are sorted, values are not. On rows sorted by time
    it changes nothing. Both positions come from range slices, so a series may be of
    any length; ties in `order` follow value and time.
    """
    reduced = (
        _timed(series)
        .groupBy(*KEY, "time")
        .agg(F.min(F.struct(*order, "value")).alias("first"))
    )
    with staged(reduced, "first_rows") as firsts:
        times = number_rows(
            firsts.select(*KEY, "time"), ["time"], within=KEY, name="n", slices=slices
        )
        values = number_rows(
            firsts.withColumnRenamed("time", "own_time"),
            ["first", "own_time"],
            within=KEY,
            name="n",
            slices=slices,
            # The position of a row is long; it only orders them.
            keep=[F.col("first.value").alias("data")],
        )
    return times.join(values, [*KEY, "n"]).select(*KEY, "time", "data")


def dedupe_timestamps(
    series: DataFrame, *, block_seconds: int = BLOCK_SECONDS
) -> DataFrame:
    """First row per time in (date text, position) order as `(time, data)`."""
    return _first_per_time(series, block_seconds).select(
        *KEY, F.col("time").cast("double").alias("time"), "data"
    )


def grid_lines(
    series: DataFrame,
    points: int = GRID_POINTS,
    *,
    mode: Mode = Mode.CORRECTED,
    order: Sequence[str] = ("date", "seq"),
    block_seconds: int = BLOCK_SECONDS,
    before: bool = False,
) -> DataFrame:
    """The grid as straight lines: one row per two neighbouring rows with points between them.

    A line goes from (t0, v0) to (t1, v1) and holds the grid points `low` to `high`;
    start and stop are the ends of the series. There are never more lines than rows,
    however fine the grid is: what is shuffled, joined or staged should be lines, which
    `grid_points` turns into points. With `before` a line knows the value of the point
    before its first one, NULL at the start of the series.

    Neighbours come from windows over (series, block); the last row of a block finds
    its neighbour in a table with one row per block. Series with fewer than two distinct
    times vanish.
    """
    require_count(points, "points", 2)
    if mode is Mode.CORRECTED:
        firsts = _first_per_time(series, block_seconds)
    else:
        firsts = zip_in_input_order(series, order).withColumn("block", _block(block_seconds))
    # A number of its own: lines are few and small, their points are not, and tasks
    # merged by the size of the lines would leave most cores idle.
    firsts = firsts.repartition(tasks(series), *KEY, "block")
    by_time = Window.partitionBy(*KEY, "block").orderBy("time")
    segments = firsts.select(
        *KEY,
        "block",
        F.col("time").alias("t0"),
        F.col("data").alias("v0"),
        F.lead("time").over(by_time).alias("t1"),
        F.lead("data").over(by_time).alias("v1"),
    )

    whole = Window.partitionBy(*KEY)
    by_block = whole.orderBy("block")
    blocks = (
        firsts.groupBy(*KEY, "block")
        .agg(
            F.min("time").alias("first_time"),
            F.max("time").alias("last_time"),
            F.min_by("data", "time").alias("first_data"),
        )
        .select(
            *KEY,
            "block",
            F.lead("first_time").over(by_block).alias("next_time"),
            F.lead("first_data").over(by_block).alias("next_data"),
            F.min("first_time").over(whole).alias("start"),
            F.max("last_time").over(whole).alias("stop"),
        )
    )

    step = _step(points)
    first_index = F.ceil((F.col("t0") - F.col("start")) / step)
    end_index = F.when(F.col("t1") == F.col("stop"), F.lit(points - 1)).otherwise(
        F.ceil((F.col("t1") - F.col("start")) / step) - 1
    )
    lines = (
        segments.join(blocks, [*KEY, "block"])
        .withColumns(
            {
                "t1": F.coalesce("t1", "next_time"),
                "v1": F.coalesce("v1", "next_data"),
            }
        )
        .where((F.col("stop") > F.col("start")) & F.col("t1").isNotNull())
        .withColumns(
            {
                "low": first_index.cast("int"),
                "high": end_index.cast("int"),
            }
        )
        .where(F.col("low") <= F.col("high"))
        .drop("next_time", "next_data")
    )
    return (_with_before(lines, points) if before else lines).drop("block")


def _step(points: int) -> Column:
    return (F.col("stop") - F.col("start")) / F.lit(float(points - 1))


def _grid_time(idx: Column, points: int) -> Column:
    # The last grid time is the last row's time exactly.
    return F.when(idx == points - 1, F.col("stop").cast("double")).otherwise(
        F.col("start") + idx * _step(points)
    )


def _on_line(time: Column) -> Column:
    slope = (F.col("v1") - F.col("v0")) / (F.col("t1") - F.col("t0"))
    return F.col("v0") + slope * (time - F.col("t0"))


def _with_before(lines: DataFrame, points: int) -> DataFrame:
    """Add `before`: the last point of the line ahead, over blocks without lines too."""
    ended = lines.withColumn("_last", _on_line(_grid_time(F.col("high"), points)))
    by_block = Window.partitionBy(*KEY).orderBy("block")
    ahead = (
        ended.groupBy(*KEY, "block")
        .agg(F.max_by("_last", "high").alias("_last"))
        .select(*KEY, "block", F.lag("_last").over(by_block).alias("_ahead"))
    )
    by_line = Window.partitionBy(*KEY, "block").orderBy("low")
    return (
        ended.withColumn("before", F.lag("_last").over(by_line))
        .join(ahead, [*KEY, "block"])
        .withColumn("before", F.coalesce("before", "_ahead"))
        .drop("_last", "_ahead")
    )


def grid_points(lines: DataFrame, points: int = GRID_POINTS, *keep: str) -> DataFrame:
    """The points of `grid_lines` as (sn, feature, idx, time, data), and the `keep` columns.

    No row moves. Lines that know the point before them give every point its `previous`
    value, NULL for the first of a series.
    """
    require_count(points, "points", 2)
    idx = F.col("idx")
    cells = {"time": _grid_time(idx, points), "data": _on_line(F.col("time"))}
    if "before" in lines.columns:
        cells["previous"] = F.when(idx == F.col("low"), F.col("before")).otherwise(
            _on_line(_grid_time(idx - 1, points))
        )
    found = lines.withColumn("idx", F.explode(F.sequence("low", "high")))
    for name, cell in cells.items():
        found = found.withColumn(name, cell)
    return found.select(*KEY, "idx", *cells, *keep)


def interpolate_series(
    series: DataFrame,
    points: int = GRID_POINTS,
    *,
    mode: Mode = Mode.CORRECTED,
    order: Sequence[str] = ("date", "seq"),
    block_seconds: int = BLOCK_SECONDS,
    previous: bool = False,
) -> DataFrame:
    """Piecewise-linear values on `points` evenly spaced times per series.

    Corrected mode sorts rows by time. Legacy mode sorts the times alone and keeps
    the values in input `order` (see `zip_in_input_order`).

    Each pair of neighbouring rows emits the grid points between them, so there
    is no join with the grid (see `grid_lines`). With `previous` each point carries
    the value of the point before it.
    """
    lines = grid_lines(
        series, points, mode=mode, order=order, block_seconds=block_seconds, before=previous
    )
    return grid_points(lines, points)


def linspace_grid(
    series: DataFrame, points: int = GRID_POINTS, *, block_seconds: int = BLOCK_SECONDS
) -> DataFrame:
    """The evenly spaced times alone."""
    require_count(points, "points", 2)
    spans = (
        series.where(F.col("value").isNotNull() & ~F.isnan("value"))
        .withColumn("time", F.unix_timestamp("date", DATE_PATTERN))
        .groupBy(*KEY)
        .agg(F.min("time").alias("start"), F.max("time").alias("stop"))
        .where(F.col("stop") > F.col("start"))
        # One small row per series, which may all be in one task. By the key alone they
        # lie already, so Spark would leave this out and merge them again.
        .repartition(tasks(series), *KEY, "start")
    )
    return spans.withColumn(
        "idx", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    ).select(*KEY, "idx", _grid_time(F.col("idx"), points).alias("time"))
