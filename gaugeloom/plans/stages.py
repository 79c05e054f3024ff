"""Stages 2 to 14 as one set of tables.

The stage order is 2-3-4-5-6; the cleaned series feeds chart data, verdicts,
epoch series and the grid, and the grid feeds the model order, histogram,
statistics and trend. Verdicts gate nothing downstream.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gaugeloom.functions.text import checked_series_name
from gaugeloom.operators import clean, diagnose, lags, profile, resample
from gaugeloom.operators import readings as reading_operators
from gaugeloom.operators import series as series_operators
from gaugeloom.scale import new_shared_path, stage
from gaugeloom.schema import KEY, PipelineOptions
from gaugeloom.sources.sinks import write_once, write_series

# Output names by stage.
STAGE_OUTPUTS = {
    "readings": "DataProcess1",
    "features": "DataProcess2",
    "merged": "DataProcess3",
    "series": "DataProcess4",
    "cleaned": "DataProcess5",
    "chart": "DataProcess6",
    "verdicts": "DataProcess7",
    "signals": "DataProcess7Kept",
    "epochs": "DataProcess8",
    "grid": "DataProcess9",
    "orders": "DataProcess10",
    "histogram": "DataProcess11",
    "statistics": "DataProcess12",
    "trend": "DataProcess13",
}
# Outputs with one row per reading or grid point of a series.
SERIES_OUTPUTS = ("series", "cleaned", "signals", "epochs", "grid")


class Stages:
    """The output of every stage, built when first asked for.

    What several stages read (features, series, cleaned, the lines of the grid) is staged
    once. The points of the grid are made anew wherever they are read.
    """

    def __init__(self, readings: DataFrame, options: PipelineOptions) -> None:
        self.readings = reading_operators.group_by_device([readings])
        self.options = options

    @cached_property
    def features(self) -> DataFrame:
        parsed = reading_operators.parse_feature_rows(self.readings, self.options.mode)
        return stage(
            parsed.withColumns(
                {name: checked_series_name(F.col(name)) for name in KEY}
            ),
            "features",
        )

    @cached_property
    def merged(self) -> DataFrame:
        return reading_operators.merge_and_sort([self.features])

    @cached_property
    def series(self) -> DataFrame:
        return stage(
            series_operators.split_numeric_series(
                self.features, self.options.mode, booleans=True
            ),
            "series",
        )

    @cached_property
    def cleaned(self) -> DataFrame:
        return stage(
            clean.remove_outliers(
                self.series, hard_upper_limit=self.options.hard_upper_limit
            ),
            "cleaned",
        )

    @cached_property
    def chart(self) -> DataFrame:
        return profile.series_points(self.cleaned)

    @cached_property
    def verdicts(self) -> DataFrame:
        return diagnose.classify_series(self.cleaned)

    @cached_property
    def signals(self) -> DataFrame:
        return diagnose.keep_signals(self.cleaned, self.verdicts)

    @cached_property
    def epochs(self) -> DataFrame:
        return resample.epoch_seconds(self.cleaned)

    @cached_property
    def lines(self) -> DataFrame:
        return stage(
            resample.grid_lines(
                self.cleaned, self.options.points, mode=self.options.mode
            ),
            "lines",
        )

    def points(self, lines: DataFrame, *keep: str) -> DataFrame:
        return resample.grid_points(lines, self.options.points, *keep)

    @cached_property
    def grid(self) -> DataFrame:
        return self.points(self.lines)

    @cached_property
    def orders(self) -> DataFrame:
        return lags.order_by_regression(
            lags.of_lines(self.lines, self.options.points),
            self.options.p_max,
            self.options.q_max,
            self.options.max_differences,
        )

    @cached_property
    def histogram(self) -> DataFrame:
        return profile.histogram(self.lines, self.options.bins, points=self.points)

    @cached_property
    def statistics(self) -> DataFrame:
        return profile.summary_statistics(self.grid)

    @cached_property
    def trend(self) -> DataFrame:
        return profile.linear_trend_from_timestamps(self.grid)


def run_pipeline(
    readings: DataFrame, options: PipelineOptions | None = None
) -> Stages:
    """All stages over the readings.

    An unsafe device or feature name fails the job, as does an unreadable
    payload in corrected mode.
    """
    return Stages(readings, options or PipelineOptions())


def stage_counts(stages: Stages, root: str | None = None) -> DataFrame:
    """Rows, devices and series of every output, which is written once below `root`.

    Rows are counted as they are written; devices and series come from the key
    columns of the written files, so no stage runs again. Without a root the outputs
    go to the shared folder.
    """
    spark = stages.readings.sparkSession
    root = root or new_shared_path(spark, "outputs")
    rows = write_pipeline(stages, root)

    def counted(name: str) -> DataFrame:
        output = STAGE_OUTPUTS[name]
        table = spark.read.schema(getattr(stages, name).schema).parquet(f"{root}/{output}")
        keys = [key for key in KEY if key in table.columns]
        series = F.count("*") if len(keys) == len(KEY) else F.lit(None).cast("bigint")
        return (
            table.select(*keys)
            .distinct()
            .agg(F.count_distinct("sn").alias("devices"), series.alias("series"))
            .select(
                F.lit(output).alias("output"),
                F.lit(rows[output]).cast("bigint").alias("rows"),
                "devices",
                "series",
            )
        )

    first, *rest = map(counted, STAGE_OUTPUTS)
    for other in rest:
        first = first.unionByName(other)
    return first


def write_pipeline(stages: Stages, root: str) -> dict[str, int]:
    """Every stage output below `root`; nothing existing is replaced.

    Returns the number of rows written per output, observed by the writing jobs. All targets are checked before any work, and a failure names its output.
    """
    paths = {name: f"{root.rstrip('/')}/{output}" for name, output in STAGE_OUTPUTS.items()}
    context = stages.readings.sparkSession.sparkContext
    for path in paths.values():
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        if target.getFileSystem(context._jsc.hadoopConfiguration()).exists(target):
            raise FileExistsError(f"output exists: {path}")
    rows = {}
    for name, path in paths.items():
        counted = Observation()
        try:
            if name == "grid":
                # Lines are laid out and sorted, points are only written.
                write_series(stages.lines, path, counted=counted, points=stages.points)
            elif name in SERIES_OUTPUTS:
                write_series(getattr(stages, name), path, counted=counted)
            else:
                write_once(getattr(stages, name), path, counted=counted)
        except Exception as error:
            error.add_note(f"while writing {STAGE_OUTPUTS[name]} ({name})")
            raise
        rows[STAGE_OUTPUTS[name]] = counted.get["rows"]
    return rows
