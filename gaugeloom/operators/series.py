"""Feature rows to numeric series, one per device and feature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.functions.text import (
    INTEGER_TEXT,
    NUMERIC_TEXT,
    is_missing,
    numeric_value,
)
from gaugeloom.scale import spread_join
from gaugeloom.schema import KEY, RESERVED_COLUMNS, Mode


def drop_nulls(series: DataFrame) -> DataFrame:
    return series.na.drop(subset=["date", "value"])


def split_numeric_series(
    features: DataFrame, mode: Mode, *, booleans: bool = False
) -> DataFrame:
    """Long `(sn, feature, date, seq, value)` rows with a double value.

    Corrected mode reads each cell on its own; with `booleans` it also reads
    series of nothing but true and false as 1 and 0, which takes another pass
    over `features`. Legacy mode keeps or drops whole series, see
    `legacy_float_series`, and always drops booleans.
    """
    # Filtering on the text keeps the conversion out of the filter, where it
    # would be computed a second time.
    numeric = features.where(
        ~F.col("feature").isin(*RESERVED_COLUMNS)
        & F.col("date").isNotNull()
        & F.col("value").rlike(NUMERIC_TEXT)
    ).select(*KEY, "date", "seq", numeric_value(F.col("value")).alias("value"))
    if mode is Mode.CORRECTED:
        return numeric.unionByName(_boolean_rows(features)) if booleans else numeric
    return spread_join(
        numeric, _float_series(features), KEY, size="present", how="left_semi"
    )


def _boolean_rows(features: DataFrame) -> DataFrame:
    """Rows of the series whose present cells are all true or false, as 1 or 0."""
    word = F.lower("value")
    is_word = word.isin("true", "false")
    cells = features.where(~F.col("feature").isin(*RESERVED_COLUMNS))
    pure = (
        cells.where(~is_missing(F.col("value")))
        .groupBy(*KEY)
        .agg(F.count("*").alias("present"), F.count_if(is_word).alias("words"))
        .where(F.col("words") == F.col("present"))
        .select(*KEY, "words")
    )
    rows = drop_nulls(
        cells.where(is_word).select(
            *KEY, "date", "seq", (word == "true").cast("double").alias("value")
        )
    )
    return spread_join(rows, pure, KEY, size="words", how="left_semi")


def legacy_float_series(features: DataFrame) -> DataFrame:
    """Series whose column would be read back from CSV as floating point.

    Old data kept only Python floats, and a CSV column becomes float when every
    present cell is a number and either one is not an integer or some row of
    the device lacks the feature. Whole integer columns were lost.
    """
    return _float_series(features).select(*KEY)


def _float_series(features: DataFrame) -> DataFrame:
    """The series of `legacy_float_series` with their number of present cells."""
    value = F.col("value")
    present = ~is_missing(value)
    columns = (
        features.where(~F.col("feature").isin(*RESERVED_COLUMNS))
        .groupBy(*KEY)
        .agg(
            F.count_if(present).alias("present"),
            F.count_if(present & value.rlike(NUMERIC_TEXT)).alias("numeric"),
            F.count_if(present & value.rlike(INTEGER_TEXT)).alias("integer"),
        )
    )
    device_rows = (
        features.where(F.col("pos") == 0).groupBy("sn").agg(F.count("*").alias("rows"))
    )
    return (
        columns.join(device_rows, "sn")
        .where(
            (F.col("present") > 0)
            & (F.col("numeric") == F.col("present"))
            & (
                (F.col("integer") < F.col("present"))
                | (F.col("present") < F.col("rows"))
            )
        )
        .select(*KEY, "present")
    )


def series_list(series: DataFrame) -> DataFrame:
    return series.select(*KEY).distinct()
