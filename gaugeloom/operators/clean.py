"""Outlier removal by the index-rule quartiles and a hard upper limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.scale import by_range, spread_join, stage, staged
from gaugeloom.schema import HARD_UPPER_LIMIT, KEY


def _value_slices(series: DataFrame, slices: int | None) -> DataFrame:
    """Distinct values with their counts, cut into value-ordered slices.

    Counting first collapses a value that fills a third of the table, and the
    range partitioning then cuts a large series into as many slices as its size
    asks for. The result is to be staged, which makes the slice number part of the data.
    """
    counted = (
        series.where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*KEY, "value")
        .agg(F.count("*").alias("copies"))
    )
    return by_range(counted, (*KEY, "value"), slices).withColumn(
        "slice", F.spark_partition_id()
    )


def _quantiles(values: DataFrame, numerators: Sequence[int]) -> DataFrame:
    per_slice = values.groupBy(*KEY, "slice").agg(F.sum("copies").alias("size"))
    whole = Window.partitionBy(*KEY)
    earlier = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_slice.select(
        *KEY,
        "slice",
        "size",
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"),
        F.sum("size").over(whole).alias("n"),
    )

    def rank(numerator: int, rounding) -> Column:
        position = rounding(F.col("n") * F.lit(numerator / 4.0)).cast("long")
        return F.least(position, F.col("n") - 1)

    # 0-based ranks of the two order statistics behind each quantile.
    ranks = {
        f"rank_{numerator}_{side}": rank(numerator, rounding)
        for numerator in numerators
        for side, rounding in (("low", F.floor), ("high", F.ceil))
    }
    # Only the slices that hold a wanted rank are read again: a few per series.
    holds_a_rank = F.greatest(
        *(
            (F.col(name) >= F.col("before"))
            & (F.col(name) < F.col("before") + F.col("size"))
            for name in ranks
        )
    )
    wanted = placed.withColumns(ranks).where(holds_a_rank).drop("size")

    in_slice = Window.partitionBy(*KEY, "slice").orderBy("value")
    ranked = values.join(wanted, [*KEY, "slice"]).withColumn(
        "upto", F.col("before") + F.sum("copies").over(in_slice)
    )
    at_rank = [
        F.max(
            F.when(
                (F.col(name) < F.col("upto"))
                & (F.col(name) >= F.col("upto") - F.col("copies")),
                F.col("value"),
            )
        ).alias(name)
        for name in ranks
    ]
    statistics = ranked.groupBy(*KEY).agg(F.max("n").alias("n"), *at_rank)
    return statistics.select(
        *KEY,
        "n",
        *(
            (
                (F.col(f"rank_{numerator}_low") + F.col(f"rank_{numerator}_high")) / 2
            ).alias(f"q{25 * numerator}")
            for numerator in numerators
        ),
    )


def legacy_quantiles(
    series: DataFrame,
    numerators: Sequence[int] = (1, 2, 3),
    *,
    slices: int | None = None,
) -> DataFrame:
    """Mean of the values at 0-based ranks floor(n*m/4) and ceil(n*m/4).

    Neither `percentile` (which interpolates) nor a sketch gives this rule.
    """
    return _quantiles(stage(_value_slices(series, slices), "values"), numerators)


def _with_bounds(quartiles: DataFrame) -> DataFrame:
    iqr = F.col("q75") - F.col("q25")
    return quartiles.withColumns(
        {
            "iqr": iqr,
            "lower": F.col("q25") - 1.5 * iqr,
            "upper": F.col("q75") + 1.5 * iqr,
        }
    )


def _inside(hard_upper_limit: float) -> Column:
    value = F.col("value")
    return (
        (value >= F.col("lower"))
        & (value <= F.col("upper"))
        & (value <= hard_upper_limit)
    )


def outlier_bounds(
    series: DataFrame,
    *,
    hard_upper_limit: float = HARD_UPPER_LIMIT,
    slices: int | None = None,
) -> DataFrame:
    """Quartiles, bounds and number of dropped rows per series."""
    values = stage(_value_slices(series, slices), "values")
    bounds = _with_bounds(_quantiles(values, (1, 3)))
    dropped = (
        spread_join(values, bounds.select(*KEY, "n", "lower", "upper"), KEY, size="n")
        .where(~_inside(hard_upper_limit))
        .groupBy(*KEY)
        .agg(F.sum("copies").alias("n_dropped"))
    )
    return bounds.join(dropped, list(KEY), "left").na.fill(0, ["n_dropped"])


def remove_outliers(
    series: DataFrame,
    *,
    hard_upper_limit: float = HARD_UPPER_LIMIT,
    slices: int | None = None,
) -> DataFrame:
    """Rows within 1.5 IQR of the quartiles and not above the hard limit.

    `series` is read twice (bounds, then filter): stage or persist it when it
    is expensive to derive.
    """
    with staged(_value_slices(series, slices), "values") as values:
        bounds = _with_bounds(_quantiles(values, (1, 3)))
        # Stages the bounds, after which the values are not read again.
        bounded = spread_join(series, bounds.select(*KEY, "n", "lower", "upper"), KEY, size="n")
    return bounded.where(_inside(hard_upper_limit)).select(*series.columns)
