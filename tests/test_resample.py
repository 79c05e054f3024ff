from __future__ import annotations

import numpy as np
import pytest
from pyspark.errors import PySparkException

from gaugeloom.operators import resample
from gaugeloom.schema import Mode


def date(second):
    return str(np.datetime64("2020-01-01T00:00:00") + np.timedelta64(int(second), "s")).replace(
        "T", " "
    )


def test_epoch_follows_the_session_zone(spark, series):
    rows = series([12.5], dates=["2020-01-01 00:00:00"])
    assert resample.epoch_seconds(rows).first().time == 1577836800.0
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert resample.epoch_seconds(rows).first().time == 1577808000.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unpadded_and_bad_text(spark, series):
    rows = series([1, 2], dates=["2020-1-1 0:0:5", "2020-01-01 00:00:06"])
    assert [r.time % 60 for r in resample.epoch_seconds(rows).orderBy("time").collect()] == [5, 6]
    with pytest.raises(PySparkException):
        resample.epoch_seconds(series([1], dates=["yesterday"])).collect()


def test_three_points(spark, series):
    rows = series([0, 10], dates=[date(0), date(10)])
    grid = resample.interpolate_series(rows, 3).orderBy("idx").collect()
    assert [r.data for r in grid] == [0, 5, 10]
    with pytest.raises(ValueError):
        resample.interpolate_series(rows, 1)


def test_first_row_per_time_wins(spark, series):
    dates = [date(5), date(0), date(5), date(0)]
    rows = series([1, 2, 3, 4], dates=dates)
    found = resample.dedupe_timestamps(rows).orderBy("time").collect()
    assert [r.data for r in found] == [2, 1]


def test_same_second_in_two_spellings(spark, series):
    rows = series([1, 2], dates=["2020-1-1 00:00:00", "2020-01-01 00:00:00"])
    assert [r.data for r in resample.dedupe_timestamps(rows).collect()] == [2]


def test_series_without_two_times_vanish(spark, series):
    rows = series([1], sn="one").unionByName(series([1, 2], sn="same", dates=[date(0)] * 2))
    assert resample.interpolate_series(rows, 4).count() == 0
    assert resample.linspace_grid(rows, 4).count() == 0


@pytest.mark.parametrize("block", [7, 1000, resample.BLOCK_SECONDS])
@pytest.mark.parametrize("points", [2, 50, 4000])
def test_against_numpy(spark, series, block, points):
    """Gaps, duplicates and many blocks, including empty ones."""
    rng = np.random.default_rng(block + points)
    seconds = np.sort(np.concatenate([rng.integers(0, 300, 200), rng.integers(5000, 6000, 100)]))
    values = rng.normal(size=seconds.size)
    rows = series(values, dates=[date(s) for s in seconds])
    found = resample.interpolate_series(rows, points, block_seconds=block)
    found = found.orderBy("idx").collect()
    times, first = np.unique(seconds, return_index=True)
    grid = np.linspace(times[0], times[-1], points)
    assert [r.idx for r in found] == list(range(points))
    start = 1577836800
    np.testing.assert_allclose([r.time - start for r in found], grid, atol=1e-6)
    np.testing.assert_allclose(
        [r.data for r in found], np.interp(grid, times, values[first]), atol=1e-6
    )
    assert found[-1].time - start == times[-1]


@pytest.mark.parametrize("slices", [None, 5])
def test_legacy_mode_keeps_the_values_in_input_order(spark, series, slices):
    """Against sorted times beside the first values of each time in row order."""
    rng = np.random.default_rng(3)
    seconds = rng.integers(0, 400, 250)
    values = rng.normal(size=seconds.size)
    rows = series(values, dates=[date(s) for s in seconds])
    places = np.sort(np.unique(seconds, return_index=True)[1])
    times, kept = np.unique(seconds), values[places]
    start = 1577836800
    zipped = resample.zip_in_input_order(rows, ("seq",), slices=slices).orderBy("time").collect()
    assert [(r.time - start, r.data) for r in zipped] == list(zip(times, kept))
    found = resample.interpolate_series(rows, 90, mode=Mode.LEGACY, order=("seq",), block_seconds=50)
    np.testing.assert_allclose(
        [r.data for r in found.orderBy("idx").collect()],
        np.interp(np.linspace(times[0], times[-1], 90), times, kept),
        atol=1e-6,
    )


def test_modes_agree_on_rows_sorted_by_time(spark, series):
    rows = series([4, 1, 3, 9], dates=[date(s) for s in (0, 3, 3, 8)])
    grids = [resample.interpolate_series(rows, 5, mode=mode).orderBy("idx").collect() for mode in Mode]
    assert grids[0] == grids[1]


def test_legacy_order_of_date_text(spark, series):
    """The 10th sorts before the 9th as text, so their values change places."""
    rows = series([1, 2], dates=["2020-1-9 0:0:0", "2020-1-10 0:0:0"])
    legacy = resample.interpolate_series(rows, 2, mode=Mode.LEGACY).orderBy("idx").collect()
    assert [r.data for r in legacy] == [2, 1]
