"""Grids as lines: what moves between tasks is as long as the rows, not as the grid."""

from __future__ import annotations

import time
import uuid

import numpy as np
import pytest
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from gaugeloom import scale
from gaugeloom.operators import arima, clean, diagnose, lags, profile, resample
from gaugeloom.plans import queries, stages
from gaugeloom.sources import sinks


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Events of three devices, some at equal times, one device with a single event."""
    rng = np.random.default_rng(12)
    rows = [
        (i, f"2024-01-01 00:{second // 60:02d}:{second % 60:02d}", int(user), kind, float(value), '{"k": %d}' % (i % 7))
        for i, (second, user, kind, value) in enumerate(
            zip(rng.integers(0, 900, 90), rng.integers(1, 4, 90), ["view", "click", "error"] * 30, rng.normal(20, 5, 90).round(2))
        )
    ]
    rows.append((90, "2024-01-01 00:00:01", 9, "view", 5.0, '{"k": 1}'))
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(
        rows, "event_id long, ts string, user_id long, event_type string, value double, props string"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(str(path / "events.parquet"))
    return str(path)


def above_points(table):
    """What a plan does with the points of a grid."""
    plan = table._jdf.queryExecution().sparkPlan().toString()
    return plan[: plan.index("Generate explode(sequence(low#")]


def noisy(series, **options):
    """Two series over many blocks, some without rows or points, as lines and points."""
    rng = np.random.default_rng(4)
    rows = None
    for sn, span in (("a", 60), ("b", 3000)):
        seconds = np.concatenate([rng.integers(0, span, 80), [span * 2, span * 2 + 1, span * 3]])
        dates = [str(np.datetime64("2020-01-01T00:00:00") + np.timedelta64(int(s), "s")).replace("T", " ") for s in seconds]
        part = series(rng.normal(size=seconds.size), sn=sn, dates=dates)
        rows = part if rows is None else rows.unionByName(part)
    return rows


@pytest.mark.parametrize("block", [7, 100, resample.BLOCK_SECONDS])
@pytest.mark.parametrize("points", [2, 50, 900])
def test_points_know_the_one_before(series, block, points):
    grid = resample.interpolate_series(noisy(series), points, block_seconds=block, previous=True)
    before = F.lag("data").over(Window.partitionBy("sn", "feature").orderBy("idx"))
    rows = grid.withColumn("lagged", before).collect()
    assert len(rows) == 2 * points
    assert all(r.previous == r.lagged for r in rows)
    assert sum(r.previous is None for r in rows) == 2


def test_operators_agree_with_and_without_the_previous_value(series):
    rows = noisy(series)
    with_it, without = (resample.interpolate_series(rows, 70, block_seconds=20, previous=p) for p in (True, False))
    assert "previous" not in without.columns
    for operator in (diagnose.difference, diagnose.dickey_fuller, arima.closed_form_bics):
        a, b = (
            sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in operator(grid).collect())
            for grid in (with_it, without)
        )
        assert a == b


@pytest.mark.parametrize("name", ["arima_bic_walk", "dickey_fuller", "difference"])
def test_queries_window_no_points(spark, folder, name):
    above = above_points(queries.QUERIES[name](spark, folder))
    assert "Window" not in above and "Sort" not in above and "Join" not in above


@pytest.mark.parametrize("block_rows", [60, 1 << 16])
def test_sums_of_lines_are_those_of_their_points(series, block_rows):
    lines = resample.grid_lines(noisy(series), 400, block_seconds=100)
    grid = lags.of_grid(resample.grid_points(lines, 400))
    options = {"differences": 2, "step_lags": 9, "value_lags": 20, "block_rows": block_rows}
    want, got = (
        {(r.sn, r.d): r for r in lags.lag_sums(rows, **options).collect()} for rows in (grid, lags.of_lines(lines, 400))
    )
    assert len(want) == 6 and want.keys() == got.keys()
    for key, row in want.items():
        assert (row.n, row.flat, row["size"]) == (got[key].n, got[key].flat, got[key]["size"])
        for name in ("total", "square", "steps", "level", "products", "head", "tail"):
            np.testing.assert_allclose(got[key][name], row[name], rtol=1e-9, atol=1e-9)


def test_lines_with_a_gap_fail(spark, series):
    lines = resample.grid_lines(noisy(series), 400)
    with pytest.raises(Exception, match="without gaps"):
        lags.lag_sums(lags.of_lines(lines.where("low = 0 or high > 200"), 400), step_lags=2).collect()


def staged_rows(monkeypatch, module):
    """Counts what `module` stages from now on."""
    counts, stage = [], module.stage

    def counted(df, label):
        table = stage(df, label)
        counts.append(table.count())
        return table

    monkeypatch.setattr(module, "stage", counted)
    return counts


def test_autoregression_shuffles_no_points(spark, folder):
    plan = queries.QUERIES["autoregression_bics"](spark, folder)._jdf.queryExecution().sparkPlan().toString()
    assert "FlatMapGroupsInPandas" in plan and "explode(sequence(low#" not in plan


@pytest.mark.parametrize("name", ["candidate_orders", "difference_order", "histogram", "is_stationary", "order_by_regression"])
def test_queries_stage_no_points(spark, folder, monkeypatch, name):
    counts = staged_rows(monkeypatch, queries)
    assert queries.QUERIES[name](spark, folder).select("sn", "feature").distinct().count() == 6
    # At most a row for each event and feature.
    assert counts and max(counts) <= 2 * 91


def test_linspace_query_keeps_its_tasks(spark, folder):
    plan = queries.QUERIES["linspace_grid"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("HashAggregate")]
    assert "REPARTITION_BY_NUM" in above


def test_linspace_is_dealt_to_all_tasks(spark, series):
    """One small row per series: merged by their size, a single task made all times."""
    rows = series([1, 2], sn="0", dates=["2020-01-01 00:00:00", "2020-01-02 00:00:00"])
    many = rows.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40)))).withColumn("sn", F.col("n").cast("string"))
    tasks = resample.linspace_grid(many, 5).select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("broadcast", [True, False])
def test_histogram_of_lines_is_that_of_their_points(series, monkeypatch, broadcast):
    if not broadcast:
        joined = profile.spread_join
        monkeypatch.setattr(profile, "spread_join", lambda *a, **b: joined(*a, **b, broadcast_bytes=0, task_rows=100))
    lines = resample.grid_lines(noisy(series), 300)
    want = profile.histogram(resample.grid_points(lines, 300), 16).collect()
    got = profile.histogram(lines, 16, points=lambda rows, *keep: resample.grid_points(rows, 300, *keep)).collect()
    assert sorted(got) == sorted(want) and sum(r["count"] for r in got) == 600


def test_stage_outputs_stage_no_points(spark, folder, monkeypatch):
    counts = staged_rows(monkeypatch, stages)
    assert queries.QUERIES["stage_outputs"](spark, folder).count() == 6
    # The feature rows: three entries for each event.
    assert counts and max(counts) <= 3 * 91


def test_lines_are_written_as_points(spark, series, tmp_path):
    lines = resample.grid_lines(noisy(series), 300)
    counted = Observation()
    sinks.write_series(
        lines, str(tmp_path / "out"), counted=counted, points=lambda rows, *keep: resample.grid_points(rows, 300, *keep)
    )
    written = spark.read.parquet(str(tmp_path / "out"))
    assert counted.get["rows"] == 600
    assert sorted(written.drop("bucket").collect()) == sorted(resample.grid_points(lines, 300).collect())
    # As write_series orders rows: by series and point within a file.
    for file in written.inputFiles():
        keys = [tuple(r) for r in spark.read.parquet(file).select("sn", "feature", "idx").collect()]
        assert keys == sorted(keys)


@pytest.fixture
def shared(monkeypatch, tmp_path):
    """Staged tables go here."""
    monkeypatch.setattr(scale, "new_shared_path", lambda spark, label: str(tmp_path / f"{label}-{uuid.uuid4().hex}"))
    return tmp_path


def test_zip_keeps_no_positions_on_disk(spark, series, shared):
    rows = series([3, 1, 2], dates=["2020-01-01 00:00:09", "2020-01-01 00:00:01", "2020-01-01 00:00:05"])
    found = resample.zip_in_input_order(rows, ("seq",)).orderBy("time").collect()
    assert [r.data for r in found] == [3, 1, 2]
    folders = sorted(shared.iterdir())
    assert [f.name.split("-")[0] for f in folders] == ["numbered", "numbered"]
    columns = {tuple(spark.read.parquet(str(f)).columns) for f in folders}
    assert columns == {("sn", "feature", "time", "_place"), ("sn", "feature", "data", "_place")}


def test_outlier_removal_drops_its_value_counts(series, shared):
    assert clean.remove_outliers(series([1, 2, 3, 4, 5, 6, 7, 8, 900])).count() == 8
    assert [f.name.split("-")[0] for f in shared.iterdir()] == ["facts"]


def test_staging_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size())}

    before = files()
    scale.stage(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "counts")
    until = time.time() + 10
    while (left := {f for f in files() - before if f.startswith("shuffle_")}) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_date_text_is_not_carried_past_the_first_row_of_a_time(series):
    """One window to find neighbours, none to drop other texts of the same second."""
    plan = resample.interpolate_series(noisy(series), 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "lag(" not in plan and plan.count("lead(time#") >= 1
