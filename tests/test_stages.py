from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from gaugeloom.operators import clean, diagnose, resample
from gaugeloom.operators.readings import merge_and_sort
from gaugeloom.plans.stages import STAGE_OUTPUTS, run_pipeline, stage_counts, write_pipeline
from gaugeloom.schema import READING_SCHEMA, Mode, PipelineOptions
from gaugeloom.streaming.pages import stream_feature_rows


def readings(spark, sn="device-a"):
    rows = [
        (
            sn,
            f"2020-01-01 00:{i:02d}:00",
            f"{{u'temperature':u'{20 + math.sin(i):.3f}',u'pressure':u'{i % 3 + 0.5}'}}",
            1,
            2,
            i,
        )
        for i in range(20)
    ]
    return spark.createDataFrame(rows, READING_SCHEMA)


@pytest.mark.parametrize("mode", list(Mode))
def test_every_stage_has_output(spark, tmp_path, mode):
    options = PipelineOptions(mode=mode, points=32, bins=8, p_max=1, q_max=0)
    stages = run_pipeline(readings(spark), options)
    root = str(tmp_path / "out")
    counts = {r.output: (r.rows, r.devices, r.series) for r in stage_counts(stages, root).collect()}
    assert counts == {
        "DataProcess1": (20, 1, None),
        "DataProcess2": (40, 1, 2),
        "DataProcess3": (40, 1, 2),
        "DataProcess4": (40, 1, 2),
        "DataProcess5": (40, 1, 2),
        "DataProcess6": (40, 1, 2),
        "DataProcess7": (2, 1, 2),
        "DataProcess7Kept": (40, 1, 2),
        "DataProcess8": (40, 1, 2),
        "DataProcess9": (64, 1, 2),
        "DataProcess10": (2, 1, 2),
        "DataProcess11": (16, 1, 2),
        "DataProcess12": (2, 1, 2),
        "DataProcess13": (2, 1, 2),
    }
    for output in STAGE_OUTPUTS.values():
        assert spark.read.parquet(f"{root}/{output}").count() == counts[output][0], output
    with pytest.raises(Exception, match="(?i)exists"):
        write_pipeline(stages, root)


def test_counts_of_no_readings(spark):
    options = PipelineOptions(mode=Mode.CORRECTED, points=8, bins=2)
    counts = stage_counts(run_pipeline(readings(spark).limit(0), options)).collect()
    assert len(counts) == len(STAGE_OUTPUTS) and not any(r.rows or r.devices for r in counts)


def test_unsafe_device_name_stops_the_run(spark):
    with pytest.raises(Exception, match="unsafe"):
        run_pipeline(readings(spark, "../escape")).features


@pytest.mark.parametrize(
    "name, bad, output",
    [("points", 1, "grid"), ("bins", 0, "histogram"), ("q_max", True, "orders"), ("max_differences", -1, "orders")],
)
def test_operators_check_the_options(spark, name, bad, output):
    options = PipelineOptions(mode=Mode.CORRECTED, **{"points": 16, name: bad})
    with pytest.raises(ValueError, match=name):
        getattr(run_pipeline(readings(spark, "dev"), options), output)


def test_no_window_holds_a_whole_series(spark, series):
    """Windows that see rows are cut by slice or time block as well."""
    rows = series(range(10))
    tables = {
        "cleaned": clean.remove_outliers(rows),
        "grid": resample.interpolate_series(rows, 32),
        "legacy grid": resample.interpolate_series(rows, 32, mode=Mode.LEGACY),
        "first": resample.dedupe_timestamps(rows),
        "verdicts": diagnose.classify_series(rows),
        "merged": merge_and_sort([rows]),
    }
    per_row = re.compile(r"\b(date|value|seq|time|data|x|copies)#")
    for name, table in tables.items():
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        windows = re.findall(r"windowspecdefinition\(.*?Frame", plan)
        for window in windows:
            cut = any(key in window for key in ("slice#", "block#"))
            assert cut or not per_row.search(window), (name, window)
        functions = re.findall(r"(\w+\([^()]*\)) windowspecdefinition\((.*?)specified", plan)
        for function, window in functions:
            cut = any(key in window for key in ("slice#", "block#"))
            assert cut or not per_row.search(function), (name, function, window)


def test_stream_of_readings(spark, tmp_path):
    readings(spark).write.parquet(str(tmp_path / "in"))
    rows = stream_feature_rows(spark, str(tmp_path / "in"), Mode.CORRECTED)
    query = rows.writeStream.format("memory").queryName("arrived").start()
    try:
        query.processAllAvailable()
        assert spark.table("arrived").agg(F.count("*")).first()[0] == 40
    finally:
        query.stop()
