from __future__ import annotations

from gaugeloom.functions.text import valid_series_name
from gaugeloom.operators import readings, series
from gaugeloom.schema import READING_SCHEMA, Mode

import pytest
from pyspark.sql import functions as F


def table(spark, rows):
    return spark.createDataFrame(
        [(sn, date, data, 1, 2, seq) for sn, date, data, seq in rows], READING_SCHEMA
    )


def test_group_by_device_keeps_page_order(spark):
    first = table(spark, [("pump", "m4", "{}", 1), (None, "m5", "{}", 2), ("fan", "m6", "{}", 3)])
    second = table(spark, [("pump", "m7", "{}", 4), ("fan", "m6", "{}", 5)])
    grouped = readings.group_by_device([first, second])
    assert [r.sn for r in readings.distinct_devices(grouped).collect()] == ["fan", "pump"]
    rows = grouped.where("sn = 'pump'").orderBy("seq").collect()
    assert [r.date for r in rows] == ["m4", "m7"]


def test_feature_order_and_pivot(spark):
    rows = table(
        spark,
        [
            ("d", "t1", '{"temperature":"1"}', 1),
            ("d", "t2", '{"pressure":"2","temperature":"3"}', 2),
            ("d", "t3", "junk", 3),
        ],
    )
    features = readings.parse_feature_rows(rows, Mode.LEGACY)
    order = readings.feature_order(features).orderBy("feature_position").collect()
    assert [r.feature for r in order] == ["temperature", "pressure"]
    wide = readings.pivot_features(features, ["temperature", "pressure"])
    assert [(r.temperature, r.pressure) for r in wide.orderBy("seq").collect()] == [
        ("1", None),
        ("3", "2"),
    ]


@pytest.mark.parametrize("slices", [None, 3])
def test_merge_and_sort_is_stable(spark, slices):
    names = "sn string, date string, seq bigint, marker string"
    first = spark.createDataFrame(
        [("d", "2023-05-09", 1, "z"), ("d", "2023-05-07", 2, "x"), ("d", "2023-05-08", 3, "w")], names
    )
    second = spark.createDataFrame([("d", "2023-05-07", 4, "y"), ("d", "2023-05-06", 5, "v")], names)
    merged = readings.merge_and_sort([first, second], slices=slices)
    assert [r.marker for r in merged.orderBy("position").collect()] == [
        "v",
        "x",
        "y",
        "w",
        "z",
    ]


def features_of(spark, columns):
    """Feature rows of one device; None leaves the feature out of a reading."""
    rows = []
    for seq, cells in enumerate(zip(*columns.values())):
        present = [(n, c) for n, c in zip(columns, cells) if c is not None]
        rows += [("d", f"t{seq}", seq, pos, n, c) for pos, (n, c) in enumerate(present)]
    return spark.createDataFrame(
        rows, "sn string, date string, seq bigint, pos int, feature string, value string"
    )


def test_legacy_keeps_float_columns_only(spark):
    features = features_of(
        spark,
        {
            "floats": ["1.5", "2", "3"],
            "integers": ["1", "2", "3"],
            "gap": ["1", None, "3"],
            "missing_word": ["1", "NA", "3"],
            "mixed": ["1.5", "x", "2"],
            "booleans": ["True", "False", "True"],
            "blank": ["", "1", "2"],
            "date": ["1.5", "1.5", "2"],
        },
    )
    kept = series.split_numeric_series(features, Mode.LEGACY)
    found = {}
    for row in kept.orderBy("seq").collect():
        found.setdefault(row.feature, []).append(row.value)
    assert found == {
        "floats": [1.5, 2.0, 3.0],
        "gap": [1.0, 3.0],
        "missing_word": [1.0, 3.0],
        "blank": [1.0, 2.0],
    }


def test_corrected_reads_each_cell(spark):
    features = features_of(
        spark, {"t": ["1.5", " 2.5 ", "x", "nan", "1d", "inf", "1e3", "", "NA"], "sn": ["1"] * 9}
    )
    kept = series.split_numeric_series(features, Mode.CORRECTED)
    assert [r.value for r in kept.orderBy("seq").collect()] == [1.5, 2.5, float("inf"), 1000.0]


def test_boolean_columns(spark):
    features = features_of(
        spark,
        {
            "pure": ["True", "false", "TRUE"],
            "gap": ["True", None, "False"],
            "missing": ["True", "NA", "False"],
            "number": ["True", "1.5", "False"],
            "text": ["True", "x", "False"],
        },
    )

    def found(**options):
        rows = series.split_numeric_series(features, Mode.CORRECTED, **options)
        result = {}
        for row in rows.orderBy("seq").collect():
            result.setdefault(row.feature, []).append(row.value)
        return result

    assert found() == {"number": [1.5]}
    assert found(booleans=True) == {
        "pure": [1, 0, 1],
        "gap": [1, 0],
        "missing": [1, 0],
        "number": [1.5],
    }


@pytest.mark.parametrize(
    "name, valid",
    [
        ("device-a", True),
        ("../escape", False),
        ("", False),
        (".", False),
        ("..", False),
        ("x" * 128, True),
        ("x" * 129, False),
        ("dot.", False),
        ("space ", False),
        ("a:b", False),
        ("a\\b", False),
        ("tab\tx", False),
        ("CON", False),
        ("com9", False),
        ("com10", True),
    ],
)
def test_series_names(spark, name, valid):
    row = spark.createDataFrame([(name,)], "name string")
    assert row.select(valid_series_name(F.col("name"))).first()[0] is valid


def test_reserved_names_are_no_features(spark):
    rows = table(spark, [("d", "t1", '{"sn":"x","date":"y","t":"1.5"}', 1)])
    features = readings.parse_feature_rows(rows, Mode.LEGACY)
    kept = series.split_numeric_series(features, Mode.CORRECTED).collect()
    assert [(r.sn, r.feature, r.date) for r in kept] == [("d", "t", "t1")]
    assert [r.feature for r in readings.feature_order(features).collect()] == ["t"]
