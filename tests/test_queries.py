from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from gaugeloom.plans import queries
from gaugeloom.schema import GRID_POINTS, Mode, PipelineOptions
from tools.check_queries import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"

# tools/check_queries.py runs all of them.
CHECKED = (
    "series_profile",
    "read_pages",
    "merge_and_sort",
    "split_numeric_legacy",
    "outlier_bounds",
    "interpolate_lineitem",
    "histogram",
    "classify_every_series",
    "unit_root_one_lag",
    "autoregression_bics",
    "lowest_bic",
    "cell_diff",
    "compare_tables",
    "compare_folders",
    "merge_and_sort_all",
    "missing_keys",
    "stage_counts",
)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", CHECKED)
def test_against_sql(spark, name):
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = entry.queries()[name](spark, FOLDER)
    result = database.execute(entry.oracle_sql()[name])
    columns = [item[0] for item in result.description]
    assert sorted(columns) == sorted(df.columns)
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    assert got == rows_of(columns, result.fetchall())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_queries_use_the_whole_grid(spark):
    per_series = queries.linspace_grid(spark, FOLDER).groupBy("sn", "feature").count()
    assert {row["count"] for row in per_series.collect()} == {GRID_POINTS}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_queries_try_every_order(spark):
    bounds = PipelineOptions(mode=Mode.CORRECTED)
    per_series = queries.candidate_orders(spark, FOLDER).groupBy("sn", "feature").count()
    assert {row["count"] for row in per_series.collect()} == {(bounds.p_max + 1) * (bounds.q_max + 1)}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_every_feature_is_merged(spark):
    rows = queries._features(spark, FOLDER).select("sn", "date", "seq", "feature", "value").collect()
    names = sorted({row["feature"] for row in rows})
    assert "label" in names
    want, position = [], {}
    for row in sorted(rows, key=lambda r: (r["sn"], r["date"], names.index(r["feature"]), r["seq"])):
        position[row["sn"]] = position.get(row["sn"], 0) + 1
        want.append((row["sn"], row["date"], position[row["sn"]], row["feature"], row["value"]))
    merged = queries.merge_and_sort_all(spark, FOLDER)
    assert merged.columns == ["sn", "date", "position", "feature", "value"]
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(want, key=str)
