from __future__ import annotations

import csv

import pytest
from pyspark.sql import functions as F

from gaugeloom.scale import number_rows, spread_join
from gaugeloom.schema import Mode
from gaugeloom.sources import pages, paging, sinks, table


@pytest.fixture
def five(spark):
    return spark.createDataFrame([(i, f"r{i}") for i in range(1, 6)], "id int, name string")


def test_legacy_offset_skips_the_first_batch(spark, five):
    rows = paging.offset_pages(five, ["id"], 2).orderBy("id").collect()
    assert [(r.page_no, r.id) for r in rows] == [(1, 3), (1, 4), (2, 5)]
    summary = paging.page_summary(five, Mode.LEGACY, 2).first()
    assert (summary.page_count, summary.row_count) == (2, 3)


@pytest.mark.parametrize("rows, batch, legacy, corrected", [(4, 2, 2, 3), (1, 2, 1, 1), (0, 2, 1, 1), (2, 2, 1, 2)])
def test_an_exact_multiple_ends_with_an_empty_page(spark, rows, batch, legacy, corrected):
    data = spark.range(rows)
    assert paging.page_summary(data, Mode.LEGACY, batch).first().page_count == legacy
    assert paging.page_summary(data, Mode.CORRECTED, batch).first().page_count == corrected


def test_keyset_pages(spark, five):
    assert [r.id for r in paging.keyset_page(five, ["id"], (), 2).collect()] == [1, 2]
    assert [r.id for r in paging.keyset_page(five, ["id"], (2,), 2).collect()] == [3, 4]
    numbered = paging.keyset_pages(five, ["id"], 2)
    assert [r.page_no for r in numbered.orderBy("id").collect()] == [1, 1, 2, 2, 3]
    last = paging.last_key(numbered, ["id", "name"]).orderBy("page_no").collect()
    assert [(r.id, r.name) for r in last] == [(2, "r2"), (4, "r4"), (5, "r5")]
    with pytest.raises(ValueError):
        paging.keyset_page(five, ["id"], (1, 2), 2)
    with pytest.raises(ValueError):
        paging.keyset_page(five, [], (), 2)


def test_composite_keyset_compares_rows(spark):
    data = spark.createDataFrame(
        [("device-a", "2020-01-01"), ("device-a", "2020-01-02"), ("device-b", "2019-01-01")],
        "sn string, date string",
    )
    rows = paging.keyset_page(data, ["sn", "date"], ("device-a", "2020-01-01"), 500).collect()
    assert [(r.sn, r.date) for r in rows] == [
        ("device-a", "2020-01-02"),
        ("device-b", "2019-01-01"),
    ]


@pytest.mark.parametrize("slices", [1, 9])
def test_numbering_over_slices(spark, slices):
    """Nine rows of ten share one group, so its slices must be put together."""
    data = spark.range(3000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("k"),
        "id",
    )
    rows = number_rows(data, ["k", "id"], within=["g"], slices=slices).collect()
    groups = {}
    for row in rows:
        groups.setdefault(row.g, []).append((row.k, row.id, row.row_number))
    for members in groups.values():
        members.sort()
        assert [n for _, _, n in members] == list(range(1, len(members) + 1))
    whole = number_rows(data, ["k", "id"], slices=slices).collect()
    assert [r.row_number for r in sorted(whole, key=lambda r: (r.k, r.id))] == list(
        range(1, 3001)
    )


def test_spread_join_keeps_every_row(spark):
    rows = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    facts = spark.createDataFrame(
        [("hot", 5, 1000), ("cold", 6, 0), ("none", 7, None)], "k string, fact int, n long"
    )
    for task_rows, limit in ((10, 0), (1 << 22, 0), (1 << 22, 1 << 20)):
        how = {"size": "n", "task_rows": task_rows, "broadcast_bytes": limit}
        joined = spread_join(rows, facts, ["k"], **how)
        assert joined.columns == ["k", "id", "fact"]
        assert joined.count() == 1000 and joined.select("fact").distinct().count() == 1
        kept = spread_join(rows, facts.select("k", "n"), ["k"], how="left_semi", **how)
        assert kept.columns == ["k", "id"] and kept.count() == 1000


def test_spread_join_copies_the_facts_of_hot_keys_only(spark):
    """A key with a third of the rows is cut; cold facts stay one row each."""
    # So few rows would share one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    facts = rows.groupBy("k").agg(F.count("*").alias("n"))
    tags = facts.withColumn("tag", F.spark_partition_id())
    joined = spread_join(rows, tags, ["k"], size="n", task_rows=100, broadcast_bytes=0)
    copied = joined._jdf.queryExecution().optimizedPlan().toString()
    tasks = joined.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct()
    spread = tasks.count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert "_cut" in copied and joined.count() == 3000 and spread > 1
    small = spread_join(rows, tags, ["k"], size="n")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in small and "hashpartitioning" not in small


def write_page(path, number, rows):
    with open(path / f"SqlData{number}.csv", "w", newline="", encoding="utf-8") as handle:
        out = csv.writer(handle)
        out.writerow(["", "id", "sn", "date", "data", "slave_id", "type_id"])
        for index, row in enumerate(rows):
            out.writerow([index, *row])


def test_page_files_are_read_in_number_order(spark, tmp_path):
    payload = '{"label": "zone: east, \\"x\\"", "t": 1}'
    for number in range(1, 12):
        write_page(tmp_path, number, [(7, f"d{number}", "t1", payload, 1, 2), (8, "e", "t2", "{}", 3, 4)])
    rows = pages.read_pages(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r.page_no for r in rows] == [n for n in range(1, 12) for _ in range(2)]
    assert [r.sn for r in rows[:4]] == ["d1", "e", "d2", "e"]
    assert rows[0].data == payload and rows[0].slave_id == 1


def test_page_numbering_is_checked(spark, tmp_path):
    with pytest.raises(Exception):
        pages.read_pages(spark, str(tmp_path / "none"))
    write_page(tmp_path, 1, [])
    write_page(tmp_path, 3, [])
    with pytest.raises(ValueError, match="contiguous"):
        pages.read_pages(spark, str(tmp_path))
    write_page(tmp_path, 2, [])
    (tmp_path / "notes.txt").write_text("x")
    with pytest.raises(ValueError, match="unexpected"):
        pages.read_pages(spark, str(tmp_path))


def test_outputs_are_written_once(spark, five, tmp_path):
    sinks.write_once(five, str(tmp_path / "out"))
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_once(five, str(tmp_path / "out"))


def test_series_are_kept_together(spark, series, tmp_path):
    rows = series(range(50), sn="a").unionByName(series(range(5), sn="b"))
    sinks.write_series(rows, str(tmp_path / "out"), buckets=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 55
    assert back.groupBy("sn").agg(F.count_distinct("bucket").alias("n")).where("n > 1").count() == 0
    with pytest.raises(Exception, match="unsafe"):
        sinks.write_series(series([1], sn="../x"), str(tmp_path / "bad"))


def test_jdbc_options_are_read_only():
    options = table.jdbc_options("jdbc:postgresql://h/db", "u", "p", key="id", lower=0, upper=9, partitions=4)
    assert options["dbtable"] == '"public"."dashboard_dtudata"'
    assert "READ ONLY" in options["sessionInitStatement"]
    assert "statement_timeout = 300000" in options["sessionInitStatement"]
    assert options["numPartitions"] == "4" and options["partitionColumn"] == '"id"'
    for bad in ({"table": 'x"; drop'}, {"key": "id"}, {"partitions": 0}, {"statement_timeout_seconds": 0}):
        with pytest.raises(ValueError):
            table.jdbc_options("u", "u", "p", **bad)


def test_only_files_of_the_named_series_are_opened(spark, series, tmp_path):
    rows = series(range(50), sn="a +b")
    for name in "cdefgh":
        rows = rows.unionByName(series(range(50), sn=name))
    path = str(tmp_path / "out")
    sinks.write_series(rows, path, buckets=6)
    index = sinks.index_series(spark, path)
    assert index.agg(F.sum("rows")).first()[0] == 350
    found = sinks.read_series(spark, path, [("a +b", "f"), ("a +b", "g"), ("x", "f")])
    assert {(r.sn, r.value) for r in found.collect()} == {("a +b", float(i)) for i in range(50)}
    assert 0 < len(found.inputFiles()) < len(spark.read.parquet(path).inputFiles())
    assert sinks.read_series(spark, path, []).count() == 0
    assert sinks.read_series(spark, path, [("x", "f")]).count() == 0
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.index_series(spark, path)


def test_a_path_with_odd_characters_is_indexed(spark, series, tmp_path):
    path = str(tmp_path / "odd +%20 dir")
    sinks.write_series(series([1, 2]), path)
    sinks.index_series(spark, path)
    assert sinks.read_series(spark, path, [("d", "f")]).count() == 2
