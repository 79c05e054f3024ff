"""Joins of op9 whose sides grow with the addresses never go through the driver."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeloom import scale
from gaugeloom.llm import url_filter


def ran(table):
    rows = table.collect()
    return rows, table._jdf.queryExecution().executedPlan().toString()


def test_gram_scores_are_merged_not_broadcast(spark):
    examples = spark.createDataFrame(
        [("http://a.org/x", 1, 0), ("http://b.net/y", 0, 1)], "text string, allow long, block long"
    )
    counts = scale.stage(url_filter.model_counts(examples), "grams")
    full = examples.select(F.explode(url_filter.grams_of(F.col("text"))).alias("full")).distinct()
    rows, plan = ran(url_filter.gram_scores(full, counts))
    assert len(rows) == full.count()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_addresses_and_scores_are_merged(spark, monkeypatch):
    staged, plans = scale.stage, {}

    def seen(df, label):
        table = staged(df, label)
        plans[label] = df._jdf.queryExecution().sparkPlan().toString()
        return table

    monkeypatch.setattr(url_filter, "stage", seen)
    pages = spark.createDataFrame(
        [(i, f"http://{name}/{i}") for i, name in enumerate(("a.org/fr", "b.net", "c.com", "d.net") * 10)], "page_id long, url string"
    )
    rows = url_filter.judge(pages).collect()
    assert len(rows) == 40 and {r.verdict for r in rows if r.rule} == {"allow", "block"}
    assert "SortMergeJoin" in plans["scores"] and "BroadcastHashJoin" not in plans["scores"]


def test_facts_measured_as_large_are_not_broadcast(spark):
    facts = spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("size"), F.col("id").alias("fact"))
    rows = spark.range(100).select((F.col("id") % 50).cast("string").alias("k"), "id")
    found, plan = ran(scale.spread_join(rows, facts, ["k"], size="size", broadcast_bytes=0))
    assert len(found) == 100 and all(int(r.k) == r.fact for r in found)
    # The list of hot keys is broadcast, the facts are merged.
    assert "SortMergeJoin" in plan
