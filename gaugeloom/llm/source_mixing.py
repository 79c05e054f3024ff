"""Mixing sources to target weights by systematic sampling.

A document's size is its number of words. Each source has a target in words; a
document of it is expected target / source_size times in the mix. The documents
of a source are put in order of size, their expected copies are summed up from
one random offset, and a document is taken once for every whole number its sum
passes. So the copies of any stretch of neighbours differ from their expectation
by less than one, and neighbours have like sizes: the words taken come near the
target. At most `most` copies of a document are taken.

Positions come from range-partitioned slices, so a source with a third of all
rows is spread over many tasks. Only DataFrame functions are used.

Null and empty texts have size 0; they take part in the order and add nothing.
A null source is a source of its own, the last one. Rows that repeat an id and a
text are separate documents next to each other in the order. In the mix the rows of
a source that repeat both share the copies drawn for them: of c copies each of k rows
gets floor(c / k), and the first c mod k by content get one more. An empty
table gives an empty mix. Reruns give the same result: the offset is a hash of
the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.tables import WORD_PATTERN, text_of, with_keys
from gaugeloom.scale import number_rows, stage

WEIGHTS = (5, 2, 1)
MOST = 3
SOURCE = ("_null", "_source")


def source_key(source: str = "source") -> tuple[Column, Column]:
    return (
        F.col(source).isNull().cast("int").alias("_null"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
    )


def size_of(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD_PATTERN)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(_null, _source, source_size, target) from rows of (_null, _source, size).

    Sources in order of code points, null last, have the weights in turn. They
    share the sum of all sizes; a target above `most` times its source is cut to
    that, and what it leaves is shared again by weight until none is above.
    """
    sources = number_rows(
        sizes.groupBy("_null", "_source").agg(F.sum("size").alias("source_size")),
        ["_null", "_source"],
        name="_rank",
    )
    turn = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int") + 1)
    sources = stage(
        sources.select("_null", "_source", "source_size", turn.cast("long").alias("_weight")), "source-weights"
    )
    cap = F.col("source_size") * most
    total, weight = sources.agg(F.sum("source_size"), F.sum("_weight")).first()
    # Each round caps at least one more weight level; a round gathers two sums.
    capped = (0, 0)
    while True:
        left, over = (total or 0) - capped[0], (weight or 0) - capped[1]
        above = sources.filter(F.lit(float(left)) * F.col("_weight") > cap * F.lit(float(over)))
        size, held = above.agg(F.sum(cap), F.sum("_weight")).first()
        if over <= 0 or (size or 0, held or 0) == capped:
            break
        capped = (size or 0, held or 0)
    share = F.lit(float(left)) * F.col("_weight") / F.lit(float(max(over, 1)))
    return sources.select("_null", "_source", "source_size", F.least(share, cap.cast("double")).alias("target"))


def source_offset(null: str = "_null", source: str = "_source") -> Column:
    """A number in [0, 1) drawn from the source."""
    digest = F.md5(F.concat(F.col(null).cast("string"), F.lit(":"), F.col(source)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def copies(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, _doc, _tid, size, source_size, target, copies), a row per document."""
    sizes = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("_doc"),
        F.xxhash64(text_of()).alias("_tid"),
        *source_key(),
        size_of().alias("size"),
    )
    # The range partitioning below reads its input twice, so words are counted first.
    sizes = stage(sizes, "sizes")
    placed = stage(number_rows(sizes, ["size", "_doc", "_tid"], within=["_null", "_source"], name="_rank"), "placed")
    targets = source_targets(placed, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    passed = F.floor(rate * F.col("_rank") + source_offset()) - F.floor(rate * (F.col("_rank") - 1) + source_offset())
    return placed.join(targets, ["_null", "_source"]).select(
        "doc_id", "_doc", "_tid", *SOURCE, "size", "source_size", "target", passed.cast("int").alias("copies")
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) per document."""
    return copies(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of the mix: each document as often as it is taken.

    Exactly the drawn copies come out; repeated rows are numbered to share them.
    """
    key = ["_doc", "_tid", *SOURCE]
    taken = (
        copies(docs, weights, most)
        .groupBy(*key)
        .agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
        .filter("_copies > 0")
    )
    rows = with_keys(docs)
    null, source = source_key("_row.source")
    joined = stage(rows.select("*", null, source).join(taken, key), "taken")
    # The last column parts equal rows, so that a large group is cut into slices.
    repeated = number_rows(
        joined.filter("_rows > 1").withColumn("_content", F.xxhash64(F.col("_row").cast("string"))).withColumn(
            "_part", F.monotonically_increasing_id()
        ),
        ["_content", "_part"],
        within=key,
        name="_turn",
    )
    more = (F.col("_turn") <= F.col("_copies") % F.col("_rows")).cast("long")
    shared = repeated.select("_row", (F.floor(F.col("_copies") / F.col("_rows")) + more).alias("_copies"))
    spread = joined.filter("_rows = 1").select("_row", "_copies").unionByName(shared)
    return spread.filter("_copies > 0").select(
        F.explode(F.array_repeat("_row", F.col("_copies").cast("int"))).alias("_row")
    ).select("_row.*")
