"""Candidate runs for repeated windows, found without listing every window.

A window is a fixed number of units (bytes or words) of one document. Its anchor
is the smallest-hashed gram inside it, the last one on ties, so equal windows
have equal anchors at equal places. Consecutive windows with the same anchor
form a run. Windows whose anchor does not recur cannot recur, so only runs with
recurring anchors go on, each with the units its windows cover. This loses
nothing: equal windows always meet under their anchor.

Anchors are counted with a map-side combine. Runs of an anchor found more often
than `hot` do not go to one task: each of their windows becomes a row of its
own, named by a 128-bit hash, and rows are counted with a map-side combine too.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.hashing import rightmost_minima
from gaugeloom.llm.tables import slices

# Occurrences of one anchor that a single task resolves together: with the text
# under a run below 1 kB, 16 MB at most.
HOT_ANCHOR = 16_384

ANCHORS = "anchor long, _doc long, _tid long, n long"
REGIONS = "anchor long, _doc long, _tid long, firsts array<long>, n long, body binary, window binary"
SPANS = "_doc long, _tid long, spans array<struct<first:long,last:long>>"
SPAN_LIST = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


@dataclass(frozen=True)
class Runs:
    """Window runs of a slice: row, first unit, windows and anchor hash."""

    row: np.ndarray
    first: np.ndarray
    n: np.ndarray
    anchor: np.ndarray


def window_runs(grams: np.ndarray, gram: int, window: int, offsets: np.ndarray) -> Runs:
    """Runs of all windows that lie within one row; `offsets` counts units."""
    least = rightmost_minima(grams, window - gram + 1)
    lengths = np.diff(offsets)
    counts = np.maximum(lengths - window + 1, 0)
    rows = np.repeat(np.arange(len(lengths)), counts)
    if not len(rows):
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none)
    before = np.concatenate(([0], np.cumsum(counts)[:-1]))
    starts = np.arange(len(rows)) - np.repeat(before, counts) + offsets[:-1][rows]
    places = least[starts]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (places[1:] != places[:-1]) | (rows[1:] != rows[:-1])
    head = np.flatnonzero(fresh)
    sizes = np.diff(np.append(head, len(rows)))
    return Runs(rows[head], starts[head] - offsets[rows[head]], sizes, grams[places[head]].view(np.int64))


def anchor_rows(batches: Iterator[pa.RecordBatch], find) -> Iterator[pa.RecordBatch]:
    """Distinct anchors of each document with their number of runs."""
    for batch in batches:
        docs, tids = batch.column("_doc").to_numpy(), batch.column("_tid").to_numpy()
        for low, _, data, offsets in slices(batch.column("_text")):
            runs = find(data, offsets)[0]
            order = np.lexsort((runs.anchor, runs.row))
            row, anchor = runs.row[order], runs.anchor[order]
            fresh = np.ones(len(row), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
            head = np.flatnonzero(fresh)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor[head]),
                    pa.array(docs[low + row[head]]),
                    pa.array(tids[low + row[head]]),
                    pa.array(np.diff(np.append(head, len(row)))),
                ],
                ["anchor", "_doc", "_tid", "n"],
            )


def region_rows(batches: Iterator[pa.RecordBatch], find) -> Iterator[pa.RecordBatch]:
    """Runs whose anchor is listed for the document, with the units they cover.

    `find` returns the runs and `cut(run, first window, windows)`, the bytes under
    those windows; hot runs give one row per window with its 128-bit name only.
    """
    for batch in batches:
        docs, tids = batch.column("_doc").to_numpy(), batch.column("_tid").to_numpy()
        hits = batch.column("_hits")
        for low, high, data, offsets in slices(batch.column("_text")):
            runs, cut = find(data, offsets)
            listed = hits.slice(low, high - low)
            flat = listed.flatten()
            sizes = listed.value_lengths().fill_null(0).to_numpy()
            row = np.repeat(np.arange(high - low), sizes)
            anchor = flat.field("anchor").to_numpy()
            hot = flat.field("hot").to_numpy(zero_copy_only=False)
            cold_runs = _listed(runs, row[~hot], anchor[~hot])
            hot_runs = _listed(runs, row[hot], anchor[hot])
            # A text that repeats a stretch many times sends it once, with its places.
            found: dict[tuple, list[int]] = defaultdict(list)
            for i in cold_runs:
                n = int(runs.n[i])
                found[int(runs.row[i]), int(runs.anchor[i]), n, cut(i, 0, n), None].append(int(runs.first[i]))
            for i in hot_runs:
                row, anchor_, first = int(runs.row[i]), int(runs.anchor[i]), int(runs.first[i])
                for k in range(int(runs.n[i])):
                    name = blake2b(cut(i, k, 1), digest_size=16).digest()
                    found[row, anchor_, 1, None, name].append(first + k)
            if found:
                rows, anchors, counts, bodies, windows = zip(*found, strict=True)
                places = low + np.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchors, pa.int64()),
                        pa.array(docs[places]),
                        pa.array(tids[places]),
                        pa.array(found.values(), pa.list_(pa.int64())),
                        pa.array(counts, pa.int64()),
                        pa.array(bodies, pa.binary()),
                        pa.array(windows, pa.binary()),
                    ],
                    ["anchor", "_doc", "_tid", "firsts", "n", "body", "window"],
                )


def _listed(runs: Runs, row: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Runs whose (row, anchor) is in the list."""
    if not len(row) or not len(runs.row):
        return np.zeros(0, np.int64)
    pair = np.dtype([("row", np.int64), ("anchor", np.int64)])
    wanted, have = np.empty(len(row), pair), np.empty(len(runs.row), pair)
    wanted["row"], wanted["anchor"] = row, anchor
    have["row"], have["anchor"] = runs.row, runs.anchor
    names, codes = np.unique(np.concatenate([wanted, have]), return_inverse=True)
    known = np.zeros(len(names), bool)
    known[codes[: len(row)]] = True
    return np.flatnonzero(known[codes[len(row) :]])


def regions(docs: DataFrame, find, *, other_document: bool, hot: int = HOT_ANCHOR) -> DataFrame:
    """Rows of REGIONS for all runs whose anchor recurs.

    With `other_document` an anchor must occur in two documents, else twice. Anchors
    are listed per distinct text of an id: rows without an id do not share a list.
    """
    anchors = docs.select("_doc", "_tid", "_text").mapInArrow(lambda batches: anchor_rows(batches, find), ANCHORS)
    counted = anchors.groupBy("anchor").agg(
        F.sum("n").alias("_n"), F.min("_doc").alias("_low"), F.max("_doc").alias("_high")
    )
    recurs = F.col("_low") < F.col("_high") if other_document else F.col("_n") > 1
    recurring = counted.filter(recurs).select("anchor", (F.col("_n") > hot).alias("hot"))
    hits = (
        anchors.select("anchor", "_doc", "_tid")
        .join(recurring, "anchor")
        .groupBy("_doc", "_tid")
        .agg(F.collect_set(F.struct("anchor", "hot")).alias("_hits"))
    )
    return (
        docs.select("_doc", "_tid", "_text")
        .join(hits, ["_doc", "_tid"])
        .mapInArrow(lambda batches: region_rows(batches, find), REGIONS)
    )


def hot_spans(found: DataFrame, reach: int, *, other_document: bool) -> DataFrame:
    """Repeated windows among the single-window rows of hot anchors."""
    single = found.filter(F.col("window").isNotNull())
    facts = single.groupBy("window").agg(F.sum(F.size("firsts")).alias("_n"), F.min("_doc").alias("_low"))
    repeated = F.col("_doc") > F.col("_low") if other_document else F.col("_n") > 1
    spans = F.transform("firsts", lambda first: F.struct(first.alias("first"), (first + reach).alias("last")))
    return (
        single.select("window", "_doc", "_tid", "firsts")
        .join(facts, "window")
        .filter(repeated)
        .select("_doc", "_tid", spans.alias("spans"))
    )


def bucket_groups(batches: Iterator[pa.RecordBatch], size) -> Iterator[list[tuple]]:
    """Whole buckets of rows sorted by anchor, gathered until `size` is reached.

    `size(row)` is a row's weight against a limit of 1. Cold anchors are bounded,
    so a group exceeds the limit by one anchor's rows at most.
    """
    group: list[tuple] = []
    weight, last = 0.0, None
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("anchor", "_doc", "_tid", "firsts", "n", "body")]
        for row in zip(*columns, strict=True):
            if weight >= 1 and row[0] != last:
                yield group
                group, weight = [], 0.0
            last = row[0]
            group.append(row)
            weight += size(row)
    if group:
        yield group


def span_rows(found: dict[tuple[int, int], list[tuple[int, int]]]) -> pa.RecordBatch:
    """Rows of SPANS from the distinct spans of each (document, text)."""
    spans = [[{"first": low, "last": high} for low, high in sorted(set(own))] for own in found.values()]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([doc for doc, _ in found], pa.int64()),
            pa.array([tid for _, tid in found], pa.int64()),
            pa.array(spans, SPAN_LIST),
        ],
        ["_doc", "_tid", "spans"],
    )


def spans_by_document(spans: DataFrame) -> DataFrame:
    """One sorted list of spans per document; its text bounds the length.

    Rows that repeat a document report the same spans, which count once.
    """
    return spans.groupBy("_doc", "_tid").agg(F.sort_array(F.flatten(F.collect_set("spans"))).alias("_spans"))


def runs_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of every stretch of consecutive sorted numbers."""
    cuts = np.flatnonzero(np.diff(starts) != 1)
    return starts[np.concatenate(([0], cuts + 1))], starts[np.concatenate((cuts, [len(starts) - 1]))]
