"""N-gram Jaccard join by chosen paths.

Documents are sets of hashed shingles (five words; a shorter text is one
shingle). Texts with the same set form one class and are compared once. In each
run every set follows paths: at a node a shingle is chosen if its hash with the
node is below 1 / (threshold * size), so two sets at or above the threshold are
expected to choose a common one. Sets with the same path meet in a bucket. A
bucket over `SPLIT` members is split again by the next shingle on the path; what
still is too large, such as thousands of near copies, is compared in pairs of
blocks, so no task gets more than two blocks. The runs are as many as find a pair at
the threshold with the probability `RECALL`, also where it must share both levels.

Buckets first compare sketches (one byte of 64 minima each) by a margin of five
standard deviations; only documents with a partner there send their whole sets
to that bucket, where the similarity is exact. A pair is counted in the first
bucket it has in common, so links need no list of pairs; a bucket reports counts
and a spanning forest, from which components are labelled.

Null, empty and blank texts have no shingle: they link to nothing and are classes
of their own. Rows that repeat a text are copies of one class. A text of any length is
one set of all its shingles. The sketch may hide a pair at the threshold, with the
chance of a deviation beyond five standard ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.hashing import byte_prefix_sums, gram_hashes, mix, prefix_sums, span_hashes
from gaugeloom.llm.tables import keyed, slices, with_keys, word_spans
from gaugeloom.scale import stage

SHINGLE = 5
# The threshold is NUMERATOR / DENOMINATOR, so that similarities compare exactly.
NUMERATOR, DENOMINATOR = 4, 5
# Part of the pairs at the threshold that the runs find together, and the levels of
# paths that a pair may have to follow.
RECALL = 0.99995
LEVELS = 2
SPLIT = 400
SKETCH = 64
# Five standard deviations of the share of 64 equal minima at 0.8.
SKETCH_LEAST = 35

# Hashes taken at once; they fit into a core's cache.
CELLS = 1 << 15


def runs_for(recall: float, levels: int) -> int:
    """Runs that find a pair at the threshold with the probability `recall`.

    On each level the pair is expected to choose one common shingle at least, so the
    chance that a common path reaches the last level is that of a branching process.
    """
    reached = 1.0
    for _ in range(levels):
        reached = 1 - math.exp(-reached)
    return math.ceil(math.log(1 - recall) / math.log(1 - reached))


RUNS = runs_for(RECALL, LEVELS)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, data, offsets in slices(column):
        starts, ends, before = word_spans(data, offsets)
        words = span_hashes(byte_prefix_sums(data), starts, ends)
        sums = prefix_sums(words)
        grams = gram_hashes(sums, SHINGLE)
        for low, high in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            if high - low >= SHINGLE:
                yield np.unique(grams[low : high - SHINGLE + 1])
            elif high > low:
                yield mix(span_hashes(sums, np.array([low]), np.array([high])))
            else:
                yield np.zeros(0, np.uint64)


def _seeds(count: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(salt))


_RUN_SEEDS = _seeds(RUNS, 1)
_SKETCH_SEEDS = _seeds(SKETCH, 2)


def chosen(shingles: np.ndarray, nodes: np.ndarray) -> list[np.ndarray]:
    """Child nodes of each node: those shingles whose hash with it is low enough."""
    limit = np.uint64(min((1 << 64) - 1, (1 << 64) * DENOMINATOR // (NUMERATOR * len(shingles))))
    out = []
    # Many nodes of a small set at once, few of a large one.
    step = max(1, CELLS // len(shingles))
    for first in range(0, len(nodes), step):
        some = nodes[first : first + step]
        hashes = mix(some[:, None] ^ shingles)
        low, places = np.nonzero(hashes < limit)
        children = mix(hashes[low, places] + some[low])
        out.extend(np.split(children, np.searchsorted(low, np.arange(1, len(some)))))
    return out


def sketch_of(shingles: np.ndarray) -> bytes:
    """A byte of the smallest hash under each of 64 seeds."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max)
    step = CELLS // SKETCH
    for first in range(0, len(shingles), step):
        hashes = _SKETCH_SEEDS[:, None] ^ shingles[first : first + step]
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        np.minimum(least, hashes.min(axis=1), out=least)
    return (mix(least) >> np.uint64(56)).astype(np.uint8).tobytes()


_SETS = "_doc long, _tid long, set_id binary, size int, sketch binary, paths array<long>, deeper array<struct<parent:long,path:long>>"


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    deeper_kind = pa.list_(pa.struct([("parent", pa.int64()), ("path", pa.int64())]))
    for batch in batches:
        ids, sizes, sketches, paths, deeper = [], [], [], [], []
        for shingles in shingle_sets(batch.column("_text")):
            sizes.append(len(shingles))
            if not len(shingles):
                ids.append(None)
                sketches.append(None)
                paths.append([])
                deeper.append([])
                continue
            ids.append(blake2b(shingles.tobytes(), digest_size=16).digest())
            sketches.append(sketch_of(shingles))
            first = np.concatenate(chosen(shingles, _RUN_SEEDS))
            second = chosen(shingles, first)
            paths.append(first.view(np.int64).tolist())
            deeper.append(
                [
                    {"parent": parent, "path": path}
                    for parent, children in zip(paths[-1], second, strict=True)
                    for path in children.view(np.int64).tolist()
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_doc"),
                batch.column("_tid"),
                pa.array(ids, pa.binary()),
                pa.array(sizes, pa.int32()),
                pa.array(sketches, pa.binary()),
                pa.array(paths, pa.list_(pa.int64())),
                pa.array(deeper, deeper_kind),
            ],
            ["_doc", "_tid", "set_id", "size", "sketch", "paths", "deeper"],
        )


def buckets_of(sets: DataFrame, split: int = SPLIT) -> DataFrame:
    """(bucket, left, right, set_id, side): members of all buckets to compare.

    A bucket is a path and a pair of blocks; `side` says in which block the member
    is (0 left, 1 right). Small buckets are one block compared with itself.
    """
    first = sets.select(F.explode("paths").alias("bucket"), "set_id").distinct()
    sizes = first.groupBy("bucket").agg(F.count("*").alias("_m")).filter("_m > 1")
    first = first.join(sizes, "bucket")
    whole = first.filter(F.col("_m") <= split).select("bucket", "set_id", "_m")
    second = (
        sets.select(F.explode("deeper").alias("_d"), "set_id")
        .select(F.col("_d.parent").alias("_parent"), F.col("_d.path").alias("bucket"), "set_id")
        .join(sizes.filter(F.col("_m") > split).select(F.col("bucket").alias("_parent")), "_parent", "left_semi")
        .select("bucket", "set_id")
        .distinct()
    )
    deep = second.groupBy("bucket").agg(F.count("*").alias("_m")).filter("_m > 1")
    members = whole.unionByName(second.join(deep, "bucket").select("bucket", "set_id", "_m"))
    blocks = F.ceil(F.col("_m") / split).cast("int")
    own = F.pmod(F.xxhash64("set_id"), F.col("_blocks").cast("long")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda other: F.struct(
            F.least("_own", other).alias("left"),
            F.greatest("_own", other).alias("right"),
            (F.col("_own") > other).cast("int").alias("side"),
        ),
    )
    return (
        members.withColumn("_blocks", blocks)
        .withColumn("_own", own)
        .select("bucket", "set_id", F.explode(pairs).alias("_p"))
        .select("bucket", "_p.left", "_p.right", "set_id", "_p.side")
    )


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows sorted by (bucket, left, right), one bucket at a time."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[batch.column(name).to_pylist() for name in names], strict=True):
            if row[:3] != key:
                if len(rows) > 1:
                    yield key, rows
                key, rows = row[:3], []
            rows.append(row[3:])
    if len(rows) > 1:
        yield key, rows


def _pairs(key: tuple, sides: np.ndarray) -> np.ndarray:
    """Matrix of pairs (i < j) that this pair of blocks compares."""
    if key[1] == key[2]:
        return np.triu(np.ones((len(sides), len(sides)), bool), 1)
    return (sides[:, None] == 0) & (sides[None, :] == 1)


def _first_common(rows: np.ndarray, columns: np.ndarray, members: list, bucket: int) -> np.ndarray:
    """True for pairs whose first common bucket is this one; `members` has their routes."""
    out = np.zeros(len(rows), bool)
    known = [(set(route), route) for route in members]
    for k, (i, j) in enumerate(zip(rows.tolist(), columns.tolist(), strict=True)):
        other = known[j][0]
        out[k] = next((path for path in known[i][1] if path in other), bucket) == bucket
    return out


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members that have a partner by sketch and size in a bucket, where the pair is first met."""
    for key, rows in _groups(batches, ["bucket", "left", "right", "set_id", "side", "size", "sketch", "route"]):
        sides = np.array([row[1] for row in rows])
        sizes = np.array([row[2] for row in rows])
        sketches = np.frombuffer(b"".join(row[3] for row in rows), np.uint8).reshape(len(rows), SKETCH)
        near = _pairs(key, sides)
        near &= DENOMINATOR * np.minimum(sizes[:, None], sizes) >= NUMERATOR * np.maximum(sizes[:, None], sizes)
        if not near.any():
            continue
        for i in np.flatnonzero(near.any(axis=1)):
            others = np.flatnonzero(near[i])
            near[i, others] = (sketches[others] == sketches[i]).sum(axis=1) >= SKETCH_LEAST
        left, right = np.nonzero(near)
        if not len(left):
            continue
        first = _first_common(left, right, [row[4] for row in rows], key[0])
        need = np.unique(np.concatenate([left[first], right[first]]))
        if len(need):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]] * len(need), pa.int64()),
                    pa.array([key[1]] * len(need), pa.int32()),
                    pa.array([key[2]] * len(need), pa.int32()),
                    pa.array([rows[i][0] for i in need], pa.binary()),
                    pa.array([rows[i][1] for i in need], pa.int32()),
                ],
                ["bucket", "left", "right", "set_id", "side"],
            )


def _set_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies = [shingles.tobytes() for shingles in shingle_sets(batch.column("_text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("set_id"), pa.array(bodies, pa.binary())], ["set_id", "shingles"]
        )


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common elements of each pair of sorted sets.

    Elements in one set only are dropped; the rest are columns of a 0/1 matrix
    whose products with itself are the overlaps, taken in stripes of columns.
    """
    values, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    shared = counts[column] > 1
    owner, column = owner[shared], (np.cumsum(counts > 1) - 1)[column[shared]]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width, step = int((counts > 1).sum()), max(1, (1 << 22) // len(sets))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, width, step):
        a, b = np.searchsorted(column, [low, low + step])
        stripe = np.zeros((len(sets), min(step, width - low)), np.float32)
        stripe[owner[a:b], column[a:b] - low] = 1
        common += stripe @ stripe.T
    return common[left, right].astype(np.int64)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per member: linked texts and rows, and a neighbour that spans its part of the bucket."""
    names = ["bucket", "left", "right", "set_id", "side", "route", "copies", "shingles"]
    for key, rows in _groups(batches, names):
        sides = np.array([row[1] for row in rows])
        sets = [np.frombuffer(row[4], np.uint64) for row in rows]
        sizes = np.array([len(x) for x in sets])
        copies = np.array([row[3] for row in rows])
        left, right = np.nonzero(_pairs(key, sides))
        fits = DENOMINATOR * np.minimum(sizes[left], sizes[right]) >= NUMERATOR * np.maximum(sizes[left], sizes[right])
        left, right = left[fits], right[fits]
        common = overlaps(sets, left, right)
        fits = DENOMINATOR * common >= NUMERATOR * (sizes[left] + sizes[right] - common)
        left, right = left[fits], right[fits]
        first = _first_common(left, right, [row[2] for row in rows], key[0])
        left, right = left[first], right[first]
        if not len(left):
            continue
        texts = np.bincount(left, minlength=len(rows)) + np.bincount(right, minlength=len(rows))
        linked = np.bincount(left, copies[right], len(rows)) + np.bincount(right, copies[left], len(rows))
        root = np.arange(len(rows))
        while True:
            before = root.copy()
            least = np.minimum(root[left], root[right])
            np.minimum.at(root, left, least)
            np.minimum.at(root, right, least)
            root = root[root]
            if (root == before).all():
                break
        members = np.flatnonzero(texts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][0] for i in members], pa.binary()),
                pa.array(texts[members].astype(np.int64)),
                pa.array(linked[members].astype(np.int64)),
                pa.array([rows[root[i]][0] for i in members], pa.binary()),
            ],
            ["set_id", "texts", "rows", "root"],
        )


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(set_id, label): the least `label` among the nodes joined by edges (set_id, root).

    Labels spread along edges and then from the node that a label names, so a path
    halves with each round; every round is written, and rounds end when no label
    changes. Common neighbours are aggregated map-side.
    """
    both = stage(
        edges.select(F.col("set_id").alias("a"), F.col("root").alias("b"))
        .unionByName(edges.select(F.col("root").alias("a"), F.col("set_id").alias("b")))
        .filter("a <> b")
        .distinct(),
        "edges",
    )
    linked = both.select(F.col("a").alias("set_id")).distinct()
    labels = stage(nodes.join(linked, "set_id", "left_semi").select("set_id", F.col("label").alias("own"), "label"), "labels")
    while True:
        reached = (
            both.join(labels.select(F.col("set_id").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("set_id"))
            .agg(F.min("label").alias("_near"))
        )
        nearer = labels.join(reached, "set_id").select(
            "set_id", "own", F.col("label").alias("_old"), F.least("label", "_near").alias("label")
        )
        jump = nearer.select(F.col("own").alias("label"), F.col("label").alias("_far"))
        moved = stage(
            nearer.join(jump, "label").select("set_id", "own", "_old", F.least("label", "_far").alias("label")), "labels"
        )
        if moved.filter("label < _old").isEmpty():
            return moved.select("set_id", "label")
        labels = moved.select("set_id", "own", "label")


def near_duplicates(docs: DataFrame, split: int = SPLIT) -> DataFrame:
    """(doc_id, _doc, _tid, class_id, n_links, n_linked_texts, is_first) per document.

    `class_id` is the least id of the documents joined by links, `n_links` counts
    the other documents with a similarity at the threshold or above, copies
    included, `n_linked_texts` the other sets among them. `is_first` marks one row
    per class and set that a dedup keeps, the least (id, text hash).
    """
    texts = keyed(docs)
    rows = stage(texts.select("_doc", "_tid", "_text").mapInArrow(_set_rows, _SETS), "sets")
    sets = stage(
        rows.filter(F.col("set_id").isNotNull())
        .groupBy("set_id")
        .agg(
            F.min(F.struct("_doc", "_tid")).alias("label"),
            F.count("*").alias("copies"),
            F.first("size").alias("size"),
            F.first("sketch").alias("sketch"),
            F.first("paths").alias("paths"),
            F.first("deeper").alias("deeper"),
        ),
        "classes",
    )
    order = ["bucket", "left", "right"]
    members = stage(buckets_of(sets, split), "members")
    # Buckets that compare a set, in the order in which pairs look for a common one.
    routes = members.groupBy("set_id").agg(F.sort_array(F.collect_set("bucket")).alias("route"))
    met = (
        members.join(sets.select("set_id", "size", "sketch").join(routes, "set_id"), "set_id")
        .select(*order, "set_id", "side", "size", "sketch", "route")
        .repartition(*order)
        .sortWithinPartitions(*order)
    )
    wanted = stage(
        met.mapInArrow(_wanted, "bucket long, left int, right int, set_id binary, side int"), "wanted"
    )
    needed = sets.join(wanted.select("set_id").distinct(), "set_id", "left_semi")
    bodies = (
        texts.select("_doc", "_tid", "_text")
        .join(needed.select("label._doc", "label._tid", "set_id"), ["_doc", "_tid"])
        .dropDuplicates(["set_id"])
        .select("set_id", "_text")
        .mapInArrow(_set_texts, "set_id binary, shingles binary")
    )
    found = stage(
        wanted.join(needed.select("set_id", "copies").join(routes, "set_id"), "set_id")
        .join(bodies, "set_id")
        .select(*order, "set_id", "side", "route", "copies", "shingles")
        .repartition(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_links, "set_id binary, texts long, rows long, root binary"),
        "links",
    )
    counted = found.groupBy("set_id").agg(F.sum("texts").alias("texts"), F.sum("rows").alias("linked"))
    joined = components(sets, found.select("set_id", "root"))
    facts = (
        sets.select("set_id", "copies", F.col("label").alias("_own"))
        .join(counted, "set_id", "left")
        .join(joined.withColumnRenamed("label", "_class"), "set_id", "left")
        .select(
            "set_id",
            F.coalesce("_class", "_own").alias("_class"),
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("texts", F.lit(0)).alias("n_linked_texts"),
        )
    )
    own = F.struct("_doc", "_tid")
    return rows.select("_doc", "_tid", "set_id").join(facts, "set_id", "left").select(
        "_doc",
        "_tid",
        F.coalesce("_class._doc", "_doc").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_linked_texts", F.lit(0)).cast("long").alias("n_linked_texts"),
        F.coalesce(F.col("_class") == own, F.lit(True)).alias("is_first"),
    )


def link_report(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links, n_linked_texts); a null id is shown as null."""
    last = F.lit((1 << 63) - 1)
    return near_duplicates(docs).select(
        F.when(F.col("_doc") < last, F.col("_doc")).alias("doc_id"),
        F.when(F.col("class_id") < last, F.col("class_id")).alias("class_id"),
        "n_links",
        "n_linked_texts",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of one document per class, with their own columns.

    The least id stays; of rows that repeat its id and text one stays.
    """
    kept = near_duplicates(docs).filter("is_first").select("_doc", "_tid").distinct()
    first = with_keys(docs).join(kept, ["_doc", "_tid"], "left_semi")
    blank = F.regexp_replace(F.coalesce(F.col("_row.text"), F.lit("")), r"[\x20\x09-\x0D]+", "") == ""
    texts = first.filter(~blank).groupBy("_doc", "_tid").agg(F.first("_row").alias("_row")).select("_row")
    return texts.unionByName(first.filter(blank).select("_row")).select("_row.*")
