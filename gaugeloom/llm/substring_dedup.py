"""Exact substring dedup by suffix sorting, one bucket at a time.

Every byte under a `length`-byte string that also starts elsewhere is removed.
`recurring` proposes runs of window starts under recurring anchors. A task gets
whole anchors, lays their distinct stretches of text side by side and sorts the
suffixes at the window starts:

* ranks of a difference-cover sample are computed first, by doubling;
* suffixes are sorted bucket by bucket (first two bytes), to the depth of the
  cover period; longer ties are decided by the ranks at the first shift that
  puts both suffixes on the cover, so no more text is compared and only one
  bucket is in memory besides the sample's ranks.

Equal windows are then neighbours. Texts equal under a whole run count once.

Nulls and empty texts keep nothing and lose nothing; texts shorter than `length`
stay whole; rows that repeat a text repeat its strings, so both lose them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cmp_to_key, lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm import recurring
from gaugeloom.llm.hashing import byte_prefix_sums, gram_hashes
from gaugeloom.llm.tables import keyed, text_bytes
from gaugeloom.scale import stage

LENGTH = 400
PERIOD = 64
# Bytes of distinct text that a task sorts at once.
BLOCK_BYTES = 1 << 21


@lru_cache
def difference_cover(period: int) -> tuple[int, ...]:
    """Residues such that every difference modulo `period` occurs between two.

    Greedy: the residue that adds most new differences comes next.
    """
    cover = [0]
    missing = set(range(1, period))
    while missing:
        gains = [
            (len(missing & {d for c in cover for d in ((x - c) % period, (c - x) % period)}), -x)
            for x in range(period)
        ]
        best = -max(gains)[1]
        missing -= {d for c in cover for d in ((best - c) % period, (c - best) % period)}
        cover.append(best)
    return tuple(sorted(cover))


@lru_cache
def cover_shifts(period: int) -> np.ndarray:
    """shifts[a, b]: least shift that puts residues a and b both on the cover."""
    cover = np.zeros(period, bool)
    cover[list(difference_cover(period))] = True
    both = np.stack([np.roll(cover, -shift) for shift in range(period)])
    return np.argmax(both[:, :, None] & both[:, None, :], axis=0)


def big_endian_words(text: np.ndarray) -> np.ndarray:
    """The eight bytes at every place as one number; `text` is padded."""
    words = np.zeros(len(text) - 7, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | text[k : len(text) - 7 + k]
    return words


def cover_ranks(text: np.ndarray, words: np.ndarray, size: int, depth: int, period: int) -> np.ndarray:
    """Rank of each cover place among all cover places, to `depth` bytes at least.

    Sample suffixes are ranked by `period` bytes, then by doubling: a cover place
    plus the period is a cover place again. Other places hold 0.
    """
    cover = np.zeros(period, bool)
    cover[list(difference_cover(period))] = True
    places = np.flatnonzero(cover[np.arange(size + depth) % period])
    ranks = np.zeros(len(text), np.int64)
    keys = [words[places + 8 * k] for k in reversed(range(period // 8))]
    order = np.lexsort(keys)
    differs = np.zeros(len(places), bool)
    for key in keys:
        differs[1:] |= key[order][1:] != key[order][:-1]
    ranks[places[order]] = np.cumsum(differs) + 1
    reached = period
    while reached < depth + period:
        joined = ranks[places] * (len(places) + 2) + ranks[np.minimum(places + reached, len(text) - 1)]
        ranks[places] = np.unique(joined, return_inverse=True)[1] + 1
        reached *= 2
    return ranks


def sorted_buckets(
    text: np.ndarray, starts: np.ndarray, size: int, depth: int, period: int = PERIOD
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each bucket's suffixes in order, and which agree with the one before
    in the first `period` bytes. `text` holds `size` bytes and zero padding."""
    words = big_endian_words(text)
    ranks = cover_ranks(text, words, size, depth, period)
    shifts = cover_shifts(period)
    heads = words[starts] >> np.uint64(48)
    by_head = np.argsort(heads, kind="stable")
    cuts = np.flatnonzero(np.diff(heads[by_head])) + 1
    for bucket in np.split(starts[by_head], cuts):
        if len(bucket) < 2:
            continue
        # Most suffixes differ early: only ties are compared further.
        keys = [words[bucket]]
        order = np.argsort(keys[0], kind="stable")
        bucket = bucket[order]
        tied = np.zeros(len(bucket), bool)
        tied[1:] = words[bucket[1:]] == words[bucket[:-1]]
        member = tied.copy()
        member[:-1] |= tied[1:]
        bucket, tied = bucket[member], tied[member]
        if not len(bucket):
            continue
        group = np.cumsum(~tied)
        keys = [words[bucket + 8 * k] for k in reversed(range(1, period // 8))]
        order = np.lexsort([*keys, group])
        bucket, group = bucket[order], group[order]
        same = np.zeros(len(bucket), bool)
        same[1:] = group[1:] == group[:-1]
        for k in range(1, period // 8):
            same[1:] &= words[bucket[1:] + 8 * k] == words[bucket[:-1] + 8 * k]
        yield _break_ties(bucket, same, ranks, shifts, period), same


def _break_ties(
    bucket: np.ndarray, same: np.ndarray, ranks: np.ndarray, shifts: np.ndarray, period: int
) -> np.ndarray:
    heads = np.flatnonzero(~same)
    sizes = np.diff(np.append(heads, len(bucket)))
    out = bucket.copy()
    pairs = heads[sizes == 2]
    if len(pairs):
        one, two = bucket[pairs], bucket[pairs + 1]
        shift = shifts[one % period, two % period]
        swap = ranks[one + shift] > ranks[two + shift]
        out[pairs[swap]], out[pairs[swap] + 1] = two[swap], one[swap]
    for head, size in zip(heads[sizes > 2], sizes[sizes > 2], strict=True):
        tie = bucket[head : head + size]
        residues = tie % period
        if (residues == residues[0]).all():
            out[head : head + size] = tie[np.argsort(ranks[tie + shifts[residues[0], residues[0]]], kind="stable")]
            continue

        def before(a: int, b: int) -> int:
            shift = shifts[a % period, b % period]
            return int(ranks[a + shift]) - int(ranks[b + shift])

        out[head : head + size] = sorted(tie.tolist(), key=cmp_to_key(before))
    return out


def repeated_starts(bodies: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """For each stretch of text, its windows that recur in another stretch."""
    lengths = np.array([len(body) for body in bodies])
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    size = int(offsets[-1])
    text = np.zeros(size + 2 * length + 4 * PERIOD, np.uint8)
    text[:size] = np.frombuffer(b"".join(bodies), np.uint8)
    counts_array = np.array(counts)
    owner = np.repeat(np.arange(len(bodies)), counts_array)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts_array) - counts_array, counts_array)
    starts = offsets[owner] + inside
    words = big_endian_words(text)
    found = np.zeros(size, bool)
    for order, same in sorted_buckets(text, starts, size, length):
        left, right = order[:-1][same[1:]], order[1:][same[1:]]
        for k in [*range(PERIOD, length - 7, 8), length - 8]:
            equal = words[left + k] == words[right + k]
            left, right = left[equal], right[equal]
        found[left] = found[right] = True
    return [np.flatnonzero(found[offsets[i] : offsets[i] + counts[i]]) for i in range(len(bodies))]


def _find(length: int, gram: int):
    def find(data: np.ndarray, offsets: np.ndarray):
        grams = gram_hashes(byte_prefix_sums(data), gram)
        runs = recurring.window_runs(grams, gram, length, offsets)

        def cut(i: int, skip: int, windows: int) -> bytes:
            start = offsets[runs.row[i]] + runs.first[i] + skip
            return data[start : start + windows - 1 + length].tobytes()

        return runs, cut

    return find


def _resolve(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for group in recurring.bucket_groups(batches, lambda row: len(row[5]) / BLOCK_BYTES):
        # Distinct stretches, by anchor.
        places: dict[tuple, list] = defaultdict(list)
        for anchor, doc, tid, firsts, n, body in group:
            places[anchor, n, body].extend((doc, tid, first) for first in firsts)
        kinds: dict[int, int] = defaultdict(int)
        for anchor, _, _ in places:
            kinds[anchor] += 1
        shared = [key for key in places if kinds[key[0]] > 1]
        windows = dict(
            zip(shared, repeated_starts([k[2] for k in shared], [k[1] for k in shared], length), strict=True)
            if shared
            else ()
        )
        out: dict[tuple, list] = defaultdict(list)
        for key, found in places.items():
            if len(found) > 1:
                spans = [(0, key[1] - 1)]
            elif key in windows and len(windows[key]):
                spans = list(zip(*(x.tolist() for x in recurring.runs_of(windows[key])), strict=True))
            else:
                continue
            for doc, tid, first in found:
                out[doc, tid].extend((first + low, first + high + length) for low, high in spans)
        if out:
            yield recurring.span_rows(out)


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = recurring.HOT_ANCHOR) -> DataFrame:
    """(_doc, _tid, spans): byte spans of `keyed` documents to remove.

    Spans of one document may overlap. `length` is 160 at least.
    """
    if length < 160:
        raise ValueError("length: at least 160 bytes")
    find = _find(length, 64)
    found = stage(recurring.regions(docs, find, other_document=False, hot=hot), "regions")
    cold = (
        found.filter(F.col("body").isNotNull())
        .select("anchor", "_doc", "_tid", "firsts", "n", "body")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(lambda batches: _resolve(batches, length), recurring.SPANS)
    )
    return cold.unionByName(recurring.hot_spans(found, length, other_document=False))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Sorted spans joined where they overlap or touch."""
    out: list[list[int]] = []
    for span in spans:
        if out and span["first"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], span["last"])
        else:
            out.append([span["first"], span["last"]])
    return [(low, high) for low, high in out]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("_text"))
        rows = []
        for i, spans in enumerate(batch.column("_spans").to_pylist()):
            body = data[offsets[i] : offsets[i + 1]].tobytes()
            runs = merged(spans or [])
            cuts = [0, *(x for run in runs for x in run), len(body)]
            kept = b"".join(body[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
            rows.append((len(body), len(body) - len(kept), len(runs), kept, sha256(kept).hexdigest()))
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
        names = ["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])


def drop_repeated_bytes(docs: DataFrame, length: int = LENGTH, hot: int = recurring.HOT_ANCHOR) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) per document."""
    texts = keyed(docs)
    spans = recurring.spans_by_document(repeated_spans(texts, length, hot))
    return texts.join(spans, ["_doc", "_tid"], "left").mapInArrow(
        _kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    )
