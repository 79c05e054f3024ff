"""Repeated phrases located by sharded Aho-Corasick automata.

Each word under a 13-word window that also starts in a document with a smaller
id is removed. `recurring` routes the passages of all documents that share an
anchor to the shard that owns the anchor. A shard confirms which windows recur
in several documents, compiles them into one automaton (words are its letters)
and streams every passage through it; a match whose first document is an
earlier one is removed. Shards hold whole anchors and a bounded number of
windows.

Nulls, empty texts and texts of fewer words lose nothing. Rows that share an id
are one document to each other: neither removes words of the other. A null id
counts as the largest.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm import recurring
from gaugeloom.llm.hashing import byte_prefix_sums, gram_hashes, prefix_sums, span_hashes
from gaugeloom.llm.substring_dedup import merged
from gaugeloom.llm.tables import keyed, text_bytes, word_spans
from gaugeloom.scale import stage

WORDS = 13
GRAM = 5
SHARD_WINDOWS = 40_000


class _Letters(dict):
    """A letter for every word of a shard, skipping the surrogates."""

    def __missing__(self, word: bytes) -> str:
        place = len(self) + 1
        letter = chr(place if place < 0xD800 else place + 0x800)
        self[word] = letter
        return letter


def _find(words: int, gram: int):
    def find(data: np.ndarray, offsets: np.ndarray):
        starts, ends, before = word_spans(data, offsets)
        hashes = span_hashes(byte_prefix_sums(data), starts, ends)
        runs = recurring.window_runs(gram_hashes(prefix_sums(hashes), gram), gram, words, before)

        def cut(i: int, skip: int, windows: int) -> bytes:
            low = before[runs.row[i]] + runs.first[i] + skip
            return b" ".join(data[starts[low] : ends[low + windows + words - 2]].tobytes().split())

        return runs, cut

    return find


def _located(passages: dict[tuple, int], words: int) -> dict[tuple, list[tuple[int, int]]]:
    """For each passage and its least document, the runs of windows that start in an earlier one.

    Windows found in two passages are confirmed and compiled; every passage of the
    shard is streamed through the automaton.
    """
    letters = _Letters()
    texts = {key: "".join([letters[word] for word in key[2].split()]) for key in passages}
    first: dict[str, int] = {}
    confirmed: dict[str, int] = {}
    for key, doc in passages.items():
        text = texts[key]
        for place in range(key[1]):
            window = text[place : place + words]
            known = first.setdefault(window, doc)
            if known != doc:
                confirmed[window] = first[window] = min(known, doc)
    if not confirmed:
        return {}
    automaton = ahocorasick.Automaton()
    for window, doc in confirmed.items():
        automaton.add_word(window, doc)
    automaton.make_automaton()
    out = {}
    for key, doc in passages.items():
        found = [end - words + 1 for end, owner in automaton.iter(texts[key]) if owner < doc]
        if found:
            out[key] = [(int(a), int(b)) for a, b in zip(*recurring.runs_of(np.array(found)), strict=True)]
    return out


def _resolve(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for group in recurring.bucket_groups(batches, lambda row: row[4] / SHARD_WINDOWS):
        # Equal passages under an anchor are streamed once; all but those of the least
        # document lose every window.
        places: dict[tuple, list] = defaultdict(list)
        for anchor, doc, tid, starts, n, body in group:
            places[anchor, n, body].extend((doc, tid, start) for start in starts)
        kinds = Counter(anchor for anchor, _, _ in places)
        shared = {key: min(found)[0] for key, found in places.items() if kinds[key[0]] > 1}
        located = _located(shared, words) if shared else {}
        out: dict[tuple, list] = defaultdict(list)
        for key, found in places.items():
            least = min(found)[0]
            early = located.get(key, ())
            for doc, tid, start in found:
                spans = [(0, key[1] - 1)] if doc > least else early
                if spans:
                    out[doc, tid].extend((start + low, start + high + words) for low, high in spans)
        if out:
            yield recurring.span_rows(out)


def repeated_spans(docs: DataFrame, words: int = WORDS, hot: int = recurring.HOT_ANCHOR) -> DataFrame:
    """(_doc, _tid, spans): word spans of `keyed` documents to remove."""
    if words < 2 * GRAM:
        raise ValueError(f"words: at least {2 * GRAM}")
    find = _find(words, GRAM)
    found = stage(recurring.regions(docs, find, other_document=True, hot=hot), "passages")
    cold = (
        found.filter(F.col("body").isNotNull())
        .select("anchor", "_doc", "_tid", "firsts", "n", "body")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(lambda batches: _resolve(batches, words), recurring.SPANS)
    )
    return cold.unionByName(recurring.hot_spans(found, words, other_document=True))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("_text"))
        rows = []
        for i, spans in enumerate(batch.column("_spans").to_pylist()):
            words = data[offsets[i] : offsets[i + 1]].tobytes().split()
            runs = merged(spans or [])
            cuts = [0, *(x for run in runs for x in run), len(words)]
            kept = [word for a, b in zip(cuts[::2], cuts[1::2], strict=True) for word in words[a:b]]
            text = b" ".join(kept)
            rows.append((len(words), len(words) - len(kept), text.decode(), sha256(text).hexdigest()))
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *arrays], ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"]
        )


def drop_repeated_phrases(docs: DataFrame, words: int = WORDS, hot: int = recurring.HOT_ANCHOR) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256) per document."""
    texts = keyed(docs)
    spans = recurring.spans_by_document(repeated_spans(texts, words, hot))
    return texts.join(spans, ["_doc", "_tid"], "left").mapInArrow(
        _kept, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"
    )
