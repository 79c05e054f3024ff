"""Tokens of two tokenizers aligned by the bytes they cover.

Each tokenization is a sparse matrix of tokens by bytes in compressed rows. The
product of one with the transposed other, row by row after Gustavson, has an entry
for every two tokens that share bytes; its value is their number. Offsets where
tokens of both end cut the text into groups, which give a matrix of tokens by
groups each; the product of these links all tokens of a group.

The first tokenizer works on bytes, the second on pieces with a byte fallback; both
read a blank and the text. Texts whose tokens do not spell just these bytes, null
and empty ones have no tokens. Texts of any length are aligned whole; short ones
are aligned together, slice by slice, and never touch, as both end with a text.
Rows are independent but for the counts over the corpus, in which repeated rows
count each. Further columns may have any name.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeloom.llm.bpe import OffsetTable, byte_letters, tokenizer_file
from gaugeloom.llm.tables import keyed, slices
from gaugeloom.scale import stage

# Linked pairs of ids whose counts are sent to every executor; the others are joined.
FREQUENT_PAIRS = 1 << 18

# Entries of a group product made at once.
BLOCK_ENTRIES = 1 << 20

# Fixed value: the pattern that splits text before the merges of the byte-level file.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Outside these characters the two libraries' Unicode tables may differ in age.
_RARE = re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]")

# Words from this length on are left to the file's own library.
LONG_WORD = 20_000


@dataclass(frozen=True)
class Csr:
    """A sparse matrix in compressed rows."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def incidence(cls, sizes: np.ndarray) -> Csr:
        """Row i covers the `sizes[i]` columns after those of the rows before."""
        starts = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        total = int(starts[-1])
        return cls(starts, np.arange(total), np.ones(total, np.int64), total)

    @classmethod
    def membership(cls, groups: np.ndarray, width: int) -> Csr:
        """Row i has its only entry in column `groups[i]`."""
        return cls(np.arange(len(groups) + 1), groups, np.ones(len(groups), np.int64), width)

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def rows(self, first: int, last: int) -> Csr:
        low, high = self.starts[first], self.starts[last]
        return Csr(self.starts[first : last + 1] - low, self.columns[low:high], self.values[low:high], self.width)

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=self.width))))
        rows = np.repeat(np.arange(self.height), np.diff(self.starts))
        return Csr(starts, rows[order], self.values[order], self.height)

    def row_work(self, other: Csr) -> np.ndarray:
        """Products that each row of self · other takes, summed from the first row on."""
        work = np.concatenate(([0], np.cumsum(np.diff(other.starts)[self.columns])))
        return work[self.starts]

    def times(self, other: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entries (row, column, value) of self · other, by row and column.

        Every entry of a row fetches the row of `other` it points to; equal columns
        of a row are then added up.
        """
        sizes = np.diff(other.starts)[self.columns]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        fetched = np.repeat(other.starts[self.columns] - ends + sizes, sizes) + np.arange(total)
        rows = np.repeat(np.repeat(np.arange(self.height), np.diff(self.starts)), sizes)
        columns = other.columns[fetched]
        values = np.repeat(self.values, sizes) * other.values[fetched]
        cells = rows * other.width + columns
        if np.any(cells[1:] < cells[:-1]):
            order = np.argsort(cells, kind="stable")
            cells, rows, columns, values = cells[order], rows[order], columns[order], values[order]
        first = np.flatnonzero(np.diff(cells, prepend=-1))
        sums = np.add.reduceat(values, first) if total else values
        return rows[first], columns[first], sums


class Alignment:
    """Two tokenizations of the same bytes, given by their token sizes."""

    def __init__(self, a_sizes: np.ndarray, b_sizes: np.ndarray):
        self.a, self.b = Csr.incidence(a_sizes), Csr.incidence(b_sizes)
        if self.a.width != self.b.width:
            raise ValueError("the tokens cover different bytes")
        # Tokens that share bytes, and how many.
        self.over_a, self.over_b, self.shared = self.a.times(self.b.transposed())
        together = self.a.starts[1:][self.over_a] == self.b.starts[1:][self.over_b]
        # Tokens that end together; each such place ends a group.
        self.end_a, self.end_b = self.over_a[together], self.over_b[together]
        self.groups = len(self.end_a)
        self.a_group = np.searchsorted(self.end_a, np.arange(self.a.height))
        self.b_group = np.searchsorted(self.end_b, np.arange(self.b.height))

    def group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All (token, token, group) of the same group, in bounded blocks."""
        left = Csr.membership(self.a_group, self.groups)
        right = Csr.membership(self.b_group, self.groups).transposed()
        work, first = left.row_work(right), 0
        while first < left.height:
            last = int(np.searchsorted(work, work[first] + BLOCK_ENTRIES, side="right")) - 1
            last = min(left.height, max(first + 1, last))
            rows, columns, _ = left.rows(first, last).times(right)
            yield rows + first, columns, self.a_group[rows + first]
            first = last


class TokenizerPair:
    """A byte-level tokenizer file and a piece model, with the bytes of their tokens."""

    def __init__(self, byte_file: bytes, piece_file: bytes):
        spec = json.loads(byte_file)
        added = {token["content"] for token in spec["added_tokens"]}
        values = {letter: byte for byte, letter in enumerate(byte_letters())}
        vocab = {
            (text.encode() if text in added else bytes([values[letter] for letter in text])): number
            for text, number in spec["model"]["vocab"].items()
        }
        self.library = Tokenizer.from_str(byte_file.decode())
        # Strings of special tokens inside texts are ordinary text.
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        self.quick = self._quick(spec, {text: n for text, n in vocab.items() if text.decode("latin-1") not in added})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_file)
        self.a_texts = OffsetTable(_by_number(vocab))
        self.b_texts = OffsetTable([self._piece(number) for number in range(self.pieces.get_piece_size())])
        self.a_count, self.b_count = len(self.a_texts.offsets) - 1, len(self.b_texts.offsets) - 1
        # Decimals with what follows them: in a group, at the end of its first and second half.
        self.decimals = OffsetTable(
            [
                b"%d%b" % (number, mark)
                for count, marks in ((self.a_count, (b",", b"|")), (self.b_count, (b",", b";")))
                for mark in marks
                for number in range(count)
            ]
        )

    @staticmethod
    def _quick(spec: dict, vocab: dict[bytes, int]) -> tiktoken.Encoding | None:
        """The same merges in a faster library, if the numbers of the tokens are their ranks."""
        merges = [merge if isinstance(merge, list) else merge.split(" ") for merge in spec["model"]["merges"]]
        numbers = spec["model"]["vocab"]
        ranked = all(numbers[a + b] == 256 + rank for rank, (a, b) in enumerate(merges))
        single = sorted(number for text, number in vocab.items() if len(text) == 1) == list(range(256))
        if not (ranked and single and len(vocab) == 256 + len(merges)):
            return None
        return tiktoken.Encoding("merges", pat_str=BYTE_PATTERN, mergeable_ranks=vocab, special_tokens={})

    def _piece(self, number: int) -> bytes:
        piece = self.pieces.id_to_piece(number)
        if self.pieces.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode_bytes(self, text: str) -> list[int]:
        """Numbers of the byte-level tokens of a blank and the text."""
        if self.quick is not None and not _RARE.search(text):
            if len(text) < LONG_WORD or max(map(len, text.split()), default=0) < LONG_WORD:
                return self.quick.encode_ordinary(" " + text)
        return self.library.encode(" " + text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Numbers of both tokenizers for every text; none where they do not spell it."""
        pieces = self.pieces.encode(texts, num_threads=1) if texts else []
        none = np.zeros(0, np.int64)
        first, second = [], []
        for text, numbers in zip(texts, pieces, strict=True):
            a = b = none
            if text:
                a, b = np.array(self.encode_bytes(text), np.int64), np.array(numbers, np.int64)
                body = b" " + text.encode()
                if self.a_texts.join(a) != body or self.b_texts.join(b) != body:
                    a = b = none
            first.append(a)
            second.append(b)
        return first, second


def _by_number(vocab: dict[bytes, int]) -> list[bytes]:
    texts = {number: text for text, number in vocab.items()}
    return [texts.get(number, b"") for number in range(max(texts) + 1)]


@lru_cache(maxsize=2)
def _pair(byte_file: bytes, piece_file: bytes) -> TokenizerPair:
    return TokenizerPair(byte_file, piece_file)


@dataclass(frozen=True)
class _Slice:
    """Some rows with their tokens one after the other."""

    first: int
    last: int
    a: np.ndarray
    b: np.ndarray
    a_from: np.ndarray
    b_from: np.ndarray
    found: Alignment

    def a_rows(self, tokens: np.ndarray) -> np.ndarray:
        """The row of each token of the first tokenizer."""
        return np.searchsorted(self.a_from, tokens, side="right") - 1


def _aligned(column: pa.Array, pair: TokenizerPair) -> Iterator[_Slice]:
    for first, last, _, _ in slices(column):
        a, b = pair.encode([text or "" for text in column.slice(first, last - first).to_pylist()])
        a_from, b_from = (np.concatenate(([0], np.cumsum([len(x) for x in side], dtype=np.int64))) for side in (a, b))
        a, b = np.concatenate(a), np.concatenate(b)
        sizes = (np.diff(table.offsets)[numbers] for table, numbers in ((pair.a_texts, a), (pair.b_texts, b)))
        yield _Slice(first, last, a, b, a_from, b_from, Alignment(*sizes))


def align_documents(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_group, b_group): tokens of every row and their group from 0."""
    files = _files(docs, byte_path, piece_path)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*(file.value for file in files))
        for batch in batches:
            for part in _aligned(batch.column("_text"), pair):
                found = part.found
                # The first group of a row is that of its first token.
                base = np.append(found.a_group, found.groups)[part.a_from[:-1]]
                columns = [batch.column("doc_id").slice(part.first, part.last - part.first)]
                for numbers, starts in (
                    (part.a, part.a_from),
                    (part.b, part.b_from),
                    (found.a_group - np.repeat(base, np.diff(part.a_from)), part.a_from),
                    (found.b_group - np.repeat(base, np.diff(part.b_from)), part.b_from),
                ):
                    columns.append(pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(numbers, pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a_ids", "b_ids", "a_group", "b_group"])

    return (
        keyed(docs)
        .select("doc_id", "_text")
        .mapInArrow(
            align, "doc_id long, a_ids array<int>, b_ids array<int>, a_group array<int>, b_group array<int>"
        )
    )


def token_links(docs: DataFrame, byte_path: str, piece_path: str, kind: str = "overlap") -> DataFrame:
    """(doc_id, a_place, b_place, a_id, b_id, n_bytes): linked token occurrences.

    `overlap` links tokens that share bytes, `end` those that also end together,
    `group` all of a group, also those that share none (0 bytes). Only the last can
    be many: a group of n and m tokens has n · m links, made block by block.
    """
    if kind not in ("overlap", "end", "group"):
        raise ValueError(f"no such link: {kind}")
    files = _files(docs, byte_path, piece_path)
    names = ["doc_id", "a_place", "b_place", "a_id", "b_id", "n_bytes"]

    def blocks(found: Alignment) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if kind == "overlap":
            yield found.over_a, found.over_b
        elif kind == "end":
            yield found.end_a, found.end_b
        else:
            yield from ((a, b) for a, b, _ in found.group_links())

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*(file.value for file in files))
        for batch in batches:
            for part in _aligned(batch.column("_text"), pair):
                found, ids = part.found, batch.column("doc_id").slice(part.first, part.last - part.first)
                for a, b in blocks(found):
                    rows = part.a_rows(a)
                    begin = np.maximum(found.a.starts[a], found.b.starts[b])
                    size = np.minimum(found.a.starts[a + 1], found.b.starts[b + 1]) - begin
                    numbers = (a - part.a_from[rows], b - part.b_from[rows], part.a[a], part.b[b], np.maximum(size, 0))
                    arrays = [ids.take(pa.array(rows)), *(pa.array(column, pa.int64()) for column in numbers)]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    return (
        keyed(docs)
        .select("doc_id", "_text")
        .mapInArrow(link, ", ".join(f"{name} long" for name in names))
    )


def _files(docs: DataFrame, byte_path: str, piece_path: str) -> tuple[Broadcast, Broadcast]:
    return tokenizer_file(docs, byte_path), tokenizer_file(docs, piece_path)


def _group_digests(part: _Slice, pair: TokenizerPair) -> list[str]:
    """Digest of `a1,a2|b1;a3|b2,b3` for each row: the tokens group by group."""
    found = part.found
    a_last = np.zeros(len(part.a), np.int64)
    b_last = np.zeros(len(part.b), np.int64)
    a_last[found.end_a] = 1
    b_last[found.end_b] = 1
    # Before a token stand those of its own kind and, of the other, those of earlier
    # groups; the second half of a group also follows its first.
    a_before = np.concatenate(([0], found.end_b + 1))[found.a_group]
    b_before = (found.end_a + 1)[found.b_group] if found.groups else part.b
    codes = np.empty(len(part.a) + len(part.b), np.int64)
    codes[np.arange(len(part.a)) + a_before] = part.a + a_last * pair.a_count
    codes[np.arange(len(part.b)) + b_before] = 2 * pair.a_count + part.b + b_last * pair.b_count
    body = memoryview(pair.decimals.join(codes))
    ends = np.concatenate(([0], np.cumsum(np.diff(pair.decimals.offsets)[codes])))
    cuts = ends[part.a_from + part.b_from].tolist()
    return [sha256(body[low : high - 1]).hexdigest() if high > low else "" for low, high in zip(cuts, cuts[1:])]


def link_report(
    docs: DataFrame, byte_path: str, piece_path: str, *, frequent_pairs: int = FREQUENT_PAIRS
) -> DataFrame:
    """Per row tokens, groups, links and what the corpus says of the linked ids.

    Links are those of tokens that end together. The count of an id pair is the
    number of its links in all rows; `n_best` counts links whose pair has the
    highest count of its second id, `count_sum` adds up the counts. Every row keeps
    its distinct pairs with their number, so hot pairs are added up before a shuffle.
    The counts of at most `frequent_pairs` pairs, the most frequent ones, are
    broadcast; all others, each rare, are joined by shuffle.
    """
    rows = stage(_digested(docs, _files(docs, byte_path, piece_path)), "alignment")
    links = rows.select("_row", F.inline("links"))
    width = _pair_width(piece_path)
    counts = stage(links.groupBy("pair").agg(F.sum("n").alias("total")), "pair_counts")
    # At most one row per piece of the vocabulary.
    best = counts.groupBy(F.pmod("pair", F.lit(width)).alias("_b")).agg(F.max("total").alias("_top"))
    facts = counts.join(F.broadcast(best), F.pmod("pair", F.lit(width)) == F.col("_b")).select(
        "pair", "total", (F.col("total") == F.col("_top")).alias("is_best")
    )
    least = _least_frequent(counts, frequent_pairs)
    common = F.broadcast(facts.filter(F.col("total") >= least))

    def summed(found: DataFrame) -> DataFrame:
        return found.groupBy("_row").agg(
            F.sum(F.col("n") * F.col("total")).alias("_sum"),
            F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("_best"),
        )

    sums = summed(links.join(common, "pair"))
    if least > 1:
        rare = links.join(common.select("pair"), "pair", "left_anti")
        sums = sums.unionByName(summed(rare.join(facts.filter(F.col("total") < least), "pair")))
        sums = sums.groupBy("_row").agg(F.sum("_sum").alias("_sum"), F.sum("_best").alias("_best"))
    zero = F.lit(0).cast("long")
    return (
        rows.drop("links")
        .join(sums, "_row", "left")
        .select(
            "doc_id",
            "n_a",
            "n_b",
            "n_groups",
            "n_links",
            F.coalesce("_best", zero).alias("n_best"),
            F.coalesce("_sum", zero).alias("count_sum"),
            "groups_sha256",
        )
    )


def _pair_width(piece_path: str) -> int:
    """Pairs are numbered a · width + b."""
    return sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()


def _least_frequent(counts: DataFrame, most: int) -> int:
    """The smallest count from which on there are at most `most` pairs.

    Counts are looked at in steps of a quarter octave, so the driver sees at most
    256 numbers.
    """
    step = F.floor(F.log2("total") * 4)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("total").alias("least")).collect()
    least, kept = 1 << 62, 0
    for row in sorted(steps, key=lambda row: -row["step"]):
        kept += row["pairs"]
        if kept > most:
            return least
        least = row["least"]
    return 1


def _digested(docs: DataFrame, files: tuple[Broadcast, Broadcast]) -> DataFrame:
    """Counts, group digest and distinct linked pairs of every row, with a row number."""
    names = ["_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*(file.value for file in files))
        width = pair.a_count * pair.b_count
        for batch in batches:
            for part in _aligned(batch.column("_text"), pair):
                found, size = part.found, part.last - part.first
                rows = part.a_rows(found.end_a)
                ends = np.bincount(rows, minlength=size)
                cells = rows * width + part.a[found.end_a] * pair.b_count + part.b[found.end_b]
                cells, numbers = np.unique(cells, return_counts=True)
                owners, pairs = np.divmod(cells, width)
                starts = np.searchsorted(owners, np.arange(size + 1)).astype(np.int32)
                structs = pa.StructArray.from_arrays(
                    [pa.array(pairs, pa.int64()), pa.array(numbers, pa.int32())], ["pair", "n"]
                )
                columns = [batch.column(name).slice(part.first, size) for name in ("_row", "doc_id")]
                counted = (np.diff(part.a_from), np.diff(part.b_from), ends, ends)
                columns += [pa.array(column, pa.int64()) for column in counted]
                columns.append(pa.array(_group_digests(part, pair), pa.string()))
                columns.append(pa.ListArray.from_arrays(starts, structs))
                yield pa.RecordBatch.from_arrays(columns, names)

    return (
        keyed(docs)
        .select(F.monotonically_increasing_id().alias("_row"), "doc_id", "_text")
        .mapInArrow(
            digest,
            "_row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "links array<struct<pair:long,n:int>>",
        )
    )
