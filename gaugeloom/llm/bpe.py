"""Byte-pair encoding by backtracking, and decoding by an offset table.

A word's tokens are found from the left: an Aho-Corasick automaton over the
vocabulary gives the longest token at a place, which is tried first and then its
shorter prefixes, and a token may follow another only if merging the two texts would give
back exactly these two tokens. That pair test looks up merges only, and its
answers are kept in a table. A place that leads nowhere is marked, so every
place is left at most once and the work is linear in the word's length. The
result equals applying the merges in order of rank.

Words repeat, so each Python worker keeps a bounded table of encoded words.
Texts are split by the file's pattern first; no token spans two words.

A null text counts as empty and gives no tokens; texts of any length are encoded
whole, and rows are independent, so repeated rows give the same tokens.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers, pre_tokenizers

from gaugeloom.llm.tables import keyed

# Words kept encoded per worker; the table is emptied when full.
KEPT_WORDS = 400_000

# The byte-level alphabet shows these bytes as themselves and the
# others, in order, as the characters from 256 on.
PRINTABLE = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))

# Outside these characters NFC and lower case are left to the library: the Latin
# ones are composed already and no mark that combines is among them.
_RARE = re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]")


# The word pattern of such texts, spelled with the letters and numbers there are.
_PLAIN_WORDS = re.compile(
    "[a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f]+|'(?:[stmd]|re|ve|ll)|[0-9\xb2\xb3\xb9\xbc-\xbe]|"
    "[^ \t-\r\x85\xa00-9\xb2\xb3\xb9\xbc-\xbea-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f]+"
)
# Fixed value: the word pattern of the file.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte."""
    others = iter(range(256, 512))
    shown = set(PRINTABLE)
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class OffsetTable:
    """Texts by number in one buffer, so that many are fetched at once."""

    def __init__(self, texts: Sequence[bytes]):
        self.offsets = np.concatenate(([0], np.cumsum([len(text) for text in texts], dtype=np.int64)))
        self.buffer = np.frombuffer(b"".join(texts), np.uint8)

    def join(self, numbers: np.ndarray) -> bytes:
        """The texts of `numbers`, one after the other."""
        if not len(numbers):
            return b""
        starts = self.offsets[numbers]
        sizes = self.offsets[numbers + 1] - starts
        ends = np.cumsum(sizes)
        places = np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])
        return self.buffer[places].tobytes()


class _Kept(dict):
    """Answers by text; emptied when full, so its memory is bounded."""

    def __init__(self, answer, limit: int):
        self.answer, self.limit = answer, limit

    def __missing__(self, text: str) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        tokens = self[text] = self.answer(text)
        return tokens


class Codec:
    """Encoder and decoder of one tokenizer file (BPE over bytes, with a word end).

    The file must have the shape of the public word-level vocabulary: NFC and
    lower case, a word pattern, byte letters, an end-of-word suffix, one merge
    per token in order of rank, and added tokens that are cut out of the text.
    """

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(merge) if isinstance(merge, list) else tuple(merge.split(" ")) for merge in model["merges"]]
        self.rank = {self.vocab[a + b]: rank for rank, (a, b) in enumerate(merges)}
        if len(self.rank) != len(merges):
            raise ValueError("two merges give the same token")
        self.parts = {self.vocab[a + b]: (self.vocab[a], self.vocab[b]) for a, b in merges}
        self.merged = {(self.vocab[a], self.vocab[b]): rank for rank, (a, b) in enumerate(merges)}
        self.pairs: dict[tuple[int, int], bool] = {}

        # Inside the automaton the last letter of a word is one letter with its suffix.
        self.letters = byte_letters()
        self.finals = [chr(ord(letter) + 0x1000) for letter in self.letters]
        bodies = {}
        for text, number in self.vocab.items():
            body = text.removesuffix(self.suffix)
            if body != text:
                body = body[:-1] + chr(ord(body[-1]) + 0x1000)
            bodies[body] = (number, len(body))
        self.automaton = ahocorasick.Automaton()
        self.shorter: dict[int, tuple[int, int] | None] = {}
        for body, token in bodies.items():
            self.automaton.add_word(body, token)
            starts = (bodies.get(body[:length]) for length in range(len(body) - 1, 0, -1))
            self.shorter[token[0]] = next((start for start in starts if start), None)
        self.automaton.make_automaton()

        self.added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.cut_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if pattern != WORD_PATTERN:
            raise ValueError(f"another word pattern: {pattern}")
        self.splitter = pre_tokenizers.Split(Regex(pattern), behavior="removed", invert=True)
        texts = {number: text for text, number in self.vocab.items()} | {n: t for t, n in self.added.items()}
        size = max(texts) + 1
        self.texts = OffsetTable([texts.get(n, "").encode() + b" " for n in range(size)])
        self.decimals = OffsetTable([b"%d " % n for n in range(size)])
        self.words = _Kept(self.encode_word, KEPT_WORDS)

    def fits(self, left: int, right: int) -> bool:
        """True if the texts of two tokens, joined, encode to these two tokens.

        The merges of both are undone from the last one back. If at some time the
        two tokens at the seam would have merged before the merge just undone,
        the pair is impossible.
        """
        answer = self.pairs.get((left, right))
        if answer is None:
            a, b, before = left, right, len(self.merged)
            answer = True
            while True:
                if self.merged.get((a, b), before) < before:
                    answer = False
                    break
                rank_a, rank_b = self.rank.get(a, -1), self.rank.get(b, -1)
                if rank_a < 0 and rank_b < 0:
                    break
                # Of equal pairs the left one merges first, so the right one is undone first.
                if rank_a > rank_b:
                    before, a = rank_a, self.parts[a][1]
                else:
                    before, b = rank_b + 1, self.parts[b][0]
            self.pairs[left, right] = answer
        return answer

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Tokens of one word of the pattern."""
        if word.isascii() and word.isprintable():
            text = word[:-1] + self.finals[ord(word[-1])]
        else:
            data = word.encode()
            text = "".join([self.letters[b] for b in data[:-1]]) + self.finals[data[-1]]
        size = len(text)
        longest = self.automaton.iter_long
        # The longest matches one after the other are the answer if all pairs fit.
        path = [number for _, (number, _) in longest(text)]
        pairs, fits = self.pairs, self.fits
        for pair in zip(path, path[1:]):
            if not (pairs[pair] if pair in pairs else fits(*pair)):
                break
        else:
            return tuple(path)
        dead = set()
        path, place = [], 0
        token: tuple[int, int] | None = next(longest(text, 0))[1]
        while place < size:
            while token is not None and (
                place + token[1] in dead or (path and not fits(path[-1][0], token[0]))
            ):
                token = self.shorter[token[0]]
            if token is not None:
                path.append(token)
                place += token[1]
                token = next(longest(text, place))[1] if place < size else None
            else:
                if not path:
                    raise ValueError(f"the vocabulary cannot spell {word!r}")
                dead.add(place)
                last = path.pop()
                place -= last[1]
                token = self.shorter[last[0]]
        return tuple([number for number, _ in path])

    def split(self, text: str) -> list[str]:
        """Normalised words of a text."""
        if _RARE.search(text):
            # Python's Unicode tables differ in age from those the file was made for.
            return [word for word, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))]
        return _PLAIN_WORDS.findall(text.lower())

    def encode(self, text: str) -> list[int]:
        """Tokens of a whole text."""
        if self.cut_added is not None and any(token in text for token in self.added):
            parts = self.cut_added.split(text)
            return [
                number
                for i, part in enumerate(parts)
                for number in ([self.added[part]] if i % 2 else self._encode_plain(part))
            ]
        return self._encode_plain(text)

    def _encode_plain(self, text: str) -> list[int]:
        known = self.words
        return list(chain.from_iterable([known[word] for word in self.split(text)]))

    def decode(self, numbers: np.ndarray) -> bytes:
        """Token texts with a blank between two; these files name no decoder."""
        return self.texts.join(numbers)[:-1]

    def spelled(self, numbers: np.ndarray) -> bytes:
        """The numbers in decimal with a blank between two."""
        return self.decimals.join(numbers)[:-1]


@lru_cache(maxsize=2)
def _codec(file: bytes) -> Codec:
    return Codec(file)


def tokenizer_file(docs: DataFrame, path: str) -> Broadcast:
    """The vocabulary file for all tasks; its size is fixed and checked."""
    with open(path, "rb") as source:
        file = source.read()
    if len(file) > 64 << 20:
        raise ValueError("a tokenizer file of more than 64 MB is not broadcast")
    return docs.sparkSession.sparkContext.broadcast(file)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, tokens): every whole text as an array of token numbers."""
    file = tokenizer_file(docs, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(file.value)
        for batch in batches:
            tokens = [codec.encode(text) for text in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tokens, pa.list_(pa.int32()))], ["doc_id", "tokens"]
            )

    return keyed(docs).select("doc_id", "_text").mapInArrow(encode, "doc_id long, tokens array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, tokens); null tokens give an empty text."""
    file = tokenizer_file(encoded, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(file.value)
        for batch in batches:
            texts = [codec.decode(np.array(x or [], np.int64)).decode() for x in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "tokens").mapInArrow(decode, "doc_id long, text string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, then decoded."""
    file = tokenizer_file(docs, path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(file.value)
        for batch in batches:
            rows = []
            for text in batch.column("_text").to_pylist():
                numbers = np.array(codec.encode(text), np.int64)
                ids, decoded = codec.spelled(numbers), codec.decode(numbers)
                rows.append((len(numbers), sha256(ids).hexdigest(), sha256(decoded).hexdigest()))
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            kinds = [pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return (
        keyed(docs)
        .select("doc_id", "_text")
        .mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    )
