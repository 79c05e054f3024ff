"""Token alignment, language identification and fill-in-middle against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeloom.llm import fill_middle, language_id, queries, token_alignment

BYTE_PATH = queries.tokenizer_path("byte_bpe_50k.json")
PIECE_PATH = queries.tokenizer_path("piece_bpe_32k.model")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


# Token alignment


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    first = Tokenizer.from_file(BYTE_PATH)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=PIECE_PATH), decoders.ByteLevel()


def byte_letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def plain_tokens(text, libraries):
    """[(id, start, end)] of both tokenizers, or nothing if they spell another text."""
    first, second, _ = libraries
    letters = byte_letters()
    if not text:
        return [], []
    ids = first.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        hexed = re.fullmatch("<0x(..)>", piece)
        b.append((i, bytes([int(hexed[1], 16)]) if hexed else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return [], []
    out = []
    for side in (a, b):
        place, spans = 0, []
        for i, body in side:
            spans.append((i, place, place + len(body)))
            place += len(body)
        out.append(spans)
    return out


def plain_report(texts, libraries):
    tokens = [(doc, *plain_tokens(text, libraries)) for doc, text in texts]
    counts = Counter((x[0], y[0]) for _, a, b in tokens for x, y in same_end(a, b))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    rows = []
    for doc, a, b in tokens:
        links = same_end(a, b)
        both = {end for _, _, end in a} & {end for _, _, end in b}
        halves = [[], []]
        for half, side in zip(halves, (a, b)):
            part = []
            for i, _, end in side:
                part.append(str(i))
                if end in both:
                    half.append(",".join(part))
                    part = []
        groups = [f"{left}|{right}" for left, right in zip(*halves)]
        numbers = [counts[x[0], y[0]] for x, y in links]
        best = sum(n == top[y[0]] for n, (_, y) in zip(numbers, links))
        rows.append((doc, len(a), len(b), len(groups), len(links), best, sum(numbers), digest(";".join(groups)) if a else ""))
    return rows


def same_end(a, b):
    by_end = {y[2]: y for y in b}
    return [(x, by_end[x[2]]) for x in a if x[2] in by_end]


ODD = [
    "<|endoftext|> and <s> in a text </s>", "▁ is a blank for one", "tab\tand\0null", "  two  blanks  ", "日本語 の テスト 🙂🙂 é́",
    "x" * 900, "ÀÉÎ don't we'll 12345 !!??", " \u0085\xa0 odd spaces", "𝔘𝔫𝔦 ꙮ ᚠᛇᚻ", "\n", " ",
]


@pytest.fixture(scope="module")
def mixed(spark, docs):
    extra = spark.createDataFrame([(500 + i, text) for i, text in enumerate(ODD)], "doc_id long, text string")
    return docs.unionByName(extra, allowMissingColumns=True)


@pytest.mark.parametrize("frequent", [1 << 18, 40, 0])
def test_alignment_report(mixed, libraries, frequent):
    texts = [(r.doc_id, r.text) for r in mixed.select("doc_id", "text").collect()]
    got = token_alignment.link_report(mixed, BYTE_PATH, PIECE_PATH, frequent_pairs=frequent).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
    assert ordered(got.collect()) == ordered(plain_report(texts, libraries))


def test_links_of_every_kind(mixed, libraries):
    texts = [(r.doc_id, r.text) for r in mixed.filter("doc_id is not null").select("doc_id", "text").distinct().collect()]
    docs = mixed.filter("doc_id is not null").dropDuplicates(["doc_id", "text"])
    want = defaultdict(list)
    for doc, text in texts:
        a, b = plain_tokens(text, libraries)
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        if sum(map(len, (a, b))) > 500:
            continue
        group = lambda token: np.searchsorted(ends, token[2])
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                shared = max(0, min(x[2], y[2]) - max(x[1], y[1]))
                row = (doc, i, j, x[0], y[0], shared)
                if shared:
                    want["overlap"].append(row)
                if x[2] == y[2]:
                    want["end"].append(row)
                if group(x) == group(y):
                    want["group"].append(row)
    small = {row[0] for row in want["end"]}
    for kind in ("overlap", "end", "group"):
        got = token_alignment.token_links(docs, BYTE_PATH, PIECE_PATH, kind).collect()
        assert ordered(r for r in got if r.doc_id in small) == ordered(want[kind])
    with pytest.raises(ValueError):
        token_alignment.token_links(docs, BYTE_PATH, PIECE_PATH, "near")


def test_aligned_tokens_and_groups(mixed, libraries):
    for row in token_alignment.align_documents(mixed, BYTE_PATH, PIECE_PATH).collect():
        assert len(row.a_ids) == len(row.a_group) and len(row.b_ids) == len(row.b_group)
        assert sorted(set(row.a_group)) == sorted(set(row.b_group)) == [*range(len(set(row.a_group)))]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 6), max_size=40), st.data())
def test_products_equal_dense_ones(sizes, data):
    total = sum(sizes)
    cuts = sorted(data.draw(st.sets(st.integers(1, max(total - 1, 1)), max_size=20)) - {total}) if total > 1 else []
    other = np.diff([0, *cuts, total]) if total else np.zeros(0, int)
    found = token_alignment.Alignment(np.array(sizes, int), other)
    dense = lambda m: np.array([np.bincount(m.rows(i, i + 1).columns, minlength=m.width) for i in range(m.height)]).reshape(m.height, m.width)
    product = dense(found.a) @ dense(found.b).T
    rebuilt = np.zeros_like(product)
    rebuilt[found.over_a, found.over_b] = found.shared
    assert np.array_equal(product, rebuilt)
    grouped = np.zeros_like(product)
    old, token_alignment.BLOCK_ENTRIES = token_alignment.BLOCK_ENTRIES, 7
    try:
        for a, b, _ in found.group_links():
            grouped[a, b] += 1
    finally:
        token_alignment.BLOCK_ENTRIES = old
    assert np.array_equal(grouped, (found.a_group[:, None] == found.b_group[None, :]).astype(int))


def test_unsorted_products_are_added_up():
    rng = np.random.default_rng(3)
    left, right = rng.integers(0, 3, (9, 12)), rng.integers(0, 3, (12, 7))

    def sparse(matrix):
        rows, columns = np.nonzero(matrix)
        starts = np.concatenate(([0], np.cumsum(np.count_nonzero(matrix, axis=1))))
        return token_alignment.Csr(starts, columns, matrix[rows, columns], matrix.shape[1])

    rows, columns, values = sparse(left).times(sparse(right))
    out = np.zeros((9, 7), int)
    out[rows, columns] = values
    assert np.array_equal(out, left @ right)


def test_quick_encoding_equals_the_library(libraries):
    with open(BYTE_PATH, "rb") as a, open(PIECE_PATH, "rb") as b:
        pair = token_alignment.TokenizerPair(a.read(), b.read())
    assert pair.quick is not None
    chars = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), 0x20AC]]
    rng = random.Random(1)
    texts = [f"a{c}b {c}{c} 1{c}'s{c}" for c in chars]
    texts += ["".join(rng.choice(chars) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    for text in texts:
        assert not token_alignment._RARE.search(text)
        assert pair.encode_bytes(text) == libraries[0].encode(" " + text, add_special_tokens=False).ids


# Language


def plain_language(text, model, level=language_id.LEVEL):
    body = " ".join(re.findall(r"[^\W\d_]+", (text or "").lower()))
    if not body:
        return "und", 0.0
    body, sizes = f" {body} ".encode(), []
    for _, words in model:
        shared = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        size = 0
        for i in range(0, len(body), 512):
            # One compressor for each block: nothing may be carried from block to block.
            packer = zstandard.ZstdCompressor(
                level=level, dict_data=shared, write_checksum=False, write_content_size=False, write_dict_id=False
            )
            size += len(packer.compress(body[i : i + 512]))
        sizes.append(size)
    least, second = sorted(sizes)[:2]
    return model[sizes.index(least)][0], 1 - least / second


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(4)
    sounds = {"aa": "ka ti mo".split(), "bb": "ßen üch rö".split(), "cc": "que ció ñon".split()}
    rows = []
    for i in range(300):
        lang = ("aa", "bb", "cc")[i % 3]
        words = ["".join(rng.choices(sounds[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(2, 80))]
        rows.append((i, " ".join(words).capitalize() + ".", lang if i % 7 else None, "x"))
    rows += [(900, None, "aa", "x"), (901, "", "bb", "x"), (902, "12 !! ́", "cc", "x"), (None, "kati", "aa", "x")]
    rows += [(903, "x" * 70000, "dd", "x"), rows[5], (905, " ".join(["Rö"] * 30000), None, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, _letters string").repartition(3)


def test_language_of_every_text(tongues):
    model = language_id.fit(tongues.filter("doc_id % 2 = 0"), sample_rows=20)
    # A language with oversized texts only is not learned.
    assert sorted(name for name, _ in model) == ["aa", "bb", "cc"]
    got = language_id.predict(tongues, model).collect()
    texts = tongues.select("doc_id", "text").collect()
    want = [(r.doc_id, *plain_language(r.text, model)) for r in texts]
    assert ordered((r.doc_id, r.lang_pred, round(r.score, 12)) for r in got) == ordered(
        (doc, lang, round(score, 12)) for doc, lang, score in want
    )
    truth = {r.doc_id: r.lang for r in tongues.collect()}
    held = [r for r in got if r.doc_id is not None and r.doc_id < 300 and r.doc_id % 2 and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(r.accepted == (r.lang_pred != "und" and r.score >= language_id.MARGIN) for r in got)


def test_dictionaries_hold_whole_texts(spark):
    rows = [(i, chr(97 + i % 26) * (10 + i), "zz") for i in range(50)] + [(7, "a" * 17, "zz")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ((_, body),) = language_id.fit(docs, sample_rows=30, dictionary_bytes=600)
    bodies = {row[1] for row in rows}
    assert body and len(body) <= 600 and set(body.decode().split()) <= bodies


def test_language_without_anything_to_learn(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b", None), (2, None, "aa"), (3, "12", "aa")], "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op12_language_id(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.lang_pred, r.score, r.accepted) for r in rows) == [(i, "und", 0.0, False) for i in (1, 2, 3)]
    assert language_id.predict(docs.limit(0), language_id.fit(docs.limit(0))).count() == 0
    one = language_id.fit(spark.createDataFrame([(1, "ab cd", "aa")], docs.schema))
    assert {r.lang_pred: r.score for r in language_id.predict(docs.filter("doc_id = 1"), one).collect()} == {"aa": 1.0}


def test_languages_are_held_out(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: (r.lang, r.text) for r in queries.table(spark, folder, "documents").collect()}
    rows = queries.op12_language_id(spark, folder).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in held) >= 0.97 * len(held)
    # Hardly anything of more than some words is taken for another language or rejected.
    long = [r for r in held if len(truth[r.doc_id][1]) >= 100]
    assert sum(r.lang_pred == truth[r.doc_id][0] and r.accepted for r in long) >= 0.98 * len(long)


# Fill in the middle


@settings(deadline=None, max_examples=60)
@given(
    st.lists(st.tuples(st.integers(0, 5), st.integers(0, 65535), st.integers(1, 9000), st.integers(1, 3)), max_size=6)
)
def test_boundary_set_selects(blocks):
    values = sorted({(k << 16) + v for k, low, n, step in blocks for v in range(low, min(65536, low + n * step), step)})
    found = fill_middle.BoundarySet(np.array(values, np.int64))
    assert len(found) == len(values)
    for rank in {0, 1, len(values) // 3, len(values) // 2, len(values) - 1} & set(range(len(values))):
        assert found.select(rank) == values[rank]
    for rank in (-1, len(values)):
        with pytest.raises(IndexError):
            found.select(rank)


@pytest.mark.parametrize(
    "values, kind",
    [
        (np.arange(0, 65536, 500), fill_middle.ArrayContainer),
        (np.arange(0, 65536, 3), fill_middle.BitmapContainer),
        (np.arange(200, 60000), fill_middle.RunContainer),
    ],
)
def test_every_container_is_used(values, kind):
    made = fill_middle.container(values)
    assert isinstance(made, kind)
    assert [made.select(rank) for rank in range(0, len(values), 97)] == values[::97].tolist()


def plain_fim(doc, text, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc, len(units), "plain", None, None, text
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < spm_rate:
        return doc, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate, spm_rate", [(100, 50), (40, 100), (100, 0)])
def test_fill_middle(spark, docs, rate, spm_rate):
    rng = random.Random(2)
    more = ["\n" * 70000, "a<P>b\nc", "<\n<S\n<M\nx" * 3, "\r\n\r\n", "é\n日本\nend", "\n", "x\n\ny"]
    more += ["".join(rng.choice("ab<PSM>\n\n\né") for _ in range(200_000))]
    more += ["".join(rng.choice("ab<\né") for _ in range(rng.randint(1, 400))) for _ in range(60)]
    extra = spark.createDataFrame([(700 + i, text) for i, text in enumerate(more)], "doc_id long, text string")
    every = docs.unionByName(extra, allowMissingColumns=True)
    want = [plain_fim(r.doc_id, r.text, rate, spm_rate) for r in every.select("doc_id", "text").collect()]
    done = fill_middle.transform_documents(every, rate=rate, spm_rate=spm_rate)
    assert ordered(done.collect()) == ordered(want)
    back = fill_middle.restore_documents(done).collect()
    assert ordered(back) == ordered((r.doc_id, r.text or "") for r in every.select("doc_id", "text").collect())


def test_fill_middle_digests(docs):
    want = []
    for row in docs.select("doc_id", "text").collect():
        *facts, output = plain_fim(row.doc_id, row.text)
        want.append((*facts, digest(output), digest(row.text or "")))
    assert ordered(fill_middle.transform_digests(docs).collect()) == ordered(want)


def test_empty_tables_stay_empty(empty, spark):
    assert fill_middle.transform_digests(empty).collect() == []
    assert token_alignment.link_report(empty, BYTE_PATH, PIECE_PATH).collect() == []
    assert token_alignment.token_links(empty, BYTE_PATH, PIECE_PATH).collect() == []
