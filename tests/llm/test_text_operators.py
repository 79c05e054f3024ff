"""The text operators against brute force on a small table of awkward cases."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeloom.llm import (
    bpe,
    fingerprints,
    jaccard_join,
    line_dedup,
    phrase_dedup,
    quality_classifier,
    quality_rules,
    queries,
    source_mixing,
    substring_dedup,
    url_filter,
)
from gaugeloom.llm.hashing import rightmost_minima

SPACE = " \t\n\v\f\r"
LAST = (1 << 63) - 1


def digest(text: str | bytes) -> str:
    return sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def split_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collected(docs):
    return [(LAST if r.doc_id is None else r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def multiset(rows):
    return sorted(map(tuple, rows), key=str)


# Tokens


def test_tokens_equal_the_library(docs, spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    want = []
    for row in docs.select("doc_id", "text").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        want.append(
            (row.doc_id, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)))
        )
    got = bpe.token_digests(docs, queries.tokenizer_path()).collect()
    assert multiset(got) == multiset(want)


def test_tokens_decode_to_the_normal_form(spark):
    docs = spark.createDataFrame([(1, "The cat's 12 mats."), (2, None)], "doc_id long, text string")
    path = queries.tokenizer_path()
    back = {r.doc_id: r.text for r in bpe.decode_documents(bpe.encode_documents(docs, path), path).collect()}
    assert back[2] == ""
    assert back[1].replace("</w> ", " ").replace("</w>", "") == "the cat 's 1 2 mats ."


# Quality


def test_scores_part_two_kinds_of_text(spark, words):
    rows = [(i, " ".join(words[i : i + 60]) if i % 2 else "!! ".join(words[i : i + 60]).upper(), i % 2) for i in range(400)]
    docs = spark.createDataFrame([(i, text) for i, text, _ in rows] + [(1000, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, _, label in rows if i % 4 < 2], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels, 100)
    scores = {r.doc_id: r.score for r in quality_classifier.score_documents(docs, model).collect()}
    right = sum((scores[i] >= 0.5) == bool(label) for i, _, label in rows if i % 4 >= 2)
    assert right >= 190 and all(0 <= s <= 1 for s in scores.values())
    with pytest.raises(ValueError):
        quality_classifier.fit(docs, labels.filter("quality = 1"))


@pytest.mark.parametrize(
    "texts, labels",
    [([], []), ([], [(0, 0), (3, 1)]), (["a b", None, "c"], []), (["a b", None, "c"], [(i, 1) for i in range(3)]), (["", None], [(0, 0), (1, 1)])],
)
def test_scores_without_a_sample_of_both_classes(spark, tmp_path, texts, labels):
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = queries.op2_quality_classifier(spark, str(tmp_path))
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    assert sorted((r.doc_id, r.score) for r in rows.collect()) == [(i, 0.5) for i in range(len(texts))]


# Repeated bytes and phrases


def removed_bytes(rows, length):
    counts = Counter(x[i : i + length] for _, t in rows for x in [t.encode()] for i in range(len(x) - length + 1))
    out = []
    for doc, text in rows:
        body = text.encode()
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            if counts[body[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        out.append((doc, len(body), sum(gone), sum(1 for run in bytes(gone).split(b"\0") if run), digest(kept)))
    return out


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeated_bytes(docs, hot):
    want = removed_bytes(collected(docs), 160)
    got = substring_dedup.drop_repeated_bytes(docs.fillna(LAST, ["doc_id"]), 160, hot).drop("kept").collect()
    assert multiset(got) == multiset(want)


def test_difference_cover_and_suffix_order():
    cover = substring_dedup.difference_cover(64)
    assert {(a - b) % 64 for a in cover for b in cover} == set(range(64))
    rng = np.random.default_rng(3)
    piece = rng.integers(97, 99, 700).astype(np.uint8).tobytes()
    body = piece + rng.integers(97, 99, 300).astype(np.uint8).tobytes() + piece * 2
    text = np.zeros(len(body) + 1100, np.uint8)
    text[: len(body)] = np.frombuffer(body, np.uint8)
    starts = np.arange(len(body) - 400)
    for order, _ in substring_dedup.sorted_buckets(text, starts, len(body), 400):
        heads = [body[i : i + 400] for i in order]
        assert heads == sorted(heads)


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeated_phrases(docs, hot):
    rows = collected(docs)
    first = {}
    for doc, text in rows:
        words = split_words(text)
        for i in range(len(words) - 12):
            key = tuple(words[i : i + 13])
            first[key] = min(first.get(key, doc), doc)
    want = []
    for doc, text in rows:
        words = split_words(text)
        gone = [0] * len(words)
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] < doc:
                gone[i : i + 13] = [1] * 13
        kept = [word for word, g in zip(words, gone, strict=True) if not g]
        want.append((doc, len(words), sum(gone), digest(" ".join(kept))))
    got = phrase_dedup.drop_repeated_phrases(docs.fillna(LAST, ["doc_id"]), hot=hot).drop("kept").collect()
    assert multiset(got) == multiset(want)


# Fingerprints


def test_minimum_is_rightmost():
    hashes = np.array([5, 1, 1, 7, 9, 1], np.uint64) << np.uint64(40)
    assert rightmost_minima(hashes, 3).tolist() == [2, 2, 2, 5]


def test_fingerprints(docs):
    rows = sorted(collected(docs))
    got = defaultdict(list)
    for r in fingerprints.fingerprint_documents(docs).collect():
        got[LAST if r.doc_id is None else r.doc_id].append(r)
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        share = len(text) // 4
        edited = text[: len(text) - share] + following[:share]
        assert any(
            r.n_chars == len(text)
            and r.edited_sha256 == digest(edited)
            and r.fingerprint == fingerprints.written(*fingerprints.chosen_grams(text))
            and r.edited_fingerprint == fingerprints.written(*fingerprints.chosen_grams(edited))
            and 0 <= r.near_next <= 1
            for r in got[doc]
        )
    hashes, places = fingerprints.chosen_grams(rows[8][1])
    back = fingerprints.read(fingerprints.written(hashes, places))
    assert (back[0] == hashes).all() and (back[1] == places).all()
    assert np.diff(places.astype(int)).max() <= fingerprints.WINDOW
    assert fingerprints.likeness(np.sort(hashes), np.sort(hashes)) == 1.0


# Lines


def line_truth(rows):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in text.split("\n"):
            key = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))
            if len(key) >= 20:
                holders[key].add(doc)
    out = []
    for doc, text in rows:
        lines = text.split("\n")
        kept = []
        for line in lines:
            found = holders.get(re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE)), ())
            if not (len(found) >= 3 and doc < max(found)):
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), digest("\n".join(kept))))
    return out


def test_lines(docs):
    want = line_truth(collected(docs))
    assert sum(row[2] for row in want) > 0
    assert multiset(line_dedup.line_digests(docs.fillna(LAST, ["doc_id"])).collect()) == multiset(want)
    cut = line_dedup.drop_lines(docs)
    assert cut.columns == docs.columns
    assert sorted(digest(r.text or "") for r in cut.collect()) == sorted(row[3] for row in want)


def test_a_line_over_many_partitions(spark):
    rows = [(i, "the same line in many documents\n" + f"own {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r.n_dropped for r in line_dedup.line_digests(docs).collect()}
    assert got.pop(399) == 0 and set(got.values()) == {1}


# Near duplicates


@pytest.mark.parametrize("split", [400, 3])
def test_near_duplicates(docs, split):
    # Rows that repeat an id and text are told apart by their place here.
    rows = collected(docs)
    sets = []
    for _, text in rows:
        words = split_words(text)
        sets.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))})
    linked = defaultdict(set)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            if i != j and x and y and 5 * len(x & y) >= 4 * len(x | y):
                linked[i].add(j)
    label = [doc for doc, _ in rows]
    while True:
        new = [min([label[i], *(label[j] for j in linked[i])]) for i in range(len(rows))]
        if new == label:
            break
        label = new
    want = sorted(
        (rows[i][0], label[i], len(linked[i]), len({frozenset(sets[j]) for j in linked[i]} - {frozenset(sets[i])}))
        for i in range(len(rows))
    )
    got = jaccard_join.near_duplicates(docs, split).select("_doc", "class_id", "n_links", "n_linked_texts").collect()
    assert sorted(map(tuple, got)) == want
    if split == 400:
        one = jaccard_join.one_of_each(docs)
        # Texts without words stay all; of the others one for each class.
        classes = {label[i] for i in range(len(rows)) if sets[i]}
        assert one.columns == docs.columns
        assert one.count() == len(classes) + sum(not x for x in sets)


# Mixing


def test_mix(docs):
    report = source_mixing.mix_report(docs).collect()
    assert len(report) == docs.count()
    by_source = defaultdict(list)
    for r in report:
        by_source[r.source_size, r.target].append(r)
        assert r.copies <= 3 and r.taken == r.size * r.copies
    total = sum(r.size for r in report)
    assert abs(sum(target for _, target in by_source) - total) < 1e-6 * total
    for (size, target), rows in by_source.items():
        assert target <= 3 * size + 1e-9
        assert abs(sum(r.taken for r in rows) - target) <= 2 * max([r.size for r in rows], default=0)
    mix = source_mixing.mix_documents(docs)
    assert mix.columns == docs.columns
    assert mix.count() == sum(r.copies for r in report)
    assert multiset(report) == multiset(source_mixing.mix_report(docs).collect())


def test_repeated_rows_get_the_drawn_copies(spark):
    rows = [(7, "same words here", "a", 0)] * 1000 + [(None, "lost id", "b", i) for i in range(90)]
    rows += [(7, "same words here", "b", 0)] * 30 + [(i, f"one of many {i}", "c", i) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other int")
    drawn, weights = Counter(), (1, 9, 40)
    for r in source_mixing.copies(docs, weights).collect():
        drawn[r._source, r.doc_id] += r.copies
    mix = [tuple(r) for r in source_mixing.mix_documents(docs, weights).collect()]
    assert 0 < drawn["a", 7] < 1000
    assert Counter((source, doc) for doc, _, source, _ in mix) == +drawn
    counts = [count for row, count in Counter(mix).items() if row[0] is None]
    assert max(counts) - (min(counts) if len(counts) == 90 else 0) <= 1


# Addresses


def test_addresses(spark):
    urls = [
        None, "no scheme/here", "http://A.Example.NET/en/1?q#f", "https://example.net/de/1", "ftp://x.net",
        "https://example.com/de/", "http://w.example.com/de", "http://a.org/fr/?x", "http://notnet/",
        "http://net/", "http://b.org?x/fr/", "http://c.example.com#/de/", "http://net/",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert len(got) == len(urls)
    assert got[0][:3] == ("", "", None) and got[1][:3] == ("", "", None)
    assert got[2] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3] == ("example.net", "/de/1", "net/", "block")
    assert got[4][:3] == ("x.net", "", None)
    assert got[5] == ("example.com", "/de/", "example.com/de/", "block")
    assert got[6][2] is None and got[7] == ("a.org", "/fr/", "org/fr/", "allow")
    assert got[8][2] is None and got[9][2:] == ("net/", "block")
    assert got[10][:3] == ("b.org", "", None) and got[11][:3] == ("c.example.com", "", None)
    assert {row[3] for row in got.values()} == {"allow", "block"}


def test_address_model(spark):
    rows = [(f"good{i % 97}site.org/page/{i}", 1, 0) for i in range(300)]
    rows += [(f"cheap{i % 89}pills.com/buy/{i}", 0, 1) for i in range(300)]
    examples = spark.createDataFrame(rows, "text string, allow long, block long")
    unknown = spark.createDataFrame([("good5site.org/page/77",), ("cheap3pills.com/buy/5",)], "text string")
    places = unknown.select("text", F.explode(url_filter.grams_of(F.col("text"))).alias("full"))
    ratios = url_filter.gram_scores(places.select("full").distinct(), url_filter.model_counts(examples))
    scores = {r[0]: r[1] for r in places.join(ratios, "full").groupBy("text").agg(F.avg("ratio")).collect()}
    assert scores["good5site.org/page/77"] > 0.5 > -0.5 > scores["cheap3pills.com/buy/5"]


def test_model_reads_whole_addresses(spark):
    urls = [f"http://n{i % 9}.example.net/en/{i}?article=library&page={i}#reading" for i in range(300)]
    urls += [f"http://n{i % 9}.example.net/xx/{i}?buy=cheap-pills&win={i}#casino" for i in range(300)]
    unknown = [
        "http://some.info/a?article=library&page=7#reading", "http://some.info/a?buy=cheap-pills&win=7#casino",
        "http://some.info/a#" + "?article=library&page=7#reading" * 4, "http://some.info/a#" + "?buy=cheap-pills&win=7#casino" * 4,
        "article=library&page=9#reading", "buy=cheap-pills&win=9#casino",
    ]
    pages = spark.createDataFrame(list(enumerate(unknown + urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert [got[i][3] for i in range(len(unknown))] == ["allow", "block"] * 3, got
    assert {got[i][:3] for i in range(4)} == {("some.info", "/a", None)}
    assert got[4][:3] == got[5][:3] == ("", "", None)


# Rules


def rule_truth(text):
    text = text or ""
    words = split_words(text)
    lines = [line for line in text.split("\n") if split_words(line)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = [0] * len(words)
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered[i : i + 5] = [1] * 5
    failed = len(words) < 10 or 100 * sum(covered) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), sum(covered), failed


def test_rules(spark, docs, words):
    labels = spark.createDataFrame([(i, 1) for i in range(8, 25)] + [(None, 1), (3, 0)], "doc_id long, quality int")
    rows = quality_rules.rule_report(docs, labels).collect()
    texts = defaultdict(list)
    for row in docs.select("doc_id", "text").collect():
        texts[row.doc_id].append(row.text)
    assert len(rows) == docs.count()
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got in [rule_truth(text) for text in texts[r.doc_id]]
        assert not (r.base_failed and r.kept)
    kept = quality_rules.keep_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)


def test_ratio_equals_counting(spark):
    import xxhash

    # Spark's xxhash64 is XXH64 with seed 42 on each value, chained.
    def grams(text):
        words = [word.encode() for word in split_words(text)]
        def signed(n):
            return n - (1 << 64) if n >> 63 else n
        def pair_bucket(a, b):
            first = xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)
            return signed(xxhash.xxh64_intdigest(b.to_bytes(8, "little"), first)) % quality_rules.BUCKETS
        ones = [signed(xxhash.xxh64_intdigest(word, 42)) % quality_rules.BUCKETS for word in words]
        pairs = [
            pair_bucket(*(xxhash.xxh64_intdigest(word, 42) for word in pair)) for pair in zip(words, words[1:])
        ]
        return ones + pairs

    docs = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None), (4, "word")], "doc_id long, text string")
    rows = docs.select("text", quality_rules.words_of(F.coalesce("text", F.lit(""))).alias("_words"))
    rows = rows.select("text", quality_rules.word_hashes().alias("_hashes"))
    for row in rows.select("text", quality_rules.gram_buckets().alias("grams")).collect():
        assert row.grams == grams(row.text)

    # The verdicts by counting, whatever way the rows are dealt.
    rng = np.random.default_rng(5)
    common, odd = [f"w{i}" for i in range(60)], [f"x{i}" for i in range(60)]
    texts = []
    for i in range(240):
        share = (i % 12) / 11 if i >= 120 else 0.1
        texts.append(" ".join(rng.choice(odd if rng.random() < share else common) for _ in range(rng.integers(8, 40))))
    rows = [*enumerate(texts), (None, texts[0]), (3, texts[3]), (3, texts[200])]
    trusted = [*range(120)]
    fold = {}
    for i in trusted:
        order = xxhash.xxh64_intdigest(b"trusted", xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42))
        fold[i] = order % 4 > 0
    raw, good = Counter(), Counter()
    for i, text in rows:
        raw.update(grams(text))
        if fold.get(i):
            good.update(grams(text))
    size = quality_rules.BUCKETS
    total = [sum(c.values()) + size / 2 for c in (good, raw)]
    def score(text):
        found = [np.log((good[g] + 0.5) / total[0]) - np.log((raw[g] + 0.5) / total[1]) for g in grams(text)]
        return float(np.mean(found)) if found else 0.0
    held = {}
    for i, text in rows:
        if fold.get(i) is False and len(split_words(text)) >= 10:
            held[i] = min(held.get(i, 9.9), score(text))
    cut = sorted(held.values())[int(np.ceil(0.005 * len(held))) - 1]
    want = [(i, score(text) >= cut - 1e-6 and not rule_truth(text)[-1]) for i, text in rows]
    labels = spark.createDataFrame([(i, 1) for i in trusted], "doc_id long, quality int")
    for parts in (1, 7):
        dealt = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = quality_rules.rule_report(dealt, labels).select("doc_id", "kept").collect()
        assert multiset(got) == multiset(want)
    assert 120 < sum(kept for _, kept in want) < 240


# Empty tables


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    pages = spark.createDataFrame([], "page_id long, url string")
    path = queries.tokenizer_path()
    assert bpe.token_digests(empty, path).count() == 0
    assert substring_dedup.drop_repeated_bytes(empty).count() == 0
    assert phrase_dedup.drop_repeated_phrases(empty).count() == 0
    assert fingerprints.fingerprint_documents(empty).count() == 0
    assert line_dedup.line_digests(empty).count() == 0
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert source_mixing.mix_report(empty).count() == 0
    assert source_mixing.mix_documents(empty).count() == 0
    assert url_filter.judge(pages).count() == 0
    assert quality_rules.rule_report(empty, labels).count() == 0
