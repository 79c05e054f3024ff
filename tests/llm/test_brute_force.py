"""Models, fingerprints and the pipeline against plain loops; hot ids and addresses."""

from __future__ import annotations

import base64
import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeloom.llm import fingerprints, phrase_dedup, quality_classifier, queries, substring_dedup, url_filter

LAST = (1 << 63) - 1
MASK = (1 << 64) - 1


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def chained(*values: bytes) -> int:
    """Spark's xxhash64 of several values: XXH64 whose seed is the hash so far."""
    seed = 42
    for value in values:
        seed = xxhash.xxh64_intdigest(value, seed)
    return signed(seed)


def split_words(text: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# Quality


def plain_quality(rows, labels):
    """(text -> score) with dictionaries of whole texts."""
    texts, known = {}, {}
    for doc, text in rows:
        if doc is not None:
            texts[doc] = min(texts.get(doc, text or ""), text or "")
    for doc, label in labels:
        known[doc] = min(known.get(doc, label), label)
    parts = {0: [], 1: []}
    calibration = []
    for doc in sorted(known.keys() & texts.keys()):
        body = texts[doc].encode()
        if chained(doc.to_bytes(8, "little", signed=True), b"part") % 4 == 0:
            calibration.append((body, known[doc]))
        elif 0 < len(body) <= 65536:
            parts[known[doc]].append(body)
    size = min(4 << 20, *(sum(map(len, part)) for part in parts.values()))
    bodies = []
    for label in (1, 0):
        out = b""
        for body in parts[label]:
            if len(out) + len(body) <= size:
                out += body
        bodies.append(out)

    def compressed(block, body):
        kind = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        kind.precompute_compress(level=6)
        maker = zstandard.ZstdCompressor(
            level=6, dict_data=kind, write_checksum=False, write_content_size=False, write_dict_id=False
        )
        return len(maker.compress(block))

    def difference(text):
        good, bad = (
            sum(compressed(text[i : i + 256], body) for i in range(0, len(text), 256)) for body in bodies
        )
        return (bad - good) / (bad + good) if text else 0.0

    slope, offset = quality_classifier.logistic(
        np.array([difference(body) for body, _ in calibration]), np.array([y for _, y in calibration], float)
    )
    return lambda text: 1 / (1 + math.exp(-(offset + slope * difference(text.encode()))))


def test_quality_scores_equal_a_plain_loop(spark, docs, words):
    rng = random.Random(3)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [
        (100 + i, " ".join(rng.choice(words[: 300] if i % 2 else words[200:500]) for _ in range(rng.randint(20, 90))))
        for i in range(60)
    ]
    labels = [(100 + i, i % 2) for i in range(60)] + [(8, 1), (101, 0), (7777, 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("quality", F.lit("clash"))
    known = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("clash"))
    known = known.unionByName(spark.createDataFrame([(None, 1, "x"), (104, None, "x")], known.schema))
    model = quality_classifier.fit(table, known)
    want = plain_quality(rows, labels)
    scores = quality_classifier.score_documents(table, model).collect()
    assert Counter((r.doc_id, round(r.score, 9)) for r in scores) == Counter(
        (doc, round(want(text or ""), 9)) for doc, text in rows
    )


def test_a_labelled_id_repeated_many_times_is_one_document(spark, words):
    rows = [(i, " ".join(words[i : i + 40])) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = once.unionByName(spark.createDataFrame([rows[3]] * 3000, once.schema))
    assert quality_classifier.fit(often, labels) == quality_classifier.fit(once, labels)


# Fingerprints


def plain_mix(value):
    value ^= value >> 32
    value = value * 0xD6E8FEB86659FD93 & MASK
    value ^= value >> 32
    value = value * 0xD6E8FEB86659FD93 & MASK
    return value ^ value >> 32


def plain_fingerprint(text):
    """Hashes of the chosen grams by hashing every gram and looking at every window."""
    size = min(10, len(text))
    base = 0x9E3779B97F4A7C15
    hashes = [
        plain_mix(sum(plain_mix(ord(c) + 1) * pow(base, k, 1 << 64) for k, c in enumerate(text[i : i + size])) & MASK)
        for i in range(len(text) - size + 1)
    ] if text else []
    window = min(32, len(hashes))
    places = {
        max(range(i, i + window), key=lambda place: (-hashes[place], place)) for i in range(len(hashes) - window + 1)
    } if hashes else set()
    return [(hashes[place] >> 32, place) for place in sorted(places)]


def plain_text(chosen):
    numbers = [h for h, _ in chosen] + [b - a for (_, a), (_, b) in zip([(0, 0), *chosen], chosen)]
    return base64.b64encode(np.array(numbers, "<u4").tobytes()).decode()


def plain_likeness(a, b):
    x, y = Counter(h for h, _ in a), Counter(h for h, _ in b)
    return 2 * sum((x & y).values()) / (len(a) + len(b)) if a or b else 1.0


@pytest.mark.parametrize("without_id", [0, 60])
def test_fingerprints_of_every_text(spark, docs, words, without_id):
    rows = [(r.doc_id, (r.text or "")[:900]) for r in docs.select("doc_id", "text").collect()]
    rows += [(None, " ".join(words[i : i + 25])) for i in range(without_id)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    ordered = sorted((LAST if d is None else d, chained(t.encode()), t, d) for d, t in rows)
    want = []
    for i, (_, _, text, doc) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][2]
        share = len(text) // 4
        edited = text[: len(text) - share] + after[:share]
        own, other, following = map(plain_fingerprint, (text, edited, after))
        want.append(
            (doc, len(text), digest(edited), plain_text(own), plain_text(other),
             plain_likeness(own, other), plain_likeness(own, following))
        )
    got = [tuple(r) for r in fingerprints.fingerprint_documents(table).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


# Rows without an id


def test_rows_without_an_id_are_spread(spark, words):
    rng = random.Random(8)
    passage = " ".join(rng.choice(words) for _ in range(80))
    texts = [" ".join(rng.choice(words) for _ in range(60)) + f" own{i} {passage}" for i in range(240)]
    rows = [(None if i % 3 == 0 else i, text) for i, text in enumerate(texts)] + [(None, texts[0])] * 40
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    placed = fingerprints.with_next(table).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in placed) < 120
    # The passage goes everywhere; in the first document that has it, the phrases stay.
    kept = phrase_dedup.drop_repeated_phrases(table).select("doc_id", "n_words", "n_removed").collect()
    assert all((r.n_removed == 0) == (r.doc_id == 1) for r in kept)
    assert all(r.n_removed == 80 for r in kept if r.doc_id != 1)
    size = len((" " + passage).encode())
    bytes_ = substring_dedup.drop_repeated_bytes(table).collect()
    whole = [r for r in bytes_ if r.n_removed == r.n_bytes]
    assert len(whole) == 41 and all(r.doc_id is None for r in whole)
    assert all(size <= r.n_removed <= size + 8 for r in bytes_ if r.n_removed != r.n_bytes)


# Addresses


def plain_verdicts(urls):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

    def ruled(url):
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
        host, path = found.groups() if found else ("", "")
        fits = [
            (len(name + start), verdict) for name, start, verdict in rules
            if (host == name or host.endswith("." + name)) and path.startswith(start)
        ]
        return max(fits)[1] if fits else None

    rows = Counter(urls)
    held = {url: chained(url.encode(), b"held") % 5 == 0 for url in rows}
    counts = {"allow": Counter(), "block": Counter()}

    def grams(url):
        padded = "\2" * 4 + url
        return [padded[i : i + 5] for i in range(len(url))]

    for url, times in rows.items():
        if ruled(url) and not held[url]:
            for full in grams(url):
                for size in range(1, 6):
                    counts[ruled(url)][full[5 - size :]] += times
    totals, kinds = defaultdict(Counter), defaultdict(Counter)
    for kind, found in counts.items():
        for gram, n in found.items():
            totals[kind][gram[:-1]] += n
            kinds[kind][gram[:-1]] += 1

    def share(kind, full):
        out = 1 / 256
        for size in range(1, 6):
            gram = full[5 - size :]
            total, different = totals[kind][gram[:-1]], kinds[kind][gram[:-1]]
            if total:
                out = (counts[kind][gram] + different * out) / (total + different)
        return out

    def score(url):
        ratios = [math.log(share("allow", full)) - math.log(share("block", full)) for full in grams(url)]
        return round(sum(ratios) / len(ratios), 9) if ratios else 0.0

    scores = {url: score(url) for url in rows}
    judged = [(math.floor(scores[u] * 100), ruled(u), rows[u]) for u in rows if held[u] and ruled(u)]
    of = {kind: sum(n for _, k, n in judged if k == kind) for kind in counts}
    best = None
    for step in sorted({s for s, _, _ in judged}):
        kept = sum(n for s, k, n in judged if k == "allow" and s >= step) / of["allow"]
        gone = sum(n for s, k, n in judged if k == "block" and s < step) / of["block"]
        if best is None or kept + gone > best[0] + 1e-12:
            best = kept + gone, step
    return {url: ruled(url) or ("allow" if scores[url] >= best[1] / 100 else "block") for url in rows}


def test_addresses_equal_a_plain_model(spark):
    rng = random.Random(4)
    good, bad = ["read", "book", "news", "town"], ["pills", "win", "cash", "news"]
    urls = []
    for i in range(150):
        urls.append(f"http://{rng.choice(good)}{i % 7}.example.net/en/{rng.choice(good)}?p={i}")
        urls.append(f"http://{rng.choice(bad)}{i % 5}.net/{rng.choice(bad)}#{i}")
        urls.append(f"https://{rng.choice(good + bad)}.info/{rng.choice(good + bad)}/{i % 40}")
    urls += ["https://common.info/cash"] * 200 + [None, "", "no scheme", "http://é日.info/ü"]
    pages = spark.createDataFrame([*enumerate(urls)], "page_id long, url string").withColumn("rows", F.lit("clash"))
    want = plain_verdicts([url or "" for url in urls])
    got = {r.page_id: r.verdict for r in url_filter.judge(pages).collect()}
    assert got == {i: want[url or ""] for i, url in enumerate(urls)}
    assert 20 < sum(verdict == "block" for url, verdict in want.items() if ".info" in url) < len(want) - 20


# The pipeline


def test_pipeline_on_a_small_folder(spark, words, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(6)
    shared = "A line that many of the documents hold, word for word"
    lines, sources, near = {}, {}, {}
    for i in range(120):
        base = [rng.choice(words) for _ in range(60)]
        for copy in range(3 if i % 10 == 0 else 1):
            doc = len(lines)
            body = [*base[:30], f"own{copy}", *base[31:]]
            lines[doc] = [" ".join(body)] + ([shared] if doc % 4 == 0 else [])
            sources[doc], near[doc] = "abc"[i % 3], i
    few, loop = len(lines), len(lines) + 1
    lines[few], lines[loop] = ["too few"], ["over and over and so on " * 12]
    sources[few] = sources[loop] = None
    docs = [(doc, "\n".join(part), sources[doc]) for doc, part in lines.items()]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    # Without a trusted document the base rules alone decide.
    spark.createDataFrame([(1, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")

    keeper = max(doc for doc in lines if shared in lines[doc])
    text = {doc: "\n".join(x for x in part if x != shared or doc == keeper) for doc, part in lines.items()}
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    copies = Counter(r.doc_id for r in rows)
    assert few not in copies and loop not in copies
    assert max(Counter(near[doc] for doc in copies).values()) == 1 and max(copies.values()) <= 3
    library = Tokenizer.from_file(queries.tokenizer_path())
    for r in rows:
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(r)[1:] == (len(ids), digest(" ".join(map(str, ids))), digest(decoded))
    # One of each class: sources hold 40 classes each and are mixed 5 : 2 : 1.
    taken = Counter()
    for doc, times in copies.items():
        taken[sources[doc]] += times * len(split_words(text[doc]))
    total = 120 * 60 + len(shared.split())
    for source, weight in zip("abc", (5, 2, 1), strict=True):
        assert abs(taken[source] - total * weight / 8) <= 150
