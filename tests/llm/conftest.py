"""A small table with every awkward case, and helpers."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, source string, _row string, anchor int, size string, `odd.name` string"


def rows_with(texts, sources=None):
    """Rows (doc_id, text, ...) with clashing further columns."""
    return [
        (i, text, (sources[i % len(sources)] if sources else f"s{i % 3}"), "x", None, "big", "dot")
        for i, text in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäé") for _ in range(rng.randint(1, 8))) for _ in range(3000)]


@pytest.fixture(scope="session")
def texts(words):
    """Nulls, empty, blank, long, repeated, near and overlapping texts."""
    rng = random.Random(9)

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(n))

    passage = prose(90)
    long = prose(6000)
    base = prose(200)
    near = [" ".join(base.split()[:k] + [f"new{k}"] + base.split()[k + 1 :]) for k in range(5, 185, 15)]
    return [
        None, "", "   \n\t ", "one", "four words are here", "tie " * 300, "a" * 3000, "a" * 3000,
        long, long, prose(40) + passage + prose(30), passage, prose(10) + "\n" + passage + "\n" + prose(10),
        base, base, *near, "Shared line of more than twenty\nown one", " shared LINE of more than twenty \nx\n",
        "shared line of more than twenty\nshared line of more than twenty", "short\nshort\nshort", None,
        prose(3) + " It's 12 ok!! ÀÉ Σ " + "é 日本語 <|endoftext|> x",
    ]


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = rows_with(texts)
    # A null id, and a row that repeats another one.
    rows.append((None, texts[11], None, None, 1, None, None))
    rows.append(rows[13])
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
