from __future__ import annotations

import ast

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugeloom.functions.payload import parse_payload
from gaugeloom.schema import Mode


def parsed(spark, texts, mode, strict=True):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, data string")
    rows = table.select("i", parse_payload(F.col("data"), mode, strict=strict).alias("p"))
    return [
        None if row.p is None else [(entry.feature, entry.value) for entry in row.p]
        for row in rows.orderBy("i").collect()
    ]


def test_legacy_reads_both_text_forms(spark):
    expected = [("rpm", "1480.25"), ("load", "61")]
    assert parsed(
        spark,
        [
            "{u'rpm':u'1480.25',u'load':u'61'}",
            "{u'rpm': u'1480.25', u'load': u'61'}",
            '{"rpm":"1480.25","load":"61"}',
        ],
        Mode.LEGACY,
    ) == [expected] * 3


def test_legacy_quirks(spark):
    assert parsed(
        spark,
        [
            '{"a":"1","b":2}',  # the first pair decides how all are sliced
            '{"t": 12.5}',
            '{"a":"x:y"}',
            '{"a":"1","b":"x:y"}',
            "{u'a':u'1',u'a':u'2',u'b':u'3'}",
            "rebooting",
            "{",
            "",
            None,
            "{}",
        ],
        Mode.LEGACY,
    ) == [
        [("a", "1"), ("b", "")],
        [],
        [],
        [],
        [("a", "2"), ("b", "3")],
        [],
        [],
        [],
        [],
        [],
    ]


def test_corrected_reads_json_and_flat_literals(spark):
    assert parsed(
        spark,
        [
            '{"door": "open: both", "rpm": 1480.25}',
            "{u'door': u'open: both', 'n': 3, u'none': None, 'yes': True,}",
            '{"a": 1, "b": 2, "a": 3}',
            '{"t": true, "f": false, "text": "true", "none": null}',
            '{"a": NaN, "b": Infinity, "c": -Infinity, "d": 1.50, "e": 1e5}',
            "{}",
            ' {"a": 1} ',
        ],
        Mode.CORRECTED,
    ) == [
        [("door", "open: both"), ("rpm", "1480.25")],
        [("door", "open: both"), ("n", "3"), ("none", "None"), ("yes", "True")],
        [("a", "3"), ("b", "2")],
        [("t", "True"), ("f", "False"), ("text", "true"), ("none", "None")],
        [("a", "nan"), ("b", "inf"), ("c", "-inf"), ("d", "1.5"), ("e", "100000.0")],
        [],
        [("a", "1")],
    ]


def test_corrected_reads_literals_piece_by_piece(spark):
    assert parsed(
        spark,
        [
            "{u'a': u'x, u', u'b': u'1'}",
            "{u'label': u'state: True, ok'}",
            "{u'a': 'x: None}'}",
            r"{u'unit': u'\xb0C', u'quote': u'it\'s', u'path': u'c:\\x41'}",
            """{u'say': u'"hi"', u'own': u"it's"}""",
            "{1: 2, u'x': -3.5e2}",
        ],
        Mode.CORRECTED,
    ) == [
        [("a", "x, u"), ("b", "1")],
        [("label", "state: True, ok")],
        [("a", "x: None}")],
        [("unit", "\xb0C"), ("quote", "it's"), ("path", "c:\\x41")],
        [("say", '"hi"'), ("own", "it's")],
        [("1", "2"), ("x", "-3.5e2")],
    ]


@pytest.mark.parametrize(
    "text",
    ['{"a":1}{"b":2}', '{"a":1} junk }', '{"a":1},{"b":2}', '{"a":1}] x [{"b":2}', "{u'a': u'1'} {u'b': u'2'}", r"{u'a': u'\N{DEGREE SIGN}'}"],
)
def test_corrected_reads_the_whole_text(spark, text):
    assert parsed(spark, [text], Mode.CORRECTED, strict=False) == [None]


@pytest.mark.parametrize("text", ["rebooting", "[1]", "3", "", None, '{"a":1} x', '{"a":'])
def test_corrected_rejects_other_text(spark, text):
    assert parsed(spark, [text], Mode.CORRECTED, strict=False) == [None]
    with pytest.raises(PySparkException):
        parsed(spark, [text], Mode.CORRECTED)


@pytest.mark.parametrize(
    "spelled",
    [
        r"\101\60\7z",
        r"\0",
        r"\\101 \\\102",
        r"\U0001F600 \U000000e9",
        r"\a\v\t",
        "one\\\ntwo",
        r"\42\134n",
        r"\400",
    ],
)
def test_escapes_by_number_follow_the_literal_rules(spark, spelled):
    text = "{'unit': '" + spelled + "'}"
    row = spark.createDataFrame([(text,)], "data string")
    pairs = row.select(parse_payload(F.col("data"), Mode.CORRECTED)).first()[0]
    assert [(p.feature, p.value) for p in pairs] == list(ast.literal_eval(text).items())


@pytest.mark.parametrize("spelled", [r"\U00110000", r"\N{BULLET}", r"\xg1", r"\U12"])
def test_other_escapes_are_no_payload(spark, spelled):
    row = spark.createDataFrame([("{'unit': '" + spelled + "'}",)], "data string")
    assert row.select(parse_payload(F.col("data"), Mode.CORRECTED, strict=False)).first()[0] is None
