"""Column expressions that unpack a reading's text payload.

Both parsers return `array<struct<feature, value>>` in payload order: a map
would lose the order that decides which feature was seen first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeloom.schema import Mode

PAIRS_TYPE = "array<struct<feature:string,value:string>>"

# The two text forms of the old payload writer, tested on the
# first pair only.
UNICODE_PAIR = r"^u'[\w\W]*':u'[\w\W]*'\z"
QUOTED_PAIR = r'^"[\w\W]*":"[\w\W]*"\z'

# JSON words whose Python spelling differs.
PLAIN_WORD = r"true|false|null|NaN|Infinity"

# The pieces of a flat dict literal: quoted text, numbers and words.
LITERAL_PIECE = (
    r"(?s)(?:[uU]?'[^'\\]*+(?:\\.[^'\\]*+)*+'"
    r'|[uU]?"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    r"|[+-]?(?:\d++\.?\d*+|\.\d++)(?:[eE][+-]?\d++)?+|True|False|None)"
)
_LITERAL_PAIR = rf"{LITERAL_PIECE}\s*+:\s*+{LITERAL_PIECE}\s*+".replace("(?s)", "")
# Plain text, an escape by number, or any other escape.
ESCAPED_PIECE = r"[^\\]++|\\[0-7]{1,3}|\\U[0-9a-fA-F]{8}|(?s:\\.)"
FLAT_LITERAL = rf"(?s)^\{{\s*+(?:{_LITERAL_PAIR}(?:,\s*+{_LITERAL_PAIR})*+,?\s*+)?\}}\z"

END_MARK = "end of the payload"


def _no_pairs() -> Column:
    return F.array().cast(PAIRS_TYPE)


def _pair(feature: Column, value: Column) -> Column:
    return F.struct(feature.alias("feature"), value.alias("value"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind `value` once: an expression used twice is otherwise computed twice,
    and inside a lambda once per element."""
    return F.transform(F.array(value), body).getItem(0)


def _last_value_wins(pairs: Column) -> Column:
    """A repeated feature keeps its first position and its last value."""

    def merged(pairs: Column, names: Column) -> Column:
        return F.transform(
            names,
            lambda name: _pair(
                name,
                F.element_at(
                    F.filter(pairs, lambda pair: pair["feature"] == name), -1
                )["value"],
            ),
        )

    def settled(pairs: Column) -> Column:
        return _let(
            F.array_distinct(pairs["feature"]),
            lambda names: F.when(
                F.size(names) < F.size(pairs), merged(pairs, names)
            ).otherwise(pairs),
        )

    return _let(pairs, settled)


def legacy_pairs(data: Column) -> Column:
    """Split on commas and colons and slice the quotes off, as written back then."""
    body = F.replace(
        F.substring(data, F.lit(2), F.length(data) - 2), F.lit(" "), F.lit("")
    )

    def from_parts(parts: Column) -> Column:
        first = F.element_at(parts, 1)
        # Characters in front of the text of each side: u' or a bare quote.
        lead = F.when(first.rlike(UNICODE_PAIR), 2).when(first.rlike(QUOTED_PAIR), 1)
        sides = F.transform(parts, lambda part: F.split(part, ":", -1))
        return _let(lead, lambda lead: _let(sides, lambda sides: paired(lead, sides)))

    def paired(lead: Column, sides: Column) -> Column:
        def unquoted(side: Column) -> Column:
            kept = F.greatest(F.length(side) - lead - 1, F.lit(0))
            return F.substring(side, lead + 1, kept)

        pairs = F.transform(
            sides,
            lambda side: _pair(unquoted(side.getItem(0)), unquoted(side.getItem(1))),
        )
        readable = lead.isNotNull() & F.forall(sides, lambda side: F.size(side) == 2)
        return F.when(readable, _last_value_wins(pairs)).otherwise(_no_pairs())

    return F.when(
        F.length(data) >= 2, _let(F.split(body, ",", -1), from_parts)
    ).otherwise(_no_pairs())


def _unicode_escape(code: Column) -> Column:
    """JSON escape of a code point, a pair of surrogates beyond the first plane."""

    def unit(number: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.hex(number), 4, "0"))

    beyond = code - 0x10000
    pair = F.concat(
        unit(F.shiftright(beyond, 10) + 0xD800), unit(beyond.bitwiseAND(0x3FF) + 0xDC00)
    )
    return F.when(code > 0x10FFFF, F.lit(None)).when(code > 0xFFFF, pair).otherwise(unit(code))


def _as_json_escapes(body: Column) -> Column:
    """Octal escapes, eight-digit ones, bell, tab and joined lines spelled as in JSON."""

    def spelled(piece: Column) -> Column:
        code = F.when(
            piece.rlike(r"\A\\[0-7]{1,3}\z"), F.conv(F.substr(piece, F.lit(2)), 8, 10)
        ).when(piece.rlike(r"\A\\U.{8}\z"), F.conv(F.substr(piece, F.lit(3)), 16, 10))
        return (
            F.when(code.isNotNull(), _unicode_escape(code.cast("bigint")))
            .when(piece == "\\a", F.lit("\\u0007"))
            .when(piece == "\\v", F.lit("\\u000b"))
            .when(piece == "\\\n", F.lit(""))
            .otherwise(piece)
        )

    pieces = F.regexp_extract_all(body, F.lit(ESCAPED_PIECE), F.lit(0))
    joined = F.concat(F.lit(""), F.array_join(F.transform(pieces, spelled), "", "\\N"))
    return F.when(body.rlike(r"\\[0-7avU\n]"), joined).otherwise(body)


def _literal_text(token: Column) -> Column:
    """Text of one piece of a dict literal; NULL if it holds an unknown escape.

    A quoted piece is spelled as JSON text and decoded as such. An escape counts
    only behind an even number of backslashes.
    """
    body = _as_json_escapes(F.regexp_extract(token, r"(?s)^[uU]?(['\"])(.*)\1\z", 2))
    for pattern, spelled in (
        (r"\\x([0-9a-fA-F]{2})", r"$1\\u00$2"),
        (r"\\'", "$1'"),
        (r'"', r'$1\\"'),
        (r"\\(?![\\\"bfnrtu0-7avxNU\n])", r"$1\\\\"),
    ):
        body = F.regexp_replace(body, r"((?<!\\)(?:\\\\)*)" + pattern, spelled)
    text = F.from_json(
        F.concat(F.lit('["'), body, F.lit('"]')),
        "array<string>",
        {"allowUnquotedControlChars": "true"},
    )
    return F.when(token.rlike(r"['\"]\z"), F.get(text, 0)).otherwise(token)


def literal_pairs(text: Column) -> Column:
    """Pairs of a flat dict literal as old Python writes it; NULL when it is none.

    The whole text has to fit; its pieces are then names and values in turn.
    """

    def paired(texts: Column) -> Column:
        names = F.filter(texts, lambda _, place: place % 2 == 0)
        pairs = F.transform(
            names, lambda name, place: _pair(name, F.get(texts, place * 2 + 1))
        )
        return F.when(F.forall(texts, lambda piece: piece.isNotNull()), pairs)

    pieces = F.regexp_extract_all(text, F.lit(LITERAL_PIECE), F.lit(0))
    return F.when(
        text.rlike(FLAT_LITERAL), _let(F.transform(pieces, _literal_text), paired)
    )


def _whole_object(text: Column) -> Column:
    """The JSON object that fills the text, as a map; else NULL.

    from_json ignores what follows an object, so it reads a list of the text and
    an end mark, which is malformed or of another length when more follows.
    """
    listed = F.from_json(
        F.concat(F.lit("["), text, F.lit(',{"' + END_MARK + '":"1"}]')),
        "array<map<string,string>>",
    )
    fits = (F.size(listed) == 2) & F.get(listed, 1)[END_MARK].isNotNull()
    return F.when(text.startswith("{") & text.endswith("}") & fits, F.get(listed, 0))


def corrected_pairs(data: Column) -> Column:
    """JSON object, else flat dict literal; NULL when it is neither."""
    text = F.trim(data)
    decoded = _whole_object(text)
    pairs = F.when(
        text.rlike(PLAIN_WORD), _let(decoded, lambda read: _spelled_out(text, read))
    ).otherwise(F.map_entries(decoded).cast(PAIRS_TYPE))
    return _last_value_wins(F.coalesce(pairs, literal_pairs(text)))


def _spelled_out(text: Column, decoded: Column) -> Column:
    """Entries with null, booleans and non-finite numbers spelled as in Python.

    from_json writes a JSON boolean and the text "true" alike; the variant type
    still tells them apart.
    """
    types = F.transform_values(
        F.try_parse_json(text).cast("map<string,variant>"),
        lambda _, value: F.schema_of_variant(value),
    )

    def spelled(feature: Column, value: Column, types: Column) -> Column:
        is_boolean = F.coalesce(F.try_element_at(types, feature) == "BOOLEAN", F.lit(False))
        return (
            F.when(value.isNull(), F.lit("None"))
            .when(value == '"NaN"', F.lit("nan"))
            .when(value == '"Infinity"', F.lit("inf"))
            .when(value == '"-Infinity"', F.lit("-inf"))
            .when(value.isin("true", "false") & is_boolean, F.initcap(value))
            .otherwise(value)
        )

    return _let(
        types,
        lambda types: F.transform(
            F.map_entries(decoded),
            lambda entry: _pair(
                entry["key"], spelled(entry["key"], entry["value"], types)
            ),
        ),
    )


def parse_payload(data: Column, mode: Mode, *, strict: bool = True) -> Column:
    """Payload text to ordered pairs.

    Legacy mode turns unreadable text into no pairs. Corrected mode raises, or
    yields NULL with `strict=False` so that the caller can count and route it.
    """
    if mode is Mode.LEGACY:
        return F.coalesce(legacy_pairs(data), _no_pairs())
    pairs = corrected_pairs(data)
    if not strict:
        return pairs
    failure = F.raise_error(F.lit("payload is neither a JSON object nor a flat dict"))
    return F.coalesce(pairs, failure.cast(PAIRS_TYPE))
