"""Text rules: numeric text, series names and cell equality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that counts as a number, as an integer, or as missing when
# a CSV column is read.
NUMERIC_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
MISSING_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Cell patterns of the output comparison.
INTEGER_CELL = r"^[+-]?[0-9]+\z"
DECIMAL_CELL = r"^[+-]?([0-9]+\.[0-9]*|[0-9]*\.[0-9]+|[0-9]+)([eE][+-]?[0-9]+)?\z"

# Characters and device names that no file system name may use.
FORBIDDEN_IN_NAME = r'[<>:"/\\|?*\x00-\x1f]'
FORBIDDEN_NAMES = (
    ".",
    "..",
    "con",
    "prn",
    "aux",
    "nul",
    *(f"com{number}" for number in range(1, 10)),
    *(f"lpt{number}" for number in range(1, 10)),
)
MAX_NAME_LENGTH = 128


def numeric_value(text: Column) -> Column:
    """The number behind a text that matches `NUMERIC_TEXT`.

    Check the pattern first: the cast alone would also read `1d` or `1.5f`.
    """
    return F.trim(text).try_cast("double")


def is_missing(text: Column) -> Column:
    return text.isNull() | text.isin(*MISSING_WORDS)


def valid_series_name(name: Column) -> Column:
    """Whether a device or feature name may become part of an output name."""
    return (
        name.isNotNull()
        & F.length(name).between(1, MAX_NAME_LENGTH)
        & ~name.rlike(FORBIDDEN_IN_NAME)
        & ~name.rlike(r"[. ]\z")
        & ~F.lower(name).isin(*FORBIDDEN_NAMES)
    )


def checked_series_name(name: Column) -> Column:
    """The name itself; an unsafe one fails the job."""
    return F.when(valid_series_name(name), name).otherwise(
        F.raise_error(F.lit("unsafe device or feature name")).cast("string")
    )


def series_file(sn: Column, feature: Column) -> Column:
    return F.concat(sn, F.lit("_"), feature, F.lit(".csv"))


def cells_match(
    expected: Column, actual: Column, relative: float, absolute: float
) -> Column:
    """Equal text, or two decimal numbers that are close.

    Two integers must be equal as text (`0` is not `00`). An overflowing cell
    reads as infinity, which only its own sign matches.
    """
    both_integers = expected.rlike(INTEGER_CELL) & actual.rlike(INTEGER_CELL)
    both_decimals = expected.rlike(DECIMAL_CELL) & actual.rlike(DECIMAL_CELL)
    left, right = expected.try_cast("double"), actual.try_cast("double")
    infinite = F.greatest(F.abs(left), F.abs(right)) == float("inf")
    slack = F.greatest(
        F.greatest(F.abs(left), F.abs(right)) * relative, F.lit(absolute)
    )
    close = F.when(infinite, left == right).otherwise(F.abs(left - right) <= slack)
    return F.when(expected == actual, True).otherwise(
        F.coalesce(both_decimals & ~both_integers & close, F.lit(False))
    )
