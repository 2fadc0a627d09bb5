"""Text expressions: tokens, e-mail form, code names, timestamps."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: accepted e-mail form.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# Code points Unicode counts as white space, so that tokens are the
# same whether a text holds plain or no-break spaces.
WHITE_SPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)

# A run of anything else. The Unicode flag makes \s cover all of the above but the
# four separators, and is ten times faster than listing the characters.
TOKEN_PATTERN = r"(?U)[^\s\x1c-\x1f]+"

# Timestamp forms, tried in this order.
TIMESTAMP_FORMATS = (
    "dd-MM-yyyy HH:mm",
    "yyyy-MM-dd HH:mm:ss",
    "dd-MM-yyyy",
    "yyyy-MM-dd",
)


def is_valid_email(column: str | Column) -> Column:
    """True when the text has the form of an e-mail address; NULL is false."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.rlike(EMAIL_PATTERN), F.lit(False))


def stripped(column: str | Column) -> Column:
    """Text without white space at either end."""
    return F.trim(column, F.lit(WHITE_SPACE))


def tokens(text: str | Column) -> Column:
    """White-space separated tokens; an empty or blank text has none."""
    text = F.col(text) if isinstance(text, str) else text
    # Plain text is cut at its spaces, which takes a quarter of the time.
    is_plain = ~text.rlike(r"[^\x20-\x7e]")
    plain = F.array_remove(F.split(text, " "), "")
    return F.when(is_plain, plain).otherwise(F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0)))


def token_count(text: str | Column) -> Column:
    return F.size(tokens(text))


def literal_map(pairs: Mapping[str, str]) -> Column:
    return F.create_map(*(F.lit(v) for v in chain.from_iterable(pairs.items())))


def code_name(column: str | Column, names: Mapping[str, str]) -> Column:
    """Name for a code in any letter case; unknown codes are title-cased."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(literal_map(names)[F.upper(column)], F.initcap(column))


# What the parser can read for the letters of a format: two digits each, and a year
# of four to 19 digits with or without a sign.
FORMAT_LETTERS = {"yyyy": r"[+-]?\d{4,19}", **dict.fromkeys(("dd", "MM", "HH", "mm", "ss"), r"\d\d")}


def format_shape(fmt: str) -> str | None:
    """A pattern that every text of the format has; None for formats of other letters."""
    parts = re.findall(r"([A-Za-z])(\1*)|([- :])", fmt)
    if "".join(a + b + c for a, b, c in parts) != fmt:
        return None
    shapes = [c or FORMAT_LETTERS.get(a + b) for a, b, c in parts]
    return None if None in shapes else f"^{''.join(shapes)}$"


def timestamp_in(column: str | Column, fmt: str) -> Column:
    """The column in one format. Texts of another shape never reach the parser.

    A text that does not parse costs an exception in the JVM, many times the price
    of a pattern.
    """
    column = F.col(column) if isinstance(column, str) else column
    shape = format_shape(fmt)
    parsed = F.try_to_timestamp(column, F.lit(fmt))
    return parsed if shape is None else F.when(column.rlike(shape), parsed)


def timestamp_of(
    column: str | Column,
    formats: Sequence[str] = TIMESTAMP_FORMATS,
    as_type: str = "timestamp",
) -> Column:
    """First format that fits, else a plain cast.

    The plain cast is tried only on texts that start with a four-digit year: a
    bare clock time such as ``12:30`` would otherwise become today at 12:30.
    """
    column = F.col(column) if isinstance(column, str) else column
    tried = [timestamp_in(column, fmt) for fmt in formats]
    plain = F.when(column.rlike(r"^\s*\d{4}"), column.try_cast("timestamp"))
    return F.coalesce(*tried, plain).cast(as_type)
