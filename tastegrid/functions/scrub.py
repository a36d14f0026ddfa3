"""Column expressions for dirty text: numbers, flags, Python-literal lists, quoted keyword lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Element types of the nested columns.
CAST_TYPE = (
    "array<struct<cast_id:bigint,character:string,credit_id:string,gender:int,id:bigint,name:string,order:bigint>>"
)
CREW_TYPE = "array<struct<credit_id:string,department:string,gender:int,id:bigint,job:string,name:string>>"
GENRE_TYPE = "array<struct<id:int,name:string>>"
COMPANY_TYPE = "array<struct<id:int,name:string>>"
COUNTRY_TYPE = "array<struct<iso_3166_1:string,name:string>>"
LANGUAGE_TYPE = "array<struct<iso_639_1:string,name:string>>"

# A quoted string with its escapes.
QUOTED = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""


def whole_number(column: str | Column, as_type: str = "double") -> Column:
    """Digits of a text as a number; null where there are none."""
    return F.regexp_replace(column, "[^0-9]", "").try_cast(as_type)


def decimal_number(column: str | Column, as_type: str = "double") -> Column:
    """Digits and dots of a text as a number; null where they do not form one."""
    return F.regexp_replace(column, "[^0-9.]", "").try_cast(as_type)


def is_true(column: str | Column) -> Column:
    """``'True'`` is true; every other text and null are false."""
    value = F.col(column) if isinstance(column, str) else column
    return value.eqNullSafe(F.lit("True"))


def literal_to_json(column: str | Column) -> Column:
    """Python-literal text to JSON text.

    ``None``, ``True`` and ``False`` are rewritten outside quoted strings only, so a name that holds one of
    the words keeps it. Quotes need no rewriting: the parser takes single quotes.
    """
    text = F.col(column) if isinstance(column, str) else column
    for word, value in (("None", "null"), ("True", "true"), ("False", "false")):
        text = F.regexp_replace(text, _bare(word), f"$1{value}")
    return text


def _bare(word: str) -> str:
    """Pattern of the next ``word`` outside quotes, with all before it: quoted strings whole, quotes that nothing closes alone."""
    first = word[0]
    return rf"""(?s)\G((?:[^'"{first}]++|{QUOTED}|(?!\b{word}\b){first}|['"])*+){word}"""


def parse_list(column: str | Column, element_type: str) -> Column:
    """Nested array out of Python-literal or JSON text; null where the text does not parse."""
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    return F.from_json(literal_to_json(column), element_type, options)


def without_brackets(column: str | Column) -> Column:
    return F.regexp_replace(column, r"^\[|\]$", "")


def without_outer_quotes(column: str | Column) -> Column:
    return F.regexp_replace(column, "^['\"]|['\"]$", "")


def words(column: str | Column) -> Column:
    """Lower-cased text split at every single white-space character; null counts as empty."""
    text = F.col(column) if isinstance(column, str) else column
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s")
