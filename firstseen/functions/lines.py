"""Functions of one raw line: blankness, JSON validity, values by path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firstseen.config import path_segments

# Wording of the reject reasons, and the text of a missing value.
INVALID_FORMAT = "invalid data/format"
INVALID_ENCODING = "invalid encoding"
INVALID_TABLE = "unusable Source.Table"
NULL_TEXT = "<null>"

SOURCE_TABLE = "Source.Table"


def is_blank(line: Column) -> Column:
    """Only whitespace. A no-break space is not whitespace here."""
    return line.rlike(r"^\p{javaWhitespace}*\z")


def parse(line: Column) -> Column:
    """The line as a VARIANT array: the value, then a hash of the line.

    NULL if the line is no JSON. Spark's parser stops after the first value, so
    text behind it would go unseen; the hash behind the line shows it.
    """
    return F.try_parse_json(F.concat(F.lit("["), line, F.lit(","), F.xxhash64(line).cast("string"), F.lit("]")))


def is_whole(parsed: Column, line: Column) -> Column:
    """The line is exactly one JSON value: object, array or scalar.

    Then, and only then, the hash comes second. A line of several values, or one
    that closes the array early, has something else there or nothing.
    """
    return F.coalesce(F.try_variant_get(parsed, "$[1]", "bigint") == F.xxhash64(line), F.lit(False))


def is_json(line: Column) -> Column:
    return is_whole(parse(line), line)


def _steps(dotted: str) -> str:
    return "".join(f"['{segment}']" for segment in path_segments(dotted))


def value_at(parsed: Column, dotted: str) -> Column:
    """The VARIANT at a dotted path of a parsed line; NULL if it is missing."""
    return F.try_variant_get(parsed, "$[0]" + _steps(dotted), "variant")


def is_container(value: Column) -> Column:
    """The VARIANT is an object or array."""
    kind = F.schema_of_variant(value)
    return F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(False))


def value_text(value: Column, line: Column, dotted: str) -> Column:
    """``path_text`` from a VARIANT already at hand.

    Strings, integers and booleans read the same from either. A VARIANT forgets
    the field order of objects and how fractions print, so those few are taken
    from the line again. That reading finds the first of repeated fields while the
    VARIANT has the last: where the two disagree, or where a field repeats inside
    an object and the line's text has more quotes, the VARIANT's text counts.
    """
    kind = F.schema_of_variant(value)
    again, own = path_text(line, dotted), F.to_json(value)
    quotes = lambda text: F.length(text) - F.length(F.replace(text, F.lit('"')))
    same = (F.to_json(F.try_parse_json(again)) == own) & (quotes(again) == quotes(own))
    return F.when(kind.isin("STRING", "BIGINT", "BOOLEAN"), value.cast("string")).when(
        kind != "VOID", F.when(same, again).otherwise(own)
    )


def path_text(line: Column, dotted: str) -> Column:
    """Text of the value at a dotted path; NULL if it is missing or JSON null.

    Only object fields are descended; of repeated ones it finds the first. Objects and arrays come back as compact
    JSON in their own field order.
    """
    return F.get_json_object(line, "$" + _steps(dotted))


def key_part(line: Column, dotted: str) -> Column:
    """Text of the value at a path, with the fixed text for a missing one."""
    return F.coalesce(value_text(value_at(parse(line), dotted), line, dotted), F.lit(NULL_TEXT))


def effective_table(line: Column, table: Column) -> Column:
    """The table a record names itself, else the table of its file."""
    return F.coalesce(value_text(value_at(parse(line), SOURCE_TABLE), line, SOURCE_TABLE), table)
