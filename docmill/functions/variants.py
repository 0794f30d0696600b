"""Reading polymorphic JSON: every function takes a VARIANT column and never guesses."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from docmill.functions.text import strip, strip_or_none

# Escapes that mean the same in a list literal and in JSON.
_ESC = r"""\\(?:['"\\nrtbf]|u[0-9a-fA-F]{4})"""
_ITEM = rf"""(?:'(?:[^'\\\r\n]|{_ESC})*+'|"(?:[^"\\\r\n]|{_ESC})*+")"""
LIST_TEXT = rf"\A\s*\[\s*(?:{_ITEM}\s*(?:,\s*{_ITEM}\s*)*,?)?\s*\]\s*\z"


def field(doc: Column, name: str) -> Column:
    """Field of a variant object, still a variant; NULL when absent."""
    return F.try_variant_get(doc, f"$['{name}']", "variant")


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def text_value(v: Column) -> Column:
    """The string inside, untouched; NULL for every other type."""
    return F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def strip_text(v: Column) -> Column:
    """Trimmed string; NULL when blank or when the value is not a string."""
    return strip_or_none(text_value(v))


def is_json_null(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v)


def clean_items(items: Column) -> Column:
    return F.filter(F.transform(items, strip), lambda x: x != "")


def clean_str_list(v: Column) -> Column:
    """Trimmed non-blank items of a list made of strings only; NULL otherwise."""
    items = F.try_variant_get(v, "$", "array<string>")
    whole = F.coalesce(~F.exists(items, lambda x: x.isNull()), F.lit(False))
    return F.when(kind(v).isin("ARRAY<STRING>", "ARRAY<VOID>") & whole, clean_items(items))


# String literals of the list texts, their escapes, and what the one-letter escapes mean. Half of a surrogate pair
# and characters by name are refused.
_CODE = r"x[0-9a-fA-F]{2}|u(?![dD][89a-fA-F])[0-9a-fA-F]{4}|U(?:0010|000(?!0[dD][89a-fA-F])[0-9a-fA-F])[0-9a-fA-F]{4}|[0-7]{1,3}"
_ESCAPE = rf"\\(?:{_CODE}|[^xuUN0-7])"
_STRING = rf"""(?:[uU]?(?:'(?:[^'\\\r\n]|{_ESCAPE})*+'|"(?:[^"\\\r\n]|{_ESCAPE})*+")|[rR](?:'(?:[^'\\\r\n]|\\.)*+'|"(?:[^"\\\r\n]|\\.)*+"))"""
_STRINGS = rf"{_STRING}(?:\s*{_STRING})*+"
LIST_LITERAL = rf"(?s)\A\s*\[\s*(?:{_STRINGS}\s*(?:,\s*{_STRINGS}\s*)*+,?)?\s*\]\s*\z"
LETTERS = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "a": "\a", "v": "\v", "\\": "\\", "'": "'", '"': '"', "\n": ""}


def _unescaped(piece: Column) -> Column:
    """A run of plain characters as it is, an escape as what it stands for; an unknown one stands for itself."""
    letter, code = F.substring(piece, 2, 1), F.substring(piece, 3, 8)
    of_code = lambda digits: F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")
    letters = F.create_map(*[F.lit(x) for pair in LETTERS.items() for x in pair])
    return (
        F.when(~F.startswith(piece, F.lit("\\")), piece)
        .when(letter.isin("x", "u", "U"), of_code(code))
        .when(letter.between("0", "7"), of_code(F.conv(F.substring(piece, 2, 3), 8, 16)))
        .otherwise(F.coalesce(F.try_element_at(letters, letter), piece)))


def _string_value(token: Column) -> Column:
    """The text of one string literal."""
    body = F.regexp_extract(token, r"(?s)\A[uUrR]?.(.*).\z", 1)
    pieces = F.regexp_extract_all(body, F.lit(rf"(?s){_ESCAPE}|[^\\]+"), F.lit(0))
    plain = ~F.contains(token, F.lit("\\")) | F.substring(token, 1, 1).isin("r", "R")
    return F.when(plain, body).otherwise(F.array_join(F.transform(pieces, _unescaped), ""))


def list_literal(c: Column) -> Column:
    """Items of a list literal of strings, whatever their escapes; NULL for any other text.

    Strings beside each other are one item. Not read: strings in three quotes that hold quotes or line feeds, items in
    parentheses, and comments.
    """
    items = F.regexp_extract_all(c, F.lit(rf"(?s){_STRINGS}"), F.lit(0))
    of_item = lambda item: F.array_join(F.transform(F.regexp_extract_all(item, F.lit(rf"(?s){_STRING}"), F.lit(0)), _string_value), "")
    return F.when(c.rlike(LIST_LITERAL), F.transform(items, of_item))


def EMPTY_LIST() -> Column:  # noqa: N802 - reads as a constant
    return F.array().cast("array<string>")


def list_text_items(c: Column) -> Column:
    """Items of list text that fits LIST_TEXT."""
    return F.from_json(
        F.regexp_replace(c, r",\s*\]\s*\z", "]"),
        "array<string>",
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"},
    )


def parse_list_text(c: Column, escapes: bool = False) -> Column:
    """List literal held in text, items trimmed, blanks dropped; NULL when malformed.

    ``escapes=True`` reads every list literal of strings, otherwise only escapes that JSON has too.
    """
    plain = c.rlike(LIST_TEXT)
    items = F.when(plain, list_text_items(c))
    if escapes:
        residue = F.when(~plain & F.startswith(strip(c), F.lit("[")), c)
        items = F.coalesce(items, list_literal(residue))
    return clean_items(items)


def parse_str_list(v: Column, escapes: bool = False) -> Column:
    """A true list first, list text as a fallback, NULL for anything else."""
    return F.coalesce(clean_str_list(v), parse_list_text(text_value(v), escapes))


def yes_no(text: Column, yes: str, no: str) -> Column:
    """Boolean behind two fixed words; NULL for anything else."""
    text = strip(text)
    return F.when(text == yes, F.lit(True)).when(text == no, F.lit(False))


def canonical_json(text: Column) -> Column:
    """JSON text with keys sorted at every level; NULL when the text is not JSON."""
    return F.to_json(F.try_parse_json(text))


def payload_hash(text: Column) -> Column:
    """SHA-256 of the canonical form, so key order and spacing do not matter."""
    return F.sha2(canonical_json(text), 256)


def last_key_wins(spark: SparkSession) -> None:
    """From now on the session reads a repeated key of a JSON object as its last value, as common JSON readers do."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
