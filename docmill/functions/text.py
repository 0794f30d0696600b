"""String functions as Column expressions (all JVM-side)."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the Unicode notion of white space covers, plus the four ASCII separators.
_SPACE = r"[\s\x1C-\x1F]"
_EDGE_SPACE = rf"(?U)\A{_SPACE}+|{_SPACE}+\z"
_INK = r"(?U)[^\s\x1C-\x1F]"

# Letters that fold to more than one ASCII character, or have no decomposition.
FOLD_EXPANSIONS = {"ß": "ss", "æ": "ae", "œ": "oe", "ĳ": "ij", "þ": "th"}
FOLD_SINGLES = {"ø": "o", "đ": "d", "ð": "d", "ł": "l", "ħ": "h", "ı": "i", "ŧ": "t"}


def strip(c: Column) -> Column:
    """Trim every Unicode white space (the built-in trim removes U+0020 only)."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def strip_or_none(c: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def has_text(c: Column) -> Column:
    """True when at least one visible character is present; never NULL."""
    return F.coalesce(c.rlike(_INK), F.lit(False))


def is_sql_blank(c: Column) -> Column:
    """NULL or spaces (U+0020) only: the narrower rule the quality checks use."""
    return c.isNull() | (F.trim(c) == "")


def title_key(c: Column) -> Column:
    """Comparison key of a title: trimmed, one kind of apostrophe, case kept."""
    return F.nullif(F.replace(strip(c), F.lit("’"), F.lit("'")), F.lit(""))


def number_key(c: Column) -> Column:
    """Comparison key of a number: trimmed, lower case."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Translate table built by rule: each Latin letter whose decomposition starts in ASCII."""
    source, target = [], []
    for point in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        char = chr(point)
        base = unicodedata.normalize("NFD", char)[0]
        base = FOLD_SINGLES.get(char, base)
        if base != char and base.isascii() and char.lower() == char:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


def fold(c: Column) -> Column:
    """ASCII folding of already lower-cased text."""
    source, target = _fold_table()
    out = F.translate(c, source, target)
    for letter, expansion in FOLD_EXPANSIONS.items():
        out = F.replace(out, F.lit(letter), F.lit(expansion))
    return out


def fold_keyword(c: Column) -> Column:
    """Keyword normaliser: lower case, accents removed, spaces kept."""
    return fold(F.lower(c))


def number_label(c: Column) -> Column:
    """Decimal text without trailing zeros: 3.00 -> 3, 1.50 -> 1.5."""
    text = c.cast("string")
    return F.when(
        text.contains("."), F.regexp_replace(text, r"\.?0+\z", "")
    ).otherwise(text)


def expectation_operator(c: Column) -> Column:
    """Operator part of an expectation text such as '<= 25'."""
    return F.split_part(c, F.lit(" "), F.lit(1))


def expectation_bound(c: Column) -> Column:
    """Numeric part of an expectation text; NULL when there is none."""
    number = F.regexp_extract(c, r"-?[0-9]+(?:\.[0-9]+)?", 0)
    return F.nullif(number, F.lit("")).cast("decimal(38,10)")


def html_escape(c: Column) -> Column:
    out = c
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"),
                        ("'", "&#x27;"), ("/", "&#x2F;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out
