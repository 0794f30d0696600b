"""URL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.text import strip


def normalize_url(c: Column) -> Column:
    """Trimmed, every trailing slash removed."""
    return F.rtrim(strip(c), F.lit("/"))


def absolute_url(base: Column, link: Column) -> Column:
    """Absolute form of a link found on a page whose address is ``base``."""
    origin = F.regexp_extract(base, r"\A([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"\A([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    path = F.regexp_extract(base, r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.concat(origin, F.when(path == "", F.lit("/")).otherwise(
        F.regexp_replace(path, r"[^/]*\z", "")))
    page = F.regexp_replace(base, r"#.*\z", "")
    return (
        F.when(link == "", base)
        .when(link.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(origin, without_dots(link)))
        .when(link.startswith("#"), F.concat(page, link))
        .when(link.startswith("?"), F.concat(F.regexp_replace(page, r"\?.*\z", ""), link))
        .otherwise(F.concat(origin, without_dots(F.concat(F.substring(folder, F.length(origin) + 1, F.length(folder)), link))))
    )


def without_dots(target: Column) -> Column:
    """A path (query and fragment left alone) with its ``.`` and ``..`` segments resolved."""
    path = F.regexp_extract(target, r"\A([^?#]*)", 1)
    rest = F.substring(target, F.length(path) + 1, F.length(target))
    segments = F.split(F.substring(path, 2, F.length(path)), "/")
    folded = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda kept, s: F.when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(s == ".", kept).otherwise(F.concat(kept, F.array(s))))
    # A path that ends in a dot segment names a folder.
    closed = F.when(F.element_at(segments, -1).isin(".", "..") & (F.size(folded) > 0), F.lit("/")).otherwise(F.lit(""))
    plain = F.concat(F.lit("/"), F.array_join(folded, "/"), closed)
    return F.when(path.rlike(r"/\.{1,2}(?:/|\z)"), F.concat(plain, rest)).otherwise(target)


def percent_encode(c: Column) -> Column:
    """Percent-encoding with no safe character but letters, digits and _ . - ~"""
    out = F.url_encode(c)
    for got, wanted in (("+", "%20"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(got), F.lit(wanted))
    return out


def detail_path(source: Column, external_id: Column) -> Column:
    return F.concat(F.lit("/decisions/"), source, F.lit("?id="), percent_encode(external_id))


def host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"\A[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path_and_query(c: Column) -> Column:
    """What URL rules are written against: path and query, at least '/'."""
    rest = F.regexp_extract(c, r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
