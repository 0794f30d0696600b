"""Polymorphic JSON fields as staged columns.

Each stage is its own projection, so a value that several later expressions need (a field of the
payload, its type, its text) is computed once per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.functions.text import strip
from docmill.functions.variants import (
    EMPTY_LIST, LIST_TEXT, clean_items, field, kind, list_literal, list_text_items,
)


def with_fields(df: DataFrame, doc: str, fields: Mapping[str, str]) -> DataFrame:
    """Fields of a variant object, and next to each its type (``_k``) and its text (``_t``)."""
    out = df.withColumns({alias: field(F.col(doc), name) for alias, name in fields.items()})
    out = out.withColumns({f"{a}_k": F.coalesce(kind(F.col(a)), F.lit("VOID")) for a in fields})
    return out.withColumns({
        f"{a}_t": F.when(F.col(f"{a}_k") == "STRING", F.try_variant_get(F.col(a), "$", "string"))
        for a in fields
    })


def with_str_lists(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """For each field prepared by ``with_fields``: its list of strings (a true list first, list
    text as a fallback, NULL when malformed), under the given name."""
    out = df.withColumns({
        f"{a}_i": F.when(F.col(f"{a}_k").isin("ARRAY<STRING>", "ARRAY<VOID>"),
                         F.try_variant_get(F.col(a), "$", "array<string>"))
        for a in fields
    })
    out = out.withColumns({f"{a}_p": F.col(f"{a}_t").rlike(LIST_TEXT) for a in fields})
    out = out.withColumns({
        f"{a}_i": F.coalesce(
            F.col(f"{a}_i"),
            F.when(F.col(f"{a}_p"), list_text_items(F.col(f"{a}_t"))),
            list_literal(F.when(~F.col(f"{a}_p") & F.col(f"{a}_t").contains("["), F.col(f"{a}_t"))))
        for a in fields
    })
    return out.withColumns({
        name: F.when(~F.exists(f"{a}_i", lambda x: x.isNull()), clean_items(F.col(f"{a}_i")))
        for a, name in fields.items()
    })


def with_main_type(df: DataFrame, alias: str, labels: Mapping[str, str], names: Sequence[str]) -> DataFrame:
    """(label, subtypes, anomaly) of a field prepared by ``with_fields``: a label, a list of main
    type and subtypes, or such a list held in text. An unknown label stays unknown."""
    label, subtypes, anomaly = names
    text, items = F.col(f"{alias}_s"), F.col(f"{alias}_l")
    out = df.withColumn(f"{alias}_s", strip(F.col(f"{alias}_t")))
    out = out.withColumn(
        f"{alias}_w", F.when(F.startswith(text, F.lit("[")), F.try_parse_json(text)).otherwise(F.col(alias)))
    out = out.withColumn(
        f"{alias}_l",
        F.when(kind(F.col(f"{alias}_w")) == "ARRAY<STRING>",
               F.try_variant_get(F.col(f"{alias}_w"), "$", "array<string>")))
    is_list = F.coalesce(F.startswith(text, F.lit("[")), F.lit(False)) | F.startswith(
        F.col(f"{alias}_k"), F.lit("ARRAY"))
    sound = F.coalesce((F.size(items) > 0) & ~F.exists(items, lambda x: x.isNull()), F.lit(False))
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    out = out.withColumns({f"{alias}_bad": is_list & ~sound, f"{alias}_good": is_list & sound})
    bad, good = F.col(f"{alias}_bad"), F.col(f"{alias}_good")
    main = F.when(good, strip(F.get(items, F.lit(0)))).when(~bad, text)
    out = out.withColumn(label, F.try_element_at(table, main)).withColumn(
        subtypes,
        F.when(good, F.transform(F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0))), strip))
        .otherwise(EMPTY_LIST()))
    return out.withColumn(
        anomaly, F.when(bad, "malformed_type_decision").when(F.col(label).isNull(), "unknown_decision_type"))
