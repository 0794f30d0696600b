"""Display title of a document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.dates import french_date
from docmill.functions.text import has_text


def display_title(
    title: Column, issuer: Column, decided: Column, number: Column, external_id: Column
) -> Column:
    """The title itself, else a citation whose missing parts are left out, else the identifier."""
    citation = F.concat_ws(
        ", ",
        F.nullif(issuer, F.lit("")),
        F.when(decided.isNotNull(), french_date(decided)),
        F.when(number != "", F.concat(F.lit("n° "), number)),
    )
    fallback = F.when(citation != "", citation).otherwise(
        F.concat(F.lit("Décision "), external_id)
    )
    return F.when(has_text(title), title).otherwise(fallback)
