"""Listing pages: cards of an HTML page become rows."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.dates import parse_iso_date
from docmill.functions.urls import absolute_url

# The parser travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Class names of the card markup.
ROW, CARD, ID, FOOTER, SECTORS = (
    "views-row", "search-index", "field--name-field-id", "search-index__footer",
    "field--name-field-sector",
)
NODE_ATTRIBUTE = "data-history-node-id"
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
_CARD_SCHEMA = (
    "page_id BIGINT, pos INT, error STRING, id_decision STRING, title STRING, href STRING, "
    "decision_type STRING, moment STRING, sectors ARRAY<STRING>, node_id STRING"
)


class _Cards(HTMLParser):
    """Collects the text pieces of each card while tags open and close."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, frozenset[str]]] = []
        self.cards: list[dict] = []
        self.card_depth: int | None = None

    def _inside(self, name: str) -> bool:
        return any(name in classes for _, classes in self.open[self.card_depth or 0:])

    def _under(self, *tags: str) -> bool:
        names = [tag for tag, _ in self.open[self.card_depth or 0:]]
        return all(tag in names for tag in tags)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        values = {k: v or "" for k, v in attrs}
        classes = frozenset(values.get("class", "").split())
        if self.card_depth is None and tag == "div" and CARD in classes:
            if self.open and self.open[-1][0] == "div" and ROW in self.open[-1][1]:
                self.card_depth = len(self.open)
                self.cards.append({"node": values.get(NODE_ATTRIBUTE), "href": None, "id": [],
                                   "link": [], "type": None, "moment": None, "sectors": []})
        elif self.card_depth is not None:
            card = self.cards[-1]
            if tag == "a" and "href" in values and self._under("h2") and card["href"] is None:
                card["href"] = values["href"]
                card["link_depth"] = len(self.open)
            if tag == "a" and self._inside(SECTORS):
                card["sectors"].append([])
            if tag == "p" and self.open[-1][1] & {FOOTER} and card["type"] is None:
                card["type"], card["type_depth"] = [], len(self.open)
            if tag == "time" and "datetime" in values and self._inside(FOOTER):
                card["moment"] = card["moment"] or values["datetime"]
        if tag not in _VOID:
            self.open.append((tag, classes))

    def handle_endtag(self, tag: str) -> None:
        while self.open and tag in [name for name, _ in self.open]:
            name, _ = self.open.pop()
            if self.card_depth is not None:
                card = self.cards[-1]
                if len(self.open) == card.get("link_depth"):
                    card["link_depth"] = -1
                if len(self.open) == card.get("type_depth"):
                    card["type_depth"] = -1
                if len(self.open) <= self.card_depth:
                    self.card_depth = None
            if name == tag:
                break

    def handle_data(self, data: str) -> None:
        text = data.strip()
        if self.card_depth is None or not text:
            return
        card = self.cards[-1]
        if card.get("link_depth", -1) >= 0:
            card["link"].append(text)
            if self._inside(ID):
                card["id"].append(text)
        if card.get("type_depth", -1) >= 0:
            card["type"].append(text)
        if self._inside(SECTORS) and self._under("a") and card["sectors"]:
            card["sectors"][-1].append(text)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in _CARD_SCHEMA.split(", ")]
    for batch in batches:
        rows: list[tuple] = []
        for page_id, html in zip(batch["page_id"], batch["html"]):
            parser = _Cards()
            parser.feed(html or "")
            if not parser.cards:
                rows.append((page_id, None, "no card", None, None, None, None, None, None, None))
            for pos, card in enumerate(parser.cards):
                found = card["href"] is not None and card["id"]
                number = "".join(card["id"])
                rows.append((
                    page_id, pos, None if found else "no link or number",
                    number or None,
                    " ".join(piece for piece in card["link"] if piece != number) if found else None,
                    card["href"],
                    None if card["type"] is None else "".join(card["type"]),
                    card["moment"],
                    ["".join(pieces) for pieces in card["sectors"]],
                    card["node"] or None,
                ))
        frame = pd.DataFrame(rows, columns=names)
        frame["pos"] = frame["pos"].astype("Int32")
        yield frame


def parse_listing(pages: DataFrame, base_url: str | Column) -> DataFrame:
    """One row per card of ``pages(page_id, html)``; a page whose structure changed gives an
    error row instead of silently giving nothing."""
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    cards = pages.select("page_id", "html").mapInPandas(_parse, _CARD_SCHEMA)
    return cards.select(
        "page_id", "pos", "error", "id_decision", "title",
        F.when(F.col("href").isNotNull(), absolute_url(base, F.col("href"))).alias("url"),
        "decision_type", parse_iso_date(F.col("moment")).alias("decision_date"), "sectors", "node_id",
    )


def structure_gate(parsed: DataFrame) -> DataFrame:
    """One row: pages and cards in error, and whether the job may go on."""
    return parsed.agg(
        F.count_if(F.col("error").isNotNull()).alias("n_errors"),
        F.count_if(F.col("error").isNull()).alias("n_items"),
    ).withColumn("accepted", F.col("n_errors") == 0)


def listing_payload() -> Column:
    """Deterministic JSON of a listing row: no collection time, so equal content hashes alike."""
    return F.to_json(
        F.struct(
            "id_decision", "title", "url", "decision_type",
            F.col("decision_date").cast("string").alias("decision_date"), "sectors", "node_id",
        ),
        {"ignoreNullFields": "false"},
    )
