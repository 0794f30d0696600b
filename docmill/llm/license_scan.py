"""License scan: exact set-similarity join of text blocks with license templates, by prefix, length and position.

A block is a run of words inside one paragraph (text between blank lines, whatever its line feeds; words are letters, digits,
everything beyond ASCII; A-Z lower-cased). For a template of m words blocks have `SPREAD` * m words, one beginning at each word,
so they overlap, a notice may be wrapped and interspersed, and words scattered over a long text are no notice. A block meets a
template of n distinct words if it holds at least ceil(`CONTAINMENT` * n) of them; the best block tells the score.

All templates' words are put in one global order, rarest first, by how often they stand in all documents. A block that meets a
template must hold one of the first n - ceil(t n) + 1 of its words (its prefix), so slices and blocks without any are out. A
block with fewer template words than needed is out by length. Let a block's first common word in the global order stand at i of
the template's n: it can reach 1 + min(n - i - 1, its template words after that one), and is out by position if that is too few.
What is left is counted in full. Blocks that begin between two of
the template's words hold no more than the one that begins at the next, so only those that begin at one are looked at.

Notices of different licenses share most of their words, so containment alone does not tell them apart. Each template names its
telling phrases; a block is labelled only if each of them stands in it, word after word. A template without any takes every block.

Templates are driver-side parameters. They are joined in parts of at most `PART_BYTES`, each part by one more narrow scan that adds
its labels, so a list of any length is whole and what a task holds stays bounded.

Base phrases label a document wherever their words stand one after another, also across lines. Defined cases: null or empty
text has no words, labels or places and a score of 0; equal rows are each returned; ties between templates keep all labels;
no template gives base labels only; an empty table gives no row; other columns are kept, those named as an added one replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.frames import with_fields
from docmill.llm.kernels import ALNUM, SPACE, Slice, slices, word_hash

CONTAINMENT = 0.8
#: Words of a block for each word of the template.
SPREAD = 2
#: Phrases and their labels, as fixed values.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Bytes of the templates that one scan joins.
PART_BYTES = 1 << 20


class Notice(NamedTuple):
    """A license notice: its label, its text and the phrases of it without which a block is another license's."""

    label: str
    text: str
    telling: tuple[str, ...] = ()


#: Public license notices, the paragraph that names or grants the license, as fixed values.
TEMPLATES = (
    Notice("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")),
    Notice(
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        ("apache license", "version 2 0"),
    ),
    Notice("mit", "Released under the MIT License", ("mit license",)),
    Notice(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions",
        ("without restriction", "sublicense"),
    ),
    Notice(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee",),
    ),
    Notice(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        ("source and binary forms", "with or without"),
    ),
    Notice("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Notice("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0", ("cc by nc sa 4 0",)),
    Notice("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("attribution 4 0",)),
    Notice(
        "cc-by-sa",
        "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License",
        ("creative commons", "attribution sharealike 4 0"),
    ),
    Notice(
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License",
        ("creative commons", "attribution noncommercial 4 0"),
    ),
    Notice(
        "cc-by-nc-sa",
        "This work is licensed under a Creative Commons Attribution NonCommercial ShareAlike 4.0 International License",
        ("creative commons", "attribution noncommercial sharealike 4 0"),
    ),
    Notice(
        "gpl-3.0",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license", "version 3"),
    ),
    Notice(
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        ("gnu general public license", "version 3"),
    ),
    Notice(
        "lgpl-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        ("gnu lesser general public license", "version 3"),
    ),
    Notice(
        "agpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        ("gnu affero general public license", "version 3"),
    ),
    Notice(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license", "v 2 0"),
    ),
    Notice(
        "public-domain",
        "This is free and unencumbered software released into the public domain",
        ("unencumbered software", "public domain"),
    ),
)


@dataclass
class Templates:
    """Words of all templates in the global order (rank: by their hash), each template's words by rank, rarest first, the
    words of its blocks and its telling phrases, as ranks in their order."""

    labels: list[str]
    hashes: np.ndarray
    ranks: np.ndarray
    words: list[np.ndarray]
    need: np.ndarray
    window: list[int]
    telling: list[list[np.ndarray]]


def _plain_words(text: str) -> list[bytes]:
    for part in slices(pa.array([text]), lower=True):
        part.words(ALNUM)
        return [part.data[a:b].tobytes() for a, b in zip(part.start, part.end, strict=True)]
    return []


def parts(templates: Sequence[Notice], size: int = PART_BYTES) -> list[list[Notice]]:
    """The templates in parts of at most so many bytes; a longer one is a part of its own."""
    out, held = [], 0
    for t in templates:
        n = len(t.text.encode())
        if not out or held + n > size:
            out.append([])
            held = 0
        out[-1].append(t)
        held += n
    return out or [[]]


def vocabulary(templates: Sequence[Notice]) -> np.ndarray:
    """Sorted hashes of the templates' words."""
    texts = [x for t in templates for x in (t.text, *t.telling)]
    return np.unique(np.array([word_hash(w) for x in texts for w in set(_plain_words(x))], np.uint64))


def frequencies(docs: DataFrame, words: np.ndarray) -> np.ndarray:
    """How often each word of the sorted vocabulary stands in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(words) + 1, np.int64)
        for batch in batches:
            for part in slices(batch.column("text"), lower=True):
                part.words(ALNUM)
                count += np.bincount(_known(words, part.hash), minlength=len(words) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(words))), pa.array(count[:-1])], ["word", "n"])

    got = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    count = np.zeros(len(words), np.int64)
    for r in got:
        count[r.word] = r.n
    return count


def _known(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Place in the sorted vocabulary, its length where a hash is not in it."""
    if not len(words):
        return np.zeros(len(h), np.int64)
    at = np.searchsorted(words, h)
    at[at == len(words)] = 0
    return np.where(words[at] == h, at, len(words))


def ordered(templates: Sequence[Notice], words: np.ndarray, count: np.ndarray, containment: float = CONTAINMENT) -> Templates:
    """Templates with their words in the global order, rarest first (ties by hash)."""
    ranks = np.empty(len(words), np.int64)
    ranks[np.lexsort((words, count))] = np.arange(len(words))

    def ranked(every: list[bytes]) -> np.ndarray:
        return ranks[np.searchsorted(words, np.array([word_hash(w) for w in every], np.uint64))]

    known = [(t, _plain_words(t.text)) for t in templates]
    known = [(t, every) for t, every in known if every]
    sets = [np.unique(ranked(every)) for _, every in known]
    telling = [[ranked(p) for p in map(_plain_words, t.telling) if p] for t, _ in known]
    need = np.array([ceil(containment * len(s) - 1e-9) for s in sets], np.int64)
    return Templates([t.label for t, _ in known], words, ranks, sets, need, [SPREAD * len(every) for _, every in known], telling)


def bound(position: np.ndarray, begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Most distinct words of a template of n that the blocks [begin, end) can hold by the words after their first common one;
    position: of each word in the template's order."""
    first, after = np.full(len(begin), n), np.zeros(len(begin), np.int64)
    steps = [np.flatnonzero(begin + d < end) for d in range(int((end - begin).max(initial=0)))]
    for d, inside in enumerate(steps):
        first[inside] = np.minimum(first[inside], position[begin[inside] + d])
    for d, inside in enumerate(steps):
        after[inside] += position[begin[inside] + d] > first[inside]
    return 1 + np.minimum(n - first - 1, after)


def _phrase(place: np.ndarray, zone: np.ndarray, rank: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where in the list of template words the phrase begins, its words one after another in one paragraph."""
    size = max(len(rank) - len(phrase) + 1, 0)
    at = np.flatnonzero(rank[:size] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[(rank[at + k] == phrase[k]) & (place[at + k] == place[at] + k) & (zone[at + k] == zone[at])]
    return at


def join(t: Templates, place: np.ndarray, zone: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, template, share) of all blocks that meet the bound, by their first word; place, zone and rank list the template
    words in order: where they stand, in which paragraph (ascending), and which they are."""
    none = np.zeros(0, np.int64)
    whos, whiches, shares = [none], [none], [np.zeros(0)]
    for i, s in enumerate(t.words):
        need, member, prefix = t.need[i], np.zeros(len(t.hashes), bool), np.zeros(len(t.hashes), bool)
        member[s], prefix[s[: len(s) - need + 1]] = True, True
        if not prefix[rank].any():
            continue
        told = [_phrase(place, zone, rank, p) for p in t.telling[i]]
        if not all(len(at) for at in told):
            continue
        word = np.flatnonzero(member[rank])
        own = rank[word]
        key = place[word] + zone[word] * t.window[i]  # no block reaches into the next paragraph
        end = np.searchsorted(key, key + t.window[i])
        hits = np.r_[0, np.cumsum(prefix[own])]
        begin = np.arange(len(word))
        live = np.flatnonzero((end - begin >= need) & (hits[end] > hits[:-1]))
        for p, at in zip(t.telling[i], told, strict=True):
            spot = np.r_[place[at] + zone[at] * t.window[i], np.iinfo(np.int64).max]
            ahead = spot[np.searchsorted(spot, key[live])]  # the phrase's next place from the block's first word on
            live = live[ahead <= key[live] + t.window[i] - len(p)]
        live = live[bound(np.searchsorted(s, own), live, end[live], len(s)) >= need]
        if not len(live):
            continue
        order = np.argsort(own, kind="stable")
        before = np.full(len(own), -1, np.int64)  # the same word's last place
        same = own[order[1:]] == own[order[:-1]]
        before[order[1:][same]] = order[:-1][same]
        got = np.zeros(len(live), np.int64)
        for d in range(int((end[live] - live).max())):
            inside = np.flatnonzero(live + d < end[live])
            got[inside] += before[live[inside] + d] < live[inside]
        good = got >= need
        whos.append(word[live[good]])
        whiches.append(np.full(int(good.sum()), i))
        shares.append(got[good] / len(s))
    return np.concatenate(whos), np.concatenate(whiches), np.concatenate(shares)


def _zones(part: Slice) -> np.ndarray:
    """Number of each word's paragraph, ascending over the whole slice."""
    feeds = np.flatnonzero(part.data == 10)
    full = np.r_[0, np.cumsum(~SPACE[part.data])]
    blank = feeds[1:][full[feeds[1:]] == full[feeds[:-1]]]
    return np.searchsorted(blank, part.start) + part.doc


ADDED = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string", "labels": "string", "score": "double"}


def scan(
    docs: DataFrame, templates: Sequence[Notice] | None = None, phrases: dict[str, str] | None = None,
    containment: float = CONTAINMENT, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The rows with n_words, n_base, first_word, last_word, base_labels, labels and score added."""
    first, *others = parts(TEMPLATES if templates is None else templates, part_bytes)
    docs = docs.drop(*ADDED)
    out = _base(docs, PHRASES if phrases is None else phrases, _known_templates(docs, first, containment))
    for part in others:
        out = _more(out, _known_templates(docs, part, containment))
    return out


def _known_templates(docs: DataFrame, templates: list[Notice], containment: float) -> Templates:
    words = vocabulary(templates)
    return ordered(templates, words, frequencies(docs, words), containment)


def _met(known: Templates, part: Slice, labels: list[set[str]], score: np.ndarray) -> None:
    """Add the labels of the templates that a slice's texts hold, and their shares to the score."""
    found = _known(known.hashes, part.hash)
    held = np.flatnonzero(found < len(known.hashes))
    who, which, share = join(known, held, _zones(part)[held], known.ranks[found[held]])
    for b, i, s in zip(part.doc[held[who]].tolist(), which.tolist(), share.tolist(), strict=True):
        labels[b].add(known.labels[i])
        score[b] = max(score[b], s)


def _joined(labels: list[set[str]]) -> pa.Array:
    return pa.array([",".join(sorted(x)) for x in labels], pa.string())


def _base(docs: DataFrame, phrases: dict[str, str], known: Templates) -> DataFrame:
    """Places and labels of the base phrases, and the labels of the first part of the templates."""
    wanted = [([np.uint64(word_hash(w)) for w in _plain_words(p)], label) for p, label in phrases.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text"), lower=True):
                part.words(ALNUM)
                n = len(part.n_words)
                base, first, last = [set() for _ in range(n)], [None] * n, [None] * n
                places = np.zeros(n, np.int64)
                for hashes, label in wanted:
                    size = len(part.hash) - len(hashes) + 1
                    if size <= 0:
                        continue
                    at = np.flatnonzero(part.hash[:size] == hashes[0])
                    for k, h in enumerate(hashes[1:], 1):
                        at = at[part.hash[at + k] == h]
                    at = at[part.doc[at] == part.doc[at + len(hashes) - 1]]
                    for d, w in zip(part.doc[at].tolist(), (at - part.first[part.doc[at]]).tolist(), strict=True):
                        base[d].add(label)
                        places[d] += 1
                        first[d] = w if first[d] is None else min(first[d], w)
                        last[d] = w if last[d] is None else max(last[d], w)
                labels, score = [set(x) for x in base], np.zeros(n)
                score[places > 0] = 1.0
                _met(known, part, labels, score)
                rows = batch.slice(part.lo, part.hi - part.lo)
                yield pa.RecordBatch.from_arrays([
                    *rows.columns, pa.array(part.n_words.astype(np.int64)), pa.array(places), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
                    _joined(base), _joined(labels), pa.array(score),
                ], [*rows.schema.names, *ADDED])

    return docs.mapInArrow(run, with_fields(docs, ADDED))


def _more(scanned: DataFrame, known: Templates) -> DataFrame:
    """The scanned rows with the labels of a further part of the templates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text"), lower=True):
                part.words(ALNUM)
                rows = batch.slice(part.lo, part.hi - part.lo)
                labels = [set(x.split(",")) - {""} for x in rows.column("labels").to_pylist()]
                score = rows.column("score").to_numpy(zero_copy_only=False).copy()
                _met(known, part, labels, score)
                changed = {"labels": _joined(labels), "score": pa.array(score)}
                yield pa.RecordBatch.from_arrays([changed.get(name, rows.column(name)) for name in rows.schema.names], rows.schema.names)

    return scanned.mapInArrow(run, scanned.schema)


def sql() -> str:
    """DuckDB: every paragraph that holds enough of a template, and in it every block that begins at one of the template's words."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    split = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    many = lambda items: "[" + ", ".join(map(quote, items)) + "]"
    templates = ", ".join(f"({i}, {quote(t.label)}, {quote(t.text)}, {many(t.telling)})" for i, t in enumerate(TEMPLATES))
    phrases = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in PHRASES.items())
    spaced = "' ' || array_to_string({}, ' ') || ' '"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {split.format("coalesce(text, '')")} AS w FROM documents),
phrases(p, label) AS (VALUES {phrases}), raw(id, label, t, telling) AS (VALUES {templates}),
templates AS (SELECT id, label, telling, list_distinct({split.format('t')}) AS tw, {SPREAD} * len({split.format('t')}) AS size FROM raw),
places AS (
  SELECT doc_id, label, unnest(list_filter(range(1, len(w) + 1), lambda k: array_to_string(w[k:k + len(string_split(p, ' ')) - 1], ' ') = p)) - 1 AS pos
  FROM d, phrases WHERE contains(' ' || array_to_string(w, ' ') || ' ', ' ' || p || ' ')
),
split AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\n[\x20\x09-\x0D]*\n')) AS p FROM d),
paragraphs AS (SELECT doc_id, {split.format('p')} AS w FROM split),
near AS (
  SELECT doc_id, w, id, label, telling, tw, size FROM paragraphs JOIN templates
    ON len(list_intersect(tw, w)) >= ceil({CONTAINMENT} * len(tw) - 1e-9)
  WHERE len(list_filter(telling, lambda p: NOT contains({spaced.format('w')}, ' ' || p || ' '))) = 0
),
starts AS (SELECT *, unnest(list_filter(range(1, len(w) + 1), lambda k: list_contains(tw, w[k]))) AS k FROM near),
blocks AS (SELECT doc_id, label, telling, tw, w[k:k + size - 1] AS b FROM starts),
met AS (
  SELECT doc_id, label, len(list_intersect(tw, b)) / len(tw) AS share FROM blocks
  WHERE len(list_intersect(tw, b)) >= ceil({CONTAINMENT} * len(tw) - 1e-9)
    AND len(list_filter(telling, lambda p: NOT contains({spaced.format('b')}, ' ' || p || ' '))) = 0
),
base AS (SELECT doc_id, count(*) AS n, min(pos) AS a, max(pos) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM places GROUP BY doc_id),
labels AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS l, max(share) AS s
  FROM (SELECT doc_id, label, 1.0::DOUBLE AS share FROM places UNION ALL SELECT doc_id, label, share FROM met) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, z AS last_word,
  coalesce(base.l, '') AS base_labels, coalesce(labels.l, '') AS labels, coalesce(s, 0)::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN labels USING (doc_id)
"""
