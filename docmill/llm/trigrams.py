"""Boolean trigram queries derived from regular expressions.

A query is a list of clauses, all of which every match meets; a clause is a list of ways, one of which holds; a way is a set of trigrams,
all of which stand in the match. Trigrams are lower-cased, so a query is asked of the lower-cased text. What the derivation cannot
follow (character classes of many characters, look-around, optional parts of unknown text, letters beyond ASCII) asks for nothing; so a
query may let documents through that hold no match, but misses none.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import product
from re import _parser as syntax

Way = frozenset[str]
Query = tuple[tuple[Way, ...], ...]
#: Alternative texts followed at once; beyond that their trigrams so far become a clause.
TEXTS, CLASS = 64, 8


def trigrams_of(text: str) -> Way:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _clause(ways: set[Way]) -> tuple[Way, ...] | None:
    """The ways that no other way is part of; None if one asks for nothing."""
    if not ways or frozenset() in ways:
        return None
    least = [w for w in ways if not any(o < w for o in ways)]
    return tuple(sorted(least, key=sorted))


class _Walk:
    """Texts that a part of a match may be, as long as they are few, and the clauses met so far."""

    def __init__(self):
        self.texts: set[str] = {""}
        self.clauses: list[tuple[Way, ...]] = []

    def close(self) -> None:
        """What follows is unknown: the texts so far become a clause."""
        clause = _clause({trigrams_of(t) for t in self.texts})
        if clause and clause not in self.clauses:
            self.clauses.append(clause)
        self.texts = {""}

    def follow(self, more: set[str] | None) -> None:
        if more is None:
            self.close()
            return
        if len(self.texts) * len(more) > TEXTS:
            self.close()
            if len(more) > TEXTS:
                return
        self.texts = {a + b for a, b in product(self.texts, more)}


def _letter(code: int) -> str | None:
    return chr(code).lower() if code < 128 else None


def _class(items: list) -> set[str] | None:
    """The characters of a short class."""
    out: set[str] = set()
    for name, value in items:
        if str(name) == "LITERAL":
            out.add(_letter(value) or "")
        elif str(name) == "RANGE" and value[1] - value[0] < CLASS:
            out |= {_letter(c) or "" for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if out and "" not in out and len(out) <= CLASS else None


def _exact(parts) -> set[str] | None:
    """All texts of a part, if they are few and known."""
    walk = _Walk()
    for item in parts:
        texts = _texts(*item)
        if texts is None or len(walk.texts) * len(texts) > TEXTS:
            return None
        walk.texts = {a + b for a, b in product(walk.texts, texts)}
    return walk.texts


def _texts(name, value) -> set[str] | None:
    kind = str(name)
    if kind == "LITERAL":
        letter = _letter(value)
        return None if letter is None else {letter}
    if kind == "IN":
        return _class(value)
    if kind == "SUBPATTERN":
        return _exact(value[-1])
    if kind == "ATOMIC_GROUP":
        return _exact(value)
    if kind == "AT":
        return {""}
    if kind == "BRANCH":
        every = [_exact(b) for b in value[1]]
        return None if None in every or sum(map(len, every)) > TEXTS else set().union(*every)
    if kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        low, high, body = value
        once = _exact(body)
        if once is None or high > 4 or sum(len(once) ** n for n in range(low, high + 1)) > TEXTS:
            return None
        return {"".join(p) for n in range(low, high + 1) for p in product(sorted(once), repeat=n)}
    return None


def _walk(parts, walk: _Walk) -> None:
    for name, value in parts:
        kind, texts = str(name), _texts(name, value)
        if texts is not None:
            walk.follow(texts)
        elif kind == "SUBPATTERN":
            _walk(value[-1], walk)
        elif kind == "ATOMIC_GROUP":
            _walk(value, walk)
        elif kind in ("ASSERT", "ASSERT_NOT"):
            walk.close()
        elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] >= 1:
            # The first round follows what stands before it; how many more there are is unknown.
            _walk(value[2], walk)
            walk.close()
        elif kind == "BRANCH":
            walk.close()
            every = [_best(b) for b in value[1]]
            if all(every):
                clause = _clause({w for c in every for w in c})
                if clause and clause not in walk.clauses:
                    walk.clauses.append(clause)
        else:
            walk.close()


def _best(parts) -> tuple[Way, ...] | None:
    """The clause of a part with the fewest ways, of those with the most trigrams in each."""
    walk = _Walk()
    _walk(parts, walk)
    walk.close()
    return min(walk.clauses, key=lambda c: (len(c), -min(map(len, c))), default=None)


@lru_cache(maxsize=1024)
def derive(pattern: str) -> Query:
    """The clauses of a pattern; none if a match may hold no trigram that is known."""
    walk = _Walk()
    try:
        _walk(syntax.parse(pattern), walk)
    except syntax.error:  # a pattern of Java's own kind is run on every document
        return ()
    walk.close()
    return tuple(walk.clauses)
