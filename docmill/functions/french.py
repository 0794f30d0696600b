"""French text analysis as Column expressions: tokens, elision, stop words, light stemming."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.text import fold

# Token shape, elided articles, stop words.
TOKEN = r"[\p{L}\p{N}_]+(?:(?:['’.]\p{L}|[.,'’]\p{N})[\p{L}\p{N}_]*)*"
ARTICLES = ("l", "m", "t", "qu", "n", "s", "j", "d", "c", "jusqu", "quoiqu", "lorsqu", "puisqu")
STOP_WORDS = tuple("""
au aux avec ce ces dans de des du elle en et eux il je la le leur lui ma mais me même mes moi mon
ne nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos
votre vous c d j l à m n s t y été étée étées étés étant suis es est sommes êtes sont serai seras
sera serons serez seront serais serait serions seriez seraient étais était étions étiez étaient fus
fut fûmes fûtes furent sois soit soyons soyez soient fusse fusses fût fussions fussiez fussent ayant
eu eue eues eus ai as avons avez ont aurai auras aura aurons aurez auront aurais aurait aurions
auriez auraient avais avait avions aviez avaient eut eûmes eûtes eurent aie aies ait ayons ayez
aient eusse eusses eût eussions eussiez eussent ceci cela celà cet cette ici ils les leurs quel
quels quelle quelles sans soi
""".split())
ELISION = rf"(?i)\A(?:{'|'.join(ARTICLES)})['’]"

# Light stemming of lower-case words without accents, as ordered (shortest word,
# ending, replacement) rules. Each plural rule applies in turn.
PLURALS = ((6, "x"), (4, "x"), (4, "s"))
# The first final rule that applies settles the word; the other two prepare later rules.
FINAL, PREPARE = True, False
SUFFIXES = (
    (10, "issement", "ir", FINAL), (9, "issant", "ir", FINAL), (8, "ivement", "if", FINAL),
    (7, "ement", "e", FINAL), (12, "ficatrice", "fier", FINAL), (11, "ficateur", "fier", FINAL),
    (10, "catrice", "quer", FINAL), (9, "cateur", "quer", FINAL), (9, "atrice", "er", FINAL),
    (8, "ateur", "er", FINAL), (7, "trice", "teur", PREPARE), (8, "teuse", "ter", FINAL),
    (7, "teur", "ter", FINAL), (6, "euse", "eu", FINAL), (8, "ive", "if", FINAL),
    (5, "folle", "fou", FINAL), (5, "molle", "mou", FINAL), (10, "nnelle", "n", FINAL),
    (10, "nnel", "n", FINAL), (9, "ique", "", PREPARE), (9, "esse", "e", FINAL),
    (8, "inage", "in", FINAL), (13, "ualisation", "uel", FINAL), (10, "isation", "", FINAL),
    (10, "isateur", "", FINAL), (9, "ation", "", FINAL), (9, "ition", "", FINAL),
)
_SETTLED = "\x01"


def tokens(c: Column) -> Column:
    """Words in text order: letters, digits and underscores, inner apostrophes and dots kept."""
    return F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0))


def without_article(token: Column) -> Column:
    apostrophe = F.contains(token, F.lit("'")) | F.contains(token, F.lit("’"))
    return F.when(apostrophe, F.regexp_replace(token, ELISION, "")).otherwise(token)


def term(token: Column) -> Column:
    """Index term of one token before stemming, NULL for a stop word."""
    return _kept(without_article(F.lower(token)))


def _kept(lowered: Column) -> Column:
    ascii_only = F.length(lowered) == F.octet_length(lowered)
    kept = ~lowered.isin(*STOP_WORDS) & (lowered != "")
    return F.when(kept & ascii_only, lowered).when(kept, fold(lowered))


def terms(c: Column) -> Column:
    """Index terms of a text before stemming, repeats kept (they are the term frequency)."""
    # One step an array: inside a lambda each mention of a value would compute it anew.
    found = F.transform(F.transform(F.transform(tokens(c), F.lower), without_article), _kept)
    return F.coalesce(F.array_compact(found), F.array().cast("array<string>"))


def _ending(word: Column, shortest: int, ending: str, replacement: str) -> Column:
    pattern = rf"\A(.{{{shortest - len(ending)},}}){ending}\z"
    return F.regexp_replace(word, pattern, f"$1{replacement}")


def _ends(c: Column, endings: Iterable[str]) -> Column:
    """Whether a word ends like any of the endings, by as many last letters as the shortest of them has."""
    size = min(len(e) for e in endings)
    return F.substring(c, -size, size).isin(*sorted({e[-size:] for e in endings}))


def _plurals(c: Column) -> Column:
    word = F.regexp_replace(c, r"\A(.{2,}[^e])aux\z", "$1al")
    for shortest, ending in PLURALS:
        word = _ending(word, shortest, ending, "")
    return F.when(_ends(c, ["aux", *[ending for _, ending in PLURALS]]), word).otherwise(c)


def _suffixes(c: Column) -> Column:
    """Suffix rules; every step reads its input once, so the expression stays as long
    as the list of rules. A settled word carries a mark at its end, which no later rule matches."""
    word = c
    for shortest, ending, replacement, final in SUFFIXES:
        word = _ending(word, shortest, ending, replacement + (_SETTLED if final else ""))
    return F.when(_ends(c, [ending for _, ending, *_ in SUFFIXES]), F.replace(word, F.lit(_SETTLED), F.lit(""))).otherwise(c)


def _single_letters(c: Column) -> Column:
    return F.when(F.length(c) > 4, F.regexp_replace(c, r"(\p{L})\1+", "$1")).otherwise(c)


def _without_ie(c: Column) -> Column:
    return F.when(F.endswith(c, F.lit("ie")), F.regexp_replace(c, r"\A(.{3,})ie\z", "$1")).otherwise(c)


def _without_e_or_r(c: Column) -> Column:
    return F.when(_ends(c, "er"), F.regexp_replace(c, r"\A(?=.{5,}\z)(.*?)e{0,2}r?\z", "$1")).otherwise(c)


#: Steps of the stemmer. Most words have none of a step's endings: they are told by their last letters and meet no rule.
STEPS = (_plurals, _suffixes, _single_letters, _without_ie, _without_e_or_r)


def stems(words: Column) -> Column:
    """Light French stems of an array of terms (lower case, accents folded). One step an array, as in ``terms``."""
    return reduce(F.transform, STEPS, words)


def with_stem(df: DataFrame, column: str = "term") -> DataFrame:
    """Replace a column of terms by their light French stems."""
    return reduce(lambda rows, step: rows.withColumn(column, step(F.col(column))), STEPS, df)
