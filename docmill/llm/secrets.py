"""Secret scan: a trigram inverted index narrows the documents on which a rule's regular expression runs.

DataFrame functions only. A rule's Boolean trigram query is derived from its pattern (`trigram_queries`): every match holds, of
each clause, all trigrams of one alternative at least. The index is a written table of postings (trigram, doc_id): the trigrams of the
lower-cased texts, cut out in one pass, that some query asks for, however many those are. Postings of a rule's trigrams are
intersected per document, and only the candidates are verified by the regular expression; a rule without a mandatory trigram is
run on every document. Candidates are stored, so their size is known: only by that size does Spark broadcast them to the
texts; more of them are joined by a shuffle.

A rule's matches are leftmost and do not overlap; the length bound applies afterwards, so a match that fails it still uses up
its text. Positions are in code points, ends exclusive; spans are ordered by start, then by the order of the rules.

Defined cases: a null or empty text has no span; a null id is a document like any other (postings and documents meet null-safe);
rows with the same id share candidates, and each is verified on its own text; repeated rows are scanned one by one; extra
columns stay, columns named like the added ones are replaced.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.frames import whole_row
from docmill.llm.trigrams import Query, derive
from docmill.session import work_dir, written


@dataclass(frozen=True)
class Rule:
    """kind, pattern, the group whose length is bounded, and the least length."""

    kind: str
    pattern: str
    group: int
    least: int


#: The base rules, as fixed values.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: More kinds of credentials, by their public prefixes.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
)
RULES = BASE + MORE


def trigram_query(rule: Rule) -> Query | None:
    """The rule's clauses; None if some match may hold no trigram."""
    return derive(rule.pattern) or None


def build_index(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Write the postings (trigram, doc_id) of the rules' trigrams to the shared folder and read them back."""
    grams = sorted({g for r in rules for clause in trigram_query(r) or () for way in clause for g in way})
    # The look-ahead takes no text, so trigrams overlap; one expression cuts them all out of a text in one pass.
    own = F.regexp_extract_all(F.lower("text"), F.lit("(?s)(?=(.{3}))"), F.lit(1))
    there = F.array_intersect(own, F.array(*map(F.lit, grams)).cast("array<string>"))
    path = work_dir(docs.sparkSession, "trigrams")
    docs.select("doc_id", F.explode(there).alias("trigram")).write.parquet(path)
    return docs.sparkSession.read.schema(docs.select("doc_id").schema.add("trigram", "string")).parquet(path)


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document that some rule's Boolean query selects, with the kinds of those rules."""
    queries = [(r.kind, q) for r in rules if (q := trigram_query(r)) is not None]
    seen = postings.groupBy("doc_id").agg(F.collect_set("trigram").alias("grams"))  # at most the trigrams of all rules

    def holds(query: Query) -> Column:
        has = lambda way: reduce(operator.and_, (F.array_contains("grams", g) for g in sorted(way)))
        return reduce(operator.and_, (reduce(operator.or_, map(has, clause)) for clause in query))

    kinds = F.array_compact(F.array(*(F.when(holds(q), F.lit(kind)) for kind, q in queries)).cast("array<string>"))
    return seen.select(F.col("doc_id").alias("candidate_id"), kinds.alias("candidate_kinds")).where(F.size("candidate_kinds") > 0)


def rule_spans(rule: Rule, order: int) -> Column:
    """A rule's spans in `row.text` as structs (start, rule, kind, end).

    What stands between matches and the matches themselves alternate, so positions are sums of their lengths.
    """
    text = F.coalesce("row.text", F.lit(""))
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    bounded = whole if rule.group == 0 else F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    steps = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), bounded.alias("bounded"))
    found = F.aggregate(
        F.filter(steps, lambda s: s["whole"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,rule:int,kind:string,end:int>>").alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["whole"]).alias("at"),
            F.when(s["bounded"] >= rule.least, F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + s["gap"]).alias("start"), F.lit(order).alias("rule"), F.lit(rule.kind).alias("kind"), (acc["at"] + s["gap"] + s["whole"]).alias("end"),
            )))).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    none = F.array().cast("array<struct<start:int,rule:int,kind:string,end:int>>")
    wanted = F.rlike(text, pattern)
    if trigram_query(rule) is not None:
        wanted = F.array_contains("candidate_kinds", rule.kind) & wanted
    return F.when(wanted, found["spans"]).otherwise(none)


def _found(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(row, secret_spans): every row as a struct and its spans."""
    candidate = written(candidates(build_index(docs, rules), rules), "candidates")
    joined = docs.select(whole_row(docs)).join(candidate, F.col("row.doc_id").eqNullSafe(F.col("candidate_id")), "left")
    spans = F.array_sort(F.concat(*(rule_spans(r, i) for i, r in enumerate(rules))))
    return joined.select("row", spans.alias("secret_spans"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with `secret_spans` added: structs (start, rule, kind, end) by start, then rule."""
    return _found(docs.drop("secret_spans"), rules).select("row.*", "secret_spans")


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets(docs: DataFrame) -> DataFrame:
    """Per document: spans of each base kind, the digest of the base spans, and all spans."""
    base = F.filter("secret_spans", lambda s: s["rule"] < len(BASE))
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", *(count(r.kind).alias(f"n_{r.kind}") for r in BASE), F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("secret_spans")).alias("spans"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every span (overlapping ones as one) replaced by [secret]; n_chars follows the text."""
    text = F.coalesce("row.text", F.lit(""))
    merged = F.aggregate(
        "secret_spans",
        F.struct(F.lit(1).alias("at"), F.lit("").cast("string").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"] + 1).alias("at"),
            F.when(s["start"] + 1 >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"], s["start"] + 1 - acc["at"]), F.lit("[secret]"))).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"], F.length(text) - acc["at"] + 1)),
    )
    found = _found(docs).select("row", F.when(F.size("secret_spans") > 0, merged).alias("redacted"))
    own = {c: F.col(f"row.`{c}`") for c in docs.columns}
    own["text"] = F.coalesce("redacted", own["text"])
    if "n_chars" in own:
        own["n_chars"] = F.coalesce(F.length("redacted").cast("long"), own["n_chars"])
    return found.select(*(v.alias(c) for c, v in own.items()))


def sql() -> str:
    """The same for DuckDB. A match's place is where its text first stands after the match before it."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for i, r in enumerate(RULES):
        parts.append(f"SELECT doc_id, text, {i} AS rule, {text(r.kind)} AS kind, {r.least} AS least, regexp_extract_all(text, {text(r.pattern)}, 0) AS whole, regexp_extract_all(text, {text(r.pattern)}, {r.group}) AS bounded FROM docs")
    return f"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS (SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE len(whole) > 0),
places AS (
  SELECT doc_id, rule, 1 AS k, instr(text, whole[1]) - 1 AS start, instr(text, whole[1]) - 1 + length(whole[1]) AS stop FROM found
  UNION ALL
  SELECT p.doc_id, p.rule, k + 1, stop + instr(substr(text, stop + 1), whole[k + 1]) - 1,
    stop + instr(substr(text, stop + 1), whole[k + 1]) - 1 + length(whole[k + 1])
  FROM places p JOIN found f ON f.doc_id = p.doc_id AND f.rule = p.rule WHERE k < len(whole)
),
spans AS (
  SELECT p.doc_id, p.rule, kind, start, kind || ':' || start || ':' || stop AS span
  FROM places p JOIN found f ON f.doc_id = p.doc_id AND f.rule = p.rule WHERE length(bounded[k]) >= least
),
sums AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(span, ',' ORDER BY start, rule) FILTER (rule < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY start, rule) AS spans
  FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN sums USING (doc_id)
"""
