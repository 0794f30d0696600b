"""URL filter: pattern rules indexed by their rarest literal token; a URL's tokens fetch the rules worth running.

DataFrame functions only. The token counts over all URLs decide which of its literal tokens indexes a rule; rules without a
literal token are run on every URL. The index is a map from tokens to rules in the expression itself: the rules are a parameter,
and no row is moved for them. A rule is a regular expression over `host/path` (a slash between, as no host holds one; the
path with its query and fragment cut off) or over the whole URL, so that only fetched rules run. Longest rule text wins; of equally long
ones a blocking rule, then the greater text.

Defined cases: a null URL or one without `://` has an empty host and path and fits no rule; it is judged like any URL that no
rule fits. Repeated rows each get their verdict; an empty table gives an empty result; other columns stay, and columns named
like the added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.frames import whole_row

TOKEN = r"[^0-9a-z]+"


@dataclass(frozen=True)
class Rule:
    """text names the rule, tokens are words every fitting URL has; whole: the pattern runs on the URL as it stands."""

    text: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    whole: bool = False


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() else f"\\{c}" for c in text)


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A host with all its subdomains and the start of a path. Only path tokens closed on both sides are certain to be there."""
    pieces = path.lower().split("/")[:-1]
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{_quoted(host)}/{_quoted(path)}", tuple(t for t in (*host.split("."), *pieces) if t.isascii() and t.isalnum()))


#: The rules of the list, as fixed values.
HOST_RULES = (
    host_rule("allow", "com", "/"), host_rule("block", "example.com", "/en/"), host_rule("allow", "www.example.com", "/en/"),
    host_rule("block", "net", "/es/"), host_rule("block", "net", "/fr/"),
)
#: Where no host rule fits: links made by trackers and feeds, and addresses without a name.
PATTERN_RULES = (
    Rule("tracker", "block", r"[?&]utm_source=", ("utm", "source"), True),
    Rule("referrer", "block", r"[?&]ref=x(?:&|#|$)", ("ref",), True),
    Rule("numeric host", "block", r"^[a-z][a-z0-9+.-]*://[0-9]+(?:\.[0-9]+){3}(?:[:/?#]|$)", (), True),
)
DEFAULT = "allow"


def ascii_lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for a null URL or one without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return (
        ascii_lower(F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit(""))),
        F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")),
    )


def rarest_tokens(pages: DataFrame, rules: tuple[Rule, ...]) -> dict[str, str]:
    """For each rule with literal tokens the one that stands in the fewest URLs (ties by name)."""
    literals = sorted({t for r in rules for t in r.tokens})
    there = F.array_intersect(F.split(F.lower("url"), TOKEN), F.array(*map(F.lit, literals)).cast("array<string>"))
    counted = pages.select(F.explode(there).alias("token")).groupBy("token").count().collect()  # the rules' tokens at most
    count = {r["token"]: r["count"] for r in counted}
    return {r.text: min(r.tokens, key=lambda t: (count.get(t, 0), t)) for r in rules if r.tokens}


def winner(rules: tuple[Rule, ...], rarest: dict[str, str], tokens: Column, url: Column, place: Column) -> Column:
    """The winning rule (struct of text and verdict) of one URL: its tokens fetch rules by number, and only those run."""
    numbered = sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text), reverse=True)
    if not numbered:
        return F.lit(None).cast("struct<text:string,verdict:string>")
    by_token: dict[str, list[int]] = {}
    for i, r in enumerate(numbered):
        if r.tokens:
            by_token.setdefault(rarest[r.text], []).append(i)
    index = F.create_map(*[x for t, own in sorted(by_token.items()) for x in (F.lit(t), F.array(*map(F.lit, own)))]).cast("map<string,array<int>>")
    listed = F.array(*[F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"), F.lit(r.pattern).alias("pattern"), F.lit(r.whole).alias("whole")) for r in numbered])
    everywhere = F.array(*[F.lit(i) for i, r in enumerate(numbered) if not r.tokens]).cast("array<int>")
    fetched = F.flatten(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(index, t), F.array().cast("array<int>"))))
    tried = F.array_sort(F.array_distinct(F.concat(everywhere, fetched)))  # in the order in which rules win
    rule = lambda i: F.get(listed, i)
    fits = F.filter(tried, lambda i: F.when(rule(i)["whole"], F.rlike(url, rule(i)["pattern"])).otherwise(F.rlike(place, rule(i)["pattern"])))
    best = rule(F.get(fits, F.lit(0)))
    return F.when(F.size(fits) > 0, F.struct(best["text"].alias("text"), best["verdict"].alias("verdict")))


def judge(pages: DataFrame, host_rules: tuple[Rule, ...] = HOST_RULES, patterns: tuple[Rule, ...] = PATTERN_RULES, default: str = DEFAULT) -> DataFrame:
    """The rows with host, path, rule (null where none of the list fits), method_rule and verdict added; one pass, no shuffle."""
    rarest = rarest_tokens(pages, (*host_rules, *patterns))
    host, path = url_parts(F.col("row.url"))
    rest = pages.drop("host", "path", "rule", "method_rule", "verdict")
    rows = rest.select(whole_row(rest)).select(
        "row", host.alias("host"), path.alias("path"), F.array_distinct(F.split(F.lower("row.url"), TOKEN)).alias("tokens"))
    place = F.concat("host", F.lit("/"), "path")
    rows = rows.select("row", "host", "path", *(
        F.when(F.col("row.url").isNotNull() & sure, winner(rules, rarest, F.col("tokens"), F.col("row.url"), place)).alias(name)
        for name, rules, sure in (("listed", host_rules, F.col("host") != ""), ("method", patterns, F.lit(True)))))
    return rows.select(
        "row.*", "host", "path", F.col("listed.text").alias("rule"), F.col("method.text").alias("method_rule"),
        F.coalesce("listed.verdict", "method.verdict", F.lit(default)).alias("verdict"))


def sql() -> str:
    """The same for DuckDB, rule by rule on every URL."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    listed = ", ".join(f"({text(r.text)}, {text(r.verdict)}, {text(r.text.partition('/')[0])}, {text('/' + r.text.partition('/')[2])})" for r in HOST_RULES)
    patterns = ", ".join(f"({text(r.text)}, {text(r.verdict)}, {text(r.pattern)})" for r in PATTERN_RULES)
    return f"""
WITH list(rule, verdict, h, p) AS (VALUES {listed}), patterns(rule, verdict, pattern) AS (VALUES {patterns}),
cut AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut
)
SELECT page_id, host, path, first_list.rule AS rule, first_pattern.rule AS method_rule,
  coalesce(first_list.verdict, first_pattern.verdict, '{DEFAULT}') AS verdict
FROM parts
LEFT JOIN LATERAL (
  SELECT rule, verdict FROM list WHERE host <> '' AND (host = h OR host LIKE '%.' || h) AND starts_with(path, p)
  ORDER BY length(rule) DESC, verdict = 'block' DESC, rule DESC LIMIT 1
) AS first_list ON TRUE
LEFT JOIN LATERAL (
  SELECT rule, verdict FROM patterns WHERE regexp_matches(coalesce(url, ''), pattern)
  ORDER BY length(rule) DESC, verdict = 'block' DESC, rule DESC LIMIT 1
) AS first_pattern ON TRUE
"""
