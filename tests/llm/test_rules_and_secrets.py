"""N-gram probabilities and trigram queries against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from docmill.llm import quality_rules, secrets
from docmill.llm.queries import QUERIES
from docmill.llm.trigrams import derive

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", "a", "ab", "abc", "abcd", " \n", "x\ny", "é日x", "Word word WORD", "one two\nthree  four five", "日本語" * 5, "long " * 300]


def model_of():
    rng = np.random.default_rng(6)
    return quality_rules.Model(0.2, rng.normal(size=quality_rules.KINDS * quality_rules.BUCKETS), 1.3, -0.1)


def plain_margin(model, text):
    """The regression on one text alone: its n-grams counted one by one."""
    from docmill.llm.kernels import mix, word_hash

    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [np.uint64(word_hash(w.encode())) for w in re.findall(r"[^\x20\x09-\x0d]+", low)]
    n, out = quality_rules.BUCKETS, model.bias
    with np.errstate(over="ignore"):
        ones = [int(h % np.uint64(n)) for h in words]
        twos = [n + int(mix(np.array([a * np.uint64(3) + b]))[0] % np.uint64(n)) for a, b in zip(words, words[1:], strict=False)]
        threes = []
        for a, b, c in zip(low, low[1:], low[2:], strict=False):
            key = np.uint64(ord(a)) * np.uint64(1 << 42) ^ np.uint64(ord(b)) * np.uint64(1 << 21) ^ np.uint64(ord(c))
            threes.append(2 * n + int(key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)))
    for own in (ones, twos, threes):
        out += quality_rules.SCALE * sum(model.weights[g] for g in own) / max(len(own), 1)
    return out


def test_probability_is_a_function_of_the_text(spark, frame):
    model, rows = model_of(), [*TEXTS, *(r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect())]
    want = [1 / (1 + np.exp(-(model.slope * plain_margin(model, t) + model.shift))) for t in rows]
    for docs in (frame(rows), frame(rows[::-1], range(len(rows) - 1, -1, -1)), frame(rows).repartition(5)):
        got = {r.doc_id: r for r in quality_rules.judge(docs, model).collect()}
        assert [got[i].probability for i in range(len(rows))] == pytest.approx(want, abs=1e-8)
    first, again = ({r.doc_id: (r.probability, r.kept) for r in quality_rules.judge(d, model).collect()} for d in (frame(rows), frame(rows).repartition(3)))
    assert first == again
    assert quality_rules.judge(frame([]), model).count() == 0


def drawn_rule(rng, i):
    """Literals, classes, options, repeats and branches in any order."""
    def part(deep):
        kind = rng.randrange(7 if deep else 4)
        word = "".join(rng.choice("abcdxyzKEY_-0") for _ in range(rng.randint(1, 5)))
        if kind == 0:
            return word
        if kind == 1:
            return rf"[{rng.choice(['abc', 'a-f', '0-9', 'A-Za-z', 'x_'])}]{rng.choice(['', '+', '*', '?', '{2}', '{1,3}'])}"
        if kind == 2:
            return f"(?:{word}){rng.choice(['?', '+', '*', '{2}', ''])}"
        if kind == 3:
            return word[:2]
        inner = [seq(False) for _ in range(rng.randint(1, 3))]
        return f"({'?:' if rng.random() < 0.5 else '?i:'}{'|'.join(inner)}){rng.choice(['', '', '?', '+'])}"

    def seq(deep):
        return "".join(part(deep) for _ in range(rng.randint(1, 4)))

    return secrets.Rule(f"r{i}", seq(True), 0, 1)


def plain_spans(rules, text):
    out = []
    for order, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or ""):
            if m.end() > m.start() and len(m.group(rule.group)) >= rule.least:
                out.append((m.start(), order, rule.kind, m.end()))
    return tuple(sorted(out))


def test_a_hundred_drawn_rules(spark, frame):
    rng, rules = random.Random(12), []
    while len(rules) < 100:
        rule = drawn_rule(rng, len(rules))
        if not re.search(rule.pattern, ""):  # empty matches are no secrets
            rules.append(rule)
    grams = {g for r in rules for c in derive(r.pattern) for w in c for g in w}
    assert len(grams) > 150 and any(derive(r.pattern) for r in rules) and any(not derive(r.pattern) for r in rules)
    texts = [None, ""] + ["".join(rng.choice("abcdxyzKEYkey_-0 ") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    for rule in rules:  # the query misses no match
        for t in texts:
            if t and re.search(rule.pattern, t):
                own = {t.lower()[i : i + 3] for i in range(len(t) - 2)}
                assert all(any(w <= own for w in clause) for clause in derive(rule.pattern)), (rule.pattern, t)
    # The scan itself, some rules at a time: an expression for each rule of all of them would be a very long plan.
    for lo in range(0, 100, 25):
        part = tuple(rules[lo : lo + 25])
        got = Counter((r.text, tuple(map(tuple, r.secret_spans))) for r in secrets.scan(frame(texts), part).collect())
        assert got == Counter((t, plain_spans(part, t)) for t in texts)


def test_rules_without_any_trigram(spark, frame):
    rules = (secrets.Rule("hex", "[0-9a-f]{4,}", 0, 4), secrets.Rule("x", "x+", 0, 1))
    got = {r.doc_id: tuple(map(tuple, r.secret_spans)) for r in secrets.scan(frame(["12ab xx", None, "zz"]), rules).collect()}
    assert got == {0: ((0, 0, "hex", 4), (5, 1, "x", 7)), 1: (), 2: ()}


def test_more_trigrams_than_bits_of_a_long(spark, frame):
    rules = tuple(secrets.Rule(f"k{i}", f"key{i:02d}word{i:02d}[a-z]+", 0, 1) for i in range(30))
    texts = [f"a key{i:02d}word{i:02d}zz b" for i in range(30)] + ["key01word02zz"]
    got = {r.doc_id: [s.kind for s in r.secret_spans] for r in secrets.scan(frame(texts), rules).collect()}
    assert got == {**{i: [f"k{i}"] for i in range(30)}, 30: []}


def test_derived_queries():
    ways = lambda p: [{frozenset(w) for w in c} for c in derive(p)]
    assert ways("AKIA[A-Z0-9]+") == [{frozenset({"aki", "kia"})}]
    assert ways("ab?cde") == [{frozenset({"abc", "bcd", "cde"}), frozenset({"acd", "cde"})}]
    assert ways("(foo|barn)x") == [{frozenset({"foo", "oox"}), frozenset({"bar", "arn", "rnx"})}]
    assert derive("[0-9a-f]{16,}") == () and derive("(abc)?") == () and derive("ab.cd") == () and derive("é日本語") == ()
    assert ways("x(abcd)+y") == [{frozenset({"xab", "abc", "bcd"})}]
    assert derive("(?<name") == ()


def test_no_text_is_shuffled(spark):
    plan = QUERIES["op3_secret_scans"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert not any("text" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
