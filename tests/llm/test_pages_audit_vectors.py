"""Extraction, filter audit and whitening against brute force, hand-made pages and defined cases."""

import itertools
import math
import re
import string

import numpy as np
import pytest

from docmill.llm import boosting, filter_audit, html_extraction, whitening
from docmill.llm.dom import NUMBER, Nodes, Tree, features
from docmill.llm.layouts import Layouts

SF = "/root/testdata/sf0.001"
P1 = "The council met on Tuesday to discuss the new bridge, which has been planned for several years and will cost more than expected."
P2 = "Members of three parties asked for another review. The mayor said that the work would begin in spring, whatever the outcome of it."
P3 = "Short end."

PAGES = {
    "article": (f"<html><head><title>T</title><script>var a='<p>x</p>';</script><style>p{{}}</style></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>"
                f"<article><h1>Bridge &amp; road</h1><p>{P1}</p><p>{P2}<br>And\n more.</p><p>{P3}</p></article><footer>&copy; 2020 The Paper</footer></body></html>",
                ["Bridge & road", P1, P2 + " And more.", P3]),
    "divs": (f"<body><div id='header'><a href=/>The Paper</a></div><div class='menu'><a href=/1>One</a> | <a href=/2>Two</a> | <a href=/3>Three</a></div>"
             f"<div class='cookie-banner'><p>We use cookies to make this site better for everybody who reads it.</p><button>Accept</button></div>"
             f"<div class='wrapper'><div class='post-content'><h1>Bridge</h1><p>{P1}</p><p>{P2}</p><div class='ad'>Buy two chairs and pay only for one of them, this week.</div><p>{P3}</p></div>"
             f"<div class='sidebar'><h3>Latest</h3><ul><li><a href=/4>Four</a></li><li><a href=/5>Five</a></li></ul><p>A teaser of another story, with a full sentence in it.</p></div></div>"
             f"<div class='comments'><h3>2 comments</h3><div class='comment'><p>ann</p><p>I have read the whole story and do not agree with the mayor, not at all.</p></div>"
             f"<div class='comment'><p>bob</p><p>Nor do I, the review should have been made before, and by others.</p></div></div>"
             f"<div class='footer'>All rights reserved, The Paper.</div></body>", ["Bridge", P1, P2, P3]),
    "unclosed": (f"<body><nav><ul><li><a href=/1>One</a><li><a href=/2>Two</a></ul></nav><main><h1>Bridge</h1><p><b>{P1}<br><p>{P2}<p>{P3}</main><aside class=widget><p>{P1}</p></aside>"
                 f"<form class='signup'><p>Write to us</p><label>Mail</label><input><textarea>t</textarea></form>", ["Bridge", P1, P2, P3]),
}


@pytest.fixture(scope="module")
def model(spark):
    return html_extraction.train(spark.read.parquet(f"{SF}/pages.parquet"))


@pytest.mark.parametrize("name", PAGES)
def test_page(model, name):
    html, want = PAGES[name]
    assert html_extraction.texts_of(model, [html])[0].split("\n") == want


def test_layouts_not_seen_before(model):
    """Other texts, another seed: precision and recall by characters."""
    draw, nodes = Layouts(77, ["Bridge", "A road, and more"], [P1, P2, P3], ["Home", "News", "Write to us", "More on this"]), Nodes(labelled=True)
    for _ in range(300):
        nodes.add_page(draw.page())
    tree = Tree(nodes)
    got = html_extraction.decode(tree, model.trees.log_chances(features(nodes, tree, model.words)))
    run, want = tree.kind == NUMBER["run"], np.array(nodes.label) == 1
    right = tree.chars[run & got & want].sum()
    assert right / tree.chars[run & want].sum() >= 0.97
    assert right / tree.chars[run & got].sum() >= 0.93


def test_decoding_is_the_likeliest_without_contradictions():
    """Against all assignments of three states to the nodes of a small tree."""
    nodes = Nodes()
    nodes.add_page("<div>a<p>b</p></div><div><p>c</p></div>")
    tree = Tree(nodes)
    rng = np.random.default_rng(3)
    for _ in range(20):
        log = np.log(rng.dirichlet([1, 1, 1], tree.n))
        best, kept = -math.inf, None
        for states in itertools.product(range(3), repeat=tree.n):
            leaf = [tree.end[i] == i + 1 for i in range(tree.n)]
            if any(leaf[i] and s == html_extraction.MIXED for i, s in enumerate(states)):
                continue
            if any(tree.parent[i] >= 0 and states[tree.parent[i]] != html_extraction.MIXED and s != states[tree.parent[i]] for i, s in enumerate(states)):
                continue
            if (value := sum(log[i, s] for i, s in enumerate(states))) > best:
                best, kept = value, [s == html_extraction.IN for s in states]
        assert html_extraction.decode(tree, log).tolist() == kept


def test_subtree_and_sibling_sums():
    nodes = Nodes()
    nodes.add_page("<div>ab<p>cde<a href=x>fg</a></p></div>h")
    nodes.add_page("")
    tree = Tree(nodes)
    names = [k for k, v in NUMBER.items()]
    assert [names[k] for k in tree.kind] == ["root", "div", "run", "p", "run", "run", "root"]
    assert tree.subtree(tree.chars).tolist() == [8, 7, 2, 5, 5, 1, 0]
    assert tree.subtree(tree.linked).tolist() == [2, 2, 0, 2, 2, 0, 0]
    place, count, before, after = tree.siblings()
    assert place.tolist() == [0, 0, 0, 1, 0, 1, 0] and count.tolist() == [1, 2, 2, 2, 1, 2, 1]
    assert before.tolist() == [-1, -1, -1, 2, -1, 1, -1] and after.tolist() == [-1, 5, 3, -1, -1, -1, -1]


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4)).astype(np.float32)
    x[:, 2] = x[:, 2] > 0.5
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0)).astype(int) + (x[:, 1] > 0.8)
    trees = boosting.fit(x[:3000], y[:3000], 3, rounds=40)
    chance = np.exp(trees.log_chances(x[3000:]))
    assert np.allclose(chance.sum(axis=1), 1)
    assert (chance.argmax(axis=1) == y[3000:]).mean() > 0.97


def test_page_defined_cases(spark, model):
    deep = "<div>" * 3000 + "<p>" + P1 + "</p>" + "</div>" * 3000
    long = "<article>" + f"<p>{P1}</p>" * 20_000 + "</article>"
    html = [None, "", "no markup at all", "<p>", "</div></p><<<&&am", "<!-- <p>x</p> --><![CDATA[x]]><?php ?>", deep, long, "<nav>&nbsp;</nav>", PAGES["article"][0], PAGES["article"][0], "<script>" + "<" * 50]
    rows = [(i, None, h, "x", "y", 1) for i, h in enumerate(html)] + [(None, "u", "", "x", "y", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, row string, n_chars int")
    got = {r.page_id: r for r in html_extraction.extract(pages, model).collect()}
    assert len(got) == len(rows) and got[None].url == "u"
    assert got[0].text == got[1].text == got[3].text == got[5].text == got[8].text == "" and got[0].n_chars == 0
    assert got[7].text == "\n".join([P1] * 20_000) and got[7].n_chars == len(got[7].text)
    assert got[9].text == got[10].text == "\n".join(PAGES["article"][1])
    trained = html_extraction.extract(pages).collect()
    assert len(trained) == len(rows)
    assert html_extraction.extract(pages.limit(0)).count() == 0


def brute_audit(rows, labels):
    """Every row through every order, filter by filter."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = []
    for doc, source, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = set()
        own |= {"A"} if len(words) < 200 else set()
        own |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        own |= {"C"} if 100 * sum(c in string.ascii_uppercase for c in text) > 2 * len(text) else set()
        own |= {"D"} if set(text) & set("#$%&*|") else set()
        own |= {"E"} if doc is not None and any(o is not None and o < doc and (t or "") == text for o, _, t in rows) else set()
        fails.append((source or "", own, doc in good, doc in toxic))
    out = {}
    for part in {f[0] for f in fails}:
        mine = [f for f in fails if f[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                lost = [f for f in left if letter in f[1]]
                redundant = sum(letter in f[1] for f in mine) - len(lost)
                left = [f for f in left if letter not in f[1]]
                total[letter] += len(lost)
                out[part, order, step] = [len(left), len(lost), redundant, sum(f[1] == {letter} for f in mine), sum(f[2] for f in lost), sum(f[3] for f in lost)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def audited(frame):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in frame.collect()}


DOCS = "doc_id long, source string, text string, part string, mask int, digest string, n string, good int"


def test_audit_is_brute_force(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)] + ["UPPER", "a#b", "é"]
    texts = [" ".join(rng.choice(words[: int(rng.integers(5, len(words)))], int(rng.integers(0, 420)))) for _ in range(60)] + [None, "", " \t\n", "A" * 9, "x" * 200_000]
    rows = [(int(rng.integers(0, 70)) if i % 9 else None, [None, "", "s1", "s2"][i % 4], texts[int(rng.integers(len(texts)))]) for i in range(200)]
    rows += rows[:20]
    labels = [(int(d), [0, 1, None][i % 3], [1, None, 0, 0][i % 4]) for i, d in enumerate(rng.integers(0, 70, 60))] + [(None, 1, 1)]
    docs = spark.createDataFrame([(*r, "p", 3, "d", "n", 1) for r in rows], DOCS)
    marks = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, part string")
    want = brute_audit(rows, labels)
    assert audited(filter_audit.audit(docs, marks)) == want
    assert audited(filter_audit.audit(docs.repartition(7), marks)) == want
    assert len(want) == 600 * 3


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, labels).count() == 0
    one = spark.createDataFrame([(1, None, None, "p", 0, "", "", 0)], DOCS)
    got = audited(filter_audit.audit(one, labels))
    assert got["", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120] and got["", "BACDE", 1] == [1, 0, 0, 0, 0, 0, 0]


def test_packed_fields_do_not_overflow():
    big = (1 << 55) + 12345
    total = filter_audit.packed(1, True, False) * big + filter_audit.packed(0, False, False) * 3
    counts = filter_audit.unpack(total)
    at = filter_audit.STEPS.index(("ABCDE", 1))
    assert counts[:, at].tolist() == [3, big, 0, big, big, 0]
    assert filter_audit.shapley(counts[1])[at] == 120 * big
    assert total.bit_length() <= filter_audit.WIDTH * 600 * len(filter_audit.OUTCOMES)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, deviation string, component double")


def brute_whitening(rows):
    """Exact deviations, eigenvalues and whitened columns by a symmetric decomposition."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept], float)
    sums, n = [sum(c) for c in zip(*(v for _, v in kept), strict=True)], len(kept)
    dev = [sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for _, v in kept]
    e, u = np.linalg.eigh(np.cov(x.T, bias=True))
    e, u = e[::-1], u[:, ::-1]
    return kept, n, dev, e, (x - x.mean(axis=0)) @ u / np.sqrt(np.maximum(e, 1e-300))


def test_whitening_is_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(0, 0.1, (300, 12)) * np.linspace(1, 4, 12)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += rows[:30] + [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [1.0] * 11 + [float("inf")]), (None, rows[3][1])]
    kept, n, dev, e, white = brute_whitening(rows)
    for parts in (1, 5):
        got = whitening.whiten(vectors(spark, rows).repartition(parts)).collect()
        assert len(got) == 8 * n and {r.n for r in got} == {n}
        by = {}
        for r in got:
            by.setdefault((r.vec_id, r.component), []).append(r)
        for at, (i, _) in enumerate(kept):
            assert by[i, 1][0].deviation == dev[at]
        for c in range(8):
            own = np.array([by[i, c + 1][0].whitened for i, _ in kept])
            assert min(np.abs(own - white[:, c]).max(), np.abs(own + white[:, c]).max()) < 1e-8
            assert abs(by[0, c + 1][0].explained / (e[c] / e.sum()) - 1) < 1e-10
        assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-10


def test_whitening_defined_cases(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).count() == 0
    flat = whitening.whiten(vectors(spark, [(1, [0.5, 0.25, 0.0]), (2, [0.5, 0.75, 0.0]), (3, [0.5, 0.75, 0.0])])).collect()
    assert {r.component for r in flat} == {1} and all(abs(r.explained - 1) < 1e-12 for r in flat)
    far = whitening.whiten(vectors(spark, [(1, [1e8, 0.0]), (2, [-1e8, 1.0]), (3, [0.0, 0.5])])).collect()
    assert {r.deviation for r in far if r.vec_id == 1} == {None} and far[0].identity_error < 1e-4
    with pytest.raises(Exception, match="differ in length"):
        whitening.whiten(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])])).count()


def test_factor_and_rotation():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(9, 5)) @ np.diag([1e4, 10, 1, 1e-2, 1e-4])
    v = a @ a.T
    low = whitening.pivoted_cholesky(v)
    assert np.allclose(low @ low.T, v, rtol=1e-12, atol=1e-9 * v.max())
    e, u = whitening.decompose(v)
    assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-10) and np.all(np.diff(e) <= 0)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    assert np.allclose(e[:3], want[:3], rtol=1e-8)
