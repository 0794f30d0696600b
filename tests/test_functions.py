"""Literal cases of the scalar functions and the per-source transforms."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from docmill.functions import dates, display, french, text, urls, variants
from docmill.operators.polymorphic import with_fields, with_main_type
from docmill.plans import silver


def column(spark, values, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def of_json(spark, fragments, fn):
    rows = spark.createDataFrame([(i, '{"t": %s}' % f) for i, f in enumerate(fragments)], "i int, j string")
    value = variants.field(F.parse_json("j"), "t")
    return [r.y for r in rows.select("i", fn(value).alias("y")).orderBy("i").collect()]


def test_strip_or_none(spark):
    got = of_json(spark, ['"  C2007/14 "', '"   "', "null", "12", '"\\u00a0x\\u2003"'], variants.strip_text)
    assert got == ["C2007/14", None, None, None, "x"]


def test_blank_rules_differ(spark):
    assert column(spark, [" ", "  ", None, "a"], text.has_text) == [False, False, False, True]
    assert column(spark, [" ", "  ", None, "a"], text.is_sql_blank) == [False, True, True, False]


def test_iso_dates(spark):
    cases = {
        "2026-08-04": date(2026, 8, 4), "2026-08-04T00:00:00": date(2026, 8, 4), "20260717": date(2026, 7, 17),
        "2026-07-17T23:30:00-05:00": date(2026, 7, 17), "2026-W53-5": date(2027, 1, 1), "2025-W53-1": None,
        "04 août 2026": None, "2026-02-30": None, "": None, "2026": None, "2026-7-1": None, "2026-07-17Tabc": None,
    }
    assert column(spark, list(cases), dates.parse_iso_date) == list(cases.values())


def test_lists(spark):
    fragments = ['[" BTP ", "", "Énergie"]', "[]", "\"['BTP']\"", '["BTP", 1]', "12", "null", "\"['BTP'\"", '"BTP"',
                 '"[1, 2]"', "\"{'a': 1}\"", '["a", null]', "\"['l\\\\'eau', \\\"c, d\\\"]\"", "\"['\\\\x41']\""]
    want = [["BTP", "Énergie"], [], ["BTP"], None, None, None, None, None, None, None, None, ["l'eau", "c, d"], ["A"]]
    assert of_json(spark, fragments, lambda v: variants.parse_str_list(v, escapes=True)) == want


def test_type_parsing(spark):
    cases = [
        ('"Avis"', "avis", [], None), ('["Décision", " DCC "]', "decision", ["DCC"], None),
        ('"[\\"Avis\\", \\"SOA\\"]"', "avis", ["SOA"], None), ('"Rapport"', None, [], "unknown_decision_type"),
        ('["Rapport", "SOA"]', None, ["SOA"], "unknown_decision_type"), ("null", None, [], "unknown_decision_type"),
        ("[]", None, [], "malformed_type_decision"), ('["Avis", 1]', None, [], "malformed_type_decision"),
        ('"[\\"Avis\\""', None, [], "malformed_type_decision"),
    ]
    rows = spark.createDataFrame([(i, '{"t": %s}' % c[0]) for i, c in enumerate(cases)], "i int, j string")
    out = with_main_type(with_fields(rows.withColumn("v", F.parse_json("j")), "v", {"f": "t"}), "f",
                         silver.AUTHORITY_TYPES, ("label", "subtypes", "anomaly"))
    assert [(r.label, r.subtypes, r.anomaly) for r in out.orderBy("i").collect()] == [c[1:] for c in cases]


def test_authority_transform(spark):
    payload = {
        "id_decision": "C2007/14 ", "type_decision": ["Avis", "SOA"], "date_decision_datetime": "2026-01-02",
        "secteur_activite": "['BTP']", "entreprises_concernees": 12, "decision_simplifiee": "Peut-être",
        "titre_decision": " t ", "texte_complet_decision": " brut ", "annee": 2026, "note": " x ", "vide": None,
    }
    raw = spark.createDataFrame([("k1", json.dumps(payload)), (" ", "{}"), ("k2", "{}")], "external_id string, payload string")
    rows = {r.external_id: r for r in silver.authority("a")(raw).collect()}
    one = rows["k1"]
    assert (one.decision_number, one.decision_type, one.title, one.text, one.sectors) == (
        "C2007/14", "avis", "t", " brut ", ["BTP"])
    assert json.loads(one.attributes) == {
        "annee": 2026, "note": "x", "vide": None, "entreprises_concernees": [], "decision_simplifiee": None, "subtypes": ["SOA"]}
    assert sorted(one.anomalies) == ["invalid_decision_simplifiee", "malformed_entreprises"]
    assert rows[None].anomalies == ["missing_external_id"]
    assert sorted(rows["k2"].anomalies) == ["invalid_decision_date", "unknown_decision_type"]
    counts = silver.row_counts(silver.authority("a")(raw)).first()
    assert (counts.n_read, counts.n_written, counts.n_skipped) == (3, 2, 1)


def test_court_transform(spark):
    good = {"numbers": ["19-24.008", "19-24.008"], "jurisdiction": "cc", "decision_date": "2026-07-29", "summary": " s ",
            "text": "t", "type": "other", "number": "corrupt"}
    bad = {"numbers": ["19-24.00820"], "jurisdiction": ["cc"]}
    raw = spark.createDataFrame([("i1", json.dumps(good)), ("i2", json.dumps(bad))], "external_id string, payload string")
    one, two = silver.court("c")(raw).orderBy("external_id").collect()
    assert (one.decision_number, one.issuer, one.sectors, one.title) == ("19-24.008", "Cour de cassation", [], None)
    assert json.loads(one.attributes)["numbers"] == ["19-24.008"] and json.loads(one.attributes)["summary"] == " s "
    assert "summary" not in json.loads(two.attributes) and json.loads(two.attributes)["ecli"] is None
    assert two.anomalies == ["invalid_decision_number", "unknown_jurisdiction", "invalid_decision_date"]


def test_hash_ignores_order_and_spaces(spark):
    got = column(spark, ['{"b": 1, "a": {"d": 1, "c": 2}}', '{"a":{"c":2,"d":1},"b":1}', "{x"], variants.payload_hash)
    assert got[0] == got[1] and got[2] is None


def test_urls(spark):
    assert column(spark, [" http://x/y// "], urls.normalize_url) == ["http://x/y"]
    join = lambda c: urls.absolute_url(F.lit("https://h.org/a/b?q=1"), c)
    assert column(spark, ["/fr/1", "c", "//o/p", "http://z", "#t", "?p=2"], join) == [
        "https://h.org/fr/1", "https://h.org/a/c", "https://o/p", "http://z", "https://h.org/a/b?q=1#t", "https://h.org/a/b?p=2"]
    assert column(spark, ["a b/~*é"], urls.percent_encode) == ["a%20b%2F~%2A%C3%A9"]


def test_display_title(spark):
    rows = spark.createDataFrame([
        ("T", "Cour", date(2026, 9, 16), "26-1", "x"), (" ", "Cour", date(2026, 10, 1), "26-1", "x"),
        (None, None, date(2026, 8, 29), None, "x"), (None, None, None, None, "x")],
        "t string, i string, d date, n string, e string")
    got = [r[0] for r in rows.select(display.display_title(*[F.col(c) for c in "tidne"])).collect()]
    assert got == ["T", "Cour, 1er octobre 2026, n° 26-1", "29 août 2026", "Décision x"]


def test_number_labels(spark):
    got = column(spark, ["1.00", "1.50", "100", "0.98"], text.number_label)
    assert got == ["1", "1.5", "100", "0.98"]
    assert column(spark, ["<= 25", "== -1.50", "x"], lambda c: text.expectation_bound(c).cast("double")) == [25.0, -1.5, None]


def test_tokens_and_stems(spark):
    got = column(spark, ["L’électricité d'aujourd'hui, n° 83.146 et l'Étang"], french.terms)
    assert got[0] == ["electricite", "aujourd'hui", "83.146", "etang"]
    words = ["chevaux", "decisions", "organisateur", "indicatrice", "concentration", "activement", "appelle", "petite"]
    stems = column(spark, [words], french.stems, "array<string>")[0]
    assert stems == ["cheval", "decision", "organis", "indiqu", "concent", "actif", "apel", "petit"]


def test_window(spark):
    from docmill.plans import runs

    today, last = F.lit(date(2026, 9, 27)), F.lit(date(2026, 9, 20))
    none = F.lit(None).cast("date")
    pairs = [runs.window(last, today), runs.window(last, today, 0), runs.window(none, today),
             runs.window(F.lit(date(2026, 9, 27)), today, 0), runs.window(last, today, start=F.lit(date(2026, 1, 1)))]
    row = spark.range(1).select(*[F.array(a, b) for a, b in pairs]).first()
    assert [tuple(x) for x in row] == [
        (date(2026, 9, 7), date(2026, 9, 27)), (date(2026, 9, 21), date(2026, 9, 27)), (date(2026, 9, 20), date(2026, 9, 27)),
        (date(2026, 9, 28), date(2026, 9, 27)), (date(2026, 1, 1), date(2026, 9, 27))]
    with pytest.raises(ValueError):
        runs.window(last, today, -1)


def test_dates_as_the_standard_library_reads_them(spark):
    cases = [
        "2026-W30", "2026-W30-1", "2026W301", "2026W30", "2026-W54", "2026-07-17x12:00:00", "2026-07-17 12:00:00+23:59", "2026-07-17T12:00:00+99:99", "0000-01-01",
        "2026-07-17T", "20260717T12", "2026-W30-8", "2026-W30 12:00", "2026W30T12:00", "2026-W30-1-12:00",
        "2026-W30-5", "2026-W30-22:00", "2026-W30512:00", "2026W30-1", "2026-W301", "2026-07-17T24:00",
    ]
    want = []
    for c in cases:
        try:
            want.append(datetime.fromisoformat(c).date() if c != "2026-07-17T24:00" else None)
        except ValueError:
            want.append(None)
    assert column(spark, cases, dates.parse_iso_date) == want


def test_links_with_dot_segments(spark):
    from urllib.parse import urljoin

    base = "https://h.org/a/b/c?q=1"
    links = ["../x", "./x", "/x/../y", "..", ".", "../../../x", "x/./y/../z?p=../q#../r", "../", "x/..", "/./", "...", "/a/..b/c", "https://o/../x"]
    got = column(spark, links, lambda c: urls.absolute_url(F.lit(base), c))
    assert got == [urljoin(base, link) for link in links]


def test_list_literals_are_read_as_the_language_reads_them(spark):
    """Drawn list texts, with every kind of escape, against the language's own reader."""
    import ast
    import random
    import warnings

    rng = random.Random(4)
    bits = ["a", "é", " ", ",", "[", "]", "日", "'", '"', "\\\\", "\\'", '\\"', "\\n", "\\t", "\\a", "\\v", "\\x41", "\\xe9", "\\u00e9", "\\u65e5", "\\U0001F600",
            "\\101", "\\7", "\\0", "\\d", "\\ ", "\\x4", "\\u12", "\\U00110000", "\\\n", "\\"]

    def literal():
        quote = rng.choice("'\"")
        body = "".join(b for b in rng.choices(bits, k=rng.randint(0, 6)) if b != quote)
        return f"{rng.choice(['', '', '', 'r', 'u', 'R'])}{quote}{body}{quote}"

    texts = ["[" + rng.choice([", ", ",", " , ", ",\n"]).join(" ".join(literal() for _ in range(rng.choice([1, 1, 1, 2]))) for _ in range(rng.randint(0, 4))) + rng.choice(["]", "]", ",]", " ] "]) for _ in range(900)]
    texts += ["['a' 'b', r'\\d' \"c\"]", "[b'a']", "[f'a']", "['a', 1]", "[('a')]]", "[,]", "['a'", "[]", "[ ]", None, "['\\\\', '\\'']"]

    def read(text):
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                value = ast.literal_eval(text.strip())
        except (ValueError, SyntaxError, AttributeError):
            return None
        return value if isinstance(value, list) and all(isinstance(x, str) for x in value) else None

    got = column(spark, texts, variants.list_literal)
    wrong = [(t, g, read(t)) for t, g in zip(texts, got, strict=True) if g != read(t)]
    assert not wrong, wrong[:5]
    assert sum(g is None for g in got) > 100 and sum(bool(g) for g in got) > 300


def test_repeated_keys_keep_the_last_value(spark):
    variants.last_key_wins(spark)
    got = column(spark, ['{"a":1,"b":2,"a":3}', '{"b":2,"a":3}', '{"a":{"x":1,"x":2}}', '{"a":{"x":2}}', "{"], variants.payload_hash)
    assert got[0] == got[1] and got[2] == got[3] and got[4] is None
