"""JSON payloads derived from the given tables: part sizes and customer nations choose the shape.

Each case is (JSON fragment, what the operator must make of it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.views import source_table

MALFORMED, UNKNOWN = "malformed_type_decision", "unknown_decision_type"
# fragment, label, subtypes joined by ';', anomaly
TYPES = [
    ('"Avis"', "avis", "", None),
    ('" Décision "', "decision", "", None),
    ('"DCC"', "concentration", "", None),
    ('"Lettre du minsitre de l\'économie"', "lettre_ministre", "", None),
    ('["Avis", "SOA"]', "avis", "SOA", None),
    ('[" Décision ", " DCC ", "X"]', "decision", "DCC;X", None),
    ('"[\\"Avis\\", \\"SOA \\"]"', "avis", "SOA", None),
    ('"Rapport"', None, "", UNKNOWN),
    ('["Rapport", "SOA"]', None, "SOA", UNKNOWN),
    ('""', None, "", UNKNOWN),
    ("null", None, "", UNKNOWN),
    ("12", None, "", UNKNOWN),
    ('{"a": 1}', None, "", UNKNOWN),
    ("[]", None, "", MALFORMED),
    ('["Avis", 1]', None, "", MALFORMED),
    ('["Avis", null]', None, "", MALFORMED),
    ('"[\\"Avis\\""', None, "", MALFORMED),
]
# fragment, items joined by ';' (None: malformed), is it JSON null
LISTS = [
    ('[" BTP ", "", "Énergie"]', "BTP;Énergie", False),
    ("[]", "", False),
    ('"[\'BTP\']"', "BTP", False),
    ('"[\' Énergie \', \'Transport\']"', "Énergie;Transport", False),
    ('"[\'a\', \\"d\'e\\", \'f, g\',]"', "a;d'e;f, g", False),
    ('"[\'l\\\\\'eau\']"', "l'eau", False),
    ('"[\'\\\\x41\']"', "A", False),
    ('"[]"', "", False),
    ("null", None, True),
    ('["BTP", 1]', None, False),
    ('["a", null]', None, False),
    ("12", None, False),
    ('"BTP"', None, False),
    ('"[\'BTP\'"', None, False),
    ('"[1, 2]"', None, False),
    ('"{\'a\': 1}"', None, False),
]
# fragment, ISO date or None
DATES = [
    ('"2026-08-04"', "2026-08-04"), ('" 2026-08-04T00:00:00 "', "2026-08-04"),
    ('"20260717"', "2026-07-17"), ('"2026-07-17T12:00:00Z"', "2026-07-17"),
    ('"2026-W30-1"', "2026-07-20"), ('"04 août 2026"', None), ('"2026-02-30"', None), ('""', None),
    ("null", None), ('"2026"', None), ('"2026-7-1"', None), ('"2026-07-17Tabc"', None), ("20260717", None),
]
# fragment, boolean as text or None, is it an anomaly
FLAGS = [('"Oui"', "true", False), ('" Non "', "false", False), ('"Peut-être"', None, True), ("1", None, True),
         ("null", None, False)]
# fragment, trimmed text or None
TEXTS = [('"  C2007/14 "', "C2007/14"), ('"   "', None), ("null", None), ("12", None), ('"\\u00a0x\\u00a0"', "x")]
# fragment, valid number or None
NUMBERS = [('["26-83.146", "26-83.146", "19-24.008"]', "26-83.146"), ('["19-24.008"]', "19-24.008"),
           ('["19-24.00820"]', None), ("[]", None), ("null", None), ("[12]", None), ('"26-83.146"', None)]
# fragment, issuer or None
COURT_CODES = [('"cc"', "Cour de cassation"), ('"ca"', "Cour d'appel"), ('"tj"', "Tribunal judiciaire"),
               ('"zz"', None), ("null", None), ('["cc"]', None)]


def index(column: str, cases: list) -> str:
    """1-based case index, the same SQL text for both engines."""
    return f"CAST(({column}) % {len(cases)} AS INT) + 1"


def _choose(column: str, cases: list) -> Column:
    options = F.array(*[F.lit(c[0]) for c in cases])
    return F.element_at(options, F.expr(index(column, cases)))


def authority_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``p_partkey, external_id, payload`` from part: the retail key walks through all cases."""
    part = source_table(spark, sf_dir, "part")
    parts = [
        ('{"url_site": "', F.lit(" https://decisions.example.org/")), ("", F.col("p_partkey").cast("string")),
        ('", "id_decision": ', _choose("p_size", TEXTS)),
        (', "type_decision": ', _choose("p_partkey", TYPES)),
        (', "secteur_activite": ', _choose("p_partkey", LISTS)),
        (', "entreprises_concernees": ', _choose("p_partkey + p_size", LISTS)),
        (', "decision_simplifiee": ', _choose("p_partkey", FLAGS)),
        (', "date_decision_datetime": ', _choose("p_partkey", DATES)),
        (', "titre_decision": "', F.col("p_name")), ('", "texte_complet_decision": " ', F.col("p_type")),
        (' ", "marque": " ', F.col("p_brand")), (' ", "taille": ', F.col("p_size").cast("string")),
    ]
    text = F.concat(*[x for head, c in parts for x in (F.lit(head), c)], F.lit("}"))
    blank = F.col("p_size") == 50
    return part.select(
        "p_partkey", "p_size", "p_name", "p_brand", "p_type",
        F.when(blank, F.lit("  ")).otherwise(
            F.concat(F.lit(" https://decisions.example.org/"), F.col("p_partkey").cast("string"))).alias("external_id"),
        text.alias("payload"))


def court_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``c_custkey, external_id, payload`` from customer."""
    customer = source_table(spark, sf_dir, "customer")
    parts = [
        ('{"id": "', F.col("c_name")), ('", "numbers": ', _choose("c_custkey", NUMBERS)),
        (', "jurisdiction": ', _choose("c_custkey", COURT_CODES)),
        (', "decision_date": ', _choose("c_custkey", DATES)),
        (', "summary": ', _choose("c_nationkey", TEXTS)),
        (', "themes": ["', F.col("c_mktsegment")), ('"], "type": "other", "text": "', F.col("c_mktsegment")),
    ]
    text = F.concat(*[x for head, c in parts for x in (F.lit(head), c)], F.lit('"}'))
    return customer.select(
        "c_custkey", "c_nationkey", "c_name", "c_mktsegment",
        F.when(F.col("c_nationkey") == 24, F.lit(" ")).otherwise(F.col("c_name")).alias("external_id"),
        text.alias("payload"))
