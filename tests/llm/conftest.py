import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, quality_kept string, n_words string, secret_spans string, fingerprint_bits string"
#: More names that the operators use on the way.
CLASHING = ("row", "candidate_id", "candidate_kinds", "redacted", "text_key", "own_key", "hit_id", "keep_id", "keep_key", "root", "bits", "held", "block", "label", "probability", "score")


@pytest.fixture
def frame(spark):
    """Documents with columns whose names clash with what the operators add."""

    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, None, "s", None if t is None else len(t), "x", "y", "z", "f") for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, DOCS).selectExpr("*", *(f"'own' AS {c}" for c in CLASHING))

    return make
