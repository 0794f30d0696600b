"""Schemas of the stored tables."""

from __future__ import annotations

RAW = (
    "source STRING, external_id STRING, payload STRING, payload_hash STRING, "
    "first_seen_run BIGINT, last_seen_run BIGINT, updated_at TIMESTAMP"
)
RUNS = (
    "run_id BIGINT, source STRING, date_type STRING, date_start DATE, date_end DATE, "
    "started_at TIMESTAMP, finished_at TIMESTAMP, status STRING, nb_fetched INT, nb_new INT, "
    "nb_changed INT, error STRING"
)
SILVER = (
    "source STRING, external_id STRING, decision_number STRING, issuer STRING, "
    "decision_type STRING, decision_date DATE, title STRING, text STRING, "
    "sectors ARRAY<STRING>, url STRING, attributes STRING, built_at TIMESTAMP"
)
EXPECTATIONS = (
    "check_name STRING, dimension STRING, severity STRING, source STRING, op STRING, bound STRING"
)
RESULTS = (
    "run_id BIGINT, check_name STRING, dimension STRING, source STRING, value DECIMAL(38,10), "
    "expected STRING, severity STRING, status STRING, error STRING, checked_at TIMESTAMP"
)

# Vocabularies.
STATUS_ORDER = ("fail", "no_data", "query_error", "unchecked", "pass")
SEVERITIES = ("error", "warning")
BLOCKING = ("fail", "no_data", "query_error")
RUN_STATUSES = ("running", "success", "failed", "skipped")
DOCUMENT_FIELDS = (
    "source", "external_id", "decision_number", "issuer", "decision_type", "decision_date",
    "title", "text", "has_text", "sectors", "url", "attributes", "indexed_at",
)
HIT_FIELDS = (
    "source", "external_id", "decision_number", "issuer", "decision_type", "decision_date",
    "title", "sectors", "url", "has_text",
)
