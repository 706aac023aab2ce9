"""Registered queries beside their oracle SQL on the smallest tables: a sample, or with ``ALL_ORACLES=1`` every one of them
(some ten minutes, as does ``python -m checks.compare`` for other sizes)."""

import os

import pytest

from checks import q_matching, q_reports, q_text, q_values  # noqa: F401
from checks.compare import compare, database
from checks.registry import ORACLES, QUERIES

SAMPLE = [
    "norm_invoice", "parse_amount", "norm_date", "date_token", "fold_name", "feed_parse", "stmt_parse", "scan_delimited",
    "period_auto", "period_manual", "source_period_split", "agg_erp", "consolidate_bank", "reconcile_rows", "dealer_summary", "audit_dates",
    "history_trend", "history_append", "rci_standardise", "reference_audit_rows", "source_inventory", "drop_empty", "column_roles",
    "neighbour_roles", "export_summary_long", "run_outputs", "closest_name_ratio", "reference_suggestions",
]


@pytest.fixture(scope="module")
def tables(sf):
    return database(sf)


@pytest.mark.parametrize("name", sorted(ORACLES) if os.environ.get("ALL_ORACLES") else SAMPLE)
def test_query_matches_oracle(spark, sf, tables, name):
    result = compare(spark, tables, QUERIES[name], ORACLES[name], sf)
    assert result.startswith("ok") and "TYPES" not in result, result


def test_every_query_has_an_oracle():
    own = {name for name, build in QUERIES.items() if not build.__module__.startswith(("lettrage.llm", "corpus_pipeline"))}
    assert own <= set(ORACLES)
