"""Every registered query against DuckDB, on the smallest tables."""

from __future__ import annotations

import pytest
from run_checks import compare, connect

import __spark_entry__ as entry
from conformance.registry import CHECKS

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = {n: c.run for n, c in CHECKS.items()}, {n: c.sql for n, c in CHECKS.items()}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    problem = compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name])
    assert problem is None, problem


def test_every_query_has_sql():
    assert all(ORACLES.values())
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 4


#: Reports with an order: the columns they are ordered by, falling ones with a minus; NULLs come last.
ORDERED = {
    "q01_tested_campaigns": ["campaign_id"],
    "q11_stale_campaigns": ["campaign_id", "margin_type", "updated_at"],
    "q12_stale_campaign_revenue": ["campaign_id", "test_group_name"],
    "q13_unique_updates": ["logged_at"],
    "q14_target_reasons": ["target"],
    "q16_logged_updates": ["-logged_at"],
    "q17_all_updates": ["campaign_id", "min_update_at"],
    "q18_disabled_campaigns": ["campaign_id", "min_update_at"],
    "q27_published_check": ["dt", "campaign_id"],
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_reports_are_in_their_order(spark, name):
    """The rows as they come, before and after which equal ones may stand in any order."""
    columns = ORDERED[name]
    found = [tuple(r) for r in QUERIES[name](spark, SF_DIR).select(*[c.lstrip("-") for c in columns]).collect()]
    assert len(found) > 1
    want = found
    for k, c in reversed(list(enumerate(columns))):
        falling = c.startswith("-")
        want = sorted((r for r in want if r[k] is not None), key=lambda r: r[k], reverse=falling) + [r for r in want if r[k] is None]
    assert found == want
