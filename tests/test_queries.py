"""Registered queries against their SQL checks on the smallest test tables.

The default run takes one query per operator family; set ODDLENS_ALL=1 for all.
"""

import os
from pathlib import Path

import pytest
from compare import compare, duck

from oddlens.catalog import all_checks, all_queries

FOLDER = "/root/testdata/sf0.001"
FAMILIES = [
    "pruned_scan", "trial_log_events", "restored_split", "contract_facts_of_lines", "parsed_dates", "column_profile",
    "sample_findings", "sample_treatment", "quality_decisions", "category_codes", "transformed_features", "bin_detail",
    "univariate_overview", "ks_buckets", "variable_information", "monthly_psi_plus_one", "monthly_discrimination", "split_psi",
    "score_psi_interpolated", "spearman_pairs", "ratio_split", "rolling_folds", "selected_features", "screened_features",
    "metrics_by_split", "thinned_roc", "group_performance", "trial_table", "bounds_check", "model_review",
]
NAMES = sorted(all_checks()) if os.environ.get("ODDLENS_ALL") else FAMILIES

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are absent")


def test_every_check_has_a_query():
    assert set(all_checks()) <= set(all_queries())


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, name, FOLDER)
    assert ok, note
