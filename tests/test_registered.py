"""Every registered query against its DuckDB statement on the smallest tables."""

import importlib.util
import os

import pytest

from checks.compare import compare

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry_module = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(entry_module)
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()

# Training runs are covered by small tests of their own.
TRAINING = {"m05_train_rf", "m06_train_gbt", "m07_train_svm", "m10_importance_report"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_proves_something(con, name):
    """A query whose statement finds no rows would agree whatever it did."""
    assert con.execute(f"SELECT count(*) FROM ({ORACLES[name].strip().rstrip(';')})").fetchone()[0] > 0


def test_both_searches_find_past_talks(con):
    """The short search leaves some requests to the key words; the long one finds something similar for most."""
    tops = {}
    for name in ("k14_short_search", "k14_build_context"):
        tops[name] = con.execute(f"SELECT count(*) FILTER (similar_found > 0), count(*) FROM ({ORACLES[name]})").fetchone()
    assert 0 < tops["k14_short_search"][0] < tops["k14_build_context"][0] <= tops["k14_build_context"][1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - TRAINING))
def test_runs_without_sql(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1


def test_no_hidden_row_caps():
    """Statements without the words that would thin out the tables, but for top-k reports and samples."""
    capped = {k for k, sql in ORACLES.items() if "LIMIT" in sql.upper().replace("EXCEEDS_LIMIT", "").replace("UNDER_LIMIT", "").replace("OVER_LIMIT", "")}
    assert capped <= {
        "p03_random_n", "p05_head_labeled", "p09_budget_check", "e06_sample_predictions",
        "e14_failure_cases", "m02_impute",
    } | {k for k in capped if any(w in ORACLES[k] for w in ("Limit substances", "Lifeline", "limit caffeine"))}
