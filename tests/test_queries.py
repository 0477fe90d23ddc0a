"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# Fits repeat the same training several times; one per family runs here.
# Hundreds of passes; test_boosting.py and test_models.py fit fewer trees.
LONG = ("fit_gbt_benchmark", "fit_gbt_champion", "fit_lgd", "uplift_t_learner")
FITS = ("cox_fit", "pd_score")


def test_keys_agree():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - set(LONG)))
def test_query_matches_sql(spark, name):
    assert compare(spark, SF, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", FITS)
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 3
