"""Tables staged in buckets of the client key are joined and grouped without moving rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lendlens.operators import features, prefix, survival
from lendlens.plans import registry, tables as t

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["feature_matrix", "ead_dynamic", "client_profile"])
def test_joins_after_staging_have_no_exchange(spark, no_broadcast, name):
    plan = _plan(registry.queries()[name](spark, SF))
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_a_chain_of_joins_shares_one_layout(spark, no_broadcast):
    at = (spark, SF)
    matrix = t.by_client(t.feature_table(at), "matrix")
    durations = t.by_client(survival.survival_dataset(matrix), "durations")
    losses = t.by_client(t.loss_table(at, matrix), "losses")
    counts = features.instalment_features(t.by_client(t.clean_lines(at), "lines"))
    chain = losses.join(durations, "SK_ID_CURR").join(counts, "SK_ID_CURR", "left").groupBy("SK_ID_CURR").agg(F.max("EAD").alias("e"))
    assert "Exchange" not in _plan(chain) and chain.count() == 1500


def test_running_sums_read_their_rows_once(spark):
    rows = t.scored_apps((spark, SF))
    sums = prefix.running_sums(rows, "PD", {"pos": F.sum("TARGET")}, cuts=prefix.find_cuts(rows, "PD"))
    sums.collect()
    plan = _plan(sums).split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
