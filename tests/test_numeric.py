"""Distributed selection, ordered sums and sampling against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendlens.operators import prefix, sampling, segments
from lendlens.operators.quantiles import exact_medians, exact_quantiles, from_key, select_ranks, to_keys
from lendlens.plans.tables import stage


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows; one value holds a third of them, some are missing."""
    rng = np.random.default_rng(7)
    x = np.where(rng.random(3000) < 0.34, 5.0, np.round(rng.normal(0, 10, 3000), 2))
    frame = pd.DataFrame({"SK_ID_CURR": np.arange(3000), "x": x, "y": rng.integers(0, 2, 3000)})
    df = spark.createDataFrame(frame).withColumn("x", F.when(F.col("SK_ID_CURR") % 17 != 0, F.col("x")))
    frame.loc[frame.SK_ID_CURR % 17 == 0, "x"] = np.nan
    return stage(df.repartition(4)), frame


def test_selection_ends_on_integers_too_large_for_a_double(spark):
    base = (1 << 60) + 7
    df = stage(spark.range(0, 300, 1, 4).select((F.lit(base) + F.col("id")).alias("x")))
    wanted = [0, 1, 149, 298, 299]
    n, values = select_ranks(df, {"x": (F.col("x"), lambda n: wanted)})["x"]
    assert n == 300 and values == [base + k for k in wanted]


@pytest.mark.parametrize("rows", [1, 2, 40, 3000])
def test_quantiles_are_exact_at_any_size(skewed, rows):
    df, frame = skewed
    points = [0.0, 0.01, 0.33, 0.5, 0.66, 0.95, 1.0]
    some = frame[frame.SK_ID_CURR.between(1, rows)]
    found = exact_quantiles(df.where(f"SK_ID_CURR between 1 and {rows}"), {"x": (F.col("x"), points)})["x"]
    np.testing.assert_allclose(found, some.x.quantile(points), rtol=1e-12)


def test_keys_keep_the_order_of_all_kinds_of_numbers(spark):
    doubles = np.array([-np.inf, -1e300, -1.5, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e300, np.inf, np.nan])
    keys = to_keys(doubles)
    assert (np.diff(keys.astype(object)) >= 0).all() and keys[4] == keys[5]
    assert [from_key(int(k), False) for k in keys[:-1]] == doubles[:-1].tolist() and np.isnan(from_key(int(keys[-1]), False))
    whole = np.array([-(2**63), -1, 0, 1, 2**63 - 1])
    assert [from_key(int(k), True) for k in to_keys(whole)] == whole.tolist()
    mixed = spark.createDataFrame([(1, 2.5, None), (-7, None, None), (3, -0.5, None)], "a int, b double, c float")
    wanted = {c: (F.col(c), lambda n: [0, n - 1]) for c in "abc"}
    assert select_ranks(mixed, wanted) == {"a": (3, [-7, 3]), "b": (2, [-0.5, 2.5]), "c": (0, [None, None])}
    with pytest.raises(TypeError, match="string"):
        select_ranks(mixed, {"x": (F.lit("x"), lambda n: [0])})


def test_ranks_out_of_range_and_all_null(spark, skewed):
    df, _ = skewed
    n, values = select_ranks(df, {"x": (F.col("x"), lambda n: [-1, n, 0])})["x"]
    assert values[:2] == [None, None] and values[2] is not None
    nothing = spark.range(3).select(F.lit(None).cast("double").alias("z"))
    assert exact_medians(nothing, ["z"]) == {"z": None}


def test_running_sums_match_sorted_cumsum(skewed):
    df, frame = skewed
    cuts = prefix.find_cuts(df, "x", rows_per_range=200)
    assert len(cuts.bounds) > 4 and 5.0 in cuts.heavy
    rows = prefix.running_sums(df, "x", {"n": F.count(F.lit(1)), "s": F.sum("y")}, ["y"], cuts).collect()
    for y, group in frame.dropna().groupby("y"):
        counts = group.x.value_counts().sort_index()
        expected = dict(zip(counts.index, counts.cumsum() - counts))
        mine = {r["x"]: r["n_before"] for r in rows if r["y"] == y}
        assert mine == expected


def test_average_rank_with_hot_value(skewed):
    df, frame = skewed
    mine = {r["SK_ID_CURR"]: r["avg_rank"] for r in prefix.average_rank(df, "x").collect()}
    expected = dict(zip(frame.SK_ID_CURR, frame.x.rank()))
    assert len(mine) == len(frame)
    for key, rank in expected.items():
        assert (mine[key] is None and np.isnan(rank)) or mine[key] == rank


def test_single_and_empty_keys(spark):
    one = spark.createDataFrame([(1, 2.0), (2, 2.0)], "SK_ID_CURR bigint, x double")
    assert {r["avg_rank"] for r in prefix.average_rank(one, "x").collect()} == {1.5}
    assert prefix.average_rank(one.where("false"), "x").count() == 0


def test_correlations_match_pandas_with_gaps(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"SK_ID_CURR": np.arange(400)})
    for i, c in enumerate(segments.CORRELATED):
        frame[c] = np.round(rng.normal(0, 3, 400), 0 if i % 2 else 3)
        if i % 3 == 0 and i:
            frame.loc[rng.random(400) < 0.2, c] = np.nan
    frame["TARGET"] = rng.integers(0, 2, 400)
    df = spark.createDataFrame(frame)
    df = stage(df.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) for c in df.columns)))
    for build, method in ((segments.pearson_matrix, "pearson"), (segments.spearman_matrix, "spearman")):
        expected = frame[list(segments.CORRELATED)].corr(method=method)
        rows = build(df).collect()
        assert len(rows) == 196
        for r in rows:
            assert r["correlation"] == pytest.approx(expected.loc[r["variable"], r["other"]], abs=1e-9)


def test_spearman_over_many_ranges_and_shared_gaps(spark):
    """Ranges of few rows, frequent values, and rank arrays no wider than the different sets of gaps."""
    rng = np.random.default_rng(6)
    n = 600
    frame = pd.DataFrame({"a": rng.normal(size=n), "b": rng.normal(size=n).round(), "c": rng.random(n), "d": np.repeat(1.5, n)})
    frame["e"] = np.where(rng.random(n) < 0.5, 0.0, frame.a + rng.normal(size=n))
    frame.loc[rng.random(n) < 0.3, ["b", "c"]] = np.nan
    frame.loc[rng.random(n) < 0.1, "e"] = np.nan
    rows = spark.createDataFrame(frame)
    rows = stage(rows.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) for c in rows.columns)))
    found = segments.spearman_matrix(rows, list("abcde"), strip_rows=25)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "r2" in plan and "r3" not in plan  # all rows, gaps of b and c, gaps of e
    want = frame.corr(method="spearman")
    for r in found.collect():
        expected = want.loc[r["variable"], r["other"]]
        assert (r["correlation"] is None and np.isnan(expected)) or r["correlation"] == pytest.approx(expected, abs=1e-9)


def test_samples_and_splits(skewed):
    df, frame = skewed
    hashed = frame.SK_ID_CURR * 2654435761 % 2**32
    sample = {r[0] for r in sampling.hash_sample(df, 100).select("SK_ID_CURR").collect()}
    assert sample == set(frame.SK_ID_CURR[hashed.argsort()[:100]])
    assert sampling.hash_sample(df, 10_000).count() == 3000
    split = sampling.stratified_split(df, "y").groupBy("y", "split").count().collect()
    for y, size in frame.y.value_counts().items():
        assert {r["count"] for r in split if r["y"] == y and r["split"] == "test"} == {int(0.2 * size)}


def test_top_bottom_breaks_ties_by_key(skewed):
    df, frame = skewed
    filled = df.fillna(0.0, ["x"])
    ordered = frame.fillna(0.0).sort_values(["x", "SK_ID_CURR"], ascending=[False, True]).SK_ID_CURR.tolist()
    tails = sampling.top_bottom(filled, "x").collect()
    assert {r["SK_ID_CURR"] for r in tails if r["tail"] == "top"} == set(ordered[:600])
    assert {r["SK_ID_CURR"] for r in tails if r["tail"] == "bottom"} == set(ordered[2400:])


def test_sample_splits_shared_hashes_by_key(spark):
    """Keys 2**31 apart share a hash; the smaller key is taken first."""
    keys = [k + shift for k in range(50) for shift in (0, 2**31)]
    df = spark.createDataFrame([(k,) for k in keys], "SK_ID_CURR bigint")
    ordered = sorted(keys, key=lambda k: (k % 2**31 * 2654435761 % 2**32, k))
    found = {r[0] for r in sampling.hash_sample(df, 41).collect()}
    assert found == set(ordered[:41])
    split = sampling.stratified_split(df.withColumn("s", F.lit("a")), "s", 0.41).where("split = 'test'")
    assert {r[0] for r in split.collect()} == set(ordered[:41])


def test_stratified_split_of_very_many_strata(spark):
    """100,000 strata of a few rows, one with a third of all rows, and a null one."""
    key = "if(id % 3 = 0, -1, if(id % 1001 = 7, null, id % 100003))"
    rows = spark.range(450_000).selectExpr("id as SK_ID_CURR", f"{key} as s")
    got = sampling.stratified_split(rows, "s", 0.5).toPandas()
    got["hash"] = got.SK_ID_CURR * 2654435761 % 2**32
    got["s"] = got.s.fillna(-2)
    got = got.sort_values(["s", "hash"])
    groups = got.groupby("s")
    assert groups.ngroups > 100_000 and len(got) == 450_000
    want = groups.cumcount() < np.floor(0.5 * groups.hash.transform("size"))
    assert ((got.split == "test") == want).all()


def test_high_risk_first_n(spark):
    df = spark.createDataFrame([(i, i / 10) for i in range(10)], "SK_ID_CURR bigint, PD double")
    keys = [r[0] for r in sampling.high_risk(df, first_n=9, top_k=1).collect()]
    assert keys == [8]
