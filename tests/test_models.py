"""Metrics, loss, survival, explanations, fairness, stress, uplift and fits."""

from __future__ import annotations

import math
from itertools import product
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendlens.operators import boosting, clean, cox, explain, govern, learn, loss, metrics, scoring, survival, uplift
from lendlens.sources.session import stage


def scores(spark, labels, values):
    return spark.createDataFrame(list(zip(range(len(labels)), labels, values)), "SK_ID_CURR bigint, TARGET int, PD double")


def test_perfect_separation(spark):
    df = scores(spark, [0, 0, 1, 1], [0.1, 0.4, 0.6, 0.9])
    assert metrics.roc_auc_gini(df).first().asDict() == {"roc_auc": 1.0, "gini": 1.0}
    assert metrics.confusion_metrics(df).first()["f1_score"] == 1.0
    assert metrics.ks_statistic(df).first()["ks_statistic"] == 1.0
    assert metrics.pr_auc_trapezoid(df).first()["pr_auc"] == pytest.approx(1.0)


def test_ranking_metrics_against_brute_force(spark):
    rng = np.random.default_rng(1)
    y, p = rng.integers(0, 2, 300), np.round(rng.random(300), 1)
    df = stage(scores(spark, y.tolist(), p.tolist()))
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    auc = metrics.roc_auc_gini(df).first()["roc_auc"]
    assert auc == pytest.approx(wins / len(pos) / len(neg))
    flipped = metrics.roc_auc_gini(df.withColumn("PD", -F.col("PD"))).first()["roc_auc"]
    assert auc == pytest.approx(1 - flipped)
    ks = max(abs((pos <= t).mean() - (neg <= t).mean()) for t in p)
    assert metrics.ks_statistic(df).first()["ks_statistic"] == pytest.approx(ks)
    area = ap = 0.0
    last_r, last_p = 0.0, 1.0
    for t in sorted(set(p), reverse=True):
        tp, fp = (pos >= t).sum(), (neg >= t).sum()
        r, q = tp / len(pos), tp / (tp + fp)
        area, ap = area + (r - last_r) * (q + last_p) / 2, ap + (r - last_r) * q
        last_r, last_p = r, q
    assert metrics.pr_auc_trapezoid(df).first()["pr_auc"] == pytest.approx(area)
    assert metrics.average_precision(df).first()["average_precision"] == pytest.approx(ap)


def test_single_class(spark):
    df = scores(spark, [0, 0], [0.2, 0.7])
    assert metrics.roc_auc_gini(df).first()["roc_auc"] is None
    assert metrics.confusion_metrics(df).first()["recall_sensitivity"] == 0.0
    ks = metrics.ks_statistic(df).collect()
    assert ks == [] or ks[0]["ks_statistic"] == 0.0


def test_profit_sweep_against_brute_force(spark):
    rng = np.random.default_rng(2)
    grid = 0.01 + np.arange(100) * ((0.99 - 0.01) / 99)
    p = np.concatenate([rng.random(200), grid[[0, 3, 50, 99]], [0.0, 1.0]])
    y = rng.integers(0, 2, len(p))
    rows = metrics.threshold_profit_sweep(scores(spark, y.tolist(), p.tolist())).orderBy("threshold").collect()
    assert len(rows) == 100
    for r, t in zip(rows, grid):
        assert (r["approved_good_tn"], r["approved_bad_fn"]) == (((p < t) & (y == 0)).sum(), ((p < t) & (y == 1)).sum())
        assert r["net_profit_usd"] == 58000 * r["approved_good_tn"] - 302000 * r["approved_bad_fn"]


def test_lgd_bounds_and_direction(loans):
    scored = loss.lgd_heuristic(loans)
    low, high = scored.agg(F.min("LGD"), F.max("LGD")).first()
    assert 0.05 <= low <= high <= 0.95
    means = {r[0]: r[1] for r in scored.groupBy("FLAG_OWN_REALTY").agg(F.avg("LGD")).collect()}
    assert means["Y"] < means["N"]


def test_exposure(loans, spark):
    for r in loss.ead_static(loans).collect():
        assert r["EAD_FACTOR"] == pytest.approx(0.75 if r["NAME_CONTRACT_TYPE"] == "Revolving loans" else 0.70 * 1.03)
    durations = loans.select("SK_ID_CURR", F.lit(12.0).alias("duration"))
    dynamic = loss.ead_dynamic(loans, durations, margin=0.0)
    assert dynamic.count() == 100 and dynamic.agg(F.max("EAD_FACTOR")).first()[0] <= 1.05
    bare = spark.createDataFrame([(1, 100.0)], "SK_ID_CURR bigint, AMT_CREDIT double")
    assert loss.ead_static(bare).first()["EAD"] == pytest.approx(72.1)


def test_expected_loss_identity_and_tiers(loans):
    tiered = loans.withColumns(
        {
            "PD": F.element_at(F.array(F.lit(0.05), F.lit(0.30), F.lit(0.75)), (F.col("SK_ID_CURR") % 3 + 1).cast("int")),
            "LGD": F.lit(0.45),
            "EAD": F.lit(100000.0),
        }
    )
    losses = loss.expected_loss(tiered)
    for r in losses.collect():
        assert r["EXPECTED_LOSS"] == pytest.approx(r["PD"] * r["LGD"] * r["EAD"])
    tiers = {r["RISK_TIER"]: r for r in loss.tier_breakdown(losses).collect()}
    assert tiers["Subprime"]["Mean_EL"] > tiers["Near-Prime"]["Mean_EL"] > tiers["Prime"]["Mean_EL"]
    assert sum(r["Loan_Count"] for r in tiers.values()) == 100
    assert sum(r["EL_Share_Pct"] for r in tiers.values()) == pytest.approx(100)
    zero = loss.expected_loss(tiered.withColumn("PD", F.lit(0.0)))
    assert zero.agg(F.max("EXPECTED_LOSS")).first()[0] == 0.0
    summary = loss.portfolio_summary(losses).first()
    assert summary["total_loans"] == 100 and 0 < summary["portfolio_el_rate_pct"] < 100


def test_stress_is_monotone(spark):
    df = spark.createDataFrame([(1e9, 0.1, 0.4), (2e9, 0.2, 0.5), (5e8, 0.5, 0.6)], "EAD double, PD double, LGD double")
    rows = {r["scenario"]: r["Total_Expected_Loss_Billions"] for r in govern.stress_test(df).collect()}
    assert rows["Baseline"] == 0.39 and rows["Baseline"] <= rows["Adverse"] <= rows["Severely Adverse"]


def test_fairness(spark):
    rows = zip("MFMFFM", [0, 0, 1, 1, 0, 1], [0, 0, 1, 0, 0, 1])
    df = spark.createDataFrame(list(rows), "g string, TARGET int, declined int")
    found = {r["group"]: r for r in govern.fairness_metrics(df, F.col("g")).collect()}
    assert found["M"]["Population_Count"] == found["F"]["Population_Count"] == 3
    assert found["M"]["Approval_Rate"] == pytest.approx(1 / 3) and found["M"]["True_Positive_Rate"] == 1.0
    ratio = {r["group"]: r for r in govern.disparate_impact(govern.fairness_metrics(df, F.col("g"))).collect()}
    assert ratio["F"]["Disparate_Impact_Ratio"] == 1.0


def test_cohort_edges_are_closed_right(spark):
    ages = spark.createDataFrame([(-int(18 * 365.25),), (-10958,), (-10957,)], "DAYS_BIRTH int")
    assert [r[0] for r in ages.select(govern.age_cohort()).collect()] == [None, "31-45", "18-30"]


def test_response_segments(spark):
    rows = list(zip(range(5), [0, 1, 0, 1, 0], [0.2, 0.8, 0.4, 0.7, 0.1], [5, 90, 15, 60, 0], [0.8, 0.2, 0.5, 0.3, 0.9]))
    df = spark.createDataFrame(
        rows, "SK_ID_CURR bigint, TARGET int, DEBT_TO_INCOME_RATIO double, INST_AVG_DPD int, EXT_SOURCE_MEAN double"
    )
    found = uplift.response_segments(df).orderBy("SK_ID_CURR").collect()
    assert all(r["true_effect"] <= 0 for r in found)
    assert [r["response_segment"] for r in found] == ["Sure Thing", "Lost Cause", "Persuadable", "Lost Cause", "Sure Thing"]


@pytest.fixture(scope="module")
def times(spark):
    rng = np.random.default_rng(5)
    n = 240
    frame = pd.DataFrame(
        {
            "SK_ID_CURR": np.arange(n),
            "duration": rng.integers(1, 30, n).astype(float),
            "event": rng.integers(0, 2, n).astype("int32"),
            "a": rng.normal(0, 1, n),
            "b": rng.normal(2, 1, n),
            "risk": np.round(rng.random(n), 1),
            "tier": rng.choice(["x", "y"], n),
        }
    )
    frame.loc[frame.tier == "y", "event"] = np.where(frame[frame.tier == "y"].duration >= 29, 1, frame[frame.tier == "y"].event)
    return stage(spark.createDataFrame(frame)), frame


def test_kaplan_meier_against_brute_force(spark, times):
    df, frame = times
    curve = survival.kaplan_meier(df)
    rows = {(r["tier"], r["duration"]): r for r in curve.collect()}
    for tier, group in frame.groupby("tier"):
        s = 1.0
        for t in sorted(group.duration.unique()):
            at_risk, d = (group.duration >= t).sum(), group.event[group.duration == t].sum()
            s *= 1 - d / at_risk
            r = rows[tier, t]
            assert (r["at_risk"], r["events"]) == (at_risk, d) and r["survival"] == pytest.approx(s)
    wiped = spark.createDataFrame([(1.0, 1, "z"), (2.0, 1, "z"), (9.0, 0, "w")], "duration double, event int, tier string")
    reads = {r["tier"]: r for r in survival.km_milestones(survival.kaplan_meier(wiped)).collect()}
    assert reads["z"]["12M_Survival"] == 0.0 and reads["w"]["12M_Survival"] == 1.0


def test_concordance_against_pairs(times):
    df, frame = times
    won = tied = total = 0
    rows = frame.to_dict("records")
    for i, j in product(rows, rows):
        later = j["duration"] > i["duration"] or (j["duration"] == i["duration"] and j["event"] == 0)
        if i["event"] == 1 and later:
            total += 1
            won += j["risk"] < i["risk"]
            tied += j["risk"] == i["risk"]
    r = survival.concordance_index(df, "risk").first()
    assert (r["concordant"], r["tied"], r["comparable"]) == (won, tied, total)
    assert r["c_index"] == pytest.approx((won + tied / 2) / total)


def test_concordance_keeps_fractions_and_long_durations(spark):
    rng = np.random.default_rng(8)
    rows = [(float(d), int(e), float(r)) for d, e, r in zip(rng.random(150) * 150, rng.integers(0, 2, 150), rng.random(150).round(1))]
    rows += [(70.0, 1, 0.5), (80.0, 1, 0.4), (100.0, 0, 0.3), (10.2, 1, 0.9), (10.8, 1, 0.9)]
    want = [0, 0, 0]
    for (d, e, r), (later, other, low) in product(rows, rows):
        if e == 1 and (later > d or (later == d and other == 0)):
            want = [want[0] + (low < r), want[1] + (low == r), want[2] + 1]
    rows.append((None, 1, 0.1))
    got = survival.concordance_index(spark.createDataFrame(rows, "duration double, event int, risk double"), "risk").first()
    assert [got["concordant"], got["tied"], got["comparable"]] == want


@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_concordance_over_many_ranges(spark, hot):
    """Ranges of few rows, frequent risks and durations; no row is copied once per bit of its class."""
    rng = np.random.default_rng(21)
    n = 1500
    risk = np.where(rng.random(n) < hot, 0.25, rng.random(n).round(2 if hot else 9))
    t = np.where(rng.random(n) < hot, 12.0, rng.random(n) * 60)
    e = (rng.random(n) < 0.4).astype(int)
    first, later = e[:, None] == 1, (t[None] > t[:, None]) | ((t[None] == t[:, None]) & (e[None] == 0))
    pairs = first & later
    want = [(pairs & (risk[None] < risk[:, None])).sum(), (pairs & (risk[None] == risk[:, None])).sum(), pairs.sum()]
    rows = list(zip(t.tolist(), e.tolist(), risk.tolist()))
    df = spark.createDataFrame(rows, "duration double, event int, risk double")
    got = survival.concordance_index(df, "risk", strip_rows=20)
    assert "Generate" not in got._jdf.queryExecution().toString()
    assert list(got.first())[:3] == want
    none = survival.concordance_index(df.where("false"), "risk").first()
    assert none["comparable"] is None and none["c_index"] is None


def test_cox_says_when_it_did_not_converge(times):
    with pytest.raises(RuntimeError, match="no convergence"):
        cox.cox_fit(times[0], ["a", "b"], max_steps=1)


def _efron(frame: pd.DataFrame, names: list[str], beta: np.ndarray, means: np.ndarray):
    """Log partial likelihood, score, information and Breslow hazards, term by term."""
    x = frame[names].to_numpy() - means
    w = np.exp(x @ beta)
    value, score, information, hazards = 0.0, np.zeros(len(names)), np.zeros((len(names),) * 2), {}
    for t in sorted(frame.duration.unique()):
        risk, dead = (frame.duration >= t).to_numpy(), ((frame.duration == t) & (frame.event == 1)).to_numpy()
        value += (x[dead] @ beta).sum()
        score += x[dead].sum(axis=0)
        for k in range(dead.sum()):
            left = risk - k / dead.sum() * dead
            total = (left * w).sum()
            mean = (left * w) @ x / total
            value -= math.log(total)
            score -= mean
            information += (x * (left * w)[:, None]).T @ x / total - np.outer(mean, mean)
        if dead.any():
            hazards[t] = dead.sum() / w[risk].sum()
    return value, score, information, hazards


def _check_cox(model, frame, names):
    n, beta = len(frame), model.coefficients
    value, score, information, hazards = _efron(frame, names, beta, model.means)
    np.testing.assert_allclose(score / n, cox.PENALIZER * beta, atol=1e-7)
    assert model.reached == pytest.approx(value / n - cox.PENALIZER / 2 * beta @ beta) and model.residual < 1e-7
    want = np.linalg.inv(information + n * cox.PENALIZER * np.eye(len(names)))
    np.testing.assert_allclose(model.covariance, want, rtol=1e-6, atol=1e-12)
    got = {r["duration"]: (r["hazard"], r["cumulative_hazard"]) for r in model.hazards.collect()}
    assert set(got) == set(hazards)
    total = 0.0
    for t, h in hazards.items():
        total += h
        assert got[t] == pytest.approx((h, total))
    last = max(hazards)
    assert model.hazard_at([min(hazards) - 1, last]) == [0.0, pytest.approx(total)]


def test_cox_satisfies_score_equation(times):
    df, frame = times
    model = cox.cox_fit(df, ["a", "b"])
    _check_cox(model, frame, ["a", "b"])
    table = cox.hazard_ratios(df.sparkSession, model).collect()
    assert all(r["HR_Lower_95"] < r["Hazard_Ratio"] < r["HR_Upper_95"] for r in table)
    curve = cox.term_structure(model, df.limit(1).withColumn("persona", F.lit("p"))).orderBy("month").collect()
    values = [r["cumulative_pd"] for r in curve]
    assert len(values) == 60 and values == sorted(values) and 0 <= values[0] <= values[-1] <= 1


@pytest.mark.parametrize("kind", ["fractions", "one hot duration", "outliers"])
def test_cox_on_durations_as_they_are(spark, kind):
    rng = np.random.default_rng(11)
    n = 400
    x = rng.normal(0, 1, (n, 2))
    duration = rng.exponential(40 * np.exp(-0.5 * x[:, 0]))  # fractions, some far over 60 months
    if kind == "one hot duration":
        duration = np.where(rng.random(n) < 0.6, 60.0, np.ceil(duration / 7))
    if kind == "outliers":
        x[:3] = [[100.0, -90.0], [-120.0, 2.0], [145.0, 130.0]]
    frame = pd.DataFrame({"duration": duration, "event": (rng.random(n) < 0.6).astype("int32"), "a": x[:, 0], "b": x[:, 1]})
    odd = pd.DataFrame({"duration": [None, 3.0, 4.0], "event": [1, None, 1], "a": [0.0, 0.0, None], "b": [0.0, 0.0, 0.0]})
    df = spark.createDataFrame(pd.concat([frame, odd]), "duration double, event double, a double, b double")
    model = cox.cox_fit(df, ["a", "b"], rows_per_block=30)
    assert model.rows == n and model.reached > model.start
    _check_cox(model, frame, ["a", "b"])


def test_cox_needs_events(times):
    with pytest.raises(ValueError, match="no event"):
        cox.cox_fit(times[0].withColumn("event", F.lit(0)), ["a"])


def test_tied_sums_are_the_sums_term_by_term():
    whole = np.array([10.0, 5.0, 400.0, 3.0, 9e5, 70.0])
    tied = np.array([4.0, 5.0, 399.0, 1e-3, 8e5, 70.0])
    events = np.array([3, 1, 500, 40, 100_000, 33])
    got = cox.tied_sums(whole, tied, events.astype(float))
    for i, (a, b, d) in enumerate(zip(whole, tied, events)):
        u = a - np.arange(d) / d * b
        np.testing.assert_allclose([g[i] for g in got], [np.log(u).sum(), (1 / u).sum(), (1 / u**2).sum()], rtol=1e-10)


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.random((60, 3)) * 0.6, 3)
    rows = [(i, int(v[0] < 0.2), *map(float, v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "SK_ID_CURR bigint, TARGET int, " + ", ".join(f"{c} double" for c in clean.SCORE_COLUMNS))
    return stage(scoring.pd_proxy(df)), x


def test_attributions_add_up(scored):
    df, _ = scored
    explained = explain.proxy_contributions(df)
    for r in explained.collect():
        assert r["base"] + sum(p["contribution"] for p in r["contributions"]) == pytest.approx(r["LOGIT"])
    notices = explain.adverse_actions(explained, clean.SCORE_COLUMNS, top_n=2).collect()
    for r in notices:
        sizes = [p["Contribution"] for p in r["Reasons"]]
        assert len(sizes) <= 2 and sizes == sorted(sizes, reverse=True) and all(s >= 0 for s in sizes)
    assert explain.top_risk_notices(explain.adverse_actions(explained, clean.SCORE_COLUMNS)).count() == 3


def test_counterfactuals_against_brute_force(scored):
    df, x = scored
    rows = {r["SK_ID_CURR"]: r for r in explain.counterfactual_grid(df).collect()}
    pd_of = lambda v: 1 / (1 + math.exp(4 * (sum(v) / 3 - 0.5)))
    risky = [i for i, v in enumerate(x) if pd_of(v) > 0.6]
    assert set(rows) == set(risky)
    for i in risky:
        best = None
        for number, moves in enumerate(product(explain.MOVES, repeat=3)):
            new = [min(a + m, 1.0) for a, m in zip(x[i], moves)]
            if pd_of(new) < 0.5 - 1e-12:
                far = round(sum(round(n - a, 9) for n, a in zip(new, x[i])), 9)
                best = min(best, (far, number)) if best else (far, number)
        assert (rows[i]["distance"], rows[i]["grid_id"]) == (best or (None, None))


@pytest.fixture(scope="module")
def regression(spark):
    from lendlens.plans import tables as t

    fields = ["SK_ID_CURR", "TARGET", "AMT_INCOME_TOTAL", *explain.ACTIONABLE]
    rows = stage(t.full_features((spark, "/root/testdata/sf0.001")).select(*fields), "actionable")
    return rows, learn.fit_logistic(rows, [*explain.ACTIONABLE, "AMT_INCOME_TOTAL"])


def test_folded_regression_and_its_contributions_give_the_log_odds(regression):
    rows, model = regression
    folded = learn.fold(model)
    scored = learn.score(model, rows).withColumn("odds", folded.log_odds())
    explained = explain.fitted_contributions(scored, folded)
    logit = F.ln(F.col("PD") / (1 - F.col("PD")))
    gaps = explained.agg(F.max(F.abs(F.col("odds") - logit)), F.max(F.abs(F.col("score") - logit)), F.count(F.lit(1))).first()
    assert gaps[0] < 1e-8 and gaps[1] < 1e-8 and gaps[2] == 1500
    names = [*folded.numbers, *folded.levels]
    notices = explain.adverse_actions(explained, names).collect()
    assert max(len(r["Reasons"]) for r in notices) == 4 and len(names) == 10
    assert any(p["FeatureLevel"] for r in notices for p in r["Reasons"])


def test_actionable_counterfactuals_are_those_of_the_exhaustive_search(regression):
    rows, model = regression
    folded = learn.fold(model)
    contracts = ["Cash loans", "Revolving loans"]
    found = {r["SK_ID_CURR"]: r for r in explain.actionable_counterfactuals(rows, folded, contracts).collect()}
    odds = lambda r: folded.intercept + sum(w * r[c] for c, w in folded.numbers.items()) + folded.levels["NAME_CONTRACT_TYPE"][r["NAME_CONTRACT_TYPE"]]
    people = [r.asDict() for r in rows.collect()]
    risky = [r for r in people if odds(r) > math.log(0.6 / 0.4)]
    assert set(found) == {r["SK_ID_CURR"] for r in risky} and len(risky) > 20
    helped = 0
    for r in sorted(risky, key=odds)[:: max(1, len(risky) // 12)]:
        best = None
        for f, g, k in product(explain.CREDIT_FACTORS, explain.ANNUITY_FACTORS, contracts):
            credit, annuity = r["AMT_CREDIT"] * f, r["AMT_ANNUITY"] * g
            offer = r | {"AMT_CREDIT": credit, "AMT_ANNUITY": annuity, "NAME_CONTRACT_TYPE": k}
            offer["DEBT_TO_INCOME_RATIO"] = annuity / (r["AMT_INCOME_TOTAL"] + 1e-5)
            offer["PAYMENT_BURDEN_INDEX"] = annuity / (credit + 1e-5)
            offer["CREDIT_TERM_MONTHS"] = min(max(credit / max(annuity, 1.0), 6.0), 60.0)
            price = (1 - f) + (1 - g) + (explain.CONTRACT_COST if k != r["NAME_CONTRACT_TYPE"] else 0.0)
            for moves in product(explain.MOVES, repeat=3):
                new = {c: min(r[c] + m, 1.0) for c, m in zip(clean.SCORE_COLUMNS, moves)}
                if odds(offer | new) < 0:
                    far = price + sum(new[c] - r[c] for c in new)
                    best = far if best is None else min(best, far)
        got = found[r["SK_ID_CURR"]]
        helped += best is not None
        assert got["distance"] == (None if best is None else pytest.approx(best, abs=1e-6))
        assert got["new_pd"] is None or got["new_pd"] < 0.5 < got["original_pd"]
    assert helped


def test_lgd_model_roundtrip(loans, tmp_path):
    model, names, medians = learn.fit_lgd(loans, trees=5)
    predicted = learn.predict_lgd(model, loans, names, medians)
    assert predicted.where("LGD < 0.05 or LGD > 0.95").count() == 0 and predicted.count() == 100
    assert learn.feature_importance(model).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    model.write().overwrite().save(str(tmp_path / "lgd"))
    again = learn.predict_lgd(boosting.BoostedTreesModel.load(str(tmp_path / "lgd")), loans, names, medians)
    both = predicted.select("SK_ID_CURR", "LGD").join(again.select("SK_ID_CURR", F.col("LGD").alias("l2")), "SK_ID_CURR")
    assert both.where("LGD <> l2").count() == 0


def test_fits_need_both_classes(loans):
    with pytest.raises(ValueError, match="both classes"):
        learn.fit_logistic(loans.where("TARGET = 0"), ["AMT_CREDIT"])


def test_cox_walks_a_long_duration_in_pieces():
    """Rows of one duration beyond a piece: the same sums, and never more than a piece's squares at once."""
    rng = np.random.default_rng(3)
    n = 3 * cox.PIECE + 17
    duration = np.sort(np.where(np.arange(n) < n // 2, 5.0, rng.integers(1, 9, n)).astype(float))[::-1].copy()
    event, x, beta = rng.random(n) < 0.3, rng.normal(size=(n, 2)), np.array([0.3, -0.2])
    packed = {"block": [1], "part": [0], "duration": [duration.tobytes()], "event": [event.tobytes()], "x": [x.tobytes()]}
    context = SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value))
    table = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=context), where=lambda _: table)
    table.mapInArrow = lambda fold, _: list(fold([pa.RecordBatch.from_pydict(packed)]))
    passes, sizes, found = cox._Passes(table, 2, cox.Cuts()), [], []
    plain = passes.sums.per_run
    passes.sums.per_run = lambda w, *rest: sizes.append(len(w)) or plain(w, *rest)
    passes._walk(beta, {"top": 0.0, "later": {1: np.ones(6)}}, lambda _, pieces: found.extend(pieces), "")
    assert max(sizes) <= cox.PIECE
    got = {d: row for ds, *rest in found for d, *row in zip(ds, *rest, strict=True)}
    assert sorted(got) == sorted(set(duration[event]))
    for d, (risk, tied, events, over) in got.items():
        w, own = np.exp(x @ beta), event & (duration == d)
        for sums, chosen in ((risk - 1, duration >= d), (tied, own)):
            np.testing.assert_allclose(sums, passes.sums.moments(w[chosen], x[chosen]), atol=1e-8)
        assert events == own.sum()
        np.testing.assert_allclose(over, x[own].sum(axis=0), atol=1e-9)
