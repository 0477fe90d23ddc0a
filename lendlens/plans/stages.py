"""The five batch stages, each reading the tables the previous one wrote.

``folder`` is a location every executor reaches. Tables are Parquet; reports
are CSV (flat) or JSON (nested), written by Spark.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from lendlens.operators import (
    clean,
    cox,
    encode,
    explain,
    features,
    fitted,
    govern,
    learn,
    loss,
    metrics,
    profile,
    sampling,
    scoring,
    segments,
    survival,
    uplift,
)
from lendlens.sources import tables as io
from lendlens.sources.session import stage


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def _report(df: DataFrame, folder: str, name: str) -> None:
    """A report has few rows: one file."""
    io.write_csv(df.coalesce(1), f"{folder}/reports/{name}")


def clean_stage(apps: DataFrame, inst: DataFrame, folder: str) -> None:
    """Profile the raw tables, then write the cleaned ones."""
    _report(profile.missing_summary(apps, 25), folder, "missing")
    _report(profile.inspect_dataset(apps, "applications"), folder, "inspection")
    _report(profile.target_distribution(apps), folder, "classes")
    _report(segments.segment_age(apps), folder, "segment_age_groups")
    _report(segments.segment_credit_band(apps), folder, "segment_credit_bands")
    _report(segments.segment_by(apps, "NAME_EDUCATION_TYPE"), folder, "segment_education")
    _report(segments.segment_by(apps, "NAME_CONTRACT_TYPE"), folder, "segment_contract_type")
    repaid = stage(segments.repay_target_join(apps, segments.client_repayment(inst)), "repayment")
    _report(segments.pearson_matrix(repaid), folder, "repayment_pearson")
    _report(segments.spearman_matrix(repaid), folder, "repayment_spearman")

    fills = clean.learn_fills(apps)
    cleaned, report = clean.clean_and_report(apps, f"{folder}/applications_cleaned", fills)
    _report(report, folder, "cleaning")
    io.csv_sample(cleaned, f"{folder}/applications_sample")
    io.write_parquet(clean.clean_instalments(inst), f"{folder}/installments_cleaned")


def feature_stage(spark: SparkSession, folder: str) -> DataFrame:
    """Write the feature table: coded and published features, raw categories kept."""
    apps, inst = _table(spark, folder, "applications_cleaned"), _table(spark, folder, "installments_cleaned")
    wide = features.metadata_app_features(features.application_features(apps))
    joined = features.attach_instalments(wide, features.client_features(inst))
    return io.write_parquet(joined.fillna(0, clean.numeric_columns(joined)), f"{folder}/features")


def model_stage(spark: SparkSession, folder: str, trees: tuple[int, int] = (200, 300)) -> None:
    """Fit, save and compare the three default models on an 80/20 split."""
    wide = sampling.train_test_split(_table(spark, folder, "features"))
    names = learn.all_features(wide)
    train, test = wide.where("split = 'train'"), wide.where("split = 'test'")
    models = {
        "logistic": learn.fit_logistic(train, names),
        "boosted_depth4": learn.fit_gbt_benchmark(train, names, trees=trees[0]),
        "boosted_depth6": learn.fit_gbt_champion(train, names, trees=trees[1]),
    }
    long = None
    for name, model in models.items():
        model.write().overwrite().save(f"{folder}/models/{name}")
        scored = learn.score(model, test).select(F.lit(name).alias("model_name"), "SK_ID_CURR", "TARGET", "PD")
        long = scored if long is None else long.unionByName(scored)
    _report(metrics.model_benchmark(stage(long, "scores")), folder, "model_benchmark")
    _report(learn.feature_importance(models["boosted_depth6"]), folder, "feature_importance")
    champion = stage(learn.score(models["boosted_depth6"], wide).select("SK_ID_CURR", "TARGET", "PD"), "scores")
    io.write_parquet(champion, f"{folder}/default_scores")
    _report(metrics.threshold_profit_sweep(champion), folder, "threshold_profit")


def survival_stage(spark: SparkSession, folder: str) -> cox.CoxModel:
    """Survival table, tier curves, Cox model, term structures and calibration."""
    wide = _table(spark, folder, "features")
    covariates = [c for c in survival.COVARIATES if c in wide.columns]
    raw = stage(survival.survival_dataset(wide, covariates), "survival")
    tiers = survival.risk_terciles(raw)
    _report(survival.km_milestones(survival.kaplan_meier(tiers)), folder, "kaplan_meier")
    split = io.write_parquet(sampling.stratified_split(raw, "event"), f"{folder}/survival")
    scaler = fitted.CovariateScaler(inputCols=covariates).fit(split.where("split = 'train'"))
    design = stage(scaler.transform(split), "design")
    test = design.where("split = 'test'")
    hazard = fitted.CoxRegression(inputCols=covariates).fit(design.where("split = 'train'"))
    PipelineModel(stages=[scaler, hazard]).write().overwrite().save(f"{folder}/models/hazard")
    model = hazard.fitted
    _report(cox.hazard_ratios(spark, model), folder, "hazard_ratios")
    risky = stage(model.with_risk(design, "hazard").select("split", "duration", "event", "hazard"), "hazards")
    sides = [
        survival.concordance_index(risky.where(F.col("split") == side), "hazard").withColumn("split", F.lit(side))
        for side in ("train", "test")
    ]
    _report(sides[0].unionByName(sides[1]), folder, "concordance")
    personas = survival.borrower_personas(test, covariates)
    _report(cox.term_structure(model, personas), folder, "term_structure")
    _report(survival.survival_calibration(test, model.pd_at), folder, "survival_calibration")
    return model


def loss_stage(spark: SparkSession, folder: str, trees: int = 100) -> DataFrame:
    """Expected loss per loan from fitted scores when present, else the closed form."""
    wide = _table(spark, folder, "features")
    scored = scoring.pd_proxy_from_mean(wide, 0.5)
    if _exists(spark, f"{folder}/default_scores"):
        scores = _table(spark, folder, "default_scores").select("SK_ID_CURR", F.col("PD").alias("fitted"))
        # loans without a fitted score keep the closed form
        scored = scored.join(scores, "SK_ID_CURR", "left").withColumn("PD", F.coalesce("fitted", "PD")).drop("fitted")
    model, names, medians = learn.fit_lgd(wide, trees=trees)
    model.write().overwrite().save(f"{folder}/models/lgd")
    _report(learn.feature_importance(model), folder, "lgd_importance")
    with_lgd = learn.predict_lgd(model, scored, names, medians)
    if _exists(spark, f"{folder}/survival"):
        exposed = loss.ead_dynamic(with_lgd, _table(spark, folder, "survival"))
    else:
        exposed = loss.ead_static(with_lgd)
    losses = io.write_parquet(loss.expected_loss(exposed), f"{folder}/expected_loss")
    tiers, contracts = loss.tier_breakdown(losses), loss.contract_breakdown(losses)
    _report(tiers, folder, "loss_by_tier")
    _report(contracts, folder, "loss_by_contract")
    nested = tiers.groupBy().agg(F.sort_array(F.collect_list(F.struct("*"))).alias("tier_breakdown"))  # 3 rows
    io.write_json(nested, f"{folder}/reports/tier_breakdown")
    io.write_json(loss.portfolio_summary(losses), f"{folder}/reports/portfolio_summary")
    return losses


def govern_stage(spark: SparkSession, folder: str, trees: int = 100) -> None:
    """Notices, counterfactuals, uplift, fairness and stress reports, on the fitted scores when present."""
    wide, losses = _table(spark, folder, "features"), _table(spark, folder, "expected_loss")
    needed = ["SK_ID_CURR", "TARGET", "CODE_GENDER", "DAYS_BIRTH", *clean.SCORE_COLUMNS, *uplift.DRIVERS[:2]]
    closed = stage(scoring.pd_proxy(wide.select(*needed)), "scored")
    decided = closed
    if _exists(spark, f"{folder}/default_scores"):
        champion = learn.BoostedTreesModel.load(f"{folder}/models/boosted_depth6")
        names = champion.ensemble.binning.features
        explained = stage(champion.explain(wide).select("SK_ID_CURR", "TARGET", "contributions", "base", "score"), "explained")
        scores = _table(spark, folder, "default_scores").select("SK_ID_CURR", F.col("PD").alias("fitted"))
        decided = closed.join(scores, "SK_ID_CURR", "left").withColumn("PD", F.coalesce("fitted", "PD")).drop("fitted")
    else:
        names, explained = list(clean.SCORE_COLUMNS), explain.proxy_contributions(closed)
    io.write_json(explain.adverse_actions(explained, names), f"{folder}/reports/adverse_action_notices")
    _report(explain.global_attribution(explained, names), folder, "global_attribution")
    _report(encode.feature_names(wide, names), folder, "feature_names")
    io.write_parquet(explain.counterfactual_grid(closed), f"{folder}/counterfactuals")
    fields = [*explain.ACTIONABLE, "AMT_INCOME_TOTAL"]
    people = stage(wide.select("SK_ID_CURR", "TARGET", *fields), "actionable")
    regression = learn.fit_logistic(people, fields)
    regression.write().overwrite().save(f"{folder}/models/recourse")
    contracts = sorted(r[0] for r in people.select("NAME_CONTRACT_TYPE").distinct().collect() if r[0])  # two of them
    moves = explain.actionable_counterfactuals(people, learn.fold(regression), contracts)
    io.write_parquet(moves, f"{folder}/counterfactual_actions")

    rows = sampling.train_test_split(uplift.response_segments(wide).withColumn("TREATMENT", uplift.treatment_arm()))
    rows = stage(rows, "response")
    _report(uplift.cate_by_cell(rows, ["response_segment"]), folder, "treatment_effects")
    features = [c for c in learn.all_features(rows) if c not in ("response_segment", "true_effect")]
    learner = learn.fit_t_learner(rows.where("split = 'train'"), features, trees=trees)
    learner.write().overwrite().save(f"{folder}/models/uplift")
    effects = stage(learn.score_t_learner(learner, rows.where("split = 'test'")), "effects")
    _report(uplift.uplift_report(effects), folder, "uplift")

    decided = stage(decided.withColumn("declined", govern.declined()), "decided")
    for name, group in (("gender", F.col("CODE_GENDER")), ("age", govern.age_cohort())):
        fair = govern.fairness_metrics(decided, group)
        _report(fair, folder, f"fairness_{name}")
        _report(govern.disparate_impact(fair), folder, f"disparate_impact_{name}")
    _report(govern.stress_test(losses), folder, "stress_test")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def run_all(apps: DataFrame, inst: DataFrame, folder: str, trees: tuple[int, int, int] = (200, 300, 100)) -> None:
    """Every stage in order. NaN in either table is a missing value."""
    spark = apps.sparkSession
    apps, inst = io.nan_to_null(apps), io.nan_to_null(inst)
    clean_stage(apps, inst, folder)
    feature_stage(spark, folder)
    model_stage(spark, folder, trees[:2])
    survival_stage(spark, folder)
    loss_stage(spark, folder, trees[2])
    govern_stage(spark, folder, trees[2])
