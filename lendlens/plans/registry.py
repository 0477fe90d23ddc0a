"""Registered queries: one entry per operator, each over its whole tables.

Doubles are rounded here, not in the operators, so that results can be
compared with another engine whose sums run in another order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lendlens.functions.columns import steady_round
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
    prefix,
    profile,
    sampling,
    scoring,
    segments,
    survival,
    uplift,
)
from lendlens.plans import tables as t
from lendlens.sources import fixture, tables as io
from lendlens.sources.session import fresh_path, stage

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

WHAT_IF = {"annuity -20%": (0.8, 1.0), "credit -20%": (0.8, 0.8), "annuity +50%": (1.5, 1.0)}
FEATURE_COLUMNS = (
    "DEBT_TO_INCOME_RATIO",
    "CREDIT_TO_INCOME_RATIO",
    "ANNUITY_TO_INCOME_RATIO",
    "CREDIT_TO_GOODS_RATIO",
    "PAYMENT_BURDEN_INDEX",
    "EMPLOYMENT_TO_AGE_RATIO",
    "DISPOSABLE_INCOME_PER_MEMBER",
    "INCOME_PER_FAMILY_MEMBER",
    "EXT_SOURCE_MEAN",
    "EXT_SOURCE_MIN",
    "EXT_SOURCE_PRODUCT",
    "EXT_SOURCE_WEIGHTED",
    "EXT_SOURCE_X_AGE",
    "EXT_SOURCE_X_DTI",
)
INST_COLUMNS = (
    "INST_AVG_DPD",
    "INST_MAX_DPD",
    "INST_PCT_LATE",
    "INST_AVG_PAYMENT_RATIO",
    "INST_TOTAL_DEFICIT",
    "INST_AVG_DEFICIT",
)
SINGLE_SCORES = ("EXT_SOURCE_MEAN", "EXT_SOURCE_MIN", "EXT_SOURCE_WEIGHTED", "EXT_SOURCE_PRODUCT")
MONEY = ("Total_EAD", "Total_EL", "Mean_EL")


def rounded(df: DataFrame, digits: int = 6, money: Sequence[str] = ()) -> DataFrame:
    """Doubles at ``digits`` places, money columns at 2."""
    return df.select(
        *(
            steady_round(F.col(c), 2 if c in money else digits).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        )
    )


def query(digits: int | None = 6, money: Sequence[str] = ()):
    def add(build: Callable[[t.Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = build((spark, sf_dir))
            return out if digits is None else rounded(out, digits, money)

        _QUERIES[build.__name__] = run
        return run

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- sources and sinks -----------------------------------------------------


@query(None)
def load_applications(at):
    path = fresh_path(at[0], "applications-csv")
    io.write_csv(t.raw_apps(at), path)
    return io.load_applications(at[0], path)


@query(None)
def load_installments(at):
    path = fresh_path(at[0], "installments-csv")
    io.write_csv(fixture.instalments(*at), path)
    return io.load_installments(at[0], path, ["SK_ID_CURR", "DAYS_INSTALMENT", "AMT_INSTALMENT", "AMT_PAYMENT"])


@query()
def parquet_roundtrip(at):
    return io.write_parquet(t.clean_apps(at), fresh_path(at[0], "cleaned"))


@query(None)
def csv_sample(at):
    path = fresh_path(at[0], "sample-csv")
    apps = t.raw_apps(at)
    io.csv_sample(apps, path)
    return io.read_csv(at[0], path, apps.schema)


@query(money=MONEY)
def json_report(at):
    tiers = loss.tier_breakdown(t.loss_table(at))
    nested = tiers.groupBy().agg(F.sort_array(F.collect_list(F.struct("*"))).alias("tier_breakdown"))
    path = fresh_path(at[0], "report-json")
    io.write_json(nested, path)
    return at[0].read.schema(nested.schema).json(path).select(F.inline("tier_breakdown"))


def _hashed(scored: DataFrame, name: str) -> DataFrame:
    """Key and a hash of all columns, those that only later stages of a model read among them."""
    return scored.select("SK_ID_CURR", F.xxhash64(*scored.columns).alias(name))


def _same_after_reading(at, name: str, model, kind, rows: DataFrame) -> DataFrame:
    """Rows that a saved and reloaded model changes, by hashes of all that either one makes of them."""
    path = fresh_path(at[0], f"model-{name}")
    model.write().overwrite().save(path)
    again = kind.load(path)
    both = _hashed(model.transform(rows), "a").join(_hashed(again.transform(rows), "b"), "SK_ID_CURR", "full")
    return both.agg(
        F.lit(name).alias("model"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("changed"),
    )


@query(None)
def model_roundtrip(at):
    """Regression, trees, Cox with its scalers, fills and dictionary: saved, read again, compared row by row."""
    wide = stage(t.full_features(at), "wide")  # read twice by the join below
    covariates = [c for c in survival.COVARIATES if c in wide.columns]
    texts = clean.string_columns(wide)
    durations = survival.survival_dataset(wide).withColumnRenamed("SK_ID_CURR", "key")
    rows = stage(wide.join(durations, F.col("SK_ID_CURR") == F.col("key")).drop("key"), "features")
    names = [c for c in learn.all_features(rows) if c not in ("duration", "event")]
    hazard = Pipeline(stages=[fitted.CovariateScaler(inputCols=covariates), fitted.CoxRegression(inputCols=covariates)])
    codes = Pipeline(stages=[fitted.GapFill(inputCols=texts), fitted.CategoryDictionary(inputCols=texts)])
    made = {
        "regression": (learn.fit_logistic(rows, names), learn.PipelineModel),
        "trees": (learn.fit_gbt_benchmark(rows, names, trees=10), learn.BoostedTreesModel),
        "hazard": (hazard.fit(rows), learn.PipelineModel),
        "codes": (codes.fit(rows), learn.PipelineModel),
    }
    out = None
    for name, (model, kind) in made.items():
        part = _same_after_reading(at, name, model, kind, rows)
        out = part if out is None else out.unionByName(part)
    return out


# --- profiling -------------------------------------------------------------


@query()
def missing_summary(at):
    return profile.missing_summary(t.raw_apps(at), 25)


@query()
def inspect_dataset(at):
    return profile.inspect_dataset(t.raw_apps(at), "applications")


@query()
def numeric_narrowing(at):
    return profile.numeric_narrowing(t.raw_apps(at))


@query()
def target_distribution(at):
    return profile.target_distribution(t.raw_apps(at, "TARGET"))


@query()
def imbalance_ratio(at):
    return profile.imbalance_ratio(t.raw_apps(at, "TARGET"))


@query()
def class_medians(at):
    return profile.class_medians(
        t.staged_apps(at, "TARGET", "AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_ANNUITY", "DAYS_BIRTH")
    )


@query()
def ext_score_medians(at):
    return profile.ext_score_medians(t.staged_apps(at, "TARGET", *clean.SCORE_COLUMNS))


@query(9)
def class_density(at):
    return profile.class_density(t.raw_apps(at, "TARGET", "AMT_CREDIT"), "AMT_CREDIT")


@query()
def trimmed_box_stats(at):
    names = ["AVG_DPD", "PCT_LATE_PAYMENTS", "AVG_PAYMENT_RATIO", "AVG_PAYMENT_DEFICIT"]
    return profile.trimmed_box_stats(stage(t.repayment_targets(at).select("TARGET", *names), "repayment"), names)


@query()
def score_histogram(at):
    return profile.score_histogram(t.scored_apps(at), "EXT_SOURCE_MEAN")


# --- cleaning and scalar features ------------------------------------------


@query()
def clean_employment_sentinel(at):
    return clean.clean_employment(t.raw_apps(at, "SK_ID_CURR", "DAYS_EMPLOYED"))


@query(None)
def rare_code_to_mode(at):
    apps = t.raw_apps(at, "SK_ID_CURR", *clean.RARE_CODES)
    return clean.rare_code_to_mode(apps, clean.column_modes(apps, list(clean.RARE_CODES)))


@query(None)
def bureau_zero_fill(at):
    return clean.zero_fill(t.raw_apps(at, "SK_ID_CURR", "AMT_REQ_CREDIT_BUREAU_YEAR"), clean.BUREAU_COLUMNS)


@query(None)
def social_zero_fill(at):
    return clean.zero_fill(t.raw_apps(at, "SK_ID_CURR", "DEF_30_CNT_SOCIAL_CIRCLE"), clean.SOCIAL_COLUMNS)


@query()
def median_impute(at):
    apps = t.staged_apps(at, "SK_ID_CURR", *clean.AMOUNT_COLUMNS)
    return clean.median_impute(apps, clean.exact_medians(apps, clean.AMOUNT_COLUMNS))


@query()
def ext_score_impute(at):
    apps = t.staged_apps(at, "SK_ID_CURR", *clean.SCORE_COLUMNS)
    return clean.ext_score_impute(apps, clean.exact_medians(apps, clean.SCORE_COLUMNS))


@query(None)
def categorical_explicit_missing(at):
    apps = t.raw_apps(at)
    return clean.explicit_missing(apps.select("SK_ID_CURR", *clean.string_columns(apps)))


@query()
def canonical_ratios(at):
    ratios = clean.canonical_ratios(t.raw_apps(at))
    return ratios.select(
        "SK_ID_CURR", "AGE_YEARS", "CREDIT_TO_INCOME_RATIO", "ANNUITY_TO_INCOME_RATIO", "CREDIT_TO_GOODS_RATIO"
    )


@query()
def cleaning_report(at):
    return clean.clean_and_report(t.staged_apps(at), fresh_path(at[0], "cleaned"))[1]


@query()
def clean_applications(at):
    return t.clean_apps(at).drop("AMT_CREDIT", "AMT_INCOME_TOTAL")


@query()
def burden_ratios(at):
    return features.burden_ratios(t.raw_apps(at)).select("SK_ID_CURR", *FEATURE_COLUMNS[:5])


@query()
def demographic_ratios(at):
    return features.demographic_ratios(t.raw_apps(at)).select("SK_ID_CURR", *FEATURE_COLUMNS[5:8])


@query()
def ext_score_features(at):
    return features.application_features(t.raw_apps(at)).select("SK_ID_CURR", *FEATURE_COLUMNS[8:])


@query(None)
def one_hot(at):
    apps = t.raw_apps(at)
    return encode.one_hot(apps, keep=["SK_ID_CURR"])


@query(None)
def clean_installments(at):
    return clean.clean_instalments(fixture.instalments(*at))


@query()
def installment_scalars(at):
    rows = features.instalment_scalars(fixture.instalments(*at))
    return rows.select("SK_ID_CURR", "NUM_INSTALMENT_NUMBER", "DPD", "LATE_PAYMENT", "PAYMENT_RATIO", "PAYMENT_DEFICIT")


@query()
def repayment_scalars(at):
    rows = features.repayment_scalars(fixture.instalments(*at))
    made = ["DPD", "DAYS_EARLY", "PAYMENT_DEFICIT", "PAYMENT_RATIO", "IS_LATE", "IS_UNDERPAID"]
    return rows.select("SK_ID_CURR", "NUM_INSTALMENT_NUMBER", *made)


@query()
def metadata_app_features(at):
    made = ["CREDIT_TERM_MONTHS", "CREDIT_TO_AGE_RATIO", "EXT_SOURCE_STD", "EXT_SOURCE_MAX", "EXT_SOURCE_X_EMPLOYED"]
    return features.metadata_app_features(t.raw_apps(at)).select("SK_ID_CURR", *made)


@query()
def generic_impute(at):
    return clean.generic_impute(t.staged_apps(at))


@query(None)
def encode_categoricals(at):
    apps = t.raw_apps(at)
    columns = [c for c in clean.string_columns(apps) if c != "FLAG_OWN_CAR"]
    rows = stage(apps.select("SK_ID_CURR", *columns, "FLAG_OWN_CAR"), "categories")
    return encode.encode_categoricals(rows, encode.learn_dictionary(rows, columns), ["FLAG_OWN_CAR"])


@query(None)
def readable_names(at):
    apps = t.raw_apps(at)
    return encode.feature_names(apps, learn.model_features(apps))


@query()
def high_risk_filter(at):
    scored = t.scored_apps(at)
    return sampling.high_risk(scored, top_k=100, order="LOGIT").select("SK_ID_CURR", "PD")


@query()
def simple_ratios(at):
    both = features.calculate_employment_ratio(features.calculate_dti(t.raw_apps(at)))
    return both.select("SK_ID_CURR", "DEBT_TO_INCOME_RATIO", "EMPLOYMENT_TO_AGE_RATIO")


# --- joins -----------------------------------------------------------------


@query()
def repay_target_join(at):
    return t.repayment_targets(at)


@query()
def feature_matrix(at):
    made = [*FEATURE_COLUMNS, *INST_COLUMNS, "INST_REC180_AVG_DPD", "INST_DPD_VELOCITY", "NO_INSTALLMENT_HISTORY"]
    return features.feature_matrix(*t.feature_sides(at)).select("SK_ID_CURR", "TARGET", *made)


@query()
def ead_dynamic(at):
    matrix = t.by_client(t.feature_table(at), "matrix")
    durations = survival.survival_dataset(matrix)
    apps = features.metadata_app_features(matrix).select(
        "SK_ID_CURR", "AMT_CREDIT", "NAME_CONTRACT_TYPE", "CREDIT_TERM_MONTHS"
    )
    return loss.ead_dynamic(apps, durations).select("SK_ID_CURR", "EAD_FACTOR", "EAD")


@query()
def client_profile(at):
    notices = t.by_client(explain.adverse_actions(t.explained(at), clean.SCORE_COLUMNS), "notices")
    joined = explain.client_profile(t.by_client(t.loss_table(at), "losses"), notices)
    text = F.transform("Reasons", lambda r: F.concat_ws("|", r["RawFeatureName"], r["Feature"]))
    return joined.select(
        "SK_ID_CURR", "PD", "LGD", "EAD", "EXPECTED_LOSS", "Risk_Score_LogOdds", F.array_join(text, ";").alias("reasons")
    )


# --- aggregations ----------------------------------------------------------


@query()
def segment_age(at):
    return segments.segment_age(t.raw_apps(at, "TARGET", "DAYS_BIRTH"))


@query()
def segment_credit_band(at):
    return segments.segment_credit_band(t.raw_apps(at, "TARGET", "AMT_CREDIT"))


@query()
def segment_education(at):
    return segments.segment_by(t.raw_apps(at, "TARGET", "NAME_EDUCATION_TYPE"), "NAME_EDUCATION_TYPE")


@query()
def segment_contract(at):
    return segments.segment_by(t.raw_apps(at, "TARGET", "NAME_CONTRACT_TYPE"), "NAME_CONTRACT_TYPE")


@query()
def segment_all(at):
    return segments.segment_all(t.raw_apps(at))


@query()
def installment_features(at):
    return t.client_aggregate(at, features.instalment_features).select("SK_ID_CURR", *INST_COLUMNS)


@query()
def dpd_velocity(at):
    made = ["INST_REC180_AVG_DPD", "INST_DPD_VELOCITY"]
    return t.client_aggregate(at, features.instalment_features).select("SK_ID_CURR", *made)


@query()
def metadata_inst_features(at):
    return t.client_aggregate(at, features.metadata_inst_features, cleaned=True)


@query()
def client_repayment(at):
    return t.client_aggregate(at, segments.client_repayment)


@query()
def pearson_matrix(at):
    return segments.pearson_matrix(t.repayment_targets(at))


@query()
def spearman_matrix(at):
    return segments.spearman_matrix(stage(t.repayment_targets(at), "repayment"))


@query(money=["total_original_credit_limit", "total_portfolio_ead", "total_portfolio_expected_loss"])
def portfolio_summary(at):
    return loss.portfolio_summary(t.loss_table(at))


@query(money=MONEY)
def tier_breakdown(at):
    return loss.tier_breakdown(t.loss_table(at))


@query(money=MONEY)
def contract_breakdown(at):
    return loss.contract_breakdown(t.loss_table(at))


# --- ranking, sampling -----------------------------------------------------


@query()
def average_rank(at):
    delays = t.client_aggregate(at, features.instalment_features).select("SK_ID_CURR", "INST_AVG_DPD")
    return prefix.average_rank(stage(delays, "delays"), "INST_AVG_DPD")


@query()
def borrower_personas(at):
    columns = ["SK_ID_CURR", "EXT_SOURCE_MEAN", "PAYMENT_BURDEN_INDEX", "INST_PCT_LATE"]
    rows = stage(t.feature_table(at).select(*columns), "personas")
    return survival.borrower_personas(rows).select("persona", "SK_ID_CURR", "metric")


@query()
def top_bottom_quintile(at):
    tails = sampling.top_bottom(t.scored_apps(at), "LOGIT").where("tail is not null")
    return tails.select("SK_ID_CURR", "PD", "tail")


@query()
def top_risk_notices(at):
    notices = explain.adverse_actions(t.explained(at), clean.SCORE_COLUMNS)
    return explain.top_risk_notices(notices).select("SK_ID_CURR", "TARGET", "Risk_Score_LogOdds")


@query()
def hash_sample(at):
    apps = t.staged_apps(at, "SK_ID_CURR", "TARGET", "AMT_CREDIT")
    return sampling.hash_sample(apps, 1000)


@query(None)
def train_test_split(at):
    return sampling.train_test_split(t.raw_apps(at, "SK_ID_CURR", "TARGET"))


@query(None)
def stratified_split(at):
    return sampling.stratified_split(t.staged_apps(at, "SK_ID_CURR", "TARGET"), "TARGET")


# --- model evaluation ------------------------------------------------------


@query()
def roc_auc_gini(at):
    return metrics.roc_auc_gini(t.scored_apps(at))


@query()
def ks_statistic(at):
    return metrics.ks_statistic(t.scored_apps(at))


@query()
def pr_auc_trapezoid(at):
    return metrics.pr_auc_trapezoid(t.scored_apps(at))


@query()
def average_precision(at):
    return metrics.average_precision(t.scored_apps(at))


@query()
def brier_score(at):
    return metrics.brier_score(t.scored_apps(at))


@query()
def confusion_metrics(at):
    return metrics.confusion_metrics(t.scored_apps(at))


@query()
def model_benchmark(at):
    return metrics.model_benchmark(stage(t.model_scores(at), "scores"))


@query()
def threshold_profit_sweep(at):
    return metrics.threshold_profit_sweep(t.scored_apps(at))


@query()
def regression_metrics(at):
    """Closed-form PD against the observed label, as a regression."""
    rows = t.scored_apps(at).withColumn("label", F.col("TARGET").cast("double"))
    return metrics.regression_metrics(rows, "label", "PD")


# --- loss ------------------------------------------------------------------


@query()
def pd_proxy(at):
    return t.scored_apps(at).select("SK_ID_CURR", "EXT_SOURCE_MEAN", "LOGIT", "PD")


@query()
def lgd_heuristic(at):
    ratios = features.instalment_features(fixture.instalment_lines(*at)).select("SK_ID_CURR", "INST_AVG_PAYMENT_RATIO")
    joined = t.raw_apps(at).join(ratios, "SK_ID_CURR", "left")
    return loss.lgd_heuristic(joined).select("SK_ID_CURR", "LGD")


@query()
def ead_static(at):
    return loss.ead_static(t.raw_apps(at)).select("SK_ID_CURR", "EAD_FACTOR", "EAD")


@query()
def expected_loss(at):
    return t.loss_table(at)


# --- survival --------------------------------------------------------------


@query()
def survival_dataset(at):
    return t.survival_table(at)


@query()
def standardize_covariates(at):
    """Raw (unfilled) features, so that the median fill has gaps to fill."""
    apps = features.application_features(clean.canonical_ratios(clean.clean_employment(t.raw_apps(at))))
    joined = features.attach_instalments(apps, features.client_features(t.clean_lines(at)))
    rows = stage(joined.select("SK_ID_CURR", *survival.COVARIATES), "covariates")
    return survival.standardize(rows, survival.learn_scalers(rows))


@query()
def risk_terciles(at):
    """The score needs no instalments, so none are read."""
    scores = features.application_features(t.clean_apps(at)).select("SK_ID_CURR", "EXT_SOURCE_MEAN")
    return survival.risk_terciles(stage(scores.fillna(0.0, ["EXT_SOURCE_MEAN"]), "terciles"))


def _tiered(at) -> DataFrame:
    return survival.risk_terciles(stage(t.survival_table(at, "EXT_SOURCE_MEAN"), "survival"))


@query()
def kaplan_meier(at):
    return survival.kaplan_meier(_tiered(at))


@query()
def km_milestones(at):
    return survival.km_milestones(survival.kaplan_meier(_tiered(at)))


@query()
def concordance_index(at):
    rows = stage(t.survival_table(at, "EXT_SOURCE_MEAN"), "survival")
    return survival.concordance_index(rows.withColumn("risk", scoring.logit_of_mean(F.col("EXT_SOURCE_MEAN"))), "risk")


@query()
def survival_calibration(at):
    rows = t.survival_table(at, "EXT_SOURCE_MEAN")
    logit = scoring.logit_of_mean(F.col("EXT_SOURCE_MEAN"))
    return survival.survival_calibration(rows, lambda m: F.lit(1.0) - F.exp(-F.exp(logit) * F.lit(m / 60.0)))


def _cox(at) -> tuple[cox.CoxModel, DataFrame]:
    design, covariates = t.cox_design(at)
    return cox.cox_fit(design.where("split = 'train'"), covariates), design


@query()
def cox_fit(at):
    """Harrell's C of the fitted hazard on either side of the split."""
    model, design = _cox(at)
    risky = stage(model.with_risk(design, "hazard").select("split", "duration", "event", "hazard"), "hazards")
    sides = [
        survival.concordance_index(risky.where(F.col("split") == side), "hazard").withColumn("split", F.lit(side))
        for side in ("train", "test")
    ]
    return sides[0].unionByName(sides[1]).withColumn("newton_steps", F.lit(model.steps))


@query()
def hazard_ratios(at):
    return cox.hazard_ratios(at[0], _cox(at)[0])


@query()
def term_structure(at):
    model, design = _cox(at)
    people = survival.borrower_personas(design.where("split = 'test'"), model.covariates)
    return cox.term_structure(model, people)


@query()
def cox_facts(at):
    """What must hold of a converged fit, whatever its coefficients: score equation, likelihood, marks, curves."""
    model, design = _cox(at)
    ratios = cox.hazard_ratios(at[0], model)
    mark = F.when(F.col("p") < 0.001, "***").when(F.col("p") < 0.01, "**").when(F.col("p") < 0.05, "*").otherwise("ns")
    inside = (F.col("HR_Lower_95") < F.col("Hazard_Ratio")) & (F.col("Hazard_Ratio") < F.col("HR_Upper_95"))
    fine = ratios.agg(
        F.count(F.lit(1)).alias("covariates"),
        F.bool_and(mark == F.col("Significance")).alias("marks_fit"),
        F.bool_and(inside).alias("ratios_inside"),
    )
    people = survival.borrower_personas(design.where("split = 'test'"), model.covariates)
    curves = cox.term_structure(model, people)
    earlier = F.lag("cumulative_pd").over(Window.partitionBy("persona").orderBy("month"))
    rising = curves.withColumn("ok", F.col("cumulative_pd").between(F.coalesce(earlier, F.lit(0.0)), F.lit(1.0)))
    shape = rising.agg(F.count(F.lit(1)).alias("curve_points"), F.bool_and("ok").alias("curves_rise"))
    last = model.hazards.agg(F.count(F.lit(1)).alias("event_times"), F.max("duration").alias("last_event"))
    facts = {
        "train_loans": F.lit(model.rows).cast("bigint"),
        "train_events": F.lit(model.events).cast("bigint"),
        "score_residual": F.lit(model.residual),
        "likelihood_rises": F.lit(model.reached > model.start),
    }
    return fine.crossJoin(shape).crossJoin(last).withColumns(facts)  # one row each


# --- explanation, recourse, uplift, fairness, stress -----------------------


@query()
def attributions(at):
    return explain.attributions(t.explained(at))


@query(None)
def adverse_actions(at):
    notices = explain.adverse_actions(t.explained(at), clean.SCORE_COLUMNS)
    return notices.select("SK_ID_CURR", "TARGET", "Risk_Score_LogOdds", F.posexplode("Reasons").alias("pos", "r")).select(
        "SK_ID_CURR", "TARGET", "Risk_Score_LogOdds", (F.col("pos") + 1).alias("reason_rank"), "r.*"
    )


@query()
def global_attribution(at):
    return explain.global_attribution(t.explained(at), clean.SCORE_COLUMNS)


@query()
def counterfactual_grid(at):
    return explain.counterfactual_grid(t.scored_apps(at))


@query()
def counterfactual_actions(at):
    """Mixed moves over all actionable fields, for a regression fitted on them."""
    rows = stage(t.full_features(at).select("SK_ID_CURR", "TARGET", "AMT_INCOME_TOTAL", *explain.ACTIONABLE), "actionable")
    model = learn.fit_logistic(rows, [*explain.ACTIONABLE, "AMT_INCOME_TOTAL"])
    contracts = sorted(r[0] for r in rows.select("NAME_CONTRACT_TYPE").distinct().collect())  # two of them
    return explain.actionable_counterfactuals(rows, learn.fold(model), contracts)


@query()
def what_if_restructure(at):
    scored = t.scored_apps(at, "AMT_INCOME_TOTAL", "AMT_ANNUITY", "AMT_CREDIT")
    return explain.what_if_restructure(scored, WHAT_IF)


@query()
def response_segments(at):
    return t.response_table(at).select("SK_ID_CURR", "response_segment", "true_effect")


@query()
def cate_by_cell(at):
    return uplift.cate_by_cell(t.response_table(at), ["response_segment"])


@query()
def uplift_report(at):
    return uplift.uplift_report(t.response_with_cate(at))


@query()
def uplift_t_learner(at):
    """The report on the effects that two fitted classifiers predict, against its sizes."""
    rows, names = _training_rows(at)
    rows = stage(uplift.response_segments(rows).withColumn("TREATMENT", uplift.treatment_arm()), "response")
    model = learn.fit_t_learner(rows.where("split = 'train'"), names)
    scored = stage(learn.score_t_learner(model, rows.where("split = 'test'")), "effects")
    report = uplift.uplift_report(scored)
    sizes = scored.agg(F.count(F.lit(1)).alias("clients"), F.sum("TREATMENT").alias("treated"))
    effects = ("Persuadables_True_Effect", "LostCauses_True_Effect")
    inside = [F.col(c).between(-0.15, -0.01) for c in effects]
    return sizes.crossJoin(report).select("clients", "treated", (inside[0] & inside[1]).alias("effects_inside"))  # one row each


@query()
def fitted_notices(at):
    """Reasons of the boosted model: contributions add up to its log odds, and no client has more than four."""
    rows, names = _training_rows(at)
    model = learn.fit_gbt_benchmark(rows.where("split = 'train'"), names, trees=25)
    explained = stage(model.explain(learn.score(model, rows)).select("SK_ID_CURR", "TARGET", "PD", "contributions", "base", "score"), "explained")
    total = F.aggregate("contributions", F.col("base"), lambda a, p: a + p["contribution"])
    gap = F.greatest(F.abs(total - F.col("score")), F.abs(F.ln(F.col("PD") / (1 - F.col("PD"))) - F.col("score")))
    notices = explain.adverse_actions(explained, names)
    fine = explained.agg(F.count(F.lit(1)).alias("clients"), F.max(gap).alias("largest_gap"))
    return fine.crossJoin(notices.agg(F.max(F.size("Reasons")).alias("most_reasons")))  # one row each


@query()
def fairness_gender(at):
    return govern.fairness_metrics(t.fair_rows(at), F.col("CODE_GENDER"))


@query()
def fairness_age(at):
    return govern.fairness_metrics(t.fair_rows(at), govern.age_cohort())


@query()
def disparate_impact(at):
    return govern.disparate_impact(govern.fairness_metrics(t.fair_rows(at), F.col("CODE_GENDER")))


@query(None)
def stress_test(at):
    return govern.stress_test(t.loss_table(at))


# --- model training --------------------------------------------------------


def _training_rows(at) -> tuple[DataFrame, list[str]]:
    """All coded features and categories of every application, split by key."""
    wide = stage(t.full_features(at), "features")
    return sampling.train_test_split(wide), learn.all_features(wide)


def _single_scores(rows: DataFrame) -> DataFrame:
    """Each published score taken alone as a ranking of risk, in long form."""
    entries = [F.struct(F.lit(c).alias("model_name"), (-F.col(c)).alias("PD")) for c in SINGLE_SCORES]
    return rows.select("SK_ID_CURR", "TARGET", F.inline(F.array(*entries)))


def _facts(at, fit) -> DataFrame:
    """The fitted model against the best single score on the test side."""
    rows, names = _training_rows(at)
    model = fit(rows.where("split = 'train'"), names)
    test = rows.where("split = 'test'")
    tested = stage(learn.score(model, test).select("SK_ID_CURR", "TARGET", "PD"), "scores")
    single = metrics.roc_auc_gini(stage(_single_scores(test), "single"), by=["model_name"])
    fitted = metrics.roc_auc_gini(tested).select(F.col("roc_auc").alias("fitted_auc"))
    sizes = tested.agg(F.count(F.lit(1)).alias("test_loans"), F.sum("TARGET").alias("test_defaults"))
    best = single.agg(F.max("roc_auc").alias("best_single_auc"))
    importance = F.lit(1.0)
    if isinstance(model, learn.BoostedTreesModel):
        importance = F.lit(float(sum(share for _, share in model.importances())))
    return best.crossJoin(fitted).crossJoin(sizes).select(  # one row each
        F.lit(fit.__name__).alias("model_name"),
        F.lit(len(names)).cast("bigint").alias("features"),
        "test_loans",
        "test_defaults",
        "best_single_auc",
        (F.col("fitted_auc") > F.col("best_single_auc") - 0.05).alias("near_best_single"),
        importance.alias("importance_total"),
    )


@query()
def fit_logistic(at):
    return _facts(at, learn.fit_logistic)


@query()
def fit_gbt_benchmark(at):
    return _facts(at, learn.fit_gbt_benchmark)


@query()
def fit_gbt_champion(at):
    return _facts(at, learn.fit_gbt_champion)


@query()
def pd_score(at):
    rows, names = _training_rows(at)
    model = learn.fit_logistic(rows.where("split = 'train'"), names)
    return learn.score(model, rows).select("SK_ID_CURR", "PD")


@query()
def feature_importance(at):
    rows, names = _training_rows(at)
    return learn.feature_importance(learn.fit_gbt_benchmark(rows, names))


@query()
def fit_lgd(at):
    """The fitted regressor against the test side's own mean."""
    wide = t.full_features(at)
    chosen = [c for c in learn.LGD_FEATURES if c in wide.columns]
    needed = sorted({*chosen, "SK_ID_CURR", "NAME_CONTRACT_TYPE", "FLAG_OWN_REALTY", "FLAG_OWN_CAR"})
    rows = sampling.train_test_split(stage(wide.select(*needed), "lgd"))
    model, names, medians = learn.fit_lgd(rows.where("split = 'train'"))
    observed = loss.lgd_heuristic(rows.where("split = 'test'")).withColumnRenamed("LGD", "actual")
    scored = learn.predict_lgd(model, observed, names, medians)
    error = F.sqrt(F.avg((F.col("LGD") - F.col("actual")) ** 2))
    return scored.agg(
        F.count(F.lit(1)).alias("test_loans"),
        F.avg("actual").alias("mean_actual"),
        F.stddev_pop("actual").alias("std_actual"),
        (error < F.stddev_pop("actual")).alias("better_than_mean"),
        F.bool_and(F.col("LGD").between(0.05, 0.95)).alias("inside_bounds"),
    )


@query()
def fit_t_learner(at):
    rows, names = _training_rows(at)
    rows = rows.withColumn("TREATMENT", uplift.treatment_arm())
    model = learn.fit_t_learner(rows.where("split = 'train'"), names)
    return learn.score_t_learner(model, rows.where("split = 'test'")).select("SK_ID_CURR", "TREATMENT", "cate")
