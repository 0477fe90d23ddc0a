"""Derived tables shared by the registered queries.

Tables that are read in several passes are staged once (see ``session.stage``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendlens.operators import clean, explain, features, govern, loss, sampling, scoring, segments, survival, uplift
from lendlens.sources import fixture
from lendlens.sources.session import stage, stage_bucketed

Inputs = tuple[SparkSession, str]


def raw_apps(at: Inputs, *columns: str) -> DataFrame:
    apps = fixture.applications(*at)
    return apps.select(*columns) if columns else apps


def staged_apps(at: Inputs, *columns: str) -> DataFrame:
    return stage(raw_apps(at, *columns), "applications")


def by_client(df: DataFrame, label: str) -> DataFrame:
    """``df`` staged in as many buckets of the client key as a shuffle has partitions.

    Joins of such tables on the key, and group-bys by it, move no rows, however many of them follow.
    """
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage_bucketed(df, ["SK_ID_CURR"], buckets, label)


def client_aggregate(at: Inputs, build, cleaned: bool = False) -> DataFrame:
    """Client-level instalment aggregate, restricted to known clients afterwards."""
    lines = fixture.instalment_lines(*at)
    grouped = build(clean.clean_instalments(lines) if cleaned else lines)
    return fixture.known_clients(grouped, at[1])


def clean_apps(at: Inputs) -> DataFrame:
    return clean.clean_applications(staged_apps(at))


def clean_lines(at: Inputs) -> DataFrame:
    """Cleaned instalments for left joins, which restrict them to known clients anyway."""
    return clean.clean_instalments(fixture.instalment_lines(*at))


def feature_table(at: Inputs) -> DataFrame:
    return features.feature_matrix(clean_apps(at), clean_lines(at))


def feature_sides(at: Inputs) -> tuple[DataFrame, DataFrame]:
    """Cleaned applications and instalments, both in buckets of the client key."""
    return by_client(clean_apps(at), "apps"), by_client(clean_lines(at), "lines")


def full_features(at: Inputs) -> DataFrame:
    """Every coded and published feature, one row per application, no gaps in numbers."""
    apps = features.metadata_app_features(features.application_features(clean_apps(at)))
    joined = features.attach_instalments(apps, features.client_features(clean_lines(at)))
    return joined.fillna(0, clean.numeric_columns(joined))


def scored_apps(at: Inputs, *extra: str) -> DataFrame:
    """Key, label, median-filled scores, LOGIT and PD (plus ``extra`` columns)."""
    return scoring.pd_proxy(staged_apps(at, "SK_ID_CURR", "TARGET", *clean.SCORE_COLUMNS, *extra))


def loss_table(at: Inputs, matrix: DataFrame | None = None) -> DataFrame:
    """Loan-level expected loss of the whole portfolio, without any fitted model."""
    scored = scoring.pd_proxy_from_mean(feature_table(at) if matrix is None else matrix, 0.5)
    return loss.expected_loss(loss.ead_static(loss.lgd_heuristic(scored)))


def survival_table(at: Inputs, *keep: str) -> DataFrame:
    return survival.survival_dataset(feature_table(at), keep)


def repayment_targets(at: Inputs) -> DataFrame:
    profiles = segments.client_repayment(fixture.instalment_lines(*at))
    return segments.repay_target_join(raw_apps(at), profiles)


def model_scores(at: Inputs) -> DataFrame:
    """Three deterministic scores in long form (model, key, label, PD)."""
    scored = scored_apps(at)
    one, two, three = (F.col(c) for c in clean.SCORE_COLUMNS)
    means = {"mean_score": F.col("EXT_SOURCE_MEAN"), "bureau_2": two, "weighted": (one * 2 + two * 3 + three) / 6}
    entries = [
        F.struct(F.lit(n).alias("model_name"), scoring.logit_to_pd(scoring.logit_of_mean(m)).alias("PD"))
        for n, m in means.items()
    ]
    return scored.select("SK_ID_CURR", "TARGET", F.inline(F.array(*entries)))


def explained(at: Inputs) -> DataFrame:
    return explain.proxy_contributions(scored_apps(at))


def response_table(at: Inputs) -> DataFrame:
    """Drivers, response segment, burden band and hash-assigned arm per client."""
    wanted = ["SK_ID_CURR", "TARGET", *uplift.DRIVERS]
    narrow = stage(feature_table(at).select(*wanted), "response")
    dti = F.col("DEBT_TO_INCOME_RATIO")
    return uplift.response_segments(narrow).withColumns(
        {
            "TREATMENT": uplift.treatment_arm(),
            "dti_band": F.when(dti < 0.1, "low").when(dti < 0.3, "mid").otherwise("high"),
        }
    )


def response_with_cate(at: Inputs) -> DataFrame:
    rows = response_table(at)
    cells = uplift.cate_by_cell(rows, ["response_segment", "dti_band"])
    cate = cells.select("response_segment", "dti_band", F.coalesce("cate", F.lit(0.0)).alias("cate"))
    # At most 3 segments x 3 bands.
    joined = rows.join(F.broadcast(cate), ["response_segment", "dti_band"])
    return stage(joined.select("SK_ID_CURR", "cate", "true_effect", "DEBT_TO_INCOME_RATIO"), "cate")


def fair_rows(at: Inputs) -> DataFrame:
    return scored_apps(at, "CODE_GENDER", "DAYS_BIRTH").withColumn("declined", govern.declined())


def cox_design(at: Inputs) -> tuple[DataFrame, list[str]]:
    """Staged survival rows with z-scored covariates and a stratified split."""
    wide = full_features(at)
    covariates = [c for c in survival.COVARIATES if c in wide.columns]
    rows = stage(survival.survival_dataset(wide, covariates), "survival")
    scaled = survival.standardize(rows, survival.learn_scalers(rows, covariates))
    return stage(sampling.stratified_split(scaled, "event"), "design"), covariates
