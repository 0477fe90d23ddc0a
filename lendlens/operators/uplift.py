"""Response segments and treatment effects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lendlens.functions.columns import hash_order
from lendlens.operators.quantiles import exact_medians
from lendlens.operators.sampling import HASH_SPACE, top_bottom

PERSUADABLE, LOST_CAUSE, SURE_THING = "Persuadable", "Lost Cause", "Sure Thing"
DRIVERS = ("DEBT_TO_INCOME_RATIO", "INST_AVG_DPD", "EXT_SOURCE_MEAN")


def response_segments(df: DataFrame, medians: Mapping[str, float | None] | None = None) -> DataFrame:
    """Adds ``response_segment`` and its assumed effect on default probability; gaps count as the median."""
    medians = medians or exact_medians(df, DRIVERS)
    dti, dpd, ext = (F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in DRIVERS)
    moderate = (dti > 0.3) & (dti < 0.6) & (dpd < 30) & (ext > 0.3) & (ext < 0.6)
    segment = F.when(moderate, PERSUADABLE).when((dti > 0.6) | (dpd > 60), LOST_CAUSE).otherwise(SURE_THING)
    return df.withColumns({"response_segment": segment, "true_effect": F.when(moderate, -0.15).otherwise(-0.01)})


def treatment_arm(key: str = "SK_ID_CURR") -> Column:
    """1 for the half of the keys with the smaller hashes."""
    return F.when(hash_order(key) < HASH_SPACE // 2, 1).otherwise(0)


def cate_by_cell(df: DataFrame, cell: Sequence[str], outcome: str = "TARGET", arm: str = "TREATMENT") -> DataFrame:
    """Mean outcome per arm and their difference, per cell."""
    y, t = F.col(outcome), F.col(arm)
    grouped = df.groupBy(*cell).agg(
        F.count_if(t == 1).alias("n_treated"),
        F.count_if(t == 0).alias("n_control"),
        F.avg(F.when(t == 1, y)).alias("mean_treated"),
        F.avg(F.when(t == 0, y)).alias("mean_control"),
    )
    return grouped.withColumn("cate", F.col("mean_treated") - F.col("mean_control"))


def uplift_report(df: DataFrame, cate: str = "cate", true_effect: str = "true_effect", dti: str = "DEBT_TO_INCOME_RATIO") -> DataFrame:
    """Mean true effect and burden of the top and bottom fifth by score = -CATE (ties by key)."""
    ranked = top_bottom(df.withColumn("uplift_score", -F.col(cate)), "uplift_score")
    top, bottom = F.col("tail") == "top", F.col("tail") == "bottom"
    return ranked.agg(
        F.avg(F.when(top, F.col(true_effect))).alias("Persuadables_True_Effect"),
        F.avg(F.when(top, F.col(dti))).alias("Persuadables_Mean_DTI"),
        F.avg(F.when(bottom, F.col(true_effect))).alias("LostCauses_True_Effect"),
        F.avg(F.when(bottom, F.col(dti))).alias("LostCauses_Mean_DTI"),
    )
