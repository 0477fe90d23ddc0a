"""Closed-form default probability used when no fitted model is supplied.

logit = -4 * (mean external score - 0.5), with the scores median-filled. The
logit is linear, so attributions and counterfactuals on it are exact.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from lendlens.functions.columns import clip
from lendlens.operators.clean import SCORE_COLUMNS, median_impute
from lendlens.operators.quantiles import exact_medians

SLOPE, CENTRE = -4.0, 0.5
PD_FLOOR, PD_CAP = 0.01, 0.95


def logit_to_pd(logit: Column) -> Column:
    return clip(F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)), PD_FLOOR, PD_CAP)


def logit_of_mean(mean: Column) -> Column:
    return F.lit(SLOPE) * (mean - F.lit(CENTRE))


def pd_proxy(df: DataFrame, medians: Mapping[str, float | None] | None = None) -> DataFrame:
    """Adds EXT_SOURCE_MEAN, LOGIT and PD from the median-filled external scores."""
    medians = medians or exact_medians(df, SCORE_COLUMNS)
    filled = median_impute(df, medians, SCORE_COLUMNS)
    one, two, three = (F.col(c) for c in SCORE_COLUMNS)
    scored = filled.withColumn("EXT_SOURCE_MEAN", (one + two + three) / 3)
    scored = scored.withColumn("LOGIT", logit_of_mean(F.col("EXT_SOURCE_MEAN")))
    return scored.withColumn("PD", logit_to_pd(F.col("LOGIT")))


def pd_proxy_from_mean(df: DataFrame, median: float, mean: str = "EXT_SOURCE_MEAN") -> DataFrame:
    """PD from an existing mean-score column, gaps filled with its median."""
    return df.withColumn("PD", logit_to_pd(logit_of_mean(F.coalesce(F.col(mean), F.lit(median)))))
